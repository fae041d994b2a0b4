"""Match analytics on Spark: nested match documents to a checked star schema."""
