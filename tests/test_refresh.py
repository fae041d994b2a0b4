"""A full refresh parses each match once."""

import pytest

from arenamart import session
from arenamart.plans import pipeline
from arenamart.plans.catalogue import loading
from arenamart.plans.catalogue.star import Star

SF = "/root/testdata/sf0.001"


def test_a_refresh_parses_half_of_the_matches_once(spark, monkeypatch):
    class Seen(Exception):
        pass

    def stop(nested, *_):
        raise Seen("from_json" in nested._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(pipeline, "extend_silver", stop)
    with pytest.raises(Seen, match="False"):
        loading._run_refresh(Star(session.apply_match_settings(spark), SF))
