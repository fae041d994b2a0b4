"""The lines of a match are shuffled once, as numbers, for all its lists."""

import re

import __spark_entry__ as entry
import pytest

from arenamart.plans.catalogue.star import Star

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "name, lists", [("coverage_flags", 4), ("coverage_report", 4), ("coverage_sample", 0), ("fact_match_players", 3)]
)
def test_lines_are_shuffled_once(spark, name, lists):
    if lists:
        df = entry.queries()[name](spark, SF)
    else:  # the flags that the sample is chosen from
        df, lists = Star(spark, SF).coverage_documents(), 4
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"ReusedExchange \[ok#\d+L, line#", plan)) >= lists


def test_players_meet_their_lists_without_another_shuffle(spark):
    documents = Star(spark, SF).driver.documents()
    plan = documents._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "ENSURE_REQUIREMENTS" not in plan
