"""Skill rows are shuffled before the texts of abilities make them wide."""

from arenamart.operators import facts
from arenamart.plans.catalogue.star import Star

SF = "/root/testdata/sf0.001"


def test_skill_rows_meet_names_before_ability_texts(spark):
    star = Star(spark, SF)
    rows = facts.fact_match_player_skills(
        star.silver("stg_match_player_skills"), star.minute_fact, star.constants("abilities", "ability_ids"), star.people, star.heroes
    )
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    texts, names = (next(i for i, line in enumerate(joins) if part in line) for part in ("replace(", "coalesce(account_id"))
    assert texts < names  # an outer operator is printed before what it reads
