"""Metric layer: measures over the star schema, with filters that follow its links.

A selection on a dimension keeps the fact rows that refer to it (a semi join per link). Three links
also pass the selection upwards: player fact to match, team bridge to match, role to hero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fact -> {dimension: (fact column, dimension key)}
LINKS: dict[str, dict[str, tuple[str, str]]] = {
    "fact_matches": {
        "dim_date": ("start_date", "date"),
        "dim_league": ("leagueid", "leagueid"),
        "dim_game_mode": ("game_mode_id", "game_mode_id"),
        "dim_lobby_type": ("lobby_type_id", "lobby_type_id"),
        "dim_region": ("region_id", "region_id"),
        "dim_patch": ("patch", "patch_id"),
    },
    "fact_match_players": {
        "dim_player": ("account_id", "account_id"),
        "dim_hero": ("hero_id", "hero_id"),
        "dim_item": ("item_0", "item_id"),
    },
    "fact_team_matches": {"dim_team": ("team_id", "team_id")},
    "fact_picks_bans": {"dim_hero": ("hero_id", "hero_id")},
    "fact_hero_matchups": {"dim_hero": ("radiant_hero_id", "hero_id")},
    "fact_team_h2h": {"dim_team": ("team_a_id", "team_id")},
    "fact_teamfight_players": {
        "dim_hero": ("hero_id", "hero_id"),
        "dim_player": ("account_id", "account_id"),
    },
    "fact_teamfight_ability_uses": {
        "dim_hero": ("hero_id", "hero_id"),
        "dim_player": ("account_id", "account_id"),
    },
}
# Second links, used only on request.
ROLE_PLAYING = {
    ("fact_hero_matchups", "dim_hero"): "dire_hero_id",
    ("fact_team_h2h", "dim_team"): "team_b_id",
}
# Facts whose selection also narrows the matches.
UPWARD = ["fact_match_players", "fact_team_matches"]
HUB = "fact_matches"


def keep(df: DataFrame, col: str, selected: DataFrame, key: str) -> DataFrame:
    """Rows that refer to a selected member."""
    members = selected.select(F.col(key).alias("__member"))
    return df.join(members, F.col(col) == F.col("__member"), "left_semi")


def slice_fact(
    tables: dict[str, DataFrame],
    fact: str,
    selections: dict[str, DataFrame],
    role: dict[str, str] | None = None,
) -> DataFrame:
    """One fact under selections (dimension name -> chosen rows).

    ``role`` names another fact column for a dimension, such as the dire hero of a pairing.
    """
    df = tables[fact]
    for dim, chosen in selections.items():
        if dim in LINKS.get(fact, {}):
            col, key = LINKS[fact][dim]
            df = keep(df, (role or {}).get(dim, col), chosen, key)
    return df


def selected_heroes(heroes: DataFrame, roles: DataFrame) -> DataFrame:
    """A selection of roles narrows the heroes."""
    return keep(heroes, "hero_id", roles, "hero_id")


def slice_star(
    tables: dict[str, DataFrame], selections: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """All facts under selections, with the upward links.

    Selections on players, heroes, items and teams narrow the matches; the narrowed matches then
    narrow every fact that carries a match id.
    """
    chosen = dict(selections)
    if "dim_hero_role" in chosen:
        heroes = chosen.get("dim_hero", tables["dim_hero"])
        chosen["dim_hero"] = selected_heroes(heroes, chosen.pop("dim_hero_role"))
    out = {f: slice_fact(tables, f, chosen) for f in tables if f.startswith("fact_")}
    hub = out[HUB]
    for fact in UPWARD:
        if fact in out and any(d in LINKS[fact] for d in chosen):
            hub = keep(hub, "match_id", out[fact], "match_id")
    out[HUB] = hub
    for fact, df in out.items():
        if fact != HUB and "match_id" in df.columns:
            out[fact] = keep(df, "match_id", hub, "match_id")
    return out


def _share(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")


def row_count(fact: DataFrame, by: list[str], name: str) -> DataFrame:
    return fact.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def total_matches(matches: DataFrame, by: list[str] = ()) -> DataFrame:
    return row_count(matches, list(by), "total_matches")


def total_picks(picks_bans: DataFrame, by: list[str] = ()) -> DataFrame:
    return row_count(picks_bans, list(by), "total_picks")


def total_players(players: DataFrame, by: list[str] = ()) -> DataFrame:
    return row_count(players, list(by), "total_players")


def radiant_win_rate(matches: DataFrame, by: list[str] = ()) -> DataFrame:
    """Share of radiant wins among all matches, draws included."""
    share = _share(F.count_if("radiant_win"), F.count(F.lit(1)))
    return matches.groupBy(*by).agg(share.alias("radiant_win_rate"))


def avg_duration(matches: DataFrame, by: list[str] = ()) -> DataFrame:
    mean = _share(F.sum("duration_sec"), F.count("duration_sec"))
    return matches.groupBy(*by).agg(mean.alias("avg_duration"))


def _record(fact: DataFrame, by: list[str], names: tuple[str, str, str]) -> DataFrame:
    games, wins = F.count(F.lit(1)), F.count_if("team_win")
    return fact.groupBy(*by).agg(
        games.alias(names[0]), wins.alias(names[1]), _share(wins, games).alias(names[2])
    )


def hero_record(players: DataFrame, by: list[str]) -> DataFrame:
    """Picks, wins and win rate by any columns of the player fact."""
    return _record(players, by, ("hero_picks", "hero_wins", "hero_win_rate"))


def team_record(team_matches: DataFrame, by: list[str]) -> DataFrame:
    """Matches, wins and win rate of teams on either side."""
    return _record(team_matches, by, ("team_matches", "team_wins", "team_win_rate"))


def heroes_in_matches(heroes: DataFrame, players: DataFrame, matches: DataFrame) -> DataFrame:
    """Heroes that were played in the given matches."""
    played = keep(players, "match_id", matches, "match_id")
    return keep(heroes, "hero_id", played, "hero_id")
