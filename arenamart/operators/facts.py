"""Gold facts and bridges.

Rows of one match (players, draft, fights) are bounded by the document they came from, so windows
and small collections per match are safe. Everything keyed by hero, account, team or league is an
aggregate that combines before its shuffle, or is split first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenamart import fixed_values as fv
from arenamart import schemas
from arenamart.functions.columns import (
    blank_to_null,
    hosted_image,
    hours,
    ladder,
    like_any,
    minutes,
    position_slot,
    position_team,
    rate,
    team_side,
    to_int,
)
from arenamart.functions.relations import (
    lookup,
    number_rows,
    rank_rows,
    top_per_key,
    unpivot_rows,
)
from arenamart.operators.staging import resource_entries

# Matches and teams -------------------------------------------------------------------------------


def team_sides(matches: DataFrame) -> DataFrame:
    """One row per (match, side with a known team), in one pass over the matches."""
    win = F.col("radiant_win")

    def side(name: str, own: str, other: str, won: Column) -> list[Column]:
        return [
            F.col("match_id"),
            F.lit(name).alias("side"),
            F.col(f"{own}_team_id").alias("team_id"),
            win.alias("radiant_win"),
            won.alias("team_win"),
            F.col(f"{own}_score").alias("team_score"),
            F.col(f"{other}_score").alias("opponent_score"),
            F.col("leagueid"),
        ]

    rows = unpivot_rows(
        matches,
        [side(fv.RADIANT, "radiant", "dire", win), side(fv.DIRE, "dire", "radiant", ~win)],
    )
    return rows.where("team_id is not null")


def league_ranks(sides: DataFrame) -> DataFrame:
    """Rank of every team within its league: wins, then win rate, then id.

    For equal wins a higher rate means fewer games, so (wins, games) orders like (wins, rate) as
    long as the rounded rate keeps them apart; the rate itself is used so that ties stay ties.
    """
    wins = F.count_if(F.col("team_win"))
    table = sides.groupBy("leagueid", "team_id").agg(
        wins.alias("wins"), rate(wins, F.count(F.lit(1))).alias("win_rate")
    )
    return rank_rows(
        table,
        ["leagueid"],
        [("wins", True), ("win_rate", True)],
        [F.col("team_id").asc_nulls_last()],
        "league_rank",
    )


def fact_team_matches(matches: DataFrame) -> DataFrame:
    sides = team_sides(matches)
    ranks = league_ranks(sides).select("leagueid", "team_id", "league_rank")
    return sides.join(ranks, ["leagueid", "team_id"], "left").select(
        "match_id",
        "side",
        "team_id",
        "radiant_win",
        "team_win",
        "team_score",
        "opponent_score",
        "league_rank",
    )


def hero_lists(players: DataFrame, heroes: DataFrame) -> DataFrame:
    """Hero names per match and side in slot order; heroes that are not listed are left out."""
    named = players.join(
        heroes.select("hero_id", F.coalesce("localized_name", F.lit("Unknown")).alias("name")),
        "hero_id",
    ).select("match_id", "team_number", "name", F.col("player_slot").cast("int").alias("slot"))

    def names(team: str) -> Column:
        return F.expr(
            "listagg(name, ', ') within group (order by slot)"
            f" filter (where team_number = '{team}')"
        )

    return named.groupBy("match_id").agg(
        names("0").alias("radiant_heroes"), names("1").alias("dire_heroes")
    )


def fact_matches(
    matches: DataFrame, players: DataFrame, heroes: DataFrame, teams: DataFrame
) -> DataFrame:
    """Hub fact. ``teams`` needs team_id, team_name and logo_url."""
    gap = F.abs(F.col("radiant_score") - F.col("dire_score"))
    rows = matches
    for side in ("radiant", "dire"):
        names = {"team_name": f"{side}_team_name", "logo_url": f"{side}_team_logo"}
        rows = lookup(rows, teams, f"{side}_team_id", "team_id", names)
    rows = rows.join(hero_lists(players, heroes), "match_id", "left")
    winner = F.col("winner")
    return rows.select(
        "match_id",
        "radiant_win",
        "winner",
        "duration_sec",
        minutes(F.col("duration_sec")).alias("duration_min"),
        hours(F.col("duration_sec")).alias("duration_hour"),
        F.col("game_mode").alias("game_mode_id"),
        F.col("lobby_type").alias("lobby_type_id"),
        F.col("region").alias("region_id"),
        "patch",
        "start_time",
        F.to_date("start_time").alias("start_date"),
        "radiant_score",
        "dire_score",
        ladder(gap, fv.SCORE_BUCKETS, fv.SCORE_BUCKET_REST).alias("score_bucket"),
        "radiant_team_id",
        "dire_team_id",
        "has_radiant_team",
        "has_dire_team",
        "leagueid",
        "first_blood_time",
        "human_players",
        "pre_game_duration",
        "loaded_at",
        F.when(winner.isin("radiant", "dire"), F.initcap(winner)).otherwise("Draw").alias(
            "winner_name"
        ),
        "radiant_team_name",
        "dire_team_name",
        "radiant_team_logo",
        "dire_team_logo",
        "radiant_heroes",
        "dire_heroes",
    )


def fact_team_h2h(matches: DataFrame, teams: DataFrame) -> DataFrame:
    """Decided matches of two known teams, the team whose id sorts first (as text) as team A."""
    first, second = F.col("radiant_team_id"), F.col("dire_team_id")
    in_order = first < second
    win = F.col("radiant_win")
    rows = matches.where("has_radiant_team and has_dire_team and radiant_win is not null").select(
        "match_id",
        F.least(first, second).alias("team_a_id"),
        F.greatest(first, second).alias("team_b_id"),
        F.when(in_order, win).otherwise(~win).alias("team_a_win"),
        F.when(in_order, F.col("radiant_score")).otherwise(F.col("dire_score")).alias("team_a_score"),
        F.when(in_order, F.col("dire_score")).otherwise(F.col("radiant_score")).alias("team_b_score"),
    )
    rows = lookup(rows, teams, "team_a_id", "team_id", {"team_name": "team_a_name"})
    rows = lookup(rows, teams, "team_b_id", "team_id", {"team_name": "team_b_name"})
    return rows.select(
        "match_id",
        "team_a_id",
        "team_b_id",
        "team_a_name",
        "team_b_name",
        "team_a_win",
        "team_a_score",
        "team_b_score",
    )


# Draft -------------------------------------------------------------------------------------------


def fact_picks_bans(drafts: DataFrame) -> DataFrame:
    return drafts.select(
        "match_id",
        "order_no",
        "order_no_int",
        "hero_id",
        "is_pick",
        "team_number",
        "active_team",
        "player_slot",
        "loaded_at",
    )


def _draft_order() -> list[Column]:
    return [
        F.col("order_no_int").asc_nulls_last(),
        F.col("order_no").asc_nulls_last(),
        F.col("hero_id").asc_nulls_last(),
    ]


def draft_sequences(drafts: DataFrame) -> DataFrame:
    """Draft rows with their number among the own team's and among all picks (or bans).

    Distributing by match first lets both windows and later per-match steps share one shuffle.
    """
    by_match = drafts.repartition("match_id")
    rows = number_rows(by_match, ["match_id", "active_team", "is_pick"], _draft_order(), "team_seq")
    return number_rows(rows, ["match_id", "is_pick"], _draft_order(), "global_seq")


def pick_ban_sequence(drafts: DataFrame) -> DataFrame:
    """Per match and hero: its number among the picks and among the bans."""
    rows = number_rows(drafts, ["match_id", "is_pick"], _draft_order(), "seq")
    return rows.groupBy("match_id", "hero_id").agg(
        F.max(F.when(F.col("is_pick"), F.col("seq"))).alias("pick_sequence"),
        F.max(F.when(~F.col("is_pick"), F.col("seq"))).alias("ban_sequence"),
    )


def longest_draft(drafts: DataFrame) -> DataFrame:
    """One row: the greatest number of picks, or bans, that one team made in one match."""
    runs = drafts.groupBy("match_id", "active_team", "is_pick").agg(F.count(F.lit(1)).alias("n"))
    return runs.agg(F.coalesce(F.max("n"), F.lit(fv.DEFAULT_DRAFT_SLOTS)).cast("int").alias("n"))


def fact_draft_sequence(drafts: DataFrame, heroes: DataFrame) -> DataFrame:
    """Grid of (match, draft slot) with each team's pick and ban of that slot.

    The number of slots follows the longest draft in the data. Each match is folded into one map
    from (team, pick, number) to the entry, which the grid rows read; there is no grid join.
    """
    entry = F.struct(F.col("hero_id").alias("hero"), F.col("global_seq").alias("seq"))
    key = F.concat_ws("/", "active_team", F.col("is_pick").cast("string"), "team_seq")
    usable = F.col("active_team").isNotNull() & F.col("is_pick").isNotNull()
    folded = (
        draft_sequences(drafts)
        .groupBy("match_id")
        .agg(
            F.map_from_entries(
                F.collect_list(F.when(usable, F.struct(key.alias("k"), entry.alias("v"))))
            ).alias("entries")
        )
    )
    slots = longest_draft(drafts).scalar()
    grid = folded.select(
        "match_id", "entries", F.explode(F.sequence(F.lit(1), slots)).alias("slot")
    )
    parts = [
        (f"{team.lower()}_{what}", team, picked)
        for team in (fv.DIRE, fv.RADIANT)
        for what, picked in (("pick", "true"), ("ban", "false"))
    ]

    def at(team: str, picked: str) -> Column:
        return F.try_element_at(
            F.col("entries"), F.concat(F.lit(f"{team}/{picked}/"), F.col("slot").cast("string"))
        )

    rows = grid.select(
        "match_id",
        "slot",
        *[at(t, b).getField("hero").alias(f"__{n}") for n, t, b in parts],
        *[at(t, b).getField("seq").alias(f"{n}_seq") for n, t, b in parts],
    )
    for name, _, _ in parts:
        shown = {"hero_localized_name": f"{name}_hero", "img": f"{name}_hero_img"}
        rows = lookup(rows, heroes, f"__{name}", "hero_id", shown)
    columns = [c for n, _, _ in parts for c in (f"{n}_hero", f"{n}_hero_img", f"{n}_seq")]
    return rows.select("match_id", "slot", *columns)


# Fights ------------------------------------------------------------------------------------------


def fight_phase(start: Column) -> Column:
    """Phase by start second; an unknown start counts as late."""
    return (
        F.when(start < 0, fv.PHASE_PREGAME)
        .when(start < 20 * 60, fv.PHASE_EARLY)
        .when(start < 40 * 60, fv.PHASE_MID)
        .otherwise(fv.PHASE_LATE)
    )


def fact_teamfights(fights: DataFrame) -> DataFrame:
    return fights.select(
        "match_id",
        "teamfight_id",
        "start_time",
        "end_time",
        "last_death",
        minutes(F.col("start_time")).alias("start_min"),
        minutes(F.col("end_time")).alias("end_min"),
        minutes(F.col("last_death")).alias("last_death_min"),
        fight_phase(F.col("start_time")).alias("fight_phase"),
        "deaths",
        "duration_sec",
        minutes(F.col("duration_sec")).alias("duration_min"),
        "players",
        "loaded_at",
    )


def _fight_members(fights: DataFrame, fields: list[str], *keep: str) -> DataFrame:
    members = F.from_json("players", schemas.fight_players(fields))
    return fights.select(
        "match_id", "teamfight_id", *keep, F.posexplode(members).alias("at", "m")
    ).withColumn("position", F.col("at") + 1)


def fact_teamfight_players(fights: DataFrame, players: DataFrame) -> DataFrame:
    """One row per (fight, position); position gives the slot, the slot the player."""
    numbers = ["damage", "healing", "deaths", "buybacks", "xp_start", "xp_end", "xp_delta", "gold_delta"]
    texts = ["ability_uses", "item_uses", "ability_targets", "killed", "deaths_pos"]
    rows = _fight_members(
        fights, [*numbers, *texts], "start_time", "end_time", "loaded_at"
    ).select(
        "match_id",
        "teamfight_id",
        F.col("start_time").alias("teamfight_start"),
        F.col("end_time").alias("teamfight_end"),
        position_slot(F.col("position")).alias("player_slot"),
        *[to_int(F.col(f"m.{n}")).alias(n) for n in numbers],
        *[F.col(f"m.{n}").alias(n) for n in texts],
        "loaded_at",
    )
    who = players.select("match_id", "player_slot", "hero_id", "account_id")
    return rows.join(who, ["match_id", "player_slot"], "left").select(
        "match_id",
        "teamfight_id",
        "teamfight_start",
        "teamfight_end",
        "player_slot",
        "hero_id",
        "account_id",
        *numbers,
        *texts,
        "loaded_at",
    )


def fact_teamfight_ability_uses(fight_players: DataFrame) -> DataFrame:
    rows = fight_players.select(
        "match_id",
        "teamfight_id",
        "player_slot",
        "hero_id",
        "account_id",
        F.explode(F.from_json("ability_uses", "map<string,string>")).alias("ability_name", "uses"),
    )
    return rows.withColumn("uses", F.col("uses").cast("int"))


def fact_phase_momentum(fights: DataFrame, matches: DataFrame) -> DataFrame:
    """Gold, experience and deaths per (match, team, phase). Pre-game fights are left out.

    Every fight has one first member per team, so counting those counts the fights without a
    distinct step.
    """
    rows = _fight_members(
        fights.where(F.col("fight_phase") != fv.PHASE_PREGAME),
        ["gold_delta", "xp_delta", "deaths"],
        "fight_phase",
    ).select(
        "match_id",
        "fight_phase",
        position_team(F.col("position")).alias("team_number"),
        *[
            F.coalesce(to_int(F.col(f"m.{n}")), F.lit(0)).alias(n)
            for n in ("gold_delta", "xp_delta", "deaths")
        ],
        F.col("position").isin(1, fv.PLAYERS_PER_SIDE + 1).alias("is_first"),
    )
    swings = rows.groupBy("match_id", "team_number", "fight_phase").agg(
        *[F.sum(n).alias(n) for n in ("gold_delta", "xp_delta", "deaths")],
        F.count_if("is_first").alias("fights"),
    )
    phase_order = (
        F.when(F.col("fight_phase") == fv.PHASE_EARLY, 0)
        .when(F.col("fight_phase") == fv.PHASE_MID, 1)
        .otherwise(2)
    )
    outcome = matches.select("match_id", "radiant_win", "duration_min")
    team, win = F.col("team_number"), F.col("radiant_win")
    return swings.join(outcome, "match_id", "left").select(
        "match_id",
        "team_number",
        team_side(team).alias("side"),
        "fight_phase",
        phase_order.alias("phase_ord"),
        "gold_delta",
        "xp_delta",
        "deaths",
        "fights",
        "radiant_win",
        "duration_min",
        F.when(team == "0", win).otherwise(~win).alias("team_win"),
    )


# Player fact and its parts -----------------------------------------------------------------------


def team_comp_signature(players: DataFrame) -> DataFrame:
    """Hero ids of a team, in text order, joined by underscores."""
    return players.groupBy("match_id", "team_number").agg(
        F.nullif(F.array_join(F.array_sort(F.collect_list("hero_id")), "_"), F.lit("")).alias(
            "comp_sig"
        )
    )


def hero_win_rate(players: DataFrame) -> DataFrame:
    """Games, wins and win rate per hero; undecided games and the unknown hero do not count."""
    decided = players.where(
        (F.col("hero_id") != fv.UNKNOWN_HERO_ID) & F.col("team_win").isNotNull()
    )
    wins = F.count_if("team_win")
    return decided.groupBy("hero_id").agg(
        F.count(F.lit(1)).alias("hero_games"),
        wins.alias("hero_wins"),
        rate(wins, F.count(F.lit(1))).alias("hero_win_rate"),
    )


def top3_skills(ability_uses: DataFrame) -> DataFrame:
    """The three most used abilities of each player as text; equal counts go by name."""
    totals = ability_uses.groupBy("match_id", "player_slot", "ability_name").agg(
        F.sum("uses").alias("uses")
    )
    order = [F.col("uses").desc_nulls_first(), F.col("ability_name").asc_nulls_last()]
    best = top_per_key(totals, ["match_id", "player_slot"], order, 3, "place")
    text = F.concat(F.col("ability_name"), F.lit(" x"), F.col("uses").cast("string"))
    return (
        best.withColumn("shown", text)
        .groupBy("match_id", "player_slot")
        .agg(F.expr("listagg(shown, ', ') within group (order by place)").alias("top_skills"))
    )


def phase_pivot(momentum: DataFrame) -> DataFrame:
    """Gold and experience swing of the three phases as columns."""

    def of(measure: str, phase: int) -> Column:
        return F.max(F.when(F.col("phase_ord") == phase, F.col(measure)))

    return momentum.groupBy("match_id", "team_number").agg(
        *[
            of(f"{what}_delta", number).alias(f"{what}_{name}")
            for what in ("gold", "xp")
            for number, name in enumerate(("early", "mid", "late"))
        ]
    )


def enemy_kill_count(kills: DataFrame) -> DataFrame:
    return kills.groupBy("match_id", "player_slot").agg(
        F.count(F.lit(1)).alias("enemy_heroes_killed")
    )


def support_items(purchases: DataFrame) -> DataFrame:
    """Bought support items per player and their price-weighted sum."""
    counts = [
        F.count_if(F.col("item_internal_name") == item).alias(column)
        for item, column, _ in fv.SUPPORT_ITEMS
    ]
    gold = sum((F.col(column) * price for _, column, price in fv.SUPPORT_ITEMS), F.lit(0))
    return (
        purchases.groupBy("match_id", "player_slot")
        .agg(*counts)
        .withColumn("support_gold", gold.cast("bigint"))
    )


def damage_by_type(damage: DataFrame) -> DataFrame:
    return damage.groupBy("match_id", "player_slot").agg(
        *[
            F.sum(F.when(F.col("damage_type") == kind, F.col("damage_amount"))).alias(
                f"damage_taken_{kind.lower()}"
            )
            for kind in fv.DAMAGE_TYPES
        ]
    )


ITEM_SLOTS = ["item_0", "item_1", "item_2", "item_3", "item_4", "item_5", "item_neutral"]


def item_slot_decode(players: DataFrame, items: DataFrame) -> DataFrame:
    """Item names for the seven slots. The lookups share one scan of the item dimension."""
    rows = players
    for slot in ITEM_SLOTS:
        rows = lookup(rows, items, slot, "item_id", {"item_name": f"{slot}_name"})
    return rows


PLAYER_FACT = [
    "match_id", "player_slot", "account_id", "hero_id", "team_number", "side", "team_win",
    "comp_sig",
    "hero_games", "hero_win_rate", "top_skills",
    *[f"{slot}_name" for slot in ITEM_SLOTS],
    "gold_early", "gold_mid", "gold_late", "xp_early", "xp_mid", "xp_late",
    "kills", "deaths", "assists", "kda", "gold", "gold_spent", "net_worth", "gold_per_min",
    "xp_per_min",
    "hero_damage", "hero_healing", "tower_damage", "tower_kills", "stuns", "last_hits",
    "denies",
    "camps_stacked", "creeps_stacked", "neutral_kills", "rune_pickups", "obs_placed",
    "sen_placed",
    "observer_kills", "sentry_kills", "purchase_ward_observer", "purchase_ward_sentry",
    "level",
    "pick_sequence", "ban_sequence", "enemy_heroes_killed",
    *[column for _, column, _ in fv.SUPPORT_ITEMS],
    "support_gold",
    *[f"damage_taken_{kind.lower()}" for kind in fv.DAMAGE_TYPES],
    *ITEM_SLOTS,
    "backpack_0", "backpack_1", "backpack_2", "backpack_3", "leaver_status", "randomed",
    "firstblood_claimed", "buyback_count", "loaded_at",
]


def _per_match(df: DataFrame, key: str, values: list[str], name: str) -> DataFrame:
    """Fold per-player or per-team rows of a match into one map row per match."""
    entry = F.struct(F.col(key).alias("k"), F.struct(*values).alias("v"))
    return (
        df.where(F.col(key).isNotNull() & F.col("match_id").isNotNull())
        .groupBy("match_id")
        .agg(F.map_from_entries(F.collect_list(entry)).alias(name))
    )


def fact_match_players(
    players: DataFrame,
    items: DataFrame,
    ability_uses: DataFrame,
    momentum: DataFrame,
    drafts: DataFrame,
    kills: DataFrame,
    purchases: DataFrame,
    damage_taken_type: DataFrame,
) -> DataFrame:
    """Player fact with all enrichments.

    The enrichments have different keys (slot, team, hero) that all start with the match. Each is
    folded into one small map per match, so the wide player rows are distributed once, by match,
    instead of once per kind of key.
    """
    parts = [
        (team_comp_signature(players), "team_number", ["comp_sig"]),
        (phase_pivot(momentum), "team_number", [
            "gold_early", "gold_mid", "gold_late", "xp_early", "xp_mid", "xp_late",
        ]),
        (pick_ban_sequence(drafts), "hero_id", ["pick_sequence", "ban_sequence"]),
        (top3_skills(ability_uses), "player_slot", ["top_skills"]),
        (enemy_kill_count(kills), "player_slot", ["enemy_heroes_killed"]),
        (support_items(purchases), "player_slot", [
            *[column for _, column, _ in fv.SUPPORT_ITEMS], "support_gold",
        ]),
        (damage_by_type(damage_taken_type), "player_slot", [
            f"damage_taken_{kind.lower()}" for kind in fv.DAMAGE_TYPES
        ]),
    ]
    rows = item_slot_decode(players, items)
    rows = lookup(
        rows,
        hero_win_rate(players),
        "hero_id",
        "hero_id",
        {"hero_games": "hero_games", "hero_win_rate": "hero_win_rate"},
    )
    extra: list[Column] = []
    for i, (df, key, values) in enumerate(parts):
        carried = rows.columns
        rows = rows.join(_per_match(df, key, values, "__part"), "match_id", "left")
        # Only the entry of the row's own key is carried on, not the map.
        entry = F.try_element_at(F.col("__part"), F.col(key)).alias(f"__found_{i}")
        rows = rows.select(*carried, entry)
        extra += [F.col(f"__found_{i}.{v}").alias(v) for v in values]
    return rows.select("*", team_side(F.col("team_number")).alias("side"), *extra).select(
        *PLAYER_FACT
    )


# Heroes ------------------------------------------------------------------------------------------


def hero_pairs(players: DataFrame, matches: DataFrame) -> DataFrame:
    """Radiant hero, dire hero and the number of such pairings, per decided match.

    Players are counted per (match, team, hero) first, so a match folds to at most one entry per
    known hero and team, however many player rows it has.
    """
    known = players.where(
        (F.col("hero_id") != fv.UNKNOWN_HERO_ID) & F.col("team_number").isin("0", "1")
    )
    counted = known.groupBy("match_id", "team_number", "hero_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    entry = F.struct("hero_id", "n")

    def team(number: str) -> Column:
        return F.collect_list(F.when(F.col("team_number") == number, entry))

    lines = counted.groupBy("match_id").agg(team("0").alias("r"), team("1").alias("d"))
    decided = matches.where("radiant_win is not null").select("match_id", "radiant_win")
    return (
        decided.join(lines, "match_id")
        .select("match_id", "radiant_win", F.explode("r").alias("r"), "d")
        .select("match_id", "radiant_win", "r", F.explode("d").alias("d"))
        .select(
            "match_id",
            F.col("r.hero_id").alias("radiant_hero_id"),
            F.col("d.hero_id").alias("dire_hero_id"),
            (F.col("r.n") * F.col("d.n")).alias("games"),
            "radiant_win",
        )
    )


def _versus(a: str, b: str) -> Column:
    return F.concat(F.col(a), F.lit(" vs "), F.col(b))


def _label_pairs(pairs: DataFrame, heroes: DataFrame) -> DataFrame:
    rows = lookup(pairs, heroes, "radiant_hero_id", "hero_id", {"hero_localized_name": "__r"})
    rows = lookup(rows, heroes, "dire_hero_id", "hero_id", {"hero_localized_name": "__d"})
    return rows.withColumn("matchup_label", _versus("__r", "__d"))


def fact_hero_matchups(players: DataFrame, matches: DataFrame, heroes: DataFrame) -> DataFrame:
    """One row per radiant and dire player pair of a decided match."""
    rows = _label_pairs(hero_pairs(players, matches), heroes)
    return rows.select(
        "match_id",
        "radiant_hero_id",
        "dire_hero_id",
        "matchup_label",
        "radiant_win",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("games"))).alias("__copy"),
    ).drop("__copy")


def fact_hero_matchups_hero(matchups: DataFrame, heroes: DataFrame) -> DataFrame:
    """Every pairing from both heroes' view; heroes that meet themselves are left out."""
    win = F.col("radiant_win")

    def view(hero: str, opponent: str, won: Column) -> list[Column]:
        return [
            F.col("match_id"),
            F.col(hero).alias("hero_id"),
            F.col(opponent).alias("opponent_id"),
            won.alias("hero_win"),
        ]

    rows = unpivot_rows(
        matchups.where("radiant_hero_id <> dire_hero_id"),
        [
            view("radiant_hero_id", "dire_hero_id", win),
            view("dire_hero_id", "radiant_hero_id", ~win),
        ],
    )
    for key, name in (("hero_id", "hero_name"), ("opponent_id", "opponent_name")):
        names = heroes.select(F.col("hero_id").alias(key), F.col("hero_localized_name").alias(name))
        rows = rows.join(names, key)
    return rows.select(
        "match_id",
        "hero_id",
        "opponent_id",
        "hero_name",
        "opponent_name",
        _versus("hero_name", "opponent_name").alias("matchup_label"),
        "hero_win",
    )


def _matchup_summary(rows: DataFrame, games: Column) -> DataFrame:
    win = F.col("radiant_win")
    counts = rows.groupBy("matchup_label").agg(
        F.sum(games).alias("matchup_games"),
        F.sum(F.when(win, games).otherwise(0)).alias("radiant_wins"),
        F.sum(F.when(~win, games).otherwise(0)).alias("dire_wins"),
    )
    return counts.select(
        "*",
        rate(F.col("radiant_wins"), F.col("matchup_games")).alias("radiant_win_rate"),
        rate(F.col("dire_wins"), F.col("matchup_games")).alias("dire_win_rate"),
    )


def fact_hero_matchup_stats(players: DataFrame, matches: DataFrame, heroes: DataFrame) -> DataFrame:
    """Games and win rates per matchup label; pairings are weighted, never multiplied out."""
    pairs = hero_pairs(players, matches).groupBy(
        "radiant_hero_id", "dire_hero_id", "radiant_win"
    ).agg(F.sum("games").alias("games"))
    return _matchup_summary(_label_pairs(pairs, heroes), F.col("games"))


def fact_hero_side(players: DataFrame) -> DataFrame:
    """Picks, wins and win rate per hero and side; ``players`` needs the side column."""
    wins = F.count_if("team_win")
    return (
        players.where(F.col("side").isin(fv.RADIANT, fv.DIRE))
        .groupBy("hero_id", "side")
        .agg(
            F.count(F.lit(1)).alias("hero_side_picks"),
            wins.alias("hero_side_wins"),
            rate(wins, F.count(F.lit(1))).alias("hero_side_win_rate"),
        )
    )


# Player logs -------------------------------------------------------------------------------------


def _with_names(rows: DataFrame, people: DataFrame, heroes: DataFrame, hero: str) -> DataFrame:
    # Anonymous players have no account. Their rows are spread by match instead of one null key.
    account = F.coalesce("account_id", F.concat(F.lit("?"), F.col("match_id")))
    rows = lookup(rows, people, account, "account_id", {"player_name": "player_name"})
    return lookup(rows, heroes, "hero_id", "hero_id", {"hero_localized_name": hero})


def xp_thresholds(constants: DataFrame) -> DataFrame:
    """One row with the list of experience thresholds."""
    return (
        constants.where(F.col("resource") == "xp_level")
        .select(F.from_json("payload", "array<decimal(18,3)>").alias("steps"))
        .agg(F.first("steps").alias("steps"))
    )


def level_for_xp(thresholds: Column, xp: Column) -> Column:
    """Number of thresholds reached; unknown experience reaches none."""
    return F.coalesce(F.size(F.filter(thresholds, lambda t: t <= xp)), F.lit(0))


def fact_match_player_minute(
    samples: DataFrame, constants: DataFrame, people: DataFrame, heroes: DataFrame
) -> DataFrame:
    rows = samples.withColumn("steps", xp_thresholds(constants).scalar())
    rows = rows.withColumn("level", level_for_xp(F.col("steps"), F.col("xp")))
    rows = _with_names(rows, people, heroes, "hero_localized_name")
    return rows.select(
        "match_id", "player_slot", "account_id", "hero_id", "side", "minute", "time_sec", "gold",
        "xp", "level",
        "last_hits", "denies", "player_name", "hero_localized_name",
    )


def fact_match_team_minute(samples: DataFrame) -> DataFrame:
    return samples.groupBy("match_id", "side", "minute").agg(
        F.sum("gold").alias("team_gold"),
        F.sum("xp").alias("team_xp"),
        F.count(F.lit(1)).alias("players_sampled"),
    )


def level_minutes(samples: DataFrame) -> DataFrame:
    """Per player: first minute of each level as a map, and that of the highest level."""
    first = samples.groupBy("match_id", "player_slot", "level").agg(
        F.min("minute").alias("minute")
    )
    return first.groupBy("match_id", "player_slot").agg(
        F.map_from_entries(F.collect_list(F.struct("level", "minute"))).alias("level_minute"),
        F.max_by("minute", "level").alias("last_minute"),
    )


def ability_names(constants: DataFrame) -> DataFrame:
    """Displayed abilities by underscore-free key, because ids and names spell keys differently."""
    return (
        resource_entries(constants, "abilities", "struct<dname:string,img:string>")
        .select(
            F.replace("key", F.lit("_"), F.lit("")).alias("plain_key"),
            F.col("entry.dname").alias("dname"),
            F.col("entry.img").alias("image"),
        )
        .where("dname <> ''")
    )


def fact_match_player_skills(
    upgrades: DataFrame,
    samples: DataFrame,
    constants: DataFrame,
    people: DataFrame,
    heroes: DataFrame,
) -> DataFrame:
    """Skill upgrades with decoded names and the minute at which the level was first reached.

    ``samples`` is the per-minute player fact. An upgrade beyond the highest recorded level gets
    the minute of that level, a player without samples minute 0.
    """
    # Rows go to their account and their player before the texts of abilities make them wide.
    rows = _with_names(upgrades, people, heroes, "hero_localized_name")
    rows = rows.join(level_minutes(samples), ["match_id", "player_slot"], "left")
    ids = resource_entries(constants, "ability_ids", "string")
    rows = lookup(rows, ids, "ability_id", "key", {"entry": "internal"})
    plain = F.replace(blank_to_null(F.col("internal")), F.lit("_"), F.lit(""))
    rows = lookup(
        rows, ability_names(constants), plain, "plain_key", {"dname": "dname", "image": "image"}
    )
    learn_level = F.col("upgrade_index") + 1
    internal = F.col("internal")
    bonus = internal == fv.ATTRIBUTE_BONUS
    talent = F.coalesce(internal.like(fv.TALENT_PREFIX + "%") | bonus, F.lit(False))
    raw_name = F.coalesce(
        F.col("dname"),
        F.when(bonus, fv.ATTRIBUTE_BONUS_LABEL),
        blank_to_null(internal),
        F.col("ability_id"),
    )
    talent_name = F.when(
        internal.isin(fv.ATTRIBUTE_BONUS, fv.ATTRIBUTE_BONUS_TALENT), fv.ATTRIBUTE_BONUS_LABEL
    ).otherwise(F.trim(F.regexp_replace(raw_name, fv.TALENT_TEMPLATE, "")))
    reached = F.try_element_at(F.col("level_minute"), learn_level.cast("int"))
    return rows.select(
        "match_id", "player_slot", "account_id", "hero_id", "side", "upgrade_index", "ability_id",
        internal.alias("ability_internal_name"),
        talent.alias("is_talent"),
        F.when(talent, talent_name).otherwise(raw_name).alias("ability_name"),
        hosted_image(F.col("image")).alias("ability_img"),
        F.coalesce(reached, F.col("last_minute"), F.lit(0)).alias("minute"),
        learn_level.alias("learn_level"),
        "player_name",
        "hero_localized_name",
    )


def fact_match_player_item_purchases(
    purchases: DataFrame, items: DataFrame, people: DataFrame, heroes: DataFrame
) -> DataFrame:
    shown = {"item_name": "__item", "img": "img"}
    rows = lookup(purchases, items, "item_internal_name", "item_internal_name", shown)
    rows = _with_names(rows, people, heroes, "hero_localized_name")
    return rows.select(
        *purchases.columns,
        F.coalesce("__item", "item_internal_name").alias("item_name"),
        "img",
        "player_name",
        "hero_localized_name",
    )


def fact_match_player_runes(
    runes: DataFrame, rune_names: DataFrame, people: DataFrame, heroes: DataFrame
) -> DataFrame:
    rows = lookup(runes, rune_names, "rune_key", "rune_key", {"rune_name": "__rune"})
    rows = _with_names(rows, people, heroes, "hero_localized_name")
    return rows.select(
        "match_id", "player_slot", "account_id", "hero_id", "side", "rune_key",
        F.coalesce("__rune", F.col("rune_key").cast("string")).alias("rune_name"),
        "rune_count",
        "player_name",
        "hero_localized_name",
    )


def unit_category(unit: Column, is_hero: Column) -> Column:
    """Kind of a damaged or damaging unit; a known hero wins over the name patterns."""
    kind = F.when(is_hero, "Hero")
    for label, patterns in fv.UNIT_CATEGORIES:
        kind = kind.when(like_any(unit, patterns), label)
    return kind.otherwise("Other")


def damage_fact(damage: DataFrame, people: DataFrame, heroes: DataFrame, unit: str) -> DataFrame:
    """Damage rows with the category and name of the other unit; ``unit`` is target or source."""
    key = f"{unit}_key"
    other = {"hero_id": "__unit_hero", "hero_localized_name": "__unit_name"}
    rows = lookup(damage, heroes, key, "hero_name", other)
    rows = _with_names(rows, people, heroes, "hero_name")
    return rows.select(
        *["match_id", "player_slot", "account_id", "hero_id", "side", key],
        unit_category(F.col(key), F.col("__unit_hero").isNotNull()).alias(f"{unit}_category"),
        F.coalesce("__unit_name", key).alias(f"{unit}_name"),
        "damage_amount",
        "player_name",
        "hero_name",
    )


def fact_match_player_damage(damage: DataFrame, people: DataFrame, heroes: DataFrame) -> DataFrame:
    return damage_fact(damage, people, heroes, "target")


def fact_match_player_damage_taken(
    damage: DataFrame, people: DataFrame, heroes: DataFrame
) -> DataFrame:
    return damage_fact(damage, people, heroes, "source")
