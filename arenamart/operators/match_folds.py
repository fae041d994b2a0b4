"""Facts folded inside the match document, before its players are exploded.

A match document already holds everything about its players, draft and fights, so what the player fact
needs of them is computed with array functions in the document's own row. Nothing is grouped and no
player row is shuffled; only reference data (items, hero win rates) is joined, from the small side.

Results equal those of the grouped forms in ``facts``, which work on silver tables: a null match, slot,
team or hero gets no value, and players of one match that share a slot share the folded logs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenamart import fixed_values as fv
from arenamart.functions.columns import blank_to_null, position_slot, to_int
from arenamart.functions.relations import lookup
from arenamart.operators import staging
from arenamart.operators.facts import (
    ITEM_SLOTS,
    PLAYER_FACT,
    fight_phase,
    hero_win_rate,
    team_side,
)

PHASES = {"early": fv.PHASE_EARLY, "mid": fv.PHASE_MID, "late": fv.PHASE_LATE}
FIGHT_MEMBER = "array<struct<gold_delta:string,xp_delta:string,ability_uses:map<string,string>>>"


def pinned(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``df`` with new columns that are computed once, however often later steps use them."""
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*keep, F.inline(F.array(made)))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, for use inside array functions."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def total(values: Column, amount: Callable[[Column], Column]) -> Column:
    """Sum over the members of an array; null where it has none."""
    return bound(
        values,
        lambda own: F.when(
            F.size(own) > 0, F.aggregate(own, F.lit(0).cast("bigint"), lambda a, e: a + amount(e))
        ),
    )


# Draft -------------------------------------------------------------------------------------------


def _draft(picked: Column | None) -> Column:
    """Entries of the draft in order; picks, bans, or (None) those that are neither."""
    entries = F.transform(
        "picks_bans",
        lambda d: F.struct(
            to_int(d["order"]).isNull().alias("no_number"),
            to_int(d["order"]).alias("number"),
            d["order"].isNull().alias("no_order"),
            d["order"].alias("order"),
            blank_to_null(d["hero_id"]).isNull().alias("no_hero"),
            blank_to_null(d["hero_id"]).alias("hero"),
            F.when(d["team"] == "0", fv.RADIANT).when(d["team"] == "1", fv.DIRE).alias("side"),
            d["is_pick"].cast("boolean").alias("is_pick"),
        ),
    )
    wanted = F.filter(
        entries, lambda e: e["is_pick"].isNull() if picked is None else e["is_pick"] == picked
    )
    ordered = F.array_sort(wanted)
    return F.transform(
        ordered, lambda e, i: F.struct(e["hero"].alias("hero"), e["side"].alias("side"), (i + 1).alias("seq"))
    )


def draft_folds(nested: DataFrame) -> DataFrame:
    """One row per match with a draft: picks and bans of each side in order, and the longest run."""
    rows = pinned(
        nested.where(F.size("picks_bans") > 0),
        ["match_id"],
        picks=_draft(F.lit(True)),
        bans=_draft(F.lit(False)),
        neither=_draft(None),
    )

    def of(name: str, side: str | None) -> Column:
        return F.filter(name, lambda e: e["side"].isNull() if side is None else e["side"] == side)

    parts = {
        f"{side.lower()}_{what}": of(f"{what}s", side)
        for side in (fv.DIRE, fv.RADIANT)
        for what in ("pick", "ban")
    }
    sides = (fv.RADIANT, fv.DIRE, None)
    runs = [F.size(of(name, side)) for name in ("picks", "bans", "neither") for side in sides]
    return rows.select("match_id", *[c.alias(n) for n, c in parts.items()], F.greatest(*runs).alias("longest"))


def fact_draft_sequence(folds: DataFrame, heroes: DataFrame) -> DataFrame:
    """Grid of (match, draft slot) with each team's pick and ban of that slot.

    ``folds`` come from ``draft_folds``, best stored: the number of slots is the greatest ``longest``
    among them, and the grid reads the rest, so the drafts themselves are read once.
    """
    longest = folds.agg(F.coalesce(F.max("longest"), F.lit(fv.DEFAULT_DRAFT_SLOTS))).scalar()
    grid = folds.select("*", F.explode(F.sequence(F.lit(1), longest)).alias("slot"))
    names = [f"{side.lower()}_{what}" for side in (fv.DIRE, fv.RADIANT) for what in ("pick", "ban")]
    at = {n: F.get(F.col(n), F.col("slot") - 1) for n in names}
    rows = grid.select(
        "match_id",
        "slot",
        *[at[n]["hero"].alias(f"__{n}") for n in names],
        *[at[n]["seq"].alias(f"{n}_seq") for n in names],
    )
    for n in names:
        shown = {"hero_localized_name": f"{n}_hero", "img": f"{n}_hero_img"}
        rows = lookup(rows, heroes, f"__{n}", "hero_id", shown)
    columns = [c for n in names for c in (f"{n}_hero", f"{n}_hero_img", f"{n}_seq")]
    return rows.select("match_id", "slot", *columns)


# Players -----------------------------------------------------------------------------------------


def _fights() -> Column:
    """Phase and members of every fight."""
    return F.transform(
        "teamfights",
        lambda f: F.struct(
            fight_phase(to_int(f["start"])).alias("phase"),
            F.from_json(f["players"], FIGHT_MEMBER).alias("members"),
        ),
    )


def _swings(first: bool) -> Column:
    """Gold and experience swing of one team in each phase; null where it has no member in a fight."""
    side = fv.PLAYERS_PER_SIDE

    def own(fight: Column) -> Column:
        members = fight["members"]
        if first:
            return F.slice(members, 1, side)
        return F.slice(members, side + 1, F.greatest(F.size(members) - side, F.lit(0)))

    def swing(phase: str) -> Column:
        fights = F.filter("__fights", lambda f: f["members"].isNotNull() & (f["phase"] == phase))
        return bound(
            F.flatten(F.transform(fights, own)),
            lambda members: F.struct(*[_sum_of(members, what).alias(what) for what in ("gold", "xp")]),
        )

    return F.struct(*[swing(phase).alias(n) for n, phase in PHASES.items()])


def _sum_of(members: Column, what: str) -> Column:
    return total(members, lambda m: F.coalesce(to_int(m[f"{what}_delta"]), F.lit(0)))


def _best_skills() -> Column:
    """Text of the three most used abilities for each place in the fights' member lists."""
    places = F.coalesce(F.array_max(F.transform("__fights", lambda f: F.size(f["members"]))), F.lit(0))

    def entries(place: Column) -> Column:
        maps = F.transform("__fights", lambda f: F.get(f["members"], place - 1)["ability_uses"])
        found = F.flatten(F.transform(F.filter(maps, lambda m: m.isNotNull()), F.map_entries))
        return F.transform(
            found, lambda e: F.struct(e["key"].alias("name"), e["value"].cast("int").alias("uses"))
        )

    def ranked(typed: Column) -> Column:
        """Falling uses, those without a number first, then names."""

        def uses(name: Column) -> Column:
            own = F.filter(typed, lambda e: (e["name"] == name) & e["uses"].isNotNull())
            return -total(own, lambda e: e["uses"])

        names = F.array_distinct(F.transform(typed, lambda e: e["name"]))
        return F.array_sort(F.transform(names, lambda n: F.struct(uses(n).alias("minus"), n.alias("name"))))

    def text(best: Column) -> Column:
        counted = F.filter(F.slice(best, 1, 3), lambda e: e["minus"].isNotNull())
        shown = F.transform(counted, lambda e: F.concat(e["name"], F.lit(" x"), (-e["minus"]).cast("string")))
        return F.nullif(F.array_join(shown, ", "), F.lit(""))

    none = F.array().cast("array<struct<slot:string,text:string>>")
    listed = F.transform(
        F.sequence(F.lit(1), F.greatest(places, F.lit(1))),
        lambda i: F.struct(
            position_slot(i).alias("slot"), text(bound(entries(i), ranked)).alias("text")
        ),
    )
    return F.when(places > 0, listed).otherwise(none)


def _by_slot(slots: str, logs: str, fold: Callable[[Column], Column]) -> Column:
    """``fold`` of each player's log; logs of players that share a slot are put together."""
    alone = F.zip_with(slots, logs, lambda s, log: F.when(s.isNotNull(), fold(log)))

    def together(slot: Column) -> Column:
        pairs = F.arrays_zip(F.col(slots).alias("slot"), F.col(logs).alias("log"))
        same = F.filter(pairs, lambda x: (x["slot"] == slot) & x["log"].isNotNull())
        return F.when(slot.isNotNull(), fold(F.flatten(F.transform(same, lambda x: x["log"]))))

    unique = F.size(F.array_distinct(slots)) == F.size(slots)
    return F.when(unique, alone).otherwise(F.transform(slots, together))


def _kills(log: Column) -> Column:
    n = F.size(F.filter(log, lambda e: e["key"].isNotNull() & e["time"].isNotNull()))
    return F.when(n > 0, n.cast("bigint"))


def _support(log: Column) -> Column:
    """Bought support items and what they cost; null for a player who bought nothing."""

    def counted(bought: Column) -> Column:
        counts = F.array(*[F.size(F.filter(bought, _is_item(item))).cast("bigint") for item, _, _ in fv.SUPPORT_ITEMS])
        return F.when(F.size(bought) > 0, bound(counts, priced))

    def priced(counts: Column) -> Column:
        own = [F.get(counts, F.lit(i)) for i in range(len(fv.SUPPORT_ITEMS))]
        gold = sum((n * price for n, (_, _, price) in zip(own, fv.SUPPORT_ITEMS, strict=True)), F.lit(0))
        named = [n.alias(column) for n, (_, column, _) in zip(own, fv.SUPPORT_ITEMS, strict=True)]
        return F.struct(*named, gold.cast("bigint").alias("support_gold"))

    return bound(F.filter(log, lambda e: e["key"].isNotNull() & e["time"].isNotNull()), counted)


def _is_item(item: str) -> Callable[[Column], Column]:
    return lambda e: e["key"] == item


def _damage(kinds: dict[str, str]) -> Callable[[Column], Column]:
    """Sums by damage type over (key, value) entries; null for a type that never occurs."""

    def of(entries: Column, kind: str) -> Column:
        keys = sorted(k for k, v in kinds.items() if v == kind)
        own = F.filter(entries, lambda e: e["key"].isin(keys) & (e["value"].cast("int") > 0))
        return total(own, lambda e: e["value"].cast("int"))

    def fold(entries: Column) -> Column:
        return F.struct(
            *[of(entries, kind).alias(f"damage_taken_{kind.lower()}") for kind in fv.DAMAGE_TYPES]
        )

    return fold


def _place_of(hero: Column, order: str) -> Column:
    """Last number of a hero in an ordered draft list."""
    heroes = F.transform(order, lambda e: e["hero"])
    at = F.array_position(F.reverse(heroes), hero)
    return F.when(at > 0, (F.size(heroes) - at + 1).cast("int"))


def _comps() -> Column:
    """Team number and its heroes in text order, joined."""
    pairs = F.zip_with(
        "__teams", "__heroes", lambda t, h: F.struct(blank_to_null(t).alias("team"), blank_to_null(h).alias("hero"))
    )

    def joined(members: Column) -> Column:
        def heroes(team: Column) -> Column:
            own = F.filter(members, lambda x: (x["team"] == team) & x["hero"].isNotNull())
            return F.array_join(F.array_sort(F.transform(own, lambda x: x["hero"])), "_")

        teams = F.array_distinct(F.transform(F.filter(members, lambda x: x["team"].isNotNull()), lambda x: x["team"]))
        return F.transform(teams, lambda t: F.struct(t.alias("team"), F.nullif(heroes(t), F.lit("")).alias("comp_sig")))

    return bound(pairs, joined)


def _found(entries: str, key: str, value: Column, field: str) -> Column:
    """``field`` of the first entry whose ``key`` is ``value``."""
    return F.get(F.filter(entries, lambda e: e[key] == value), F.lit(0))[field]


def enriched_players(nested: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Player rows with everything the document says about them. One scan, no shuffle."""
    fields = staging.FIELDS["stg_match_players"][1]
    logs = {
        "kills_log": F.col("players.kills_log"),
        "purchase_log": F.col("players.purchase_log"),
        "entries": F.transform("players.damage_inflictor_received", F.map_entries),
    }
    rows = nested.select(
        "match_id",
        *staging.player_match_fields(),
        F.arrays_zip(*[F.col(f"players.{f}").alias(f) for f in fields]).alias("__players"),
        *[c.alias(f"__{n}") for n, c in logs.items()],
        F.col("players.player_slot").alias("__slots"),
        F.col("players.team_number").alias("__teams"),
        F.col("players.hero_id").alias("__heroes"),
        "picks_bans",
        "teamfights",
    )
    first = pinned(
        rows,
        [c for c in rows.columns if c not in ("picks_bans", "teamfights")],
        __fights=_fights(),
        __picks=_draft(F.lit(True)),
        __bans=_draft(F.lit(False)),
    )
    second = pinned(
        first,
        ["match_id", "radiant_win", "at", "__players", "__slots", "__teams", "__heroes", "__picks", "__bans"],
        __radiant=_swings(True),
        __dire=_swings(False),
        __skills=_best_skills(),
        __comps=_comps(),
        __killed=_by_slot("__slots", "__kills_log", _kills),
        __support=_by_slot("__slots", "__purchase_log", _support),
        __damage=_by_slot("__slots", "__entries", _damage(kinds)),
    )
    swing = [(what, n) for what in ("gold", "xp") for n in PHASES]

    def extras(p: Column, i: Column) -> Column:
        team, hero = blank_to_null(p["team_number"]), blank_to_null(p["hero_id"])
        support = F.get("__support", i)
        damage = F.get("__damage", i)
        return F.struct(
            p.alias("p"),
            _found("__comps", "team", team, "comp_sig").alias("comp_sig"),
            *[
                F.when(team == "0", F.col(f"__radiant.{n}.{what}"))
                .when(team == "1", F.col(f"__dire.{n}.{what}"))
                .alias(f"{what}_{n}")
                for what, n in swing
            ],
            _found("__skills", "slot", p["player_slot"], "text").alias("top_skills"),
            _place_of(hero, "__picks").alias("pick_sequence"),
            _place_of(hero, "__bans").alias("ban_sequence"),
            F.get("__killed", i).alias("enemy_heroes_killed"),
            *[support[c].alias(c) for _, c, _ in fv.SUPPORT_ITEMS],
            support["support_gold"].alias("support_gold"),
            *[damage[n].alias(n) for n in (f"damage_taken_{k.lower()}" for k in fv.DAMAGE_TYPES)],
        )

    each = second.select("match_id", "radiant_win", "at", F.explode(F.transform("__players", extras)).alias("x"))
    flat = each.select("match_id", "radiant_win", "at", "x.*")
    own = [c for c in flat.columns if c not in ("match_id", "radiant_win", "at", "p")]
    known = F.col("match_id").isNotNull()
    return flat.select(*staging.player_columns(), *[F.when(known, F.col(c)).alias(c) for c in own])


def fact_match_players(
    nested: DataFrame, items: DataFrame, kinds: dict[str, str], results: DataFrame | None = None
) -> DataFrame:
    """Player fact with all enrichments, from match documents.

    ``results`` are hero and outcome of all their players, where a narrower frame than the documents has them.
    The lookups carry a player as one struct beside the keys, so that none of them copies it field by field.
    """
    rates = hero_win_rate(staging.player_results(nested) if results is None else results)
    players = enriched_players(nested, kinds)
    # With a field that nothing reads the optimizer would take the struct apart before the lookups.
    own = [c for c in PLAYER_FACT if c in players.columns]
    carried = [*ITEM_SLOTS, "hero_id"]
    rows = players.select(*[F.col(c).alias(f"__{c}") for c in carried], F.struct(*own).alias("__player"))
    for slot in ITEM_SLOTS:
        rows = lookup(rows, items, f"__{slot}", "item_id", {"item_name": f"{slot}_name"})
    shown = {"hero_games": "hero_games", "hero_win_rate": "hero_win_rate"}
    rows = lookup(rows, rates, "__hero_id", "hero_id", shown).select("*", "__player.*")
    return rows.withColumn("side", team_side(F.col("team_number"))).select(*PLAYER_FACT)
