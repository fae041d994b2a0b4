"""The driver's star-schema tables seen as match data, so that every model can run on them.

orders are matches, the lines of one (order, line number) are a player, events are player logs,
embeddings are per-minute series, parts are heroes, items and abilities, suppliers are teams and
pro players, nations are leagues and patches. Whole tables are used. Lines go to their match once, as a few
numbers each; every list of the match is made of them there, without another shuffle. They are aggregated
per (order, line number), so a match never holds more players than there are line numbers, however many
lines one order has.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arenamart import schemas

LOADED_AT = "timestamp'2024-06-01 00:00:00'"

SLOT = "case when ln % 2 = 1 then (ln - 1) div 2 else 128 + (ln - 2) div 2 end"
HERO_KEY = "concat('npc_dota_hero_', {0} % 131)"
UNIT_KEY = (
    "case {0} % 7 when 0 then concat('npc_dota_hero_', {0} % 131)"
    " when 1 then 'npc_dota_goodguys_tower1_mid' when 2 then 'badguys_melee_rax_bot'"
    " when 3 then 'npc_dota_creep_goodguys_melee' when 4 then 'npc_dota_neutral_kobold'"
    " when 5 then 'observer_ward' else 'illusion_of_someone' end"
)
INFLICTOR_KEY = (
    "case part % 5 when 0 then 'null' when 1 then concat('spell_', part % 40)"
    " when 2 then concat('item_', part % 60) when 3 then 'odd_thing'"
    " else concat('spell_', supp % 40) end"
)

DAMAGE_KIND = (
    "case id % 4 when 0 then 'Magical' when 1 then 'Pure' when 2 then 'Physical' else 'Odd' end"
)
RESOURCES = [
    "heroes",
    "items",
    "item_ids",
    "abilities",
    "ability_ids",
    "game_mode",
    "lobby_type",
    "region",
    "patch",
    "xp_level",
]

# Player fields in the order of the schema: name -> expression over the aggregated lines.
PLAYER_EXPR = {
    "player_slot": SLOT,
    "account_id": "case when (ok + ln) % 10 <> 0 then pmin end",
    "hero_id": "pmax % 131",
    "team_number": "case when ok % 29 = 0 and ln = 3 then null else 1 - ln % 2 end",
    "kills": "qty % 20",
    "deaths": "case when smin % 13 <> 0 then ln - 1 end",
    "assists": "pmax % 25",
    "gold": "price % 5000",
    "gold_spent": "price % 20000",
    "net_worth": "price % 30000",
    "gold_per_min": "price % 900",
    "xp_per_min": "price % 800",
    "hero_damage": "price % 40000",
    "hero_healing": "case when qty % 3 <> 0 then price % 3000 end",
    "tower_damage": "price % 7000",
    "tower_kills": "qty % 5",
    "stuns": "disc",
    "last_hits": "price % 400",
    "denies": "price % 40",
    "camps_stacked": "case when qty % 3 <> 0 then qty % 6 end",
    "creeps_stacked": "qty % 7",
    "neutral_kills": "price % 100",
    "rune_pickups": "qty % 9",
    "obs_placed": "case when qty % 2 = 1 then qty % 8 end",
    "sen_placed": "qty % 6",
    "observer_kills": "qty % 3",
    "sentry_kills": "qty % 2",
    "purchase_ward_observer": "qty % 4",
    "purchase_ward_sentry": "qty % 5",
    "personaname": "case when smin % 7 = 0 then '' else concat('P', smin) end",
    "level": "case when qty % 11 = 0 then '' else cast(1 + price % 30 as string) end",
    "item_0": "pmin % 260",
    "item_1": "(pmin + 37) % 260",
    "item_2": "(pmin + 74) % 260",
    "item_3": "(pmin + 111) % 260",
    "item_4": "(pmin + 148) % 260",
    "item_5": "(pmin + 185) % 260",
    "item_neutral": "pmax % 260",
    "backpack_0": "case when qty % 2 = 0 then '' else cast(pmax % 50 as string) end",
    "backpack_1": "pmax % 51",
    "backpack_2": "pmax % 52",
    "backpack_3": "cast(null as int)",
    "leaver_status": "qty % 2",
    "randomed": "qty % 2 = 0",
    "firstblood_claimed": "case when ln = 1 then 1 else 0 end",
    "buyback_count": "qty % 4",
}

# Player log and map fields by section.
SECTIONS = {
    "wards": ["obs_log", "sen_log"],
    "minutes": ["times", "gold_t", "xp_t", "lh_t", "dn_t"],
    "upgrades": ["ability_upgrades_arr"],
    "logs": ["purchase_log", "kills_log"],
    "runes": ["runes"],
    "damage": ["damage"],
    "damage_taken": ["damage_taken"],
    "inflictors": ["damage_inflictor_received"],
}
ALL = ("players", "picks_bans", "teamfights", *SECTIONS)

# What a line carries to its match: name -> expression over the table.
LINE = {
    "ln": "l_linenumber",
    "flag": "l_returnflag",
    "part": "l_partkey",
    "supp": "l_suppkey",
    "quantity": "floor(l_quantity)",
    "amount": "floor(l_extendedprice)",
    "discount": "cast(l_discount as decimal(12,2))",
}
# What each list of a match reads of its lines.
LINE_READS = {
    "picks_bans": ["part", "supp"],
    "teamfights": ["flag", "part", "supp", "amount"],
    "wards": ["quantity"],
    "upgrades": ["part"],
    "runes": ["quantity"],
    "damage": ["part", "amount"],
    "damage_taken": ["supp", "quantity"],
    "inflictors": ["part", "supp", "amount"],
}
# The sums of a player's lines: name -> (what they read, aggregate).
LINE_SUMS = {
    "pmin": ("part", F.min),
    "pmax": ("part", F.max),
    "smin": ("supp", F.min),
    "smax": ("supp", F.max),
    "qty": ("quantity", F.sum),
    "price": ("amount", F.sum),
    "disc": ("discount", lambda c: F.sum(c).cast("decimal(14,2)")),
}


class DriverTables:
    """Frames over one folder of driver tables; everything is lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def matches(self) -> DataFrame:
        """Match fields in schema order, typed as in real documents."""
        return self._matches_of(self.table("orders"))

    def _matches_of(self, orders: DataFrame) -> DataFrame:
        return orders.selectExpr(
            "o_orderkey as match_id",
            "case o_orderstatus when 'F' then true when 'O' then false end as radiant_win",
            "cast(floor(o_totalprice) % 5400 as int) as duration",
            "substring(o_orderpriority, 1, 1) as game_mode",
            "o_orderkey % 16 as lobby_type",
            "o_custkey % 5 as region",
            "year(o_orderdate) - 1975 as patch",
            "timestampdiff(second, timestamp_ntz'1970-01-01', o_orderdate) as start_time",
            "case when o_orderkey % 17 <> 0 then cast(floor(o_totalprice) % 50 as int) end"
            " as radiant_score",
            "o_custkey % 50 as dire_score",
            "case when o_custkey % 11 <> 0 then o_custkey end as radiant_team_id",
            "case when o_orderkey % 13 <> 0 then (7 * o_custkey + o_orderkey) % 120 end"
            " as dire_team_id",
            "o_custkey % 27 as leagueid",
            "cast(floor(o_totalprice) % 300 as int) as first_blood_time",
            "10 as human_players",
            "case when o_orderkey % 23 = 0 then '' else '90' end as pre_game_duration",
            "o_orderkey * 31 % 1000 as replay_salt",
            "21 as version",
            "cast(null as string) as timestamp_fetched",
        )

    def _lines(self, reads: list[str]) -> DataFrame:
        """Lines in the task of their match (``ok``), with what is read of them.

        The columns travel in one value, which keeps the optimizer from giving every reader an exchange of its
        own columns: all lists of a match read the same one. Lines without an order belong to no match.
        """
        own = F.struct(*[F.expr(e).alias(n) for n, e in LINE.items() if n == "ln" or n in reads])
        lines = self.table("lineitem").where("l_orderkey is not null")
        lines = lines.select(F.col("l_orderkey").alias("ok"), F.array(own).alias("line")).repartition("ok")
        return lines.select("ok", F.inline("line"))

    def _players(self, reads: list[str]) -> DataFrame:
        """One row per player: lines aggregated per (order, line number)."""
        sums = [f(F.col(read)).alias(n) for n, (read, f) in LINE_SUMS.items() if read in reads]
        return self._lines(reads).groupBy("ok", "ln").agg(F.count(F.lit(1)).alias("n"), *sums)

    def _map(self, reads: list[str], key: str, amount: str, name: str) -> DataFrame:
        """``{key: amount}`` per player; one entry per distinct key."""
        return (
            self._lines(reads)
            .selectExpr("ok", "ln", f"{key} as k", f"{amount} as v")
            .groupBy("ok", "ln", "k")
            .agg(F.sum("v").alias("v"))
            .groupBy("ok", "ln")
            .agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias(name))
        )

    def _section(self, name: str, reads: list[str]) -> DataFrame:
        """The nested fields of one section, keyed by (ok, ln), in the task of their match."""
        if name == "logs":
            time = "case when floor(value) % 8 <> 0 then cast(floor(value * 10) - 60 as int) end"
            item = (
                "case when floor(value) % 9 = 0 then null when event_id % 17 = 0 then 'gem'"
                " when event_type = 'click' then 'ward_observer'"
                " when event_type = 'view' then 'ward_sentry'"
                " when event_type = 'purchase' then 'dust'"
                " when event_type = 'signup' then 'smoke_of_deceit'"
                " else concat('item_', event_id % 60) end"
            )
            victim = f"case when floor(value) % 6 <> 0 then {HERO_KEY.format('user_id')} end"
            events = self.table("events").where("event_id is not null")
            events = events.select(F.expr("event_id div 20").alias("ok"), "event_id", "user_id", "event_type", "value")
            rows = events.repartition("ok").selectExpr(
                "ok",
                "cast(event_id % 20 % 7 + 1 as int) as ln",
                f"struct(event_id, {item} as key, {time} as time) as bought",
                f"struct(event_id, {victim} as key, {time} as time) as killed",
            )

            def log(col: str) -> Column:
                ordered = F.array_sort(F.collect_list(col))
                return F.transform(ordered, lambda e: F.struct(e["key"], e["time"]))

            return rows.groupBy("ok", "ln").agg(
                log("bought").alias("purchase_log"), log("killed").alias("kills_log")
            )
        if name == "minutes":
            at = "(e, i) -> "
            samples = self.table("embeddings").where("vec_id is not null").select("vec_id", "label", "embedding")
            return samples.repartition("vec_id").selectExpr(
                "vec_id as ok",
                "cast(label % 7 + 1 as int) as ln",
                f"transform(embedding, {at} i * 60) as times",
                f"transform(embedding, {at} cast(floor(1000 * abs(cast(e as double))) as int))"
                " as gold_t",
                f"transform(embedding, {at} i * 600) as xp_t",
                f"transform(embedding, {at} i * 3) as lh_t",
                f"case when vec_id % 5 <> 0 then transform(embedding, {at} i) end as dn_t",
            )
        if name == "runes":
            return self._map(reads, "cast(quantity % 12 as string)", "cast(quantity % 12 % 5 as int)", "runes")
        if name == "damage":
            return self._map(reads, UNIT_KEY.format("part"), "amount % 1000", "damage")
        if name == "damage_taken":
            return self._map(reads, UNIT_KEY.format("supp"), "quantity - 1", "damage_taken")
        if name == "inflictors":
            return self._map(reads, INFLICTOR_KEY, "amount % 700", "damage_inflictor_received")
        raise KeyError(name)

    def _drafts(self, reads: list[str]) -> DataFrame:
        """Draft list per match: a ban and a pick for every player."""
        team = "case when smax % 41 <> 0 then 1 - ln % 2 end"
        slot = f"cast({SLOT} as string)"
        rows = self._players(reads).selectExpr(
            "ok",
            "inline(array("
            f"struct(false as is_pick, (pmin + ln) % 131 as hero_id, {team} as team,"
            " 2 * ln - 2 as `order`, cast(null as string) as player_slot),"
            f"struct(true as is_pick, pmax % 131 as hero_id, {team} as team,"
            f" 2 * ln - 1 as `order`, {slot} as player_slot)))",
        )
        entry = F.struct("order", F.struct("is_pick", "hero_id", "team", "order", "player_slot").alias("e"))
        return rows.groupBy("ok").agg(
            F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["e"]).alias("picks_bans")
        )

    def _fights(self, as_text: bool, reads: list[str]) -> DataFrame:
        """Fight list per match: one fight per return flag, one entry per line number in it.

        ``as_text`` gives texts, with the entries as JSON. They are made in the row of the fight, as behind
        the list of fights later filters on it would make each text once more.
        """
        member = self._lines(reads).groupBy("ok", "flag", "ln").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("part").alias("parts"),
            F.sum("supp").alias("supps"),
            F.sum("amount").alias("price"),
        )
        entry = F.expr(
            "struct(ln, struct(price % 900 as damage, price % 70 as healing, n % 3 as deaths,"
            " n % 2 as buybacks, price % 3000 as xp_start, price % 3000 + 10 as xp_end,"
            " supps % 300 - 100 as xp_delta, parts % 500 - 250 as gold_delta,"
            " map(concat('spell_', parts % 40), ln, 'spell_common', n) as ability_uses,"
            " map('item_used', n) as item_uses, cast(null as string) as ability_targets,"
            " cast(null as string) as killed, cast(null as string) as deaths_pos) as e)"
        )
        fight = member.withColumn("entry", entry).groupBy("ok", "flag").agg(
            F.min("price").alias("low"),
            F.sum("n").alias("lines"),
            F.transform(
                F.array_sort(F.collect_list("entry"), _by("ln")), lambda e: e["e"]
            ).alias("players"),
        )
        start = "case when (ok + lines) % 19 <> 0 then low % 3100 - 60 end"
        parts = {
            "start": F.expr(start),
            "end": F.expr(f"{start} + 30 + lines"),
            "last_death": F.expr(f"{start} + 20"),
            "deaths": F.col("lines"),
            "players": F.col("players"),
        }
        if as_text:
            parts = {n: c.cast("string") for n, c in parts.items() if n != "players"}
            parts["players"] = F.to_json("players", {"ignoreNullFields": "false"})
        own = F.struct(*[c.alias(n) for n, c in parts.items()])
        rows = fight.select("ok", F.struct("flag", own.alias("f")).alias("f"))
        return rows.groupBy("ok").agg(
            F.transform(
                F.array_sort(F.collect_list("f"), _by("flag")), lambda e: e["f"]
            ).alias("teamfights")
        )

    def typed(
        self, *sections: str, fields: list[str] | None = None, text_fights: bool = False
    ) -> DataFrame:
        """Match rows with nested lists, with the value types of real documents.

        ``fields`` narrows the players to the named fields of the sections.
        """
        want = [s for s in SECTIONS if s in sections]
        teams = bool(want) or "players" in sections
        sides = [s for s in ("picks_bans", "teamfights") if s in sections]
        if not teams and not sides:
            return self.matches
        names = self.player_fields(*sections, fields=fields) if teams else []
        own = {
            "obs_log": "case when ln % 3 = 0 then array_repeat('w', cast(qty % 4 as int)) end",
            "sen_log": "cast(null as array<string>)",
            "ability_upgrades_arr": "transform(sequence(0, ln), i -> (pmin * 3 + i * 7) % 300)",
        }
        exprs = {f: own.get(f) or PLAYER_EXPR.get(f) or f"`{f}`" for f in names}
        words = set(re.findall(r"\w+", " ".join(exprs.values())))
        reads = sorted(
            {r for s in [*want, *sides] for r in LINE_READS.get(s, [])}
            | {read for n, (read, _) in LINE_SUMS.items() if n in words}
        )
        # Orders go to the task of the match before its fields are made.
        out = self._matches_of(self.table("orders").repartition("o_orderkey"))
        if teams:
            rows = self._players(reads)
            for name in want:
                if name not in ("wards", "upgrades"):
                    rows = _beside(rows, self._section(name, reads))
            entry = F.struct("ln", F.struct(*[F.expr(e).alias(f) for f, e in exprs.items()]).alias("p"))
            listed = rows.select("ok", entry.alias("e")).groupBy("ok").agg(
                F.transform(
                    F.array_sort(F.collect_list("e"), _by("ln")), lambda e: e["p"]
                ).alias("players")
            )
            out = out.join(listed, out["match_id"] == listed["ok"], "left").drop("ok")
        for section in sides:
            side = self._drafts(reads) if section == "picks_bans" else self._fights(text_fights, reads)
            out = out.join(side, out["match_id"] == side["ok"], "left").drop("ok")
        if "picks_bans" in sections:
            out = out.withColumn("picks_bans", F.expr("if(match_id % 37 = 0, null, picks_bans)"))
        return out

    def player_fields(self, *sections: str, fields: list[str] | None = None) -> list[str]:
        base = [*PLAYER_EXPR] if "players" in sections else [*schemas.PLAYER_IDENTITY]
        every = [*base, *[f for s in SECTIONS if s in sections for f in SECTIONS[s]]]
        return every if fields is None else [f for f in every if f in fields]

    def documents(self, *sections: str) -> DataFrame:
        """Bronze match documents: key, JSON text, load time. Missing values are JSON nulls."""
        typed = self.typed(*(sections or ALL))
        text = F.to_json(F.struct(*typed.columns), {"ignoreNullFields": "false"})
        return typed.select("match_id", text.alias("payload"), F.expr(LOADED_AT).alias("loaded_at"))

    def nested(self, *sections: str, fields: list[str] | None = None) -> DataFrame:
        """The parsed form of the documents, made without the detour over JSON text."""
        typed = self.typed(*sections, fields=fields, text_fights=True)
        out = typed.select(
            *[F.col(n).cast("string").alias(n) for n in schemas.MATCH_TEXT],
            *[c for c in ("players", "picks_bans", "teamfights") if c in typed.columns],
            F.expr(LOADED_AT).alias("loaded_at"),
        )
        if "players" in typed.columns:
            kind = schemas.T.ArrayType(schemas.player_type(self.player_fields(*sections, fields=fields)))
            out = out.withColumn("players", F.col("players").cast(kind))
        if "picks_bans" in typed.columns:
            out = out.withColumn("picks_bans", F.col("picks_bans").cast(schemas.PICK_BAN))
        return out

    # Reference documents -------------------------------------------------------------------------

    def _object(self, rows: DataFrame, key: str, *fields: str) -> Column | DataFrame:
        """One JSON object keyed by ``key`` (a small set of ids) from grouped rows."""
        value = F.expr(fields[0]) if len(fields) == 1 and " as " not in fields[0] else F.struct(
            *[F.expr(f) for f in fields]
        )
        entry = F.struct(F.expr(f"cast({key} as string)").alias("k"), value.alias("v"))
        return rows.agg(
            F.to_json(
                F.map_from_entries(F.array_sort(F.collect_list(entry), _by("k"))),
                {"ignoreNullFields": "false"},
            ).alias("payload")
        )

    def constants(self, *names: str) -> DataFrame:
        """The named resource documents, or all. Ids are remainders, so their size is fixed."""
        out = None
        for name in names or RESOURCES:
            one = getattr(self, f"_{name}")().select(
                F.lit(name).alias("resource"), "payload", F.expr(LOADED_AT).alias("loaded_at")
            )
            out = one if out is None else out.unionByName(one)
        return out

    def _parts_by(self, expr: str) -> DataFrame:
        return self.table("part").groupBy(F.expr(expr).alias("id")).agg(
            F.min("p_name").alias("name"),
            F.min("p_type").alias("type"),
            F.min("p_brand").alias("low"),
            F.max("p_brand").alias("high"),
        )

    def _heroes(self) -> DataFrame:
        return self._object(
            self._parts_by("1 + p_partkey % 127"),
            "id",
            "case when id % 50 <> 7 then concat('npc_dota_hero_', id) end as name",
            "name as localized_name",
            "case id % 5 when 0 then 'agi' when 1 then 'all' when 2 then 'int' when 3 then 'str'"
            " else 'odd' end as primary_attr",
            "type as attack_type",
            "array(low, high) as roles",
            "concat('/heroes/', id, '.png?') as img",
        )

    def _items(self) -> DataFrame:
        return self._object(
            self._parts_by("p_partkey % 60"),
            "concat('item_', id)",
            "case when id % 7 <> 0 then concat('Item ', name) end as dname",
            "case when id % 5 <> 0 then concat('/items/', id, '.png') else '' end as img",
            f"{DAMAGE_KIND} as dmg_type",
        )

    def _item_ids(self) -> DataFrame:
        return self._object(self._parts_by("p_partkey % 250"), "id", "concat('item_', id)")

    def _abilities(self) -> DataFrame:
        return self._object(
            self._parts_by("p_partkey % 280"),
            "case when id % 10 = 0 then concat('special_bonus_unique_', id)"
            " when id < 40 then concat('spell_', id) else concat('rest_', id) end",
            "case when id = 5 then null when id = 6 then ''"
            " when id % 20 = 0 then concat('-{s:bonus_value} Gain ', id)"
            " when id % 10 = 0 then concat('+{s:bonus_value}% Gain ', id)"
            " else concat('Spell ', id) end as dname",
            "case when id % 3 <> 0 then concat('/abilities/', id, '.png') end as img",
            f"{DAMAGE_KIND} as dmg_type",
        )

    def _ability_ids(self) -> DataFrame:
        return self._object(
            self._parts_by("p_partkey % 280"),
            "id",
            "case id % 10 when 0 then concat('special_bonus_unique_', id)"
            " when 1 then 'attribute_bonus' when 2 then ''"
            " when 3 then 'special_bonus_attributes' else concat('sp_ell_', id % 40) end",
        )

    def _game_mode(self) -> DataFrame:
        modes = self.table("orders").groupBy(
            F.expr("substring(o_orderpriority, 1, 1)").alias("id")
        ).agg(F.min(F.expr("lower(substring(o_orderpriority, 3))")).alias("name"))
        return self._object(
            modes, "id", "concat('game_mode_', name) as name", "id < '4' as balanced"
        )

    def _lobby_type(self) -> DataFrame:
        lobbies = self.table("orders").select(F.expr("o_orderkey % 14").alias("id")).distinct()
        return self._object(
            lobbies, "id", "concat('lobby_type_l_', id) as name", "id % 2 = 0 as balanced"
        )

    def _region(self) -> DataFrame:
        return self._object(self.table("region"), "r_regionkey", "r_name")

    def _patch(self) -> DataFrame:
        entry = (
            "struct(n_nationkey as id, n_name as name,"
            " concat(2000 + n_nationkey, '-03-04T00:00:00Z') as date)"
        )
        return self.table("nation").agg(F.to_json(F.collect_list(F.expr(entry))).alias("payload"))

    def _xp_level(self) -> DataFrame:
        steps = F.sort_array(F.collect_list(F.expr("n_nationkey * 1500")))
        return self.table("nation").agg(F.to_json(steps).alias("payload"))

    def _records(self, rows: DataFrame, key: str, key_type: str, *fields: str) -> DataFrame:
        text = F.to_json(F.struct(*[F.expr(f) for f in fields]), {"ignoreNullFields": "false"})
        return rows.select(
            F.expr(fields[0].split(" as ")[0]).cast(key_type).alias(key),
            text.alias("payload"),
            F.expr(LOADED_AT).alias("loaded_at"),
        )

    @cached_property
    def hero_stats(self) -> DataFrame:
        rows = self.table("part").groupBy(F.expr("1 + p_partkey % 127").alias("hid")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size")
        )
        return self._records(
            rows,
            "id",
            "int",
            "hid as id",
            "n as pro_pick",
            "n div 2 as pro_win",
            "size % 50 as pro_ban",
            "case when hid % 9 = 0 then 0 else size end as pub_pick",
            "size div 3 as pub_win",
        )

    @cached_property
    def leagues(self) -> DataFrame:
        return self._records(
            self.table("nation"),
            "leagueid",
            "bigint",
            "n_nationkey as leagueid",
            "lower(n_name) as name",
            "case n_regionkey when 0 then 'premium' when 1 then 'professional' else 'amateur' end"
            " as tier",
            "cast(null as string) as ticket",
            "concat('b', n_nationkey) as banner",
        )

    @cached_property
    def teams(self) -> DataFrame:
        return self._records(
            self.table("supplier"),
            "team_id",
            "bigint",
            "s_suppkey as team_id",
            "case s_suppkey % 4 when 0 then '' when 1 then null else lower(s_name) end as name",
            "case s_suppkey % 3 when 0 then null when 1 then '' else concat('t', s_suppkey) end"
            " as tag",
            "cast(s_acctbal as decimal(12,2)) as rating",
            "s_nationkey as wins",
            "case when s_suppkey % 6 = 0 then '' else cast(s_nationkey + 1 as string) end as losses",
            "concat('logo/', s_suppkey) as logo_url",
        )

    @cached_property
    def pros(self) -> DataFrame:
        return self._records(
            self.table("supplier"),
            "account_id",
            "bigint",
            "s_suppkey as account_id",
            "s_name as name",
            "case when s_suppkey % 3 = 0 then '' else '80' end as rank_tier",
            "s_nationkey as team_id",
            "concat('avatar/', s_suppkey) as avatarmedium",
        )

    def bronze(self) -> dict[str, DataFrame]:
        """All bronze tables."""
        return {
            "matches": self.documents(),
            "leagues": self.leagues,
            "players": self.pros,
            "teams": self.teams,
            "hero_stats": self.hero_stats,
            "constants": self.constants(),
        }


def _beside(rows: DataFrame, section: DataFrame) -> DataFrame:
    """``rows`` with the fields of a section of the same player.

    Only the match is a join key, as both sides lie in the tasks of their matches; with the line number as a
    second one Spark would shuffle them by both.
    """
    other = section.withColumnsRenamed({"ok": "__ok", "ln": "__ln"})
    apart = F.abs(F.col("ln").cast("bigint") - F.col("__ln").cast("bigint"))
    return rows.join(other, (F.col("ok") == F.col("__ok")) & (apart == 0), "left").drop("__ok", "__ln")


def _by(field: str):
    """Comparator for structs by one field; the other fields may be maps, which have no order."""

    def compare(a: Column, b: Column) -> Column:
        return F.when(a[field] < b[field], -1).when(a[field] > b[field], 1).otherwise(0)

    return compare
