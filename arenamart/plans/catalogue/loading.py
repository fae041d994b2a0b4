"""Queries for sources, sinks, worklists, coverage, streams and the whole build.

Files and tables that a query needs are written below the shared folder of the session, each time
under a new path.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from functools import cache
from itertools import groupby
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenamart import schemas
from arenamart.operators import checks, staging
from arenamart.plans import pipeline
from arenamart.plans.catalogue import models
from arenamart.plans.catalogue.oracle_tables import PRELUDE, oracle
from arenamart.plans.catalogue.digests import checks_sql, digests_sql, table_digests
from arenamart.plans.catalogue.star import SECTIONS, Star
from arenamart.plans.catalogue.support import Entry, published
from arenamart.session import fresh_path
from arenamart.sources import coverage, documents, sinks, worklists
from arenamart.streaming import micro_batch

ENTRIES: dict[str, Entry] = {}
# Document files carry their name; a null name as Spark writes it.
FILE_NAME = r"name=([^/]+)[.]txt$"
NO_NAME = "__HIVE_DEFAULT_PARTITION__"
#: Tasks that write document files.
FILE_TASKS = 64


def add(name: str, build, sql: str | None = None) -> None:
    """Register ``build(spark, table)`` where ``table(name)`` reads a driver table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(spark, lambda t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet"))

    ENTRIES[name] = Entry(published(run), sql)


def star(name: str, build, sql: str | None = None) -> None:
    run = published(lambda spark, sf_dir: build(Star(spark, sf_dir)))
    ENTRIES[name] = Entry(run, oracle(sql) if sql else None)


def _write_files(folder: str):
    """Writes ``value`` of rows sorted by ``name`` as files; values of one name are lines of one file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        rows = ((r["name"], r["value"] or "") for batch in batches for r in batch.to_pylist())
        for name, same in groupby(rows, key=lambda r: r[0]):
            with files.open_output_stream(f"{root}/name={NO_NAME if name is None else quote(name)}.txt") as out:
                out.write("".join(f"{value}\n" for _, value in same).encode())
            yield pa.RecordBatch.from_pylist([{"name": name}], pa.schema([("name", pa.string())]))

    return run


def written_files(spark: SparkSession, docs: DataFrame) -> str:
    """Write ``value`` of every row as a file of its own, which carries ``name``.

    The tasks write the files themselves, as a file of Spark's writer comes with a folder, a checksum and
    several renames. A task that runs again writes the same files.
    """
    path = fresh_path(spark, "files")
    files, root = fs.FileSystem.from_uri(path)
    files.create_dir(root)
    rows = docs.select(F.col("name").cast("string").alias("name"), "value")
    rows = rows.repartition(FILE_TASKS, "name").sortWithinPartitions("name")
    rows.mapInArrow(_write_files(path), "name string").count()
    return path


TEAM_DOC = (
    "to_json(struct(case when s_suppkey % 4 <> 0 then s_suppkey end as team_id, s_name as name,"
    " '2026-01-01T00:00:00Z' as timestamp_fetched))"
)


def _team_files(spark: SparkSession, t) -> str:
    return written_files(spark, t("supplier").selectExpr("s_suppkey as name", f"{TEAM_DOC} as value"))


def _doc_per_file(spark: SparkSession, t) -> DataFrame:
    files = documents.read_files(spark, _team_files(spark, t), FILE_NAME)
    rows = documents.documents_by_key(files, "team_id", "bigint", F.lit(None).cast("timestamp"))
    return rows.select("team_id", _written(F.col("payload")).alias("payload"))


def _written(payload):
    """The text writer ends every file with a line feed."""
    return F.rtrim(payload, F.lit("\n"))


TEAM_PAYLOADS = """SELECT s_suppkey AS team_id, CASE WHEN s_suppkey % 4 <> 0
     THEN '{"team_id":' || s_suppkey || ',"name":"' || s_name || '"}'
     ELSE '{"name":"' || s_name || '","timestamp_fetched":"2026-01-01T00:00:00Z"}' END AS payload
FROM supplier"""
add("src_doc_per_file", _doc_per_file, TEAM_PAYLOADS)


def _quarantine(spark: SparkSession, t) -> DataFrame:
    """A folder in which every third document is cut off."""
    doc = F.expr(f"case when s_suppkey % 3 = 0 then substr({TEAM_DOC}, 1, 12) else {TEAM_DOC} end")
    path = written_files(spark, t("supplier").select(F.col("s_suppkey").alias("name"), doc.alias("value")))
    tables = documents.load_folder(spark, path, layout=[("teams", "name=*.txt", False)])
    broken = tables["quarantine"].select("table", F.lit(None).cast("bigint").alias("team_id"), _written(F.col("value")).alias("text"))
    return tables["teams"].select(F.lit("loaded").alias("table"), "team_id", F.col("payload").alias("text")).unionByName(broken)


add(
    "src_quarantine",
    _quarantine,
    """SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'teams' ELSE 'loaded' END AS "table",
       CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey END AS team_id,
       CASE WHEN s_suppkey % 3 <> 0 THEN '{"team_id":' || s_suppkey || ',"name":"' || s_name || '"}'
         WHEN s_suppkey % 4 = 0 THEN substr('{"name":"' || s_name, 1, 12)
         ELSE substr('{"team_id":' || s_suppkey || ',"name"', 1, 12) END AS text
    FROM supplier WHERE s_suppkey % 3 = 0 OR s_suppkey % 4 <> 0""",
)


def _array_file(spark: SparkSession, t) -> DataFrame:
    """Files of up to 50 teams; a number and an object without key must be skipped."""
    lists = t("supplier").groupBy(F.expr("s_suppkey div 50").alias("name")).agg(
        F.concat(
            F.lit('[7,{"other":1},'),
            F.substring(F.to_json(F.collect_list(F.expr(
                "struct(s_suppkey as team_id, s_name as name, 'x' as timestamp_fetched)"
            ))), 2, 2**31 - 1),
        ).alias("value")
    )
    files = documents.read_files(spark, written_files(spark, lists), FILE_NAME)
    rows = documents.elements_by_key(files, "team_id", "bigint", F.lit(None).cast("timestamp"))
    return rows.select("team_id", "payload")


add(
    "src_array_file",
    _array_file,
    """SELECT s_suppkey AS team_id,
       '{"team_id":' || s_suppkey || ',"name":"' || s_name || '"}' AS payload FROM supplier""",
)


def _resource_file(s: Star) -> DataFrame:
    path = written_files(
        s.spark, s.constants().select(F.col("resource").alias("name"), F.col("payload").alias("value"))
    )
    files = documents.read_files(s.spark, path, FILE_NAME)
    bronze = documents.resource_documents(files, F.lit(None).cast("timestamp"))
    return staging.resource_entries(bronze, "item_ids", "string").unionByName(
        staging.resource_entries(bronze, "region", "string")
    )


star(
    "src_resource_file",
    _resource_file,
    "SELECT item_id AS key, item_internal_name AS entry FROM d_item"
    " UNION ALL SELECT CAST(r_regionkey AS VARCHAR), r_name FROM region",
)
add(
    "strip_payload_field",
    lambda spark, t: t("events").selectExpr(
        "event_id",
        "case when event_id % 2 = 0 then concat('{\"u\": ', user_id,"
        " ', \"timestamp_fetched\": \"t\", \"p\": ', props, '}') else props end as doc",
    ).select("event_id", documents.strip_payload_field(F.col("doc")).alias("doc")),
    """SELECT event_id, CASE WHEN event_id % 2 = 0
         THEN '{"u":' || user_id || ',"p":' || replace(props, ' ', '') || '}' ELSE props END AS doc
    FROM events""",
)


def _upsert(spark: SparkSession, t) -> DataFrame:
    stored = t("customer").selectExpr("c_custkey as id", "c_mktsegment as payload")
    incoming = t("orders").groupBy(F.expr("o_custkey * 2").alias("id")).agg(
        F.max("o_orderpriority").alias("payload")
    )
    path = fresh_path(spark, "upserted")
    sinks.upsert_sink(stored, path, "id")
    return sinks.upsert_sink(incoming, path, "id")


add(
    "upsert_by_key",
    _upsert,
    """WITH n AS (SELECT o_custkey * 2 AS id, max(o_orderpriority) AS p FROM orders GROUP BY 1)
    SELECT coalesce(id, c_custkey) AS id, coalesce(p, c_mktsegment) AS payload
    FROM customer FULL JOIN n ON id = c_custkey""",
)
add(
    "skip_existing",
    lambda spark, t: documents.skip_existing(
        t("orders").selectExpr("cast(o_orderkey as string) as name", "o_orderstatus as value"),
        t("lineitem").select("l_orderkey"),
    ),
    "SELECT CAST(o_orderkey AS VARCHAR) AS name, o_orderstatus AS value FROM orders"
    " WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
add(
    "append_new_keys",
    lambda spark, t: worklists.append_new_keys(
        t("supplier").selectExpr("s_suppkey as id"),
        t("lineitem").selectExpr("nullif(l_partkey, 500) as id", "l_suppkey", "l_orderkey", "l_linenumber"),
        "id",
        F.lit("2026-01-01T00:00:00Z"),
        ["l_orderkey", "l_linenumber", "l_suppkey"],
    ),
    """SELECT l_partkey AS id, l_suppkey, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       '2026-01-01T00:00:00Z' AS timestamp_fetched FROM lineitem
    WHERE l_partkey <> 500 AND l_partkey NOT IN (SELECT s_suppkey FROM supplier)
    QUALIFY row_number() OVER (PARTITION BY l_partkey
                               ORDER BY l_orderkey, l_linenumber, l_suppkey) = 1""",
)


add(
    "append_new_members",
    lambda spark, t: worklists.append_new_members(
        t("supplier").selectExpr("cast(s_suppkey as string) as name"),
        t("part").selectExpr(
            "cast(p_partkey as string) as name",
            "case when p_partkey % 3 = 0 then to_json(struct(p_size as n, 'old' as timestamp_fetched))"
            " else cast(p_size as string) end as value",
        ),
        F.lit("2026-01-01T00:00:00Z"),
    ),
    """SELECT CAST(p_partkey AS VARCHAR) AS name, CASE WHEN p_partkey % 3 = 0
         THEN '{"n":' || p_size || ',"timestamp_fetched":"2026-01-01T00:00:00Z"}'
         ELSE CAST(p_size AS VARCHAR) END AS value
    FROM part WHERE p_partkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
add(
    "append_by_first_useful_key",
    lambda spark, t: worklists.append_by_first_useful_key(
        t("part").selectExpr("p_name as name", "p_partkey as id"),
        t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).selectExpr(
            "p_name as name", "l_orderkey as id", "l_linenumber", "l_suppkey"
        ),
        F.lit("2026-01-01T00:00:00Z"),
        ["l_linenumber", "l_suppkey", "name"],
    ).select("id", "l_linenumber", "timestamp_fetched"),
    """SELECT l_orderkey AS id, CAST(min(l_linenumber) AS BIGINT) AS l_linenumber,
       '2026-01-01T00:00:00Z' AS timestamp_fetched
    FROM lineitem WHERE l_orderkey NOT IN (SELECT p_partkey FROM part) GROUP BY 1""",
)


def _worklist(spark: SparkSession, t) -> DataFrame:
    return worklists.missing_worklist(
        t("orders").selectExpr("o_orderkey as id", "o_custkey % 27 as league"),
        t("lineitem").selectExpr("l_orderkey as id"),
        t("embeddings").selectExpr("vec_id as id"),
        "id",
    )


add(
    "missing_worklist",
    _worklist,
    """SELECT o_orderkey AS id, o_custkey % 27 AS league FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
      AND o_orderkey NOT IN (SELECT vec_id FROM embeddings)""",
)
def _leagues(t, tier: str, later: str) -> DataFrame:
    """Customers as leagues; some are listed a second time with another tier."""
    return t("customer").selectExpr(
        "c_custkey as leagueid",
        "case when c_custkey % 40 = 0 then concat('The International ', 1000 + c_custkey)"
        " else c_name end as name",
        f"case {tier} when 0 then 'premium' when 1 then 'professional' when 2 then 'amateur' end as tier",
        f"c_custkey + {later} as at",
    )


add(
    "priority_worklist",
    lambda spark, t: worklists.priority_worklist(
        _leagues(t, "c_nationkey % 4", "0").unionByName(
            _leagues(t, "(c_nationkey + 1) % 4", "10000000").where("leagueid % 10 = 3")
        ),
        ["77", "40", "13"],
    ).select("leagueid", "place.group", "place.within", "place.at"),
    """SELECT * FROM (SELECT c_custkey AS leagueid, CAST(CASE WHEN f THEN 0
         WHEN c_custkey IN (77, 13) THEN 1 WHEN k = 0 THEN 2 WHEN k = 1 THEN 3 END AS BIGINT)
         AS "group",
       CASE WHEN f THEN 1000 + c_custkey WHEN c_custkey = 77 THEN 1 WHEN c_custkey = 13 THEN 3
            ELSE 0 END AS within, c_custkey AS at
    FROM (SELECT *, c_custkey % 40 = 0 AND c_custkey < 9000 AS f,
          CAST((c_nationkey + CASE WHEN c_custkey % 10 = 3 THEN 1 ELSE 0 END) % 4 AS BIGINT) AS k
          FROM customer)) WHERE "group" IS NOT NULL""",
)


def _csv_seed(spark: SparkSession, t) -> DataFrame:
    path = fresh_path(spark, "csv")
    t("customer").select("c_custkey", "c_name", "c_mktsegment").write.csv(path, header=True)
    return documents.read_csv_seed(spark, path, "c_custkey bigint, c_name string, c_mktsegment string")


add("csv_seed", _csv_seed, "SELECT c_custkey, c_name, c_mktsegment FROM customer")


def _table_sink(spark: SparkSession, t) -> DataFrame:
    path = fresh_path(spark, "table")
    return sinks.table_sink(
        t("orders").select("o_orderkey", "o_custkey", "o_orderstatus"),
        path,
        ["o_orderkey"],
        ["o_orderstatus"],
    )


add("table_sink", _table_sink, "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")


def _view_sink(spark: SparkSession, t) -> DataFrame:
    sinks.view_sink(t("customer").where("c_acctbal > 0"), "solvent_customers")
    return spark.sql(
        "select c_mktsegment, count(*) as n from solvent_customers group by c_mktsegment"
    )


add(
    "view_sink",
    _view_sink,
    "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1",
)


def _incremental_sink(spark: SparkSession, t) -> DataFrame:
    """A refresh of wrong rows, a part, then everything twice: each row must be there once."""
    path = fresh_path(spark, "incremental")
    events = t("events").select("event_id", "user_id", "event_type")
    sinks.incremental_sink(events.withColumn("user_id", -F.col("user_id")), path, ["event_id"])
    sinks.incremental_sink(events.where("event_type = 'view'"), path, ["event_id"], full_refresh=True)
    sinks.incremental_sink(events.where("event_type = 'click'"), path, ["event_id"])
    sinks.incremental_sink(events, path, ["event_id"])
    return sinks.incremental_sink(events, path, ["event_id"])


add("incremental_sink", _incremental_sink, "SELECT event_id, user_id, event_type FROM events")


def _snapshot(spark: SparkSession, t) -> DataFrame:
    tables = {n: t(n) for n in ("customer", "orders", "part")}
    root = sinks.snapshot_sink(tables, fresh_path(spark, "snapshots"), "gold", datetime(2026, 1, 2))
    keys = {"customer": "c_custkey", "orders": "o_orderkey", "part": "p_partkey"}
    copies = [
        spark.read.parquet(f"{root}/{n}").select(
            F.lit(root.rsplit("/", 1)[1]).alias("folder"), F.lit(n).alias("table"), F.col(k).alias("key"),
            F.col(text).alias("text"),
        )
        for (n, k), text in zip(keys.items(), ("c_name", "o_orderpriority", "p_name"))
    ]
    return copies[0].unionByName(copies[1]).unionByName(copies[2])


add(
    "snapshot_sink",
    _snapshot,
    """SELECT 'gold_20260102_000000' AS folder, * FROM (
       SELECT 'customer' AS "table", c_custkey AS key, c_name AS text FROM customer
       UNION ALL SELECT 'orders', o_orderkey, o_orderpriority FROM orders
       UNION ALL SELECT 'part', p_partkey, p_name FROM part)""",
)


def _analyze(spark: SparkSession, t) -> DataFrame:
    path = fresh_path(spark, "analyzed")
    t("orders").select("o_orderkey", "o_custkey").write.parquet(path)
    name = "analyzed_" + path.rsplit("-", 1)[1]
    spark.sql(f"create table {name} using parquet location '{path}'")
    sinks.analyze_tables(spark, [name])
    found = spark.sql(f"describe extended {name} o_custkey")
    spark.sql(f"drop table {name}")
    return found.where("info_name in ('min', 'max', 'num_nulls')").select(
        F.col("info_name").alias("stat"), F.col("info_value").cast("bigint").alias("value")
    )


add(
    "analyze_tables",
    _analyze,
    "SELECT unnest(['min', 'max', 'num_nulls']) AS stat,"
    " unnest([min(o_custkey), max(o_custkey), count(*) - count(o_custkey)]) AS value FROM orders",
)

# Coverage --------------------------------------------------------------------------------------------

FLAGS_SQL = """SELECT match_id AS name, match_id, radiant_win, leagueid, patch, game_mode, lobby_type,
       region, coalesce(fights, 0) AS n_teamfights, coalesce(picks, 0) AS n_picks_bans,
       coalesce(series, false) AS has_gold_t, coalesce(series, false) AS has_xp_t,
       played AS has_ability_upgrades, coalesce(logged, false) AS has_purchase_log,
       coalesce(obs, false) AS has_obs_log, false AS has_sen_log, played AS has_damage_type,
       played AS has_runes, coalesce(logged, false) AS has_kills_log,
       coalesce(fights, 0) > 0 AS has_teamfights, coalesce(picks, 0) > 0 AS has_picks_bans,
       coalesce(zero, false) AS has_hero_zero,
       coalesce(radiant_team_id, '0') = '0' OR coalesce(dire_team_id, '0') = '0'
         AS has_missing_team
    FROM s_matches
    LEFT JOIN (SELECT CAST(ok AS VARCHAR) AS match_id, bool_or(pmax % 131 = 0) AS zero,
                 bool_or(ln % 3 = 0 AND qty % 4 > 0) AS obs, true AS present
               FROM lines GROUP BY 1) USING (match_id)
    LEFT JOIN (SELECT match_id, count(*) AS fights FROM s_fights GROUP BY 1) USING (match_id)
    LEFT JOIN (SELECT match_id, count(*) AS picks FROM s_picks GROUP BY 1) USING (match_id)
    LEFT JOIN (SELECT DISTINCT CAST(ok AS VARCHAR) AS match_id, true AS logged
               FROM events JOIN lines ON ok = event_id // 20 AND ln = event_id % 20 % 7 + 1)
      USING (match_id)
    LEFT JOIN (SELECT DISTINCT CAST(ok AS VARCHAR) AS match_id, true AS series
               FROM embeddings JOIN lines ON ok = vec_id AND ln = label % 7 + 1) USING (match_id)
    CROSS JOIN LATERAL (SELECT coalesce(present, false) AS played)"""
RICH_SQL = "SELECT *, " + " + ".join(f"CAST({f} AS BIGINT)" for f in coverage.FLAGS) + (
    f" AS richness FROM ({FLAGS_SQL})"
)
star("coverage_flags", lambda s: coverage.coverage_flags(s.coverage_documents()), RICH_SQL)


def _values(col: str) -> str:
    return f"count(DISTINCT {col}) + max(CAST({col} IS NULL AS BIGINT))"


star(
    "coverage_report",
    lambda s: coverage.coverage_report(coverage.coverage_flags(s.coverage_documents())),
    "SELECT " + ", ".join(f"count(*) FILTER ({f}) AS {f}" for f in coverage.FLAGS) + f""",
       count(*) AS matches, count(*) FILTER (radiant_win) AS radiant_wins,
       count(*) FILTER (NOT radiant_win) AS dire_wins,
       count(*) FILTER (radiant_win IS NULL) AS draws, {_values("leagueid")} AS leagues,
       {_values("patch")} AS patches, {_values("region")} AS regions,
       {_values("game_mode")} AS game_modes FROM ({FLAGS_SQL})""",
)


SAMPLE, FOCUS = 200, 12


def _sample(s: Star) -> DataFrame:
    """The choice reads the flags several times, so they are written once."""
    path = fresh_path(s.spark, "flags")
    flags = sinks.table_sink(coverage.coverage_flags(s.coverage_documents()), path)
    return coverage.coverage_sample(flags, SAMPLE, FOCUS)


BEST = "richness DESC, n_teamfights DESC, n_picks_bans DESC, name"


def _sample_sql() -> str:
    """The greedy choice as a recursion: one step for each branch, which picks its best free match."""
    tests = [f"SELECT {i} AS code, * FROM flags WHERE {test}" for i, test in enumerate(coverage.BRANCHES)]
    for k, field in enumerate(coverage.DIVERSE_FIELDS, 1):
        tests.append(
            f"""SELECT {100 * k} + place AS code, flags.* FROM flags JOIN (
         SELECT {field}, row_number() OVER (ORDER BY count(*) DESC, {field}) AS place
         FROM flags WHERE {field} IS NOT NULL GROUP BY {field}) USING ({field})
       WHERE place <= {coverage.DIVERSE_VALUES}"""
        )
    union = "\n  UNION ALL BY NAME ".join(tests)
    return PRELUDE.replace("WITH\n", "WITH RECURSIVE\n", 1).rstrip().rstrip(",") + f""",
flags AS MATERIALIZED ({RICH_SQL}),
candidates AS MATERIALIZED (
  SELECT dense_rank() OVER (ORDER BY code) AS branch, name,
         row_number() OVER (PARTITION BY code ORDER BY {BEST}) AS pos FROM ({union})),
picks AS (
  SELECT CAST(1 AS BIGINT) AS branch, CAST([] AS VARCHAR[]) AS chosen
  UNION ALL
  SELECT branch + 1, list_concat(chosen, list_filter([(
    SELECT arg_min(c.name, c.pos) FROM candidates c
    WHERE c.branch = picks.branch AND NOT list_contains(picks.chosen, c.name))], lambda x: x IS NOT NULL))
  FROM picks WHERE branch <= (SELECT max(branch) FROM candidates)),
required AS (
  SELECT unnest(chosen) AS name, generate_subscripts(chosen, 1) AS first
  FROM (SELECT chosen FROM picks ORDER BY branch DESC LIMIT 1)),
focus AS (
  SELECT leagueid, row_number() OVER (ORDER BY count(*) DESC, min(name)) AS turn
  FROM flags GROUP BY leagueid ORDER BY turn LIMIT {FOCUS}),
rest AS (
  SELECT flags.*, turn FROM flags LEFT JOIN focus ON flags.leagueid IS NOT DISTINCT FROM focus.leagueid
  WHERE name NOT IN (SELECT name FROM required)),
queue AS (
  SELECT name, 0 AS stage, first, 0 AS second FROM required
  UNION ALL SELECT name, 1, row_number() OVER (PARTITION BY turn ORDER BY {BEST}), turn FROM rest WHERE turn IS NOT NULL
  UNION ALL SELECT name, 2, row_number() OVER (ORDER BY {BEST}), 0 FROM rest WHERE turn IS NULL)
SELECT name, row_number() OVER (ORDER BY stage, first, second) AS place
FROM queue QUALIFY place <= {SAMPLE}"""


star("coverage_sample", _sample)
ENTRIES["coverage_sample"] = Entry(ENTRIES["coverage_sample"].run, _sample_sql())

# Streams and the whole build -------------------------------------------------------------------------


def _stream_bronze(spark: SparkSession, t) -> DataFrame:
    """Documents arrive twice; the second run must add nothing."""
    folder, target = _team_files(spark, t), fresh_path(spark, "bronze")
    for _ in range(2):
        micro_batch.stream_bronze(
            spark, folder, target, fresh_path(spark, "progress"), "teams", FILE_NAME
        ).awaitTermination()
    return spark.read.parquet(target).select("team_id", _written(F.col("payload")).alias("payload"))


add("stream_bronze", _stream_bronze, TEAM_PAYLOADS)


def _stream_silver(s: Star) -> DataFrame:
    """Every match arrives again, changed; what was flattened first must stay as it is."""
    bronze, target = fresh_path(s.spark, "bronze"), fresh_path(s.spark, "silver")
    progress = fresh_path(s.spark, "progress")
    columns = [f.name for f in schemas.bronze_schema("matches").fields]
    first = s.driver.documents("logs").select(*columns)
    changed = first.withColumn("payload", F.replace("payload", F.lit("npc_dota_hero_"), F.lit("npc_dota_hero_9")))
    for documents_of_day in (first, changed):
        documents_of_day.write.mode("append").option("compression", sinks.CODEC).parquet(bronze)
        micro_batch.stream_silver(s.spark, bronze, target, progress, "stg_match_player_kills").awaitTermination()
    return s.spark.read.parquet(target).drop("batch")


star("stream_silver", _stream_silver, "SELECT * FROM s_kills")


def _stream_silver_tables(s: Star) -> DataFrame:
    """All silver tables from one stream that sees half of the matches first, then all of them."""
    bronze, target = fresh_path(s.spark, "bronze"), fresh_path(s.spark, "silver")
    progress = fresh_path(s.spark, "progress")
    columns = [f.name for f in schemas.bronze_schema("matches").fields]
    every = s.driver.documents().select(*columns)
    for odd in (False, True):
        part = every.where(f"match_id % 2 {'<>' if odd else '='} 0")
        if odd:  # the others come again as they were stored
            part = part.unionByName(s.spark.read.parquet(bronze))
        part.write.mode("append").option("compression", sinks.CODEC).parquet(bronze)
        micro_batch.stream_silver_tables(s.spark, bronze, target, progress, s.constants("abilities", "items")).awaitTermination()
    return table_digests(micro_batch.silver_tables(s.spark, target))


star("stream_silver_tables", _stream_silver_tables)
ENTRIES["stream_silver_tables"] = Entry(
    ENTRIES["stream_silver_tables"].run, digests_sql({n: models.SILVER_SQL[n] for n in SECTIONS})
)

GOLD = [n for n in models.ENTRIES if n.startswith(("dim_", "fact_"))]


def _bronze(s: Star, root: str) -> dict[str, DataFrame]:
    return {n: sinks.table_sink(df, f"{root}/raw_{n}") for n, df in s.driver.bronze().items()}


@cache
def _built(session: str, sf_dir: str) -> dict[str, DataFrame]:
    """One stored build per session and folder; the queries on it read its tables."""
    s = Star(SparkSession.getActiveSession(), sf_dir)
    root = fresh_path(s.spark, "build")
    return pipeline.run_layers(s.spark, None, root, _bronze(s, root), load=False, check=False, freshness=False)


def _build_of(s: Star) -> dict[str, DataFrame]:
    return _built(s.spark.sparkContext.applicationId, s.driver.sf_dir)


def _model_sql(name: str) -> str:
    sql = models.ENTRIES[name].sql.removeprefix(PRELUDE)
    # The registered queries of the fixed lists join them with the match data.
    extra = {"dim_date": "matches", "dim_rune": "picked_up"}.get(name)
    return f"SELECT * EXCLUDE ({extra}) FROM ({sql})" if extra else sql


def _run_layers(s: Star) -> DataFrame:
    """Build every table from bronze documents, stored layer by layer, and digest the gold tables."""
    tables = _build_of(s)
    return table_digests({n: tables[n] for n in GOLD})


star("run_layers", _run_layers)
ENTRIES["run_layers"] = Entry(ENTRIES["run_layers"].run, digests_sql({n: _model_sql(n) for n in GOLD}))


def _run_increment(s: Star) -> DataFrame:
    """Silver of half of the matches, then an increment with all of them; digests of what is stored then."""
    root, silver = fresh_path(s.spark, "build"), fresh_path(s.spark, "silver")
    bronze = _bronze(s, root)
    half = bronze | {"matches": bronze["matches"].where("match_id % 2 = 0")}
    for place, part in (("a", half), ("b", bronze)):
        tables = pipeline.run_layers(
            s.spark, None, f"{root}/{place}", part, load=False, gold=False, check=False, extend=silver
        )
    return table_digests({n: tables[n] for n in SECTIONS})


def _run_refresh(s: Star) -> DataFrame:
    """Stored silver that misses half of the matches; a full refresh must not rely on it."""
    root, silver = fresh_path(s.spark, "build"), fresh_path(s.spark, "silver")
    bronze = _bronze(s, root)
    half = staging.parse_matches(bronze["matches"].where("match_id % 2 = 0"))
    # Stored, as each silver table reads it.
    half = sinks.table_sink(half, f"{root}/half")
    pipeline.extend_silver(half, bronze["constants"], silver)
    tables = pipeline.run_layers(
        s.spark, None, f"{root}/a", bronze, load=False, gold=False, check=False, extend=silver, full_refresh=True
    )
    return table_digests({n: tables[n] for n in SECTIONS})


for _name, _run in (("run_increment", _run_increment), ("run_full_refresh", _run_refresh)):
    star(_name, _run)
    ENTRIES[_name] = Entry(ENTRIES[_name].run, digests_sql({n: models.SILVER_SQL[n] for n in SECTIONS}))


def _check_summary(s: Star) -> DataFrame:
    """Failing rows of every declared check over a whole build."""
    return checks.summarize(_build_of(s))


star("check_summary", _check_summary)
CHECKED = sorted({c.table for c in checks.DECLARED_CHECKS} | {c.parent[0] for c in checks.DECLARED_CHECKS if c.parent[0]})
ENTRIES["check_summary"] = Entry(
    ENTRIES["check_summary"].run, checks_sql({n: models.RUNE_SQL if n == "rune_lookup" else _model_sql(n) for n in CHECKED})
)
