"""The relational, JSON and scalar building blocks of the models, each on the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenamart.functions import columns as C
from arenamart.functions import relations as R
from arenamart.plans.catalogue.support import Entry, published, rounded

ENTRIES: dict[str, Entry] = {}
Tables = Callable[[str], DataFrame]


def add(name: str, build: Callable[[Tables], DataFrame], sql: str) -> None:
    def run(spark, sf_dir):
        return build(lambda t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet"))

    ENTRIES[name] = Entry(published(run), sql)


def rows(name: str, table: str, exprs: list[str], sql: str, where: str | None = None) -> None:
    """A projection, optionally filtered, of one whole table."""

    def build(t: Tables) -> DataFrame:
        df = t(table)
        return (df.where(where) if where else df).selectExpr(*exprs)

    add(name, build, sql)


# Joins -----------------------------------------------------------------------------------------------

add(
    "join_inner",
    lambda t: t("customer").join(
        t("nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "c_name", "n_name"),
    "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
add(
    "join_left",
    lambda t: R.lookup(
        t("orders").select("o_orderkey", "o_custkey"),
        t("supplier"),
        "o_custkey",
        "s_suppkey",
        {"s_name": "s_name"},
    ),
    "SELECT o_orderkey, o_custkey, s_name FROM orders LEFT JOIN supplier ON s_suppkey = o_custkey",
)


def _line_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


add(
    "join_composite_key",
    lambda t: _line_totals(t("lineitem")).join(
        t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("part")),
        ["l_orderkey", "l_linenumber"],
    ),
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, a.n, b.part
    FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2) a
    JOIN (SELECT l_orderkey, l_linenumber, max(l_partkey) AS part FROM lineitem GROUP BY 1, 2) b
      USING (l_orderkey, l_linenumber)""",
)
add(
    "join_computed_key",
    lambda t: R.lookup(
        t("events").select("event_id", "user_id"),
        t("nation"),
        F.expr("cast((user_id * 3 + event_id) % 29 as int)"),
        "n_nationkey",
        {"n_name": "n_name"},
    ),
    "SELECT event_id, user_id, n_name FROM events"
    " LEFT JOIN nation ON n_nationkey = (user_id * 3 + event_id) % 29",
)


def _self_join(t: Tables) -> DataFrame:
    turns = t("conversations").select("conv_id", "turn", "role")
    nxt = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("reply_by"))
    return turns.join(nxt, ["conv_id", "turn"])


add(
    "join_self",
    _self_join,
    "SELECT a.conv_id, a.turn, a.role, b.role AS reply_by FROM conversations a"
    " JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1",
)


def _grid(t: Tables) -> DataFrame:
    """Every customer segment with every slot up to the largest line number, without a join."""
    slots = t("lineitem").agg(F.max("l_linenumber")).scalar()
    segments = t("customer").select("c_mktsegment").distinct()
    return segments.select("c_mktsegment", F.explode(F.sequence(F.lit(1), slots)).alias("slot"))


add(
    "join_cross",
    _grid,
    "SELECT c_mktsegment, slot FROM (SELECT DISTINCT c_mktsegment FROM customer) CROSS JOIN"
    " (SELECT unnest(range(1, 1 + (SELECT max(l_linenumber) FROM lineitem))) AS slot)",
)
add(
    "join_single_row",
    lambda t: t("supplier").select(
        "s_suppkey", t("nation").agg(F.max("n_name")).scalar().alias("last_nation")
    ),
    "SELECT s_suppkey, (SELECT max(n_name) FROM nation) AS last_nation FROM supplier",
)
add(
    "join_anti_not_in",
    lambda t: R.null_aware_not_in(
        t("orders").selectExpr("o_orderkey", "nullif(o_custkey % 200, 0) as k"),
        "k",
        t("supplier"),
        "s_suppkey",
    ),
    "SELECT o_orderkey, k FROM (SELECT o_orderkey, nullif(o_custkey % 200, 0) AS k FROM orders)"
    " WHERE k NOT IN (SELECT s_suppkey FROM supplier)",
)
add(
    "join_anti_not_exists",
    lambda t: t("orders").select("o_orderkey").join(
        t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti"
    ),
    "SELECT o_orderkey FROM orders WHERE NOT EXISTS"
    " (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)


def _thresholds(t: Tables) -> DataFrame:
    steps = t("nation").agg(F.collect_list(F.expr("cast(n_nationkey * 1000 as double)"))).scalar()
    reached = F.size(F.filter("steps", lambda s: s <= F.col("c_acctbal")))
    return t("customer").withColumn("steps", steps).select("c_custkey", reached.alias("level"))


add(
    "join_range_threshold",
    _thresholds,
    "SELECT c_custkey, (SELECT count(*) FROM nation WHERE n_nationkey * 1000 <= c_acctbal) AS level"
    " FROM customer",
)
add(
    "join_lateral",
    lambda t: t("embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "x")).where(
        "x > 0"
    ).select("vec_id", "pos"),
    "SELECT vec_id, pos FROM (SELECT vec_id, unnest(embedding) AS x,"
    " unnest(range(len(embedding))) AS pos FROM embeddings) WHERE x > 0",
)

# Aggregation -----------------------------------------------------------------------------------------

add(
    "agg_group",
    lambda t: t("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_partkey").alias("parts"),
        F.min("l_suppkey").alias("low"),
        F.max("l_suppkey").alias("high"),
        C.exact_avg(F.col("l_partkey"), 2).alias("mean_part"),
    ),
    f"""SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS parts,
       min(l_suppkey) AS low, max(l_suppkey) AS high,
       {rounded("sum(l_partkey)", "count(l_partkey)", 2)} AS mean_part
    FROM lineitem GROUP BY 1, 2""",
)
add(
    "agg_filter",
    lambda t: t("orders").groupBy("o_orderpriority").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("finished"),
        F.sum(F.when(F.col("o_orderstatus") == "O", F.col("o_custkey"))).alias("open_sum"),
    ),
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS finished,
       CAST(sum(o_custkey) FILTER (o_orderstatus = 'O') AS BIGINT) AS open_sum
    FROM orders GROUP BY 1""",
)
add(
    "agg_pivot",
    lambda t: t("orders").groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"]).agg(
        F.max("o_orderkey")
    ),
    """SELECT o_custkey, max(o_orderkey) FILTER (o_orderstatus = 'F') AS F,
       max(o_orderkey) FILTER (o_orderstatus = 'O') AS O,
       max(o_orderkey) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1""",
)
add(
    "agg_string_ordered",
    lambda t: t("customer").select("c_nationkey", "c_mktsegment").distinct().groupBy(
        "c_nationkey"
    ).agg(
        F.expr(
            "listagg(c_mktsegment, ', ') within group (order by c_mktsegment desc)"
            " filter (where c_mktsegment <> 'BUILDING')"
        ).alias("segments")
    ),
    """SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey,
       string_agg(c_mktsegment, ', ' ORDER BY c_mktsegment DESC)
         FILTER (c_mktsegment <> 'BUILDING') AS segments
    FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer) GROUP BY 1""",
)
add(
    "agg_count_distinct",
    lambda t: t("lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders")
    ),
    "SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1",
)
add(
    "agg_safe_ratio",
    lambda t: t("orders").groupBy("o_custkey").agg(
        C.rate(
            F.count_if(F.col("o_orderstatus") == "F"), F.count_if(F.col("o_orderstatus") != "P")
        ).alias("share")
    ),
    "SELECT o_custkey, " + rounded(
        "count(*) FILTER (o_orderstatus = 'F')", "count(*) FILTER (o_orderstatus <> 'P')", 4
    ) + " AS share FROM orders GROUP BY 1",
)
add(
    "agg_scalar",
    lambda t: t("lineitem").agg(F.max("l_linenumber").alias("top"), F.min("l_partkey").alias("low")),
    "SELECT CAST(max(l_linenumber) AS BIGINT) AS top, min(l_partkey) AS low FROM lineitem",
)
add(
    "agg_having",
    lambda t: _line_totals(t("lineitem")).where("n > 1"),
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n FROM lineitem"
    " GROUP BY 1, 2 HAVING count(*) > 1",
)


def _nested_agg(t: Tables) -> DataFrame:
    totals = t("events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("event_type").asc()]
    return R.number_rows(totals, ["user_id"], order, "place")


add(
    "agg_nested",
    _nested_agg,
    """SELECT user_id, event_type, count(*) AS n,
       row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS place
    FROM events GROUP BY 1, 2""",
)

# Windows ---------------------------------------------------------------------------------------------

add(
    "win_row_number",
    lambda t: R.rank_rows(
        t("orders").select("o_orderkey", "o_custkey", "o_orderdate"),
        ["o_custkey"],
        [("o_orderdate", False)],
        [F.col("o_orderkey").asc_nulls_last()],
        "nth",
    ).select("o_orderkey", "nth"),
    "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"
    " AS nth FROM orders",
)
add(
    "win_latest_per_key",
    lambda t: R.latest_per_key(
        t("events"), ["user_id"], ["ts", "event_id"], ["event_type", "event_id"]
    ),
    """SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER
       (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1""",
)
add(
    "win_top_n",
    lambda t: R.top_per_key(
        t("orders"),
        ["o_custkey"],
        [F.col("o_totalprice").desc_nulls_first(), F.col("o_orderkey").asc()],
        3,
        "place",
    ).select("o_custkey", "o_orderkey", "place"),
    """SELECT o_custkey, o_orderkey, row_number() OVER w AS place FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey)
    QUALIFY place <= 3""",
)
add(
    "win_rank_multi_key",
    lambda t: R.rank_rows(
        t("lineitem").groupBy("l_returnflag", "l_suppkey").agg(
            F.count(F.lit(1)).alias("n"), F.max("l_partkey").alias("part")
        ),
        ["l_returnflag"],
        [("n", True), ("part", True)],
        [F.col("l_suppkey").asc_nulls_last()],
        "place",
    ).select("l_returnflag", "l_suppkey", "place"),
    """SELECT l_returnflag, l_suppkey, row_number() OVER (PARTITION BY l_returnflag
       ORDER BY count(*) DESC, max(l_partkey) DESC, l_suppkey) AS place
    FROM lineitem GROUP BY 1, 2""",
)
add(
    "win_max_row",
    lambda t: t("lineitem").groupBy("l_orderkey").agg(
        F.max_by("l_suppkey", F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("suppkey")
    ),
    """SELECT l_orderkey, l_suppkey AS suppkey FROM lineitem QUALIFY row_number() OVER
       (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1""",
)

# Sort, limit, sets, generators -----------------------------------------------------------------------

add(
    "sort_multi",
    lambda t: t("customer").select("c_custkey", "c_nationkey", "c_mktsegment").orderBy(
        F.col("c_nationkey").desc_nulls_first(), F.col("c_mktsegment").asc_nulls_last(), "c_custkey"
    ),
    "SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment FROM customer"
    " ORDER BY c_nationkey DESC NULLS FIRST, c_mktsegment ASC NULLS LAST, c_custkey",
)
add(
    "limit_n",
    lambda t: t("orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(50).select(
        "o_orderkey"
    ),
    "SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50",
)
add(
    "set_union_all",
    lambda t: t("customer").selectExpr("c_custkey as id", "'customer' as kind").unionByName(
        t("supplier").selectExpr("s_suppkey as id", "'supplier' as kind")
    ),
    "SELECT c_custkey AS id, 'customer' AS kind FROM customer UNION ALL"
    " SELECT s_suppkey, 'supplier' FROM supplier",
)
add(
    "set_union_distinct",
    lambda t: t("customer").selectExpr("c_nationkey as id").union(
        t("supplier").selectExpr("s_nationkey as id")
    ).distinct(),
    "SELECT CAST(c_nationkey AS BIGINT) AS id FROM customer"
    " UNION SELECT CAST(s_nationkey AS BIGINT) FROM supplier",
)
add(
    "distinct_rows",
    lambda t: t("lineitem").select("l_partkey", "l_suppkey").distinct(),
    "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
)
add(
    "gen_series_int",
    lambda t: t("lineitem").agg(F.max("l_linenumber").alias("top")).select(
        F.explode(F.expr("sequence(1, top)")).alias("slot")
    ),
    "SELECT unnest(range(1, 1 + (SELECT max(l_linenumber) FROM lineitem))) AS slot",
)
add(
    "gen_series_date",
    lambda t: t("orders").agg(
        F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b")
    ).select(F.explode(F.expr("sequence(a, b, interval 1 day)")).alias("day")),
    """SELECT strftime(unnest(generate_series(a, b, INTERVAL 1 DAY)), '%Y-%m-%d') AS day
    FROM (SELECT date_trunc('day', min(o_orderdate)) AS a, date_trunc('day', max(o_orderdate)) AS b
          FROM orders)""",
)


def _values_row(t: Tables) -> DataFrame:
    from arenamart.operators.dimensions import with_unknown_member

    return with_unknown_member(
        t("part").select("p_partkey", "p_name", "p_size"), {"p_partkey": -1, "p_name": "Unknown"}
    )


add(
    "values_row",
    _values_row,
    "SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size FROM part"
    " UNION ALL SELECT -1, 'Unknown', NULL",
)

# JSON ------------------------------------------------------------------------------------------------


def docs(t: Tables) -> DataFrame:
    """One JSON document per event: scalars, an object, a list, a list of objects, sometimes null."""
    return t("events").select(
        "event_id",
        F.to_json(
            F.expr(
                "struct(event_type as type, user_id as user, from_json(props, 'k int') as props,"
                " case when event_id % 7 = 0 then null else array(user_id, event_id % 10) end as ids,"
                " array(struct('a' as key, event_id % 3 as n), struct('b' as key, user_id as n))"
                " as parts, map('x', event_id % 4, event_type, user_id) as counts)"
            ),
            {"ignoreNullFields": "false"},
        ).alias("doc"),
    )


K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def json(name: str, build: Callable[[DataFrame], DataFrame], sql: str) -> None:
    add(name, lambda t: build(docs(t)), sql)


json(
    "json_get_text",
    lambda d: d.select("event_id", F.get_json_object("doc", "$.type").alias("type")),
    "SELECT event_id, event_type AS type FROM events",
)
json(
    "json_get_path",
    lambda d: d.select(
        "event_id",
        F.variant_get(F.parse_json("doc"), "$.props.k", "bigint").alias("k"),
        F.try_variant_get(F.parse_json("doc"), "$.ids[1]", "bigint").alias("second"),
    ),
    f"SELECT event_id, {K} AS k, CASE WHEN event_id % 7 <> 0 THEN event_id % 10 END AS second"
    " FROM events",
)
json(
    "json_scalar_text",
    lambda d: d.select(
        "event_id",
        F.explode(F.from_json(F.get_json_object("doc", "$.counts"), "map<string,string>")).alias(
            "k", "v"
        ),
    ),
    "SELECT event_id, unnest(['x', event_type]) AS k,"
    " CAST(unnest([event_id % 4, user_id]) AS VARCHAR) AS v FROM events",
)
PARTS = "struct<parts:array<struct<key:string,n:bigint>>>"
json(
    "json_array_explode",
    lambda d: d.select("event_id", F.inline(F.from_json("doc", PARTS)["parts"])),
    "SELECT event_id, 'a' AS key, event_id % 3 AS n FROM events"
    " UNION ALL SELECT event_id, 'b', user_id FROM events",
)
json(
    "json_array_explode_ordinal",
    lambda d: d.select(
        "event_id", F.posexplode(F.from_json("doc", PARTS)["parts"]).alias("at", "p")
    ).select("event_id", (F.col("at") + 1).alias("ordinal"), "p.key"),
    "SELECT event_id, unnest([CAST(1 AS BIGINT), 2]) AS ordinal, unnest(['a', 'b']) AS key"
    " FROM events",
)
json(
    "json_array_text_explode",
    lambda d: d.select(
        "event_id", F.explode(F.from_json("doc", "struct<ids:array<string>>")["ids"]).alias("id")
    ),
    "SELECT event_id, CAST(unnest([user_id, event_id % 10]) AS VARCHAR) AS id FROM events"
    " WHERE event_id % 7 <> 0",
)
json(
    "json_object_explode",
    lambda d: d.select(
        "event_id", F.explode(F.from_json("doc", "map<string,variant>")).alias("field", "value")
    ).select(
        "event_id",
        "field",
        C.variant_kind(F.col("value"))
        .alias("kind"),
    ),
    "SELECT event_id, unnest(['type', 'user', 'props', 'ids', 'parts', 'counts']) AS field,"
    " unnest(['string', 'number', 'object', CASE WHEN event_id % 7 = 0 THEN 'null' ELSE 'array' END,"
    " 'array', 'object']) AS kind FROM events",
)
json(
    "json_object_text_explode",
    lambda d: d.select(
        "event_id",
        F.explode(F.from_json("doc", "struct<counts:map<string,string>>")["counts"]).alias("k", "v"),
    ).select("event_id", "k", F.col("v").cast("bigint").alias("n")).where("n > 0"),
    """SELECT * FROM (SELECT event_id, unnest(['x', event_type]) AS k,
       unnest([event_id % 4, user_id]) AS n FROM events) WHERE n > 0""",
)


def _recordset(t: Tables) -> DataFrame:
    """Rows of one JSON list per nation's customers' segments."""
    lists = t("customer").select("c_nationkey", "c_mktsegment").distinct().groupBy(
        "c_nationkey"
    ).agg(F.to_json(F.collect_list(F.struct("c_mktsegment"))).alias("doc"))
    return lists.select(
        "c_nationkey", F.inline(F.from_json("doc", "array<struct<c_mktsegment:string,none:int>>"))
    )


add(
    "json_recordset",
    _recordset,
    "SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment,"
    " CAST(NULL AS BIGINT) AS none FROM customer",
)
json(
    "json_typeof",
    lambda d: d.select(
        "event_id",
        C.json_kind(F.col("doc")).alias("whole"),
        C.json_kind(F.from_json("doc", "struct<ids:string>")["ids"]).alias("ids"),
    ),
    "SELECT event_id, 'object' AS whole, CASE WHEN event_id % 7 <> 0 THEN 'array' END AS ids"
    " FROM events",
)
json(
    "json_array_length",
    lambda d: d.select(
        "event_id",
        F.coalesce(F.json_array_length(F.get_json_object("doc", "$.ids")), F.lit(0)).alias("n"),
    ),
    "SELECT event_id, CAST(CASE WHEN event_id % 7 <> 0 THEN 2 ELSE 0 END AS BIGINT) AS n FROM events",
)
json(
    "json_has_key",
    lambda d: d.select(
        "event_id",
        F.map_contains_key(F.from_json("doc", "map<string,string>"), "ids").alias("has_ids"),
        F.map_contains_key(
            F.from_json("doc", "struct<counts:map<string,string>>")["counts"], "click"
        ).alias("has_click"),
    ),
    "SELECT event_id, true AS has_ids, event_type = 'click' AS has_click FROM events",
)
json(
    "json_null_default",
    lambda d: d.select(
        "event_id",
        F.explode_outer(
            F.coalesce(F.from_json("doc", "struct<ids:array<bigint>>")["ids"], F.array(F.lit(-1)))
        ).alias("id"),
    ),
    "SELECT event_id, unnest(CASE WHEN event_id % 7 <> 0 THEN [user_id, event_id % 10]"
    " ELSE [-1] END) AS id FROM events",
)


def _dynamic_key(t: Tables) -> DataFrame:
    """A value of one JSON object by a key that differs per row: join with the object's entries."""
    names = t("nation").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.expr(
            "struct(cast(n_nationkey as string), n_name)"
        )))).alias("doc")
    )
    entries = names.select(F.explode(F.from_json("doc", "map<string,string>")).alias("k", "v"))
    wanted = t("customer").selectExpr("c_custkey", "cast(c_nationkey + c_custkey % 3 as string) as want")
    return R.lookup(wanted, entries, "want", "k", {"v": "value"})


add(
    "json_dynamic_key",
    _dynamic_key,
    "SELECT c_custkey, CAST(c_nationkey + c_custkey % 3 AS VARCHAR) AS want, n_name AS value"
    " FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey + c_custkey % 3",
)
add(
    "json_to_text",
    lambda t: t("orders").select(
        "o_orderkey",
        F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("s"))).alias(
            "doc"
        ),
    ),
    "SELECT o_orderkey, '{\"id\":' || o_orderkey || ',\"s\":\"' || o_orderstatus || '\"}' AS doc"
    " FROM orders",
)
add(
    "text_to_json",
    lambda t: t("events").select("event_id", F.from_json("props", "k int")["k"].alias("k")),
    f"SELECT event_id, {K} AS k FROM events",
)

# Projection, predicates, casts -----------------------------------------------------------------------

rows(
    "proj_rename_compute",
    "orders",
    ["o_orderkey as id", "o_custkey * 2 + 1 as odd", "o_orderstatus = 'F' as done"],
    "SELECT o_orderkey AS id, o_custkey * 2 + 1 AS odd, o_orderstatus = 'F' AS done FROM orders",
)


def _flip(t: Tables) -> DataFrame:
    a, b = F.col("l_partkey"), F.col("l_suppkey")
    views = [
        [F.col("l_orderkey"), a.alias("own"), b.alias("other")],
        [F.col("l_orderkey"), b.alias("own"), a.alias("other")],
    ]
    return R.unpivot_rows(t("lineitem"), views).where("own <> other")


add(
    "proj_flip_columns",
    _flip,
    """SELECT * FROM (SELECT l_orderkey, l_partkey AS own, l_suppkey AS other FROM lineitem
       UNION ALL SELECT l_orderkey, l_suppkey, l_partkey FROM lineitem) WHERE own <> other""",
)
rows(
    "filter_compare",
    "lineitem",
    ["l_orderkey", "l_partkey", "l_suppkey"],
    "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem"
    " WHERE l_partkey < l_suppkey AND l_quantity >= 10 AND l_returnflag <> 'N'",
    "l_partkey < l_suppkey and l_quantity >= 10 and l_returnflag <> 'N'",
)
add(
    "filter_boolean_column",
    lambda t: t("orders").selectExpr(
        "o_orderkey", "case o_orderstatus when 'F' then true when 'O' then false end as done"
    ).where("done"),
    "SELECT o_orderkey, true AS done FROM orders WHERE o_orderstatus = 'F'",
)
rows(
    "filter_conjunction",
    "customer",
    ["c_custkey"],
    "SELECT c_custkey FROM customer WHERE c_acctbal > 0 AND c_nationkey IN (1, 2, 3)"
    " AND c_mktsegment IS NOT NULL AND NOT c_mktsegment = 'BUILDING'",
    "c_acctbal > 0 and c_nationkey in (1, 2, 3) and c_mktsegment is not null"
    " and not c_mktsegment = 'BUILDING'",
)
add(
    "cast_text_int",
    lambda t: t("orders").select(
        "o_orderkey", C.to_int(F.expr("if(o_custkey % 5 = 0, '', cast(o_custkey as string))")).alias("n")
    ),
    "SELECT o_orderkey, CASE WHEN o_custkey % 5 <> 0 THEN o_custkey END AS n FROM orders",
)
add(
    "cast_text_decimal",
    lambda t: t("orders").select(
        "o_orderkey", C.to_exact(F.expr("concat(o_custkey, '.', o_orderkey % 90 + 10)")).alias("x")
    ),
    "SELECT o_orderkey, CAST(o_custkey || '.' || (o_orderkey % 90 + 10) AS DOUBLE) AS x FROM orders",
)
rows(
    "cast_text_boolean",
    "orders",
    ["o_orderkey", "cast(if(o_custkey % 2 = 0, 'true', 'false') as boolean) as even"],
    "SELECT o_orderkey, o_custkey % 2 = 0 AS even FROM orders",
)
rows(
    "cast_to_text",
    "orders",
    ["cast(o_orderkey as string) as id", "cast(o_custkey % 2 = 0 as string) as even"],
    "SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey % 2 = 0 AS VARCHAR) AS even"
    " FROM orders",
)


def _chain(t: Tables) -> DataFrame:
    per_customer = t("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    per_nation = per_customer.join(
        t("customer"), F.col("o_custkey") == F.col("c_custkey")
    ).groupBy("c_nationkey").agg(F.sum("n").alias("orders"), F.count(F.lit(1)).alias("buyers"))
    return R.lookup(per_nation, t("nation"), "c_nationkey", "n_nationkey", {"n_name": "nation"})


add(
    "cte_chain",
    _chain,
    """WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
    n AS (SELECT c_nationkey, CAST(sum(n) AS BIGINT) AS orders, count(*) AS buyers
          FROM c JOIN customer ON c_custkey = o_custkey GROUP BY 1)
    SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, orders, buyers, n_name AS nation
    FROM n LEFT JOIN nation ON n_nationkey = c_nationkey""",
)

# Strings, dates, numbers, conditions -----------------------------------------------------------------

rows(
    "str_concat",
    "part",
    ["p_partkey", "concat(p_name, ' vs ', nullif(p_type, 'SMALL')) as label"],
    "SELECT p_partkey, p_name || ' vs ' || nullif(p_type, 'SMALL') AS label FROM part",
)
rows("str_upper", "part", ["p_partkey", "upper(p_name) as u"],
     "SELECT p_partkey, upper(p_name) AS u FROM part")
add(
    "str_replace",
    lambda t: t("customer").select("c_custkey", C.display_name(F.col("c_name"), "Customer#").alias("n")),
    "SELECT c_custkey, upper(replace(c_name, 'Customer#', '')) AS n FROM customer",
)
rows("str_rtrim_chars", "customer", ["c_custkey", "rtrim('0', c_name) as n"],
     "SELECT c_custkey, rtrim(c_name, '0') AS n FROM customer")
rows("str_trim", "part", ["p_partkey", "trim(concat('  ', p_name, ' ')) as n"],
     "SELECT p_partkey, trim('  ' || p_name || ' ') AS n FROM part")
add(
    "str_like",
    lambda t: t("part").where(C.like_any(F.col("p_name"), ["%_ing", "red%"])).select("p_partkey", "p_name"),
    "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%_ing' OR p_name LIKE 'red%'",
)
rows(
    "str_regexp_replace",
    "documents",
    ["doc_id", "md5(regexp_replace(text, '[0-9]+', '#')) as masked"],
    "SELECT doc_id, md5(regexp_replace(text, '[0-9]+', '#', 'g')) AS masked FROM documents",
)
rows(
    "str_regexp_match",
    "pages",
    ["page_id", "regexp_extract(url, '^https?://([^/]+)/', 1) as host"],
    "SELECT page_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host FROM pages",
)
add(
    "str_null_if_empty",
    lambda t: t("supplier").select(
        "s_suppkey", C.blank_to_null(F.expr("if(s_nationkey % 2 = 0, '', s_name)")).alias("n")
    ),
    "SELECT s_suppkey, CASE WHEN s_nationkey % 2 <> 0 THEN s_name END AS n FROM supplier",
)
rows(
    "date_from_epoch",
    "events",
    ["event_id", "timestamp_seconds(1700000000 + event_id * 37) as at"],
    "SELECT event_id, strftime(TIMESTAMP '1970-01-01' + to_seconds(1700000000 + event_id * 37),"
    " '%Y-%m-%d %H:%M:%S') AS at FROM events",
)
rows("date_cast", "events", ["event_id", "cast(ts as date) as day"],
     "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
rows(
    "date_parse_iso",
    "orders",
    ["o_orderkey", "cast(to_timestamp(concat(2000 + o_custkey % 30, '-03-04T05:06:07Z')) as date) as day"],
    "SELECT o_orderkey, (2000 + o_custkey % 30) || '-03-04' AS day FROM orders",
)
rows(
    "date_parts",
    "orders",
    ["o_orderkey", "extract(year from o_orderdate) as y", "extract(quarter from o_orderdate) as q",
     "extract(doy from o_orderdate) as doy", "extract(week from o_orderdate) as w"],
    "SELECT o_orderkey, date_part('year', o_orderdate) AS y, date_part('quarter', o_orderdate) AS q,"
    " date_part('doy', o_orderdate) AS doy, date_part('week', o_orderdate) AS w FROM orders",
)
rows(
    "date_trunc_week",
    "orders",
    ["o_orderkey", "cast(date_trunc('week', o_orderdate) as date) as monday"],
    "SELECT o_orderkey, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS monday FROM orders",
)
rows(
    "date_labels",
    "orders",
    ["o_orderkey", "date_format(o_orderdate, 'EEEE') as d", "date_format(o_orderdate, 'yyyy-MMM') as m"],
    "SELECT o_orderkey, dayname(o_orderdate) AS d,"
    " date_part('year', o_orderdate) || '-' || substr(monthname(o_orderdate), 1, 3) AS m FROM orders",
)
add(
    "math_round",
    lambda t: t("orders").select("o_orderkey", C.minutes(F.col("o_custkey") - 700).alias("m")),
    f"SELECT o_orderkey, {rounded('(o_custkey - 700)', '60', 2)} AS m FROM orders",
)
add(
    "math_floor",
    lambda t: t("orders").select("o_orderkey", F.floor((F.col("o_custkey") - 700) / F.lit(60)).alias("m")),
    "SELECT o_orderkey, CAST(floor((o_custkey - 700) / 60.0) AS BIGINT) AS m FROM orders",
)
rows("math_abs", "orders", ["o_orderkey", "abs(o_custkey - 700) as gap"],
     "SELECT o_orderkey, abs(o_custkey - 700) AS gap FROM orders")
rows("math_mod", "orders", ["o_orderkey", "o_custkey % 400 = 0 as a", "(o_custkey - 700) % 7 as b"],
     "SELECT o_orderkey, o_custkey % 400 = 0 AS a, (o_custkey - 700) % 7 AS b FROM orders")
rows(
    "math_greatest_least",
    "lineitem",
    ["l_orderkey", "greatest(cast(l_partkey as string), cast(l_suppkey as string)) as hi",
     "least(l_partkey, l_suppkey, nullif(cast(l_linenumber as bigint), 1)) as lo"],
    "SELECT l_orderkey, greatest(CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS hi,"
    " least(l_partkey, l_suppkey, nullif(CAST(l_linenumber AS BIGINT), 1)) AS lo FROM lineitem",
)
add(
    "cond_case",
    lambda t: t("orders").select(
        "o_orderkey",
        C.ladder(F.expr("nullif(o_custkey % 30, 7)"), [(5, "close"), (10, "near"), (20, "far")], "rest")
        .alias("bucket"),
    ),
    """SELECT o_orderkey, CASE WHEN o_custkey % 30 = 7 THEN 'rest' WHEN o_custkey % 30 < 5 THEN 'close'
       WHEN o_custkey % 30 < 10 THEN 'near' WHEN o_custkey % 30 < 20 THEN 'far' ELSE 'rest' END
       AS bucket FROM orders""",
)
rows(
    "cond_simple_case",
    "orders",
    ["o_orderkey", "case o_orderstatus when 'F' then 'Finished' when 'O' then 'Open' else o_orderstatus end as s"],
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open'"
    " ELSE o_orderstatus END AS s FROM orders",
)
rows(
    "cond_coalesce",
    "supplier",
    ["s_suppkey", "coalesce(nullif(s_nationkey % 3, 0), nullif(s_nationkey % 5, 0), -1) as n"],
    "SELECT s_suppkey, CAST(coalesce(nullif(s_nationkey % 3, 0), nullif(s_nationkey % 5, 0), -1)"
    " AS BIGINT) AS n FROM supplier",
)
rows("cond_nullif", "customer", ["c_custkey", "nullif(c_mktsegment, 'MACHINERY') as s"],
     "SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS s FROM customer")
DONE = "case o_orderstatus when 'F' then true when 'O' then false end"
rows(
    "cond_is_true_false",
    "orders",
    ["o_orderkey", f"case when ({DONE}) is true then 'radiant' when ({DONE}) is false then 'dire'"
     " else 'draw' end as w"],
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'radiant' WHEN 'O' THEN 'dire'"
    " ELSE 'draw' END AS w FROM orders",
)
rows(
    "cond_not_3vl",
    "orders",
    ["o_orderkey", f"not ({DONE}) as lost"],
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN false WHEN 'O' THEN true END AS lost"
    " FROM orders",
)
rows(
    "cond_in_list",
    "orders",
    ["o_orderkey", "dayofweek(o_orderdate) - 1 in (0, 6) as weekend"],
    "SELECT o_orderkey, date_part('dow', o_orderdate) IN (0, 6) AS weekend FROM orders",
)
rows(
    "cond_not_null_filter",
    "orders",
    ["o_orderkey"],
    "SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'P') IS NOT NULL",
    "nullif(o_orderstatus, 'P') is not null",
)
add(
    "sub_scalar_uncorrelated",
    lambda t: t("orders").where(
        F.col("o_custkey") > t("customer").agg(F.count(F.lit(1)) / 2).scalar()
    ).select("o_orderkey"),
    "SELECT o_orderkey FROM orders WHERE o_custkey > (SELECT count(*) / 2 FROM customer)",
)


def _correlated(t: Tables) -> DataFrame:
    """A per-row count from another table, as one aggregate and a left join."""
    counts = t("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    found = R.lookup(t("customer").select("c_custkey"), counts, "c_custkey", "o_custkey", {"n": "n"})
    return found.withColumn("n", F.coalesce("n", F.lit(0)))


add(
    "sub_scalar_correlated",
    _correlated,
    "SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer",
)
