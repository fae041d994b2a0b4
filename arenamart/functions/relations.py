"""Relational patterns that recur in the models, usable on any DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def null_aware_not_in(df: DataFrame, col: str, other: DataFrame, other_col: str) -> DataFrame:
    """Rows of ``df`` for which SQL's ``col NOT IN (SELECT other_col ...)`` is true.

    Spark plans NOT IN as an anti join that must broadcast the whole other side. An equi anti join
    plus two counts of the other side gives the same rows for sides of any size.
    """
    facts = other.agg(
        F.struct(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col(other_col).isNull()).alias("nulls")
        ).alias("facts")
    )
    seen = other.select(F.col(other_col).alias("__seen")).where("__seen is not null").distinct()
    side = facts.scalar()
    kept = df.join(seen, df[col] == seen["__seen"], "left_anti")
    nothing_listed = side.getField("rows") == 0
    no_null_listed = (side.getField("nulls") == 0) & F.col(col).isNotNull()
    return kept.where(nothing_listed | no_null_listed)


def without_keys(df: DataFrame, col: Column, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``col`` is not among ``keys`` (its first column).

    One lazy anti join; the adaptive planner broadcasts the keys where their measured size allows.
    """
    listed = keys.select(F.col(keys.columns[0]).alias("__listed")).distinct()
    return df.join(listed, col == F.col("__listed"), "left_anti")


def number_rows(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Row number within groups that are small by nature, such as the rows of one match."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def rank_rows(
    df: DataFrame,
    keys: list[str],
    coarse: list[tuple[str, bool]],
    fine: list[Column],
    name: str,
) -> DataFrame:
    """Row number over ``coarse + fine`` order within ``keys``, for groups that may be huge.

    Groups are split by the values of the ``coarse`` order columns, one column after the other: a
    window numbers the rows of each smallest split, and every column adds the number of rows with
    an earlier value. A window over a column holds one row per distinct value of it among rows that
    agree in all columns before, never the rows of a group. The order is ``(column, descending)``
    pairs for the coarse part and sort expressions for the fine part.
    """
    outer = [f"__key_{i}" for i in range(len(keys))]
    names = [f"__coarse_{i}" for i in range(len(coarse))]
    tagged = df.withColumns(dict(zip([*outer, *names], [F.col(c) for c in [*keys, *[c for c, _ in coarse]]])))
    sizes = tagged.groupBy(*outer, *names).agg(F.count(F.lit(1)).alias("__size"))
    before = None
    for level, (_, down) in enumerate(coarse):
        own, above = [*outer, *names[: level + 1]], [*outer, *names[:level]]
        here = sizes.groupBy(*own).agg(F.sum("__size").alias("__size"))
        order = F.col(names[level]).desc_nulls_first() if down else F.col(names[level]).asc_nulls_last()
        earlier = Window.partitionBy(*above).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        here = here.select(*own, F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before"))
        before = here if before is None else _add_before(here, before, above)
    local = tagged.withColumn("__local", F.row_number().over(Window.partitionBy(*outer, *names).orderBy(*fine)))
    joined = _same_keys(local, before, [*outer, *names])
    return joined.select(*df.columns, (F.col("__before") + F.col("__local")).alias(name))


def _same_keys(df: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
    """Left join on equal values, with null equal to null; the keys of ``side`` are dropped."""
    named = side.withColumnsRenamed({c: f"{c}_s" for c in on})
    match = [F.col(c).eqNullSafe(F.col(f"{c}_s")) for c in on]
    return df.join(named, match, "left").drop(*[f"{c}_s" for c in on])


def _add_before(here: DataFrame, above: DataFrame, on: list[str]) -> DataFrame:
    joined = _same_keys(here, above.withColumnRenamed("__before", "__above"), on)
    return joined.withColumn("__before", F.col("__before") + F.col("__above")).drop("__above")


def top_per_key(
    df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows per key; Spark prunes each input partition to ``n`` rows first."""
    name = rank or "__rank"
    top = number_rows(df, keys, order, name).where(F.col(name) <= n)
    return top if rank else top.drop(name)


def latest_per_key(
    df: DataFrame, keys: list[str], order: list[str], values: list[str]
) -> DataFrame:
    """Values of the row with the greatest ``order`` tuple (nulls count as oldest) per key.

    An aggregate rather than a window, so a key with very many rows is reduced before the shuffle.
    """
    newest = F.max_by(F.struct(*values), F.struct(*order)).alias("__newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "__newest.*")


def lookup(
    df: DataFrame, dim: DataFrame, on: Column | str, key: str, fields: dict[str, str]
) -> DataFrame:
    """Left join that adds ``fields`` (dim column -> new name) from a dimension with unique key.

    No broadcast hint: the planner broadcasts when the measured size of the dimension allows it.
    """
    source = F.col(on) if isinstance(on, str) else on
    side = dim.select(F.col(key).alias("__key"), *[F.col(c).alias(n) for c, n in fields.items()])
    return df.join(side, source == F.col("__key"), "left").drop("__key")


def unpivot_rows(df: DataFrame, variants: list[list[Column]]) -> DataFrame:
    """One output row per variant and input row, in a single pass over the input."""
    return df.select(F.inline(F.array(*[F.struct(*v) for v in variants])))
