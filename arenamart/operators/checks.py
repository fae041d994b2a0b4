"""Data-quality checks. Each returns the failing rows, so an empty result means passed."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenamart import fixed_values as fv
from arenamart.operators.facts import longest_draft


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values that occur more than once."""
    return unique_combination(df.where(F.col(col).isNotNull()), [col])


def unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def accepted_values(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Values outside the list with their number of rows; null passes."""
    odd = df.where(~F.col(col).isin(values))
    return odd.groupBy(col).agg(F.count(F.lit(1)).alias("row_count"))


def relationships(df: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose key has no parent; null passes."""
    known = parent.select(F.col(parent_col).alias("__parent"))
    return df.where(F.col(col).isNotNull()).join(
        known, F.col(col) == F.col("__parent"), "left_anti"
    )


def seq_in_range(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col) < 1)


def slot_coverage(draft_grid: DataFrame, drafts: DataFrame) -> DataFrame:
    """One row if the grid has fewer slots than the longest draft needs."""
    grid = draft_grid.agg(F.max("slot").alias("slot_max"))
    return grid.withColumn("seq_max", longest_draft(drafts).scalar()).where("slot_max < seq_max")


def freshness(
    df: DataFrame,
    now: Column,
    col: str = "loaded_at",
    warn_days: int = fv.FRESHNESS_WARN_DAYS,
    error_days: int = fv.FRESHNESS_ERROR_DAYS,
) -> DataFrame:
    """One row: newest load, its age in days, and pass, warn or error."""
    newest = df.agg(F.max(col).alias("newest"))
    age = (F.unix_seconds(now.cast("timestamp")) - F.unix_seconds("newest")) / F.lit(86400)
    status = (
        F.when(F.col("newest").isNull() | (age > error_days), "error")
        .when(age > warn_days, "warn")
        .otherwise("pass")
    )
    return newest.select("newest", age.alias("age_days"), status.alias("status"))


@dataclass(frozen=True)
class Check:
    """A declared check: ``kind`` names a function of this module."""

    kind: str
    table: str
    column: str
    values: tuple[str, ...] = ()
    parent: tuple[str, str] = ("", "")

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.table}.{self.column}"

    def failing(self, tables: dict[str, DataFrame]) -> DataFrame:
        df = tables[self.table]
        if self.kind == "accepted_values":
            return accepted_values(df, self.column, list(self.values))
        if self.kind == "relationships":
            return relationships(df, self.column, tables[self.parent[0]], self.parent[1])
        if self.kind == "unique_combination":
            return unique_combination(df, list(self.values))
        if self.kind == "slot_coverage":
            return slot_coverage(df, tables[self.parent[0]])
        return {"not_null": not_null, "unique": unique, "seq_in_range": seq_in_range}[self.kind](
            df, self.column
        )


DECLARED_CHECKS: list[Check] = [
    *[Check(kind, t, c) for kind in ("not_null", "unique") for t, c in fv.KEY_COLUMNS],
    *[Check("not_null", t, c) for t, columns in fv.REQUIRED_COLUMNS for c in columns],
    *[Check("relationships", t, c, parent=(parent, key)) for t, c, parent, key in fv.REFERENCES],
    *[Check("accepted_values", t, "side", (fv.RADIANT, fv.DIRE)) for t in fv.SIDED_TABLES],
    *[Check("accepted_values", t, c, values) for t, c, values in fv.ACCEPTED],
    *[Check("seq_in_range", t, c) for t, c in fv.NUMBERED_COLUMNS],
    *[Check("unique_combination", t, ", ".join(columns), columns) for t, columns in fv.GRAINS],
    *[Check("slot_coverage", t, c, parent=(drafts, "")) for t, c, drafts in fv.DRAFT_GRIDS],
]


def _row_test(check: Check) -> Column | None:
    """Condition of a failing row, for checks that look at one row at a time."""
    if check.kind == "not_null":
        return F.col(check.column).isNull()
    if check.kind == "seq_in_range":
        return F.col(check.column) < 1
    if check.kind == "accepted_values":
        return ~F.col(check.column).isin(list(check.values))
    return None


def summarize(tables: dict[str, DataFrame], checks: list[Check] | None = None) -> DataFrame:
    """One row per check with its number of failures, as one lazy plan.

    All row-wise checks of a table share one scan; keys and links take an aggregate or join each.
    """
    usable = [
        c
        for c in checks or DECLARED_CHECKS
        if c.table in tables and (not c.parent[0] or c.parent[0] in tables)
    ]
    parts = []
    for table in dict.fromkeys(c.table for c in usable):
        tests = [(c, _row_test(c)) for c in usable if c.table == table]
        tests = [(c, test) for c, test in tests if test is not None]
        if tests:
            counts = [F.count_if(test).alias(f"n{i}") for i, (_, test) in enumerate(tests)]
            named = [
                F.struct(F.lit(c.name).alias("check"), F.col(f"n{i}").alias("failing"))
                for i, (c, _) in enumerate(tests)
            ]
            parts.append(tables[table].agg(*counts).select(F.inline(F.array(*named))))
    for check in usable:
        if _row_test(check) is None:
            failing = check.failing(tables).agg(F.count(F.lit(1)).alias("failing"))
            parts.append(failing.select(F.lit(check.name).alias("check"), "failing"))
    return reduce(DataFrame.unionByName, parts)
