"""Column expressions shared by all models. Everything stays inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from arenamart import fixed_values as fv


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def to_int(col: Column) -> Column:
    """Integer from JSON text; an empty text counts as missing, dirty text is an error."""
    return blank_to_null(col).cast("int")


def to_exact(col: Column, precision: int = 18, scale: int = 8) -> Column:
    return blank_to_null(col).cast(f"decimal({precision},{scale})")


def slot_side(slot: Column) -> Column:
    return F.when(slot.cast("int") < fv.FIRST_DIRE_SLOT, fv.RADIANT).otherwise(fv.DIRE)


def team_side(team_number: Column) -> Column:
    """Side by team number; anything but '0', also a missing number, is dire."""
    return F.when(team_number == "0", fv.RADIANT).otherwise(fv.DIRE)


def position_team(position: Column) -> Column:
    """Team number for a 1-based position in a fight's player list."""
    return F.when(position <= fv.PLAYERS_PER_SIDE, "0").otherwise("1")


def position_slot(position: Column) -> Column:
    """Player slot for a 1-based position in a fight's player list."""
    dire = position - (fv.PLAYERS_PER_SIDE + 1) + fv.FIRST_DIRE_SLOT
    return F.when(position <= fv.PLAYERS_PER_SIDE, position - 1).otherwise(dire).cast("string")


def log_minute(seconds: Column) -> Column:
    """Whole minute of an event; events before the start fall into minute 0."""
    return F.greatest(F.floor(seconds / F.lit(60)), F.lit(0)).cast("int")


def exact_div(numerator: Column, denominator: Column, scale: int) -> Column:
    """Quotient in exact decimals, rounded half away from zero; null when dividing by zero.

    The operand widths leave at least 14 digits behind the point before rounding.
    """
    below = F.nullif(denominator.cast("decimal(13,0)"), F.lit(0).cast("decimal(13,0)"))
    return F.round(numerator / below, scale)


def rate(part: Column, whole: Column, scale: int = 4) -> Column:
    return exact_div(part.cast("decimal(19,0)"), whole, scale)


def exact_avg(col: Column, scale: int, source_scale: int = 0) -> Column:
    """Average over non-null values without floating point.

    Integer columns are summed as such; a decimal column names its own scale.
    """
    total = F.sum(col).cast("decimal(19,0)") if source_scale == 0 else F.sum(col)
    return exact_div(total, F.count(col), scale)


def minutes(seconds: Column) -> Column:
    return F.round(seconds.cast("decimal(10,0)") / F.lit(60).cast("decimal(2,0)"), 2)


def hours(seconds: Column) -> Column:
    return F.round(seconds.cast("decimal(10,0)") / F.lit(3600).cast("decimal(4,0)"), 3)


def ladder(value: Column, steps: list[tuple[int, str]], rest: str) -> Column:
    """Label of the first upper bound above the value; a null value gets the last label."""
    col = None
    for bound, label in steps:
        col = F.when(value < bound, label) if col is None else col.when(value < bound, label)
    return col.otherwise(rest)


def like_any(col: Column, patterns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [col.like(p) for p in patterns])


def json_kind(text: Column) -> Column:
    """Kind of a JSON text by its first character, which decides it for valid JSON."""
    first = F.substring(F.ltrim(text), 1, 1)
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(first == "{", "object")
        .when(first == "[", "array")
        .when(first == '"', "string")
        .when(first.isin("t", "f"), "boolean")
        .when(first == "n", "null")
        .otherwise("number")
    )


def variant_kind(value: Column) -> Column:
    """Kind of a JSON value by its own type; a missing value and a JSON null are both ``null``."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.isNull() | (kind == "VOID"), "null")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean")
        .otherwise("number")
    )


def display_name(name: Column, prefix: str) -> Column:
    return F.upper(F.replace(name, F.lit(prefix), F.lit("")))


def hosted_image(path: Column) -> Column:
    return F.when(blank_to_null(path).isNotNull(), F.concat(F.lit(fv.IMAGE_HOST), path))
