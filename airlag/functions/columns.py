"""Scalar expressions of the silver layer and the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlag.config import LATE_AFTER

# The code points that Unicode calls White_Space.
WHITESPACE = "".join(
    chr(point)
    for first, last in [
        (0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
        (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
        (0x3000, 0x3000),
    ]
    for point in range(first, last + 1)
)


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The given names that ``df`` has, compared with their exact case."""
    have = set(df.columns)
    return [name for name in names if name in have]


def column_for(
    df: DataFrame, names: Sequence[str], coalesce_layouts: bool = False
) -> Column | None:
    """The first of ``names`` found in ``df``, or all of them coalesced."""
    found = present(df, names)
    if not found:
        return None
    if coalesce_layouts and len(found) > 1:
        return F.coalesce(*[F.col(name) for name in found])
    return F.col(found[0])


def required_column(
    df: DataFrame, names: Sequence[str], coalesce_layouts: bool = False
) -> Column:
    column = column_for(df, names, coalesce_layouts)
    if column is None:
        raise ValueError(f"bronze has none of the columns {list(names)}")
    return column


def decoded_path(encoded: Column) -> Column:
    """A path as the file system names it; Spark reports it percent-encoded."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def normalize_code(column: Column) -> Column:
    """Upper case without white space at the ends, of whatever Unicode kind.

    Most codes begin and end with a visible ASCII character once spaces are
    off; only the others are searched for the full list, which costs more.
    """
    spaceless = F.trim(column.cast("string"))
    first, last = F.ascii(spaceless), F.ascii(F.right(spaceless, F.lit(1)))
    visible = first.between(33, 126) & last.between(33, 126)
    return F.upper(
        F.when(visible, spaceless).otherwise(F.btrim(spaceless, F.lit(WHITESPACE)))
    )


def scheduled_hour(clock: Column) -> Column:
    """Hour of an HHMM clock value; 2400 gives 24."""
    return F.floor(clock / F.lit(100)).cast("tinyint")


def season(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .otherwise("Autumn")
    )


def route(origin: Column, dest: Column) -> Column:
    """``origin-dest``; null when either end is null."""
    return F.concat(origin, F.lit("-"), dest)


def dashed(*parts: Column) -> Column:
    """Parts joined by dashes without zero padding; null if any part is null."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("-"), part.cast("string")]
    return F.concat(*pieces[1:])


def flag_is_zero(df: DataFrame, flag: Column) -> Column:
    """``flag == 0`` for a numeric or a boolean flag."""
    if isinstance(df.select(flag.alias("flag")).schema["flag"].dataType, T.BooleanType):
        return ~flag
    return flag == F.lit(0)


def is_late(delay: Column) -> Column:
    return delay > F.lit(LATE_AFTER)


def delay_bucket(delay: Column) -> Column:
    """Histogram label; nulls land in the last bucket."""
    return (
        F.when(delay < -15, "< -15")
        .when(delay < 0, "-15..0")
        .when(delay <= 15, "0..15")
        .when(delay <= 60, "16..60")
        .when(delay <= 180, "61..180")
        .otherwise("> 180")
    )
