"""Joins and aggregates that several domain operators share.

No operator here uses a window partitioned by a business key: a key that holds
a large part of the rows would put them all in one task. Group totals are
partially aggregated before the shuffle and joined back with hot keys dealt out
(``spread``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.functions.predicates import ci, not_deleted

FISCAL_COLUMNS = ("fiscal_year", "quarter", "period", "week")


def live(df: DataFrame) -> DataFrame:
    return df.filter(not_deleted())


def fiscal_days(calendar: DataFrame) -> DataFrame:
    """One row per day of the calendar, so a date finds its week by equality."""
    return calendar.select(
        F.explode(F.sequence("week_start", "week_end")).alias("fiscal_day"),
        *[c for c in FISCAL_COLUMNS if c in calendar.columns],
    )


def fiscal_period_of(
    df: DataFrame, date_col: str, calendar: DataFrame, columns: tuple[str, ...] = FISCAL_COLUMNS
) -> DataFrame:
    """Adds the fiscal columns of a date; a date outside every week gets NULLs."""
    days = fiscal_days(calendar).select("fiscal_day", *columns)
    return df.join(days, F.to_date(df[date_col]) == F.col("fiscal_day"), "left").drop("fiscal_day")


def lowest(columns: dict[str, Column], *order: Column, where: Column | None = None) -> Column:
    """The columns of the row that sorts first, as one struct; ties do not matter
    because the values themselves end the order."""
    keys = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    row = F.struct(*keys, *[c.alias(n) for n, c in columns.items()])
    return F.min(row if where is None else F.when(where, row))


def highest(columns: dict[str, Column], *order: Column, where: Column | None = None) -> Column:
    keys = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    row = F.struct(*keys, *[c.alias(n) for n, c in columns.items()])
    return F.max(row if where is None else F.when(where, row))


def join_by_code_or_default(
    df: DataFrame, table: DataFrame, code: str, columns: list[str], default: str = "DEFAULT"
) -> DataFrame:
    """Columns of the table row for ``code``, or of the default row when the code has none.

    The choice is per row: one matched row supplies all columns. Rows whose
    code is NULL take the default row as well.
    """
    rows = table.select(ci(F.col("source_system")).alias("_code"), F.struct(*columns).alias("_own"))
    fallback = rows.filter(F.col("_code") == default).select(F.col("_own").alias("_def"))
    joined = df.join(rows, ci(df[code]) == rows["_code"], "left")
    spare = fallback.agg(F.min("_def")).scalar()
    picked = F.coalesce(F.col("_own"), spare)
    out = joined.withColumn("_pick", picked)
    return out.select(*df.columns, *[F.col(f"_pick.{c}").alias(c) for c in columns])


def sort_by(df: DataFrame, column: str, direction: str, allowed: tuple[str, ...], tiebreak: str) -> DataFrame:
    """Order by a column named by the caller; anything outside ``allowed`` is refused."""
    name = column.lower()
    if name not in allowed:
        raise ValueError(f"cannot sort by {column!r}; choose one of {', '.join(allowed)}")
    order = F.col(name).desc() if direction.upper() == "DESC" else F.col(name).asc()
    return df.orderBy(order, F.col(tiebreak).asc())
