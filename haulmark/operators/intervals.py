"""Joins of moments with the periods that hold them.

An index of bins instead of a comparison of everything with everything: a
period is filed under bins about as long as itself, in one or two of them, so
long and open periods cost no more rows than short ones. A moment asks one bin
of each length that occurs, an equality that Spark hashes, and the bounds
themselves decide. Bins are counted in whole seconds; the bounds may be finer.

A missing bound is open: the period reaches to the first or last moment there
is. Bounds belong to the period. A moment that is missing lies in no period.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins are 2^SHORTEST seconds long at least (about an hour), and lengths grow by factors of 2^STEP.
SHORTEST, STEP = 12, 2


def _seconds(moment: Column) -> Column:
    """Whole seconds since 1970 as a clock on the wall shows them; a date is its midnight. No time zone enters."""
    at = moment.cast("timestamp_ntz")
    of_day = F.hour(at) * 3600 + F.minute(at) * 60 + F.floor(F.second(at))
    return F.datediff(F.to_date(at), F.lit("1970-01-01").cast("date")).cast("long") * 86400 + of_day


def _level(length: Column) -> Column:
    """The exponent of the shortest bin length that is not below ``length`` seconds."""
    exact = F.ceil(F.log2(length.cast("double"))).cast("int")
    steps = F.ceil(F.greatest(exact - SHORTEST, F.lit(0)) / STEP).cast("int")
    return steps * STEP + SHORTEST


def _bin(second: Column, level: Column) -> Column:
    return F.floor(second / F.pow(F.lit(2.0), level)).cast("long")


def filed(periods: DataFrame, start: str, end: str, first: Column, last: Column) -> DataFrame:
    """``periods`` with ``_level`` and ``_bin``, in one or two rows each; ``first`` and ``last`` bound the moments that will ask."""
    begin = F.greatest(F.coalesce(_seconds(F.col(start)), first), first)
    stop = F.least(F.coalesce(_seconds(F.col(end)), last), last)
    cut = periods.withColumns({"_begin": begin, "_stop": stop}).filter("_begin <= _stop")
    cut = cut.withColumn("_level", _level(F.col("_stop") - F.col("_begin") + 1))
    bins = F.sequence(_bin(F.col("_begin"), F.col("_level")), _bin(F.col("_stop"), F.col("_level")))
    return cut.withColumn("_bin", F.explode(bins)).drop("_begin", "_stop")


def join_periods(
    moments: DataFrame,
    periods: DataFrame,
    at: str,
    start: str,
    end: str,
    keys: Sequence[str] = (),
    ids: Sequence[str] = (),
    how: str = "inner",
    open_ends: bool = True,
) -> DataFrame:
    """Each row of ``moments`` with every row of ``periods`` that holds its ``at`` and agrees in ``keys``.

    ``how="left"`` keeps moments outside every period with NULLs; it needs
    ``ids``, columns that tell the moments apart. Without ``open_ends`` a period
    that lacks a bound holds nothing. The columns of ``periods`` must not bear
    names of ``moments`` other than ``keys``.
    """
    if how not in ("inner", "left") or (how == "left" and not ids):
        raise ValueError("how is inner, or left with ids")
    keys = list(keys)
    span = moments.agg(F.min(at).alias("a"), F.max(at).alias("b"))
    usable = periods if open_ends else periods.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    index = filed(usable, start, end, _seconds(span.select("a").scalar()), _seconds(span.select("b").scalar()))
    # At most one length for each factor of 2^STEP, some thirty in all.
    lengths = index.agg(F.collect_set("_level").alias("levels")).scalar()
    asked = moments.filter(F.col(at).isNotNull()).withColumn("_level", F.explode(lengths))
    asked = asked.withColumn("_bin", _bin(_seconds(F.col(at)), F.col("_level")))
    inside = F.coalesce(F.col(start) <= F.col(at), F.lit(True)) & F.coalesce(F.col(at) <= F.col(end), F.lit(True))
    found = asked.join(index, [*keys, "_level", "_bin"]).filter(inside)
    values = [c for c in periods.columns if c not in keys]
    found = found.select(*moments.columns, *values)
    if how == "inner":
        return found
    return moments.join(found.select(*ids, *values), list(ids), "left").select(*moments.columns, *values)
