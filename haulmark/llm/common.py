"""Helpers that several operators share: table reading, checked broadcasts, ranks by key ranges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, which is counted first; else ``df`` for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def free(names: list[str], wanted: str) -> str:
    """``wanted``, with as many underscores before it as keep it apart from ``names``, whose case does not matter."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def folded(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def meet(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on ``names``, null equal to null; the keys of ``left`` stay."""
    renamed = right.withColumnsRenamed({n: f"__right_{n}" for n in names})
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"__right_{n}")) for n in names])
    return left.join(renamed, same, how).drop(*[f"__right_{n}" for n in names])


def hash_bin(key: Column, bins: int) -> Column:
    """Number of the equal range that a 64-bit hash falls into; ranges ascend with the key. ``bins`` is a power of two."""
    return F.shiftright(key, 64 - (bins.bit_length() - 1)).cast("int")


def ranked(df: DataFrame, within: list[str], bin_col: str, order: list[str], name: str, weight: str | None = None) -> DataFrame:
    """Number the rows of each ``within`` group from 1 along (``bin_col``, ``order``) without gathering a group in one task.

    ``bin_col`` must be a range of the first ``order`` column. Rows are sorted
    inside one bin only; where a bin starts follows from a running sum over one
    row for each bin. With ``weight``, ``name`` is the running sum of it instead.
    """
    amount = F.col(weight) if weight else F.lit(1)
    sums = df.groupBy(*within, bin_col).agg(F.sum(amount).alias("__bin_sum"))
    along = Window.partitionBy(*within).orderBy(bin_col).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*within, bin_col, F.coalesce(F.sum("__bin_sum").over(along), F.lit(0)).alias("__bin_start"))
    inside = Window.partitionBy(*within, bin_col).orderBy(*order)
    here = F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, 0)) if weight else F.row_number().over(inside)
    met = meet(df, starts, [*within, bin_col])
    return met.withColumn(name, (F.col("__bin_start") + here).cast("long")).drop("__bin_start")
