"""Joins of many rows with one row per key that stay level when a key is hot.

A key that more than one in ``SHARE`` rows carry, and a missing key, is dealt
over ``SALTS`` parts by a hash of other columns; the one row of a hot key is
copied to each part. At most ``SHARE`` keys can be hot, whatever the data, and
they come from a frequent-items sketch of bounded size, read as a scalar
subquery: nothing is collected, and a key that the sketch misses only loses its
spreading, never a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE, SALTS, TRACKED = 50, 64, 4096


def _one(keys: Sequence[str]) -> Column:
    return F.col(keys[0]) if len(keys) == 1 else F.xxhash64(*keys)


def hot_keys(rows: DataFrame, keys: Sequence[str]) -> Column:
    """The keys (or hashes of several key columns) of more than one in ``SHARE`` rows, as an array in a scalar subquery."""
    seen = rows.select(_one(keys).alias("_key")).agg(
        F.call_function("approx_top_k", F.col("_key"), F.lit(SHARE), F.lit(TRACKED)).alias("_top"), F.count(F.lit(1)).alias("_rows")
    )
    often = F.filter("_top", lambda k: k["count"] * SHARE > F.col("_rows"))
    return seen.select(F.transform(often, lambda k: k["item"]).alias("_hot")).scalar()


def _missing(keys: Sequence[str]) -> Column:
    test = F.col(keys[0]).isNull()
    for k in keys[1:]:
        test = test | F.col(k).isNull()
    return test


def join_spread(
    rows: DataFrame, per_key: DataFrame, keys: Sequence[str], by: Sequence[str], how: str = "inner", hot: Column | None = None,
    keep_part: bool = False,
) -> DataFrame:
    """``rows`` joined with the row of ``per_key`` for their ``keys``, which must be unique there.

    ``by`` names the columns of ``rows`` whose hash deals the rows of a hot key;
    ``how`` is inner, left, left_semi or left_anti. ``hot`` may hand over the
    array of ``hot_keys`` of a table with the same hot keys. ``keep_part`` leaves
    the part as ``_part``, so that grouping by the keys and it takes no further shuffle.
    """
    keys = list(keys)
    hot = hot_keys(rows, keys) if hot is None else hot
    joined = join_dealt(rows.withColumn("_part", part_of(keys, by, hot)), per_key, keys, hot, how)
    return joined if keep_part else joined.drop("_part")


def _is_hot(keys: Sequence[str], hot: Column) -> Column:
    return F.coalesce(F.array_contains(hot, _one(keys)), F.lit(False))


def part_of(keys: Sequence[str], by: Sequence[str], hot: Column) -> Column:
    """The part a row is dealt to: by a hash of ``by`` where its key is hot or missing, else 0."""
    # Never NULL, else Spark would filter both sides' inputs on it.
    part = F.coalesce(F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"), F.lit(0))
    return F.when(_missing(keys) | _is_hot(keys, hot), part).otherwise(F.lit(0))


def join_dealt(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], hot: Column, how: str = "inner") -> DataFrame:
    """``join_spread`` for rows that carry their ``_part`` already, as after a repartition by the keys and it."""
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    copies = per_key.withColumn("_part", F.explode(F.when(_is_hot(keys, hot), every).otherwise(F.array(F.lit(0)))))
    return rows.join(copies, [*keys, "_part"], how)


def with_totals(df: DataFrame, keys: Sequence[str], by: Sequence[str], **totals: Column) -> DataFrame:
    """Adds whole-group aggregates to every row of the group; rows without a key get NULLs."""
    sums = df.filter(~_missing(keys)).groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()])
    return join_spread(df, sums, keys, by, "left")
