"""Tables kept in folders of key buckets, so a merge rewrites only what it touches.

The bucket of a row is a hash of its key. Changes name their buckets, only
those folders are read and written again, and a folder without a change keeps
its files. Running the same merge twice leaves the same table, so a lost
executor or a broken run is mended by running it once more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "key_bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Keys are hashed as text, so a change may bring them in another number type."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def store(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write a whole table; its keys must be unique, which ``merge`` relies on."""
    df.withColumn(BUCKET, bucket_of(keys, buckets)).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path).drop(BUCKET)


def load_touched(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The stored rows of the keys in ``changes``; folders without such a key are not read."""
    wanted = changes.select(*keys).distinct().withColumn(BUCKET, bucket_of(keys, buckets))
    return spark.read.parquet(path).join(wanted, [BUCKET, *keys], "left_semi").drop(BUCKET)


def once_per_key(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``changes`` that have a key, refused at run time when a key has two of them."""
    values = [c for c in changes.columns if c not in keys]
    rows = changes.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*keys, *values)).alias("_row"))
    told = F.concat(F.lit("two changes for one key: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    checked = F.when(F.col("_n") > 1, F.raise_error(told).cast("int")).otherwise(F.lit(0))
    return rows.filter(checked == 0).select(*keys, *[F.col("_row")[v].alias(v) for v in values])


def merge(
    spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], buckets: int, insert: bool = False
) -> None:
    """Matched rows take the values of their change, NULLs too; with ``insert``, changes of unknown keys become rows.

    Columns that the table lacks are ignored, columns that a change lacks keep
    their value. ``buckets`` is the number the table was stored with.
    """
    keys = list(keys)
    stored = spark.read.parquet(path)
    kinds = dict(stored.dtypes)
    kinds.pop(BUCKET)
    values = [c for c in changes.columns if c in kinds and c not in keys]
    new = once_per_key(changes.select(*keys, *values), keys).withColumn(BUCKET, bucket_of(keys, buckets))
    touched = new.select(BUCKET).distinct()
    old = stored.join(touched, BUCKET, "left_semi")
    named = new.select(
        *[F.col(k).cast(kinds[k]).alias(k) for k in keys],
        F.lit(True).alias("_hit"),
        *[F.col(v).cast(kinds[v]).alias(f"_new_{v}") for v in values],
    )
    met = old.join(named, keys, "full" if insert else "left")
    picked = [
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in kinds
    ]
    out = met.select(*picked).withColumn(BUCKET, bucket_of(keys, buckets))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    spark.catalog.refreshByPath(path)
