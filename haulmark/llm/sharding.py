"""Proportional stratified interleaving into shards, in DataFrame operations only.

Method: within each source, rows are ranked in a seeded random order. A row's
fractional rank, (rank - phase) / rows of its source, lies evenly between 0 and
1 for every source, so sorting all rows by it interleaves the sources in
proportion, and equal cuts of that order give every shard the whole mixture.
The phase is a hash of the source, which keeps many small sources from meeting
at one place. Counts of shards differ by one row at most (law ``rows``).

Both rankings sort inside key ranges only (``common.ranked``), so a source with
a third of all rows is sorted by many workers, and only narrow columns move.

Defined cases. Null texts and sources count as values of their own; a null text
has 0 bytes. Repeated rows are dealt one by one. With fewer rows than shards
some shards stay empty; empty tables give no rows. Extra columns are ignored by
``assign`` and kept by ``sharded``, except that its own ``shard`` and ``slot``
replace columns so named.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import hash_bin, meet, ranked
from haulmark.session import written

BINS = 1024
_UNIT = 1 << 40


def assign(rows: DataFrame, shards: int = 16) -> DataFrame:
    """``rows`` (with columns source and key, a random 64-bit number) plus shard, and slot counted from 0 in each shard."""
    rows = rows.withColumn("__bin", hash_bin(F.col("key"), BINS))
    others = [c for c in rows.columns if c not in ("source", "key", "__bin")]
    inside = ranked(rows, ["source"], "__bin", ["key", *others], "__rank").drop("__bin")
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("__rows"))
    met = meet(inside, sizes, ["source"])
    phase = F.pmod(F.xxhash64("source"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    share = F.floor((F.col("__rank") - phase) / F.col("__rows") * F.lit(float(_UNIT))).cast("long")
    placed = written(met.withColumn("__share", F.greatest(share, F.lit(0))).drop("__rank", "__rows"))
    placed = placed.withColumn("__bin", F.floor(F.col("__share") / F.lit(_UNIT // BINS)).cast("int")).withColumn("__all", F.lit(0))
    total = placed.count()
    out = ranked(placed, ["__all"], "__bin", ["__share", "key", *others], "__place").drop("__bin", "__all", "__share")
    place = F.col("__place") - 1
    whole = F.lit(max(total, 1))
    out = out.withColumn("shard", F.call_function("div", place * shards, whole).cast("int"))
    start = F.call_function("div", F.col("shard") * whole + (shards - 1), F.lit(shards))
    return out.withColumn("slot", (place - start).cast("long")).drop("__place")


def sharded(docs: DataFrame, shards: int = 16, seed: int = 0) -> DataFrame:
    """``docs`` with all columns plus shard and slot. Ids of rows are pinned by writing the documents once."""
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    pinned = written(docs.select(F.struct(*kept).alias("__row"), F.monotonically_increasing_id().alias("__no")))
    narrow = pinned.select(F.col("__row.source").alias("source"), F.xxhash64(F.lit(seed), "__row.doc_id", "__row.text", "__no").alias("key"), "__no")
    dealt = assign(narrow, shards).select("__no", "shard", "slot")
    return pinned.join(dealt, "__no").select("__row.*", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 0) -> None:
    """Write ``docs`` as one folder per shard, in the order of the slots."""
    out = sharded(docs, shards, seed)
    out.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def report(docs: DataFrame, shards: int = 16, seed: int = 0) -> DataFrame:
    """Per document row: doc_id, size (bytes and one), text_crc32, law, shard, slot, grown_shard (null under this law)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(
        docs.select(
            "doc_id",
            "source",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(F.lit(seed), "doc_id", "text").alias("key"),
        )
    )
    return assign(rows, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
