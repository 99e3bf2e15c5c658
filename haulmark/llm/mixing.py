"""Mixing sources to target weights by hash-random order and exact word budgets.

Method: every row gets a hash of a seed, its id and its text as its key. Within
a source, rows are ranged by key; sums of their sizes per key range, added up
along the ranges, show the range where the source's budget ends, and only that
range is sorted to find the row at the cut. A row then knows its repetitions
from its own key and the cut of its source: all rows before the cut take one
epoch more than those behind it. Texts are never shuffled.

The row at the cut is taken in part for the words that the budget still has
(``whole=False``), or, as a whole document, if that brings the source nearer to
its target (``whole=True``).

Defined cases. A null text has no words, is never taken in part, and follows
its key like others. Repeated rows share a key, so the remainder at a cut is
divided evenly among them, in whole words. A null source is a source of its own
and comes last. Empty tables give an empty mix; if all texts are empty every
target is 0. Extra columns are kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from haulmark.llm.common import hash_bin, meet, word_count
from haulmark.session import written

BINS = 4096
MOST = 3


def _key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """source, source_size, target from (source, source_size): weights repeat along the sorted sources, null last.

    Targets share the total by weight but stop at ``most`` times their source;
    the excess is shared again among the others until none is above.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # one row per source
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int")).cast("double")
    rows = written(sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most))))
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:  # ends: each round fills at least one source more
        open_ = F.col("cap") >= F.col("weight") * F.lit(level)
        got = rows.agg(F.sum(F.when(~open_, F.col("cap"))), F.sum(F.when(open_, F.col("weight"))), F.count_if(~open_)).first()
        if got[2] == full or not got[1]:
            break
        full, level = got[2], (total - (got[0] or 0.0)) / got[1]
    return rows.select("source", "source_size", F.least(F.col("cap"), F.col("weight") * F.lit(level)).alias("target"))


def cuts(docs: DataFrame, seed: int = 0, whole: bool = False, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """Per source: source_size, target, epochs (all rows take so many), cut_key, cut_copies and cut_words for the row at the cut."""
    rows = written(docs.select("source", word_count(F.col("text")).alias("size"), _key(seed).alias("key")))
    ranges = written(rows.groupBy("source", hash_bin(F.col("key"), BINS).alias("bin")).agg(F.sum("size").alias("words")))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    budget = targets.withColumn("budget", F.round("target").cast("long")).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    )
    budget = written(budget.withColumn("left", F.col("budget") - F.col("epochs") * F.col("source_size")))
    along = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    begun = ranges.withColumn("before", F.coalesce(F.sum("words").over(along), F.lit(0)))
    holds = meet(begun, budget, ["source"]).where("before <= left and left < before + words")
    holds = holds.select("source", "bin", (F.col("left") - F.col("before")).alias("left"))
    near = rows.withColumn("bin", hash_bin(F.col("key"), BINS))
    last = meet(near, holds, ["source", "bin"]).select("source", "key", "size", "left")
    ties = last.groupBy("source", "key").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"), F.first("left").alias("left"), F.max("size").alias("size"))
    sorted_ = ties.withColumn("before", F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rest = F.floor((F.col("left") - F.col("before")) / F.col("n"))
    at = sorted_.where("before <= left and left < before + words").select(
        F.col("source").alias("cut_source"),
        F.col("key").alias("cut_key"),
        (F.col("n") * 2 * rest >= F.col("words")).cast("int").alias("cut_copies") if whole else F.lit(0).alias("cut_copies"),
        F.lit(0).cast("long").alias("cut_words") if whole else rest.cast("long").alias("cut_words"),
    )
    met = budget.join(at, budget["source"].eqNullSafe(at["cut_source"]), "left")
    return written(met.select("source", "source_size", "target", "epochs", "cut_key", "cut_copies", "cut_words"))


def _dealt(rows: DataFrame, seed: int, whole: bool, weights: tuple[int, ...], most: int) -> tuple[DataFrame, Column, Column]:
    """``rows`` beside the cut of their source; whole copies and words in part of each row."""
    at = cuts(rows, seed, whole, weights, most).select(F.struct("*").alias("__cut"))
    met = rows.withColumn("__key", _key(seed)).join(at, F.col("source").eqNullSafe(F.col("__cut.source")))
    first, cut = F.col("__key") < F.col("__cut.cut_key"), F.col("__key") == F.col("__cut.cut_key")
    copies = F.col("__cut.epochs") + F.when(first, 1).when(cut, F.col("__cut.cut_copies")).otherwise(0)
    return met, copies, F.when(cut, F.col("__cut.cut_words")).otherwise(F.lit(0))


def mixture(docs: DataFrame, seed: int = 0, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """Per document row: doc_id, size, source_size, target, copies (whole), part (words of one more), taken."""
    rows = docs.select("doc_id", "text", "source")
    met, copies, part = _dealt(rows, seed, False, weights, most)
    size = word_count(F.col("text"))
    return met.select(
        "doc_id",
        size.alias("size"),
        F.col("__cut.source_size").alias("source_size"),
        F.col("__cut.target").alias("target"),
        copies.alias("copies"),
        part.alias("part"),
        (size * copies + part).cast("long").alias("taken"),
    )


def mix(docs: DataFrame, seed: int = 0, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """``docs`` with each row repeated, or left out, as its source's target asks; all columns stay, no text is cut."""
    met, copies, _ = _dealt(docs, seed, True, weights, most)
    return met.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.greatest(copies, F.lit(1))))).where(copies > 0).select(*docs.columns)
