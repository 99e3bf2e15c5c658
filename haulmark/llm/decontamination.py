"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

Method: postings (document, word, position) of the words that the benchmark
uses are stored in one pass over the texts. For each window of an item, the two
rarest of its words are looked up; a position of the rarest less its offset in
the item is an alignment, and it stays if the second rarest stands at its own
offset as well. Only then are the lists of the item's other words intersected
at that alignment, and runs of consecutive words give the exact phrases. The items' words and
their windows' rarest words are written to the shared folder once, as several
joins and counts read them.

Defined cases. Null or empty texts, on either side, have no words and match
nothing. Repeated document rows each get their own result row, repeated items
count once. Items without an id mark words but appear in no list. Long texts
are indexed whole. Empty tables give no matches. Extra columns are ignored by
``report`` and kept by ``decontaminate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from haulmark.llm.common import folded, free, meet, small
from haulmark.session import written

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A side of a join is broadcast up to so many rows, which are counted first.
BROADCAST_ROWS = 300_000
_DOC = ["__id", "__hash"]


def _pieces(text: Column) -> Column:
    """The words in lower case; the first or the last may be empty, which is no word."""
    return F.split(folded(F.coalesce(text, F.lit(""))), SEPARATORS)


def item_words(items: DataFrame, width: int) -> DataFrame:
    """One row per item word: item, item_id, offset from 0, word, n (words of the item), width of its windows."""
    rows = items.select(
        F.xxhash64("item_id", "text").alias("item"), F.col("item_id").alias("item_id"), F.filter(_pieces(F.col("text")), lambda w: w != "").alias("w")
    ).dropDuplicates(["item"])
    return rows.select(
        "item", "item_id", F.size("w").alias("n"), F.least(F.size("w"), F.lit(width)).alias("width"), F.posexplode("w").alias("offset", "word")
    )


def build_index(docs: DataFrame, words: DataFrame) -> DataFrame:
    """Postings of ``words`` in all documents: __id, __hash (of the text), word, pos; plus one row per document with its n_words and no word.

    Written to the shared folder, as several lookups read it.
    """
    pieces = docs.select(F.col("doc_id").alias("__id"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("__hash"), _pieces(F.col("text")).alias("w"))
    size = F.size("w")
    n = size - (F.element_at("w", 1) == "").cast("int") - ((size > 1) & (F.element_at("w", -1) == "")).cast("int")
    tokens = pieces.select(*_DOC, size.alias("size"), n.alias("n_words"), F.posexplode("w").alias("pos", "word"))
    known = small(words.where("word <> ''").select("word").distinct().withColumn("known", F.lit(True)), BROADCAST_ROWS)
    found = tokens.join(known, "word", "left")
    last = F.col("pos") == F.col("size") - 1
    posting = F.col("known").isNotNull()
    return written(
        found.where(posting | last).select(
            *_DOC, F.when(posting, F.col("word")).alias("word"), F.col("pos"), F.when(last, F.col("n_words").cast("long")).alias("n_words")
        )
    )


def _rarest(index: DataFrame, words: DataFrame) -> DataFrame:
    """Per window of an item its rarest word and, if it has another, its second rarest, each with its offset. Windows with a word that no document has are left out."""
    counts = index.where("word is not null").groupBy("word").agg(F.count(F.lit(1)).alias("times"))
    starts = F.sequence(F.greatest(F.col("offset") - F.col("width") + 1, F.lit(0)), F.least(F.col("offset"), F.col("n") - F.col("width")))
    rows = words.join(counts, "word", "left").select("item", "width", "offset", "word", "times", F.explode(starts).alias("start"))
    windows = rows.groupBy("item", "start", "width").agg(
        F.array_sort(F.collect_list(F.struct("times", "offset", "word"))).alias("w"), F.count("times").alias("present")
    )
    first, second = F.element_at("w", 1), F.when(F.size("w") > 1, F.element_at("w", 2))
    return (
        windows.where("present = width")
        .select("item", first["word"].alias("w1"), first["offset"].alias("o1"), second["word"].alias("w2"), second["offset"].alias("o2"))
        .distinct()
    )


def _alignments(index: DataFrame, rarest: DataFrame, slop: int = 0) -> DataFrame:
    """Distinct (document, item, diagonal): where the rarest word stands at its offset and the second rarest within ``slop`` of its own."""
    keys = small(rarest.select(F.explode(F.array("w1", "w2")).alias("word")).where("word is not null").distinct(), BROADCAST_ROWS)
    lists = index.where("word is not null").select(*_DOC, "word", "pos").join(keys, "word")
    begun = lists.join(small(rarest.withColumnRenamed("w1", "word"), BROADCAST_ROWS), "word").select(
        *_DOC, "item", (F.col("pos") - F.col("o1")).alias("diagonal"), "w2", "o2"
    )
    shift = F.explode(F.sequence(F.lit(-slop), F.lit(slop))) if slop else F.lit(0)
    wanted = begun.where("w2 is not null").withColumn("shift", shift).select(
        *_DOC, "item", "diagonal", F.col("w2").alias("word"), (F.col("diagonal") + F.col("o2") + F.col("shift")).alias("pos")
    )
    both = meet(wanted, lists, [*_DOC, "pos", "word"], "left_semi").select(*_DOC, "item", "diagonal")
    alone = begun.where("w2 is null").select(*_DOC, "item", "diagonal")
    return both.unionByName(alone).distinct()


def phrase_spans(index: DataFrame, words: DataFrame) -> DataFrame:
    """Runs of at least a window's words that a document and an item share: __id, __hash, item, item_id, start, words."""
    found = written(_alignments(index, written(_rarest(index, words))))
    held = small(found.select(*_DOC).distinct(), BROADCAST_ROWS)
    postings = index.where("word is not null").select(*_DOC, "word", "pos")
    lists = meet(postings, held, _DOC, "left_semi").dropDuplicates([*_DOC, "pos"])
    wanted = found.join(small(words, BROADCAST_ROWS), "item").withColumn("pos", F.col("diagonal") + F.col("offset"))
    met = meet(wanted, lists, [*_DOC, "pos", "word"], "left_semi")
    aligned = Window.partitionBy(*_DOC, "item", "diagonal").orderBy("offset")
    runs = met.withColumn("run", F.col("offset") - F.row_number().over(aligned))
    return (
        runs.groupBy(*_DOC, "item", "item_id", "diagonal", "width", "run")
        .agg(F.min("pos").alias("start"), F.count(F.lit(1)).alias("words"))
        .where("words >= width")
        .select(*_DOC, "item", "item_id", "start", "words")
    )


def proximity(index: DataFrame, words: DataFrame, slop: int = 3) -> DataFrame:
    """Looser matches: (__id, __hash, item) with the two rarest words of a window at their distance, give or take ``slop`` words."""
    return _alignments(index, written(_rarest(index, words)), slop).select(*_DOC, "item").distinct()


def report(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit (words inside an occurring window), n_items, items_sha256, contaminated."""
    words = written(item_words(items, width))
    index = build_index(docs, words)
    spans = phrase_spans(index, words).withColumn("pos", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("words").cast("int") - 1)))
    hit = spans.groupBy(*_DOC).agg(
        F.countDistinct("pos").alias("n_hit"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids")
    )
    all_docs = index.where("n_words is not null").select(*_DOC, "n_words")
    joined = meet(all_docs, hit, _DOC, "left")
    ids = F.coalesce(F.col("ids"), F.array().cast("array<string>"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0))
    return joined.select(
        F.col("__id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """``docs`` without the rows that hold a window of a benchmark item; all columns stay."""
    words = written(item_words(items, width))
    spans = phrase_spans(build_index(docs, words), words)
    id_, hash_ = (free(docs.columns, c) for c in _DOC)
    hit = small(written(spans.select(F.col("__id").alias(id_), F.col("__hash").alias(hash_)).distinct()), BROADCAST_ROWS)
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.coalesce(F.xxhash64("text"), F.lit(0)) == F.col(hash_))
    return docs.join(hit, same, "left_anti")
