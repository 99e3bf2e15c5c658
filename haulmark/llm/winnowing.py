"""Document fingerprints by winnowing, in DataFrame operations only.

Method. The code points of a text are cut into overlapping pieces of bounded
length. Each run of ``GRAM`` code points is hashed by CRC-32, a polynomial hash
of the rolling kind, and minima of all windows of ``WINDOW`` such hashes come from
minima of half as many, doubled; of equal minima the rightmost counts. A mark is a
chosen hash with its position, and the marks of a text are its fingerprint. Two
texts that share ``GRAM + WINDOW - 1`` code points share a mark at the same place
of the passage.
A text is one row from start to end and is never exploded or shuffled for its
marks; a worker holds the arrays of one piece and the marks of one text.

Documents meet their successor in bins of consecutive ids: a few hundred id
percentiles come to the driver, an id that many rows carry gets bins by text
hash, and the first row of each bin visits the bin before it, so one shuffle of
the texts is enough and no order over all rows is made in one place.

Defined cases. A null text is empty and has no marks. A text shorter than a gram
is one gram; one with fewer grams than a window holds is one window. Likeness is
the share of distinct hashes that both have among those that either has, and 1
for two texts without marks. Rows of one id follow each other by text hash, rows
without an id come last, a single row succeeds itself; repeated rows stay. Ids
must be numbers. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from haulmark.llm.common import small

#: Code points of a gram, and grams of a window, a power of two.
GRAM, WINDOW = 16, 16
#: Windows that begin in one piece of a text.
PIECE = 512
#: Rows of a bin of consecutive documents, and id percentiles that come to the driver at most.
BIN_ROWS, BOUNDS = 500, 512
#: Up to so many bins, their first rows are broadcast.
BROADCAST_ROWS = 100_000
#: Code points that one match of the reading expression goes forward.
STEP = 8
_PLACE_BITS, _HASH_BITS, _HASH = 12, 32, (1 << 32) - 1
_PLACE = 1 << _PLACE_BITS


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once; a lambda evaluates what it names again each time."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _minima(values: Column, window: int) -> Column:
    """Minima of all windows of ``window`` values; those that run over the end are of fewer."""

    def doubled(v: Column, width: int) -> Column:
        if width == window:
            return v
        pair = F.zip_with(v, F.slice(v, width + 1, _PLACE), lambda a, b: F.when(b < a, b).otherwise(a))
        return _let(pair, lambda m: doubled(m, 2 * width))

    return doubled(values, 1)


def _grams(text: Column, gram: int) -> Column:
    """The hashes of all runs of ``gram`` code points, each with its place below it so that the rightmost of equal ones is least.

    The text is read in steps of ``STEP`` code points, each with what its runs need beyond it.
    """
    chunks = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{gram + STEP - 1}}})).{{1,{STEP}}}"), F.lit(1))

    def runs(chunk: Column, below: Column) -> Column:
        hashes = [F.crc32(F.substring(chunk, j + 1, gram).cast("binary")) for j in range(STEP)]
        return F.array(*[F.shiftleft(h, _PLACE_BITS) + (below - j) for j, h in enumerate(hashes)])

    each = F.transform(chunks, lambda c, i: _let(F.lit(_PLACE - 1) - i * STEP, lambda below: runs(c, below)))
    return F.slice(F.flatten(each), 1, F.greatest(F.length(text) - gram + 1, F.lit(0)))


def marks(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The marks of a text in order of position, each as one number: position * 2^32 + hash."""
    beyond = gram + window - 2
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def of_piece(piece: Column, number: Column, all_pieces: Column) -> Column:
        tail = F.coalesce(F.substring(F.get(all_pieces, number + 1), 1, beyond), F.lit(""))
        return _let(F.concat(piece, tail), lambda p: chosen(p, number))

    def chosen(piece: Column, number: Column) -> Column:
        windows = F.greatest(F.least(F.length(piece) - beyond, F.lit(PIECE)), F.when(number == 0, F.lit(1)).otherwise(F.lit(0)))
        least = _let(_grams(piece, gram), lambda v: F.array_distinct(F.slice(_minima(v, window), 1, windows)))
        at = number.cast("long") * PIECE + F.lit(_PLACE - 1)
        return F.transform(least, lambda v: F.shiftleft(at - v % F.lit(_PLACE), _HASH_BITS) + F.shiftright(v, _PLACE_BITS))

    # neighbouring pieces share marks
    many = _let(pieces, lambda ps: F.array_distinct(F.flatten(F.transform(ps, lambda p, j: of_piece(p, j, ps)))))
    none, whole = F.array().cast("array<bigint>"), F.array(F.crc32(text.cast("binary")))
    return F.when(F.coalesce(text, F.lit("")) == "", none).when(F.length(text) < gram, whole).otherwise(many)


def _moved(found: Column, by: Column) -> Column:
    return F.transform(found, lambda m: m + F.shiftleft(by.cast("long"), _HASH_BITS))


def _before(found: Column, position: Column) -> Column:
    return F.filter(found, lambda m: m < F.shiftleft(position.cast("long"), _HASH_BITS))


def marks_of_joined(own: str, text: str, kept: Column, other: str, other_text: str, taken: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The marks of the first ``kept`` code points of ``text`` followed by the first ``taken`` of ``other_text``, from the marks of both.

    A mark that stands a window and a gram before an end was chosen there, whatever follows; only the windows about the
    seam and at the end are looked at again.
    """
    beyond = gram + window - 2
    reach = beyond + window - 1
    long_enough = taken >= reach
    first = F.substring(text, kept - reach + 1, F.lit(reach))
    seam = F.concat(first, F.substring(other_text, F.lit(1), F.when(long_enough, F.lit(beyond)).otherwise(taken)))
    end = F.substring(other_text, taken - reach + 1, F.lit(reach))
    parts = [_before(F.col(own), kept - beyond), _moved(marks(seam, gram, window), kept - reach)]
    rest = F.concat(_moved(_before(F.col(other), taken - beyond), kept), _moved(marks(end, gram, window), kept + taken - reach))
    after = F.when(long_enough, rest).otherwise(F.array().cast("array<bigint>"))
    whole = marks(F.concat(F.substring(text, F.lit(1), kept), F.substring(other_text, F.lit(1), taken)), gram, window)
    return F.when(kept >= reach, F.array_sort(F.array_distinct(F.concat(*parts, after)))).otherwise(whole)


def positions(found: Column) -> Column:
    """Marks as (position, hash)."""
    return F.transform(found, lambda m: F.struct(F.shiftright(m, _HASH_BITS).alias("position"), m.bitwiseAND(F.lit(_HASH)).alias("hash")))


def hashes(found: Column) -> Column:
    return F.array_distinct(F.transform(found, lambda m: m.bitwiseAND(F.lit(_HASH))))


def fingerprint(found: Column) -> Column:
    """A digest of all marks."""
    return F.sha2(F.array_join(F.transform(found, lambda m: m.cast("string")), ","), 256)


def likeness(a: Column, b: Column) -> Column:
    """Share of hashes that both sides have, of arrays of distinct hashes."""
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def _placed(docs: DataFrame) -> DataFrame:
    """__id, __hash and text of each row, with its bin (__cell, __sub) and __down, which orders ids downwards. Bins ascend as ids descend."""
    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("__hash"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.count()
    cells = min(BOUNDS, max(1, ceil(total / BIN_ROWS)))
    subs = max(1, ceil(total / cells / BIN_ROWS))
    cuts = [i / cells for i in range(1, cells)]
    found = (rows.agg(F.percentile_approx("__id", cuts, 20 * BOUNDS).alias("cuts")).first()["cuts"] or []) if cuts else []
    hot = {a for a, b in zip(found, found[1:], strict=False) if a == b}
    bounds = sorted({*found, *(h + 1 for h in hot if h + 1 < 1 << 63)})
    edges = F.lit([-(1 << 63), *bounds, (1 << 63) - 1])
    id_ = F.col("__id")
    above = F.size(F.filter(F.lit(bounds), lambda b: b > id_)) if bounds else F.lit(0)
    cell = F.coalesce(F.when(id_.isNotNull(), above), F.lit(len(bounds) + 1))
    low, high = (F.get(edges, F.lit(len(bounds) + d) - F.col("__cell")).cast("double") for d in (0, 1))
    by_id = F.least(F.floor((high - id_.cast("double")) / (high - low) * subs), F.lit(subs - 1))
    parts = max(1, ceil(total / BIN_ROWS))
    by_hash = F.floor((F.col("__hash").cast("double") / F.lit(2.0**64) + 0.5) * parts)
    one_id = F.coalesce(id_.isin(sorted(hot)), F.lit(True)) if hot else id_.isNull()
    return (
        rows.withColumn("__cell", cell)
        .withColumn("__sub", F.when(one_id, by_hash).otherwise(by_id if bounds else F.lit(0)).cast("long"))
        .withColumn("__down", F.bitwise_not(id_))
    )


def with_next(docs: DataFrame, *carried: tuple[str, Column]) -> DataFrame:
    """Rows (doc_id, text, ``carried``) with the same of the next document by descending id as ``next_...``; after the last comes the first."""
    placed = _placed(docs)
    heads = placed.groupBy("__cell", "__sub").agg(F.min(F.struct("__down", "__hash")).alias("__head"))
    along = Window.orderBy("__cell", "__sub")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bin_ = F.struct("__cell", "__sub")
    chain = heads.withColumn("__before", F.coalesce(F.lag(bin_).over(along), F.last(bin_).over(whole)))
    chain = chain.select("__cell", "__sub", F.col("__head.__down").alias("__d"), F.col("__head.__hash").alias("__h"), F.col("__before.__cell").alias("__c"), F.col("__before.__sub").alias("__s"))
    first = placed.join(small(chain, BROADCAST_ROWS), ["__cell", "__sub"]).where(F.col("__down").eqNullSafe(F.col("__d")) & (F.col("__hash") == F.col("__h")))
    guests = first.dropDuplicates(["__c", "__s"]).select("__id", "__hash", "text", F.col("__c").alias("__cell"), F.col("__s").alias("__sub"), "__down", F.lit(1).alias("__guest"))
    order = ["__guest", "__down", "__hash"]
    both = placed.withColumn("__guest", F.lit(0)).unionByName(guests).repartition("__cell", "__sub").sortWithinPartitions("__cell", "__sub", *order)
    inside = Window.partitionBy("__cell", "__sub").orderBy(*order)
    names = ["text", *(n for n, _ in carried)]
    held = both.select("*", *[c.alias(n) for n, c in carried])
    met = held.select("*", *[F.lead(n).over(inside).alias(f"next_{n}") for n in names]).where("__guest = 0")
    return met.select(F.col("__id").alias("doc_id"), *names, *[f"next_{n}" for n in names])


def report(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Per document row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_marks.

    The edited text has its last third replaced by the beginning of the next document.
    """
    rows = with_next(docs, ("own", marks(F.col("text"), gram, window)))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    cut = rows.withColumn("kept", n - third).withColumn("taken", F.least(third, F.length("next_text")))
    edited = F.concat(F.substring("text", F.lit(1), F.col("kept")), F.substring("next_text", F.lit(1), F.col("taken")))
    other = cut.select(
        "doc_id", n.cast("long").alias("n_chars"), "own", "next_own", edited.alias("edited"),
        marks_of_joined("own", "text", F.col("kept"), "next_own", "next_text", F.col("taken"), gram, window).alias("edited_marks"),
    )
    sets = other.select("*", *[hashes(F.col(c)).alias(f"{c}_set") for c in ("own", "next_own", "edited_marks")])
    return sets.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(F.col("own_set"), F.col("edited_marks_set")).alias("near_edited"),
        likeness(F.col("own_set"), F.col("next_own_set")).alias("near_next"),
        F.size("own").cast("long").alias("n_marks"),
    )
