"""Periodic runs of words, found through string synchronising sets.

Method. A run is a maximal stretch of words with smallest period q that is at
least twice q long. Words are 64-bit hashes; hashes of stretches of 2, 4, 8 ...
words come from two halves. Periods up to ``DIRECT`` are read off by comparing
words that far apart. For longer ones the scales t = 4, 8, 16 ... are gone
through upwards, each for periods from 3t - 1 to 6t - 2:

- highly periodic places, where t words have a period of at most t / 3, follow
  from the runs that are known by then;
- the synchronising set has the places i where the least hash of t words among
  the other places from i to i + t stands at i or at i + t. It depends on the 2t
  words from i only, and any t places in a row hold one unless 3t - 1 words are
  highly periodic there;
- two of its places with equal 2t words at a distance of the scale propose that
  distance as a period. Equal places are more than t / 3 apart, so each has at
  most 18 partners;
- a run without such a pair consists of two overlapping or touching runs of one
  small period and equal root, and their distances in phase are proposed.

A proposal is extended to both sides by descending powers of two; of equal
stretches the smallest period counts, so repeated roots are no runs of their own.

Texts of an Arrow batch are handled in pieces of bounded size, with a word
between texts that occurs nowhere else, and long periods only for texts that
repeat 8 words in a row. A single long text is one piece: it needs 8 bytes a
word and scale.

Defined cases. A null or empty text has no words and no runs, and its collapsed
text is empty. Repeated rows each get their own result. Words are told apart by
64-bit hashes. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import SPACES
from haulmark.llm.text import mix, pieces, stream, words

#: Periods up to this are compared word by word; the first scale begins above.
DIRECT = 10
#: A run has at least so many words.
SHORTEST = 12
PIECE_BYTES = 1_500_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_FAR = np.uint64(0xFFFFFFFFFFFFFFFF)


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and after-last index of each stretch of true values."""
    edge = np.diff(np.concatenate([[0], equal.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _spread(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count, one after another."""
    first = np.cumsum(counts) - counts
    return np.arange(int(counts.sum()), dtype=np.int64) - np.repeat(first, counts)


class _Found:
    """Runs known so far as rows (start, end, period)."""

    def __init__(self):
        self.rows = np.zeros((0, 3), np.int64)

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        """Keep stretches at least twice their period long, the smallest period of each."""
        new = np.stack([start, end, period], axis=1)[end - start >= 2 * period]
        if len(new):
            rows = np.concatenate([self.rows, new])
            rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
            first = np.ones(len(rows), bool)
            first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
            self.rows = rows[first]


def _powers(letters: np.ndarray, longest: int) -> list[np.ndarray]:
    """Hashes of all stretches of 1, 2, 4 ... letters, up to ``longest``."""
    out, width = [letters], 1
    while 2 * width <= longest:
        last = out[-1]
        out.append(mix(last[:-width] * _GOLD + (last[width:] ^ np.uint64(width))))
        width *= 2
    return out


def _extended(powers: list[np.ndarray], place: np.ndarray, period: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the widest stretch around ``place`` that repeats after ``period``."""
    right, left = place.copy(), place.copy()
    for level in range(len(powers) - 1, -1, -1):
        hashes, width = powers[level], 1 << level
        ok = np.flatnonzero(right + period + width <= n)
        ok = ok[hashes[right[ok]] == hashes[right[ok] + period[ok]]]
        right[ok] += width
        ok = np.flatnonzero(left >= width)
        ok = ok[hashes[left[ok] - width] == hashes[left[ok] - width + period[ok]]]
        left[ok] -= width
    return left, right + period


def _synchronising(hashes: np.ndarray, width: int, runs: np.ndarray) -> np.ndarray:
    """The places of the synchronising set of scale ``width``."""
    periodic = runs[(runs[:, 2] * 3 <= width) & (runs[:, 1] - runs[:, 0] >= width)]
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, periodic[:, 0], 1)
    np.add.at(edge, periodic[:, 1] - width + 1, -1)
    shown = np.where(np.cumsum(edge[:-1]) > 0, _FAR, hashes)
    if len(shown) <= width:
        return np.zeros(0, np.int64)
    least, reach = shown, 1
    while reach < width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    least = np.minimum(least[: len(shown) - width], shown[width:])
    return np.flatnonzero((least != _FAR) & ((least == shown[: len(least)]) | (least == shown[width:])))


def _pairs(places: np.ndarray, context: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal context, ``low`` to ``high`` apart: the first of each pair and the distance."""
    key = context[places]
    order = np.lexsort((places, key))
    places, key = places[order], key[order]
    first, gap, lag = [], [], 1
    while lag < len(places):
        same = key[lag:] == key[:-lag]
        distance = places[lag:] - places[:-lag]
        if not (same & (distance <= high)).any():
            break
        take = same & (distance >= low) & (distance <= high)
        first.append(places[:-lag][take])
        gap.append(distance[take])
        lag += 1
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *first]), np.concatenate([none, *gap])


def _turns(powers: list[np.ndarray], a: np.ndarray, b: np.ndarray, period: np.ndarray) -> np.ndarray:
    """The first k with equal stretches of ``period`` letters at a + k and b, for each row; -1 where there is none."""
    out = np.full(len(a), -1)
    levels = np.frexp(period)[1] - 1  # the largest power of two within the period: two such stretches cover it
    for level in np.unique(levels):
        rows = np.flatnonzero(levels == level)
        p, hashes = period[rows], powers[level]
        step, rest = _spread(p), np.repeat(p - (1 << int(level)), p)
        here, there = np.repeat(a[rows], p) + step, np.repeat(b[rows], p)
        same = np.flatnonzero((hashes[here] == hashes[there]) & (hashes[here + rest] == hashes[there + rest]))
        which, first = np.unique(np.repeat(rows, p)[same], return_index=True)
        out[which] = step[same[first]]
    return out


def _doubled(powers: list[np.ndarray], runs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods for two runs of one period and root that overlap or touch, in every phase."""
    runs = runs[np.lexsort((runs[:, 0], runs[:, 2]))]
    a, b = runs[:-1], runs[1:]
    met = (a[:, 2] == b[:, 2]) & (b[:, 0] <= a[:, 1])
    a, b = a[met], b[met]
    turn = _turns(powers, a[:, 0], b[:, 0], a[:, 2])
    a, b, turn = a[turn >= 0], b[turn >= 0], turn[turn >= 0]
    p = a[:, 2]
    phase = (b[:, 0] - a[:, 0] - turn) % p
    most = np.minimum(a[:, 1] - a[:, 0], b[:, 1] - b[:, 0]) + p
    counts = np.maximum((most - phase) // p + 1, 0)
    period = np.repeat(phase, counts) + _spread(counts) * np.repeat(p, counts)
    place = np.maximum(np.repeat(a[:, 0], counts), np.repeat(b[:, 0], counts) - period)
    ok = (period > DIRECT) & (place + period < n) & (place < np.repeat(a[:, 1], counts))
    return place[ok], period[ok]


def find_runs(letters: np.ndarray, starts: np.ndarray, shortest: int = SHORTEST) -> np.ndarray:
    """Runs (start, end, period), in order, of the texts that begin at ``starts`` (with one past the end) in ``letters``, by place in ``letters``."""
    counts = np.diff(starts)
    number = np.repeat(np.arange(len(counts)), counts)
    # each text has letters of its own, and a letter that occurs once stands behind it
    own = mix(letters ^ mix(number.astype(np.uint64) * _GOLD + np.uint64(1))) if len(letters) else letters
    joined = np.insert(own, starts[1:], stream(len(counts), 91)) if len(counts) else own
    shift = np.arange(len(counts))
    found = _Found()
    n = len(joined)
    for q in range(1, min(DIRECT, n - 1) + 1):
        begin, end = _stretches(joined[q:] == joined[:-q])
        keep = end - begin >= q
        found.add(begin[keep], end[keep] + q, np.full(int(keep.sum()), q))
    _long_periods(joined, starts + np.append(shift, len(counts)), found)
    runs = found.rows[found.rows[:, 1] - found.rows[:, 0] >= shortest]
    runs[:, :2] -= np.searchsorted(starts[1:] + shift, runs[:, :1], "left")
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _long_periods(joined: np.ndarray, bounds: np.ndarray, found: _Found) -> None:
    """Add the runs with periods above ``DIRECT``, of the texts that repeat 8 letters in a row."""
    if len(joined) < 2 * DIRECT:
        return
    first = _powers(joined, 8)
    if len(first) < 4:
        return
    order = np.argsort(first[3])
    again = np.flatnonzero(first[3][order][1:] == first[3][order][:-1])
    texts = np.unique(np.searchsorted(bounds, order[again], "right") - 1)
    if not len(texts):
        return
    length = bounds[texts + 1] - bounds[texts]
    place = np.repeat(bounds[texts], length) + _spread(length)
    letters, n = joined[place], len(place)
    known = found.rows
    slot = np.searchsorted(place, known[:, 0])
    kept = (slot < n) & (place[np.minimum(slot, n - 1)] == known[:, 0])
    local = _Found()
    local.rows = known[kept].copy()
    local.rows[:, 1] -= local.rows[:, 0] - slot[kept]
    local.rows[:, 0] = slot[kept]
    powers = _powers(letters, int(length.max()))
    for level in range(2, len(powers) - 1):
        t = 1 << level
        if 3 * t - 1 > int(length.max()) // 2:
            break
        places = _synchronising(powers[level], t, local.rows)
        at, period = _pairs(places, powers[level + 1], 3 * t - 1, 6 * t - 2)
        more, its_period = _doubled(powers, local.rows[(local.rows[:, 2] * 3 <= t) & (local.rows[:, 2] * 6 > t)], n)
        at, period = np.concatenate([at, more]), np.concatenate([period, its_period])
        if len(at):
            local.add(*_extended(powers, at, period, n), period)
    new = local.rows
    back = place[new[:, 0]]
    found.rows = np.zeros((0, 3), np.int64)
    found.add(np.concatenate([known[~kept][:, 0], back]), np.concatenate([known[~kept][:, 1], back + new[:, 1] - new[:, 0]]), np.concatenate([known[~kept][:, 2], new[:, 2]]))


SCHEMA = "__row string, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _detector(shortest: int):
    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            for first, after, data, offsets in pieces(column, PIECE_BYTES):
                hashes, starts, _, _ = words(data, offsets, fold=False)
                runs = find_runs(hashes, starts, shortest)
                text = np.searchsorted(starts, runs[:, 0], "right") - 1
                edge = np.zeros(len(hashes) + 1, np.int64)
                np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
                np.add.at(edge, runs[:, 1], -1)
                keep = np.cumsum(edge[:-1]) == 0
                counts = np.bincount(text, minlength=after - first)
                raw, begins = data.tobytes(), starts.tolist()
                cuts, changed = offsets.tolist(), counts > 0
                collapsed = []
                for i in range(after - first):
                    tokens = raw[cuts[i] : cuts[i + 1]].split()
                    collapsed.append(b" ".join(compress(tokens, keep[begins[i] : begins[i + 1]].tolist()) if changed[i] else tokens).decode())
                struct = pa.StructArray.from_arrays(
                    [pa.array(runs[:, 0] - starts[text]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])], names=["start", "length", "period"]
                )
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), struct)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, after - first).cast(pa.string()), pa.array(np.diff(starts)), lists, pa.array(collapsed, pa.string())],
                    names=["__row", "n_words", "runs", "collapsed"],
                )

    return detect


def detect(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, its runs (start, length, period) by start, then period, and collapsed, the text without the repetitions of each run."""
    found = docs.select(F.col("doc_id").cast("string").alias("__row"), F.col("text").cast("string").alias("text")).mapInArrow(_detector(shortest), SCHEMA)
    return found.select(F.col("__row").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "n_words", "runs", "collapsed")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where each tenth document by crc32 of its id is made periodic from some word on."""
    split = F.filter(F.split(F.coalesce("text", F.lit("")), SPACES), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    rows = docs.select("doc_id", "text", (h % 10 == 0).alias("chosen"), g.alias("g"))
    rows = rows.withColumn("w", F.when(F.col("chosen"), split)).withColumn("n", F.size("w"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn("p", F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1)

    def source(i: Column) -> Column:
        return F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")

    moved = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get(F.col("w"), source(i)))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def report(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Per row: doc_id, n_runs, the longest run (start, length, period, exponent_milli; null without one), runs_sha256, collapsed_sha256, n_words."""
    found = detect(docs, shortest)
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    top = F.array_min(order)
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.s").alias("start"),
        (-F.col("top.l")).alias("length"),
        F.col("top.p").alias("period"),
        F.floor(-F.col("top.l") * 1000 / F.col("top.p")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
