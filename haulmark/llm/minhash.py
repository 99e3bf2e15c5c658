"""Near-duplicate documents by bottom-k sketches of one hash function.

Method. A document's set is the hashes of its distinct word shingles. Documents
with the same set (a 128-bit fingerprint and the size agree) become one node
first, however many they are. A node keeps the ``SKETCH`` smallest hashes of its
set. Inverted lists hold the nodes that retain the same two values next to each
other in the order of the hash; values that unrelated texts share seldom lie
side by side in both. Two sets at the threshold share most such neighbours, so
of a node's neighbours the commonest few are left out and a common list still
remains. Overlaps in the lists give pairs, the sketch of a pair's union
estimates its similarity and filters it, and the full sets decide.

A node is first compared with one leader only, of those in its lists the one
whose neighbours most others share, which in a family of edited copies is the
text they stem from; then, of the lists whose nodes are still apart, with the
leader of most of them, by that order and by another. Nodes that are linked need
no other proof of being together. What is apart after that is compared across
groups: a node with every member of a large group whose lists it shares, by
blocks of the group, on full sets inside the task; and the rest pair by pair, a
long list by squares of its pairs that go to several tasks. A
group of thousands of copies thus costs about a comparison a node.

Sketches estimate: at a similarity of 0.8 the chance that a pair is in no
common list or falls under the estimate's floor is below one in a million, and
nil for sets that the listed part of the sketch holds whole. No list, group or
candidate is capped.

Defined cases. Null texts and texts without words have the empty set and are
linked with nothing. Texts with fewer words than a shingle have their whole
sequence as one. Repeated rows are nodes with the same set. Documents without
an id are never chosen as component_id while another has one; ids must be numbers. Long texts are
hashed whole. Empty tables give no rows. Extra columns are kept by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import free, meet, small
from haulmark.llm.components import components
from haulmark.llm.text import mix, pieces, shingles, words
from haulmark.session import written

SKETCH = 64
#: Neighbours among so many of the smallest values are listed, but for the commonest sixth of them.
LISTED, LEFT_OUT = 48, 6
#: Under this similarity neighbours are too seldom common, and single values are listed.
NEIGHBOURS_FROM = 75
#: Pairs whose union sketch holds less than this share of common values are dropped unproved.
FLOOR = 0.5
BROADCAST_ROWS = 200_000
#: From so many members a group is compared as a whole, in blocks of so many members.
LARGE, BLOCK = 32, 2_000
#: Members of a list in a side of one square of its pairs.
TILE = 128
#: Words of 64 bits (a power of two) that tell most unlike sketches apart.
BIT_WORDS = 4
_SKETCHED = "__id long, __hash long, n long, print binary, low array<long>, sketch array<int>"


def _lists(rows: list[np.ndarray], half: bool = False) -> pa.Array:
    """Rows of values as an Arrow list column; ``half`` keeps the upper 32 bits of each, in the same order."""
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)])
    values = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    values = ((values >> np.uint64(32)).astype(np.int64) - (1 << 31)).astype(np.int32) if half else values.view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def _fingerprint(values: np.ndarray) -> bytes | None:
    """16 bytes that depend on the set alone."""
    if not len(values):
        return None
    return mix(values).sum(dtype=np.uint64).tobytes() + mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).tobytes()


def _keys(values: np.ndarray, run: int) -> np.ndarray:
    """One number for each ``run`` (1 or 2) of neighbours among the smallest values."""
    low = values[:LISTED]
    return low if run == 1 else mix(low[:-1]) ^ low[1:]


def sketches(docs: DataFrame, width: int, run_length: int = 2) -> DataFrame:
    """Per document row: __id, __hash (of the text), n (size of its set), print (fingerprint of the set), low (list keys), sketch (its smallest values)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, after, data, offsets in pieces(batch.column("text")):
                hashes, starts, _, _ = words(data, offsets)
                sets = shingles(hashes, starts, width)
                kept = batch.slice(first, after - first)
                yield pa.RecordBatch.from_arrays(
                    [
                        kept.column("__id"),
                        kept.column("__hash"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_fingerprint(s) for s in sets], pa.binary()),
                        _lists([_keys(s, run_length) for s in sets]),
                        _lists([s[:SKETCH] for s in sets], half=True),
                    ],
                    names=["__id", "__hash", "n", "print", "low", "sketch"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("__hash"), "text")
    return rows.mapInArrow(run, _SKETCHED)


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """(node, members): the whole set of each document of ``docs`` (columns node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, after, data, offsets in pieces(batch.column("text")):
                hashes, starts, _, _ = words(data, offsets)
                members = _lists(shingles(hashes, starts, width))
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(first, after - first), members], names=["node", "members"])

    return docs.select("node", "text").mapInArrow(run, "node long, members array<long>")


def inverted_lists(nodes: DataFrame) -> DataFrame:
    """(value, node, n, degree): for each node its list keys that another node has as well, without the commonest sixth of all its keys.

    Two similar nodes have more keys in common than either leaves out, so the
    rarest common one remains in both.
    """
    rows = nodes.select("node", "n", F.size("low").alias("held"), F.explode("low").alias("value"))
    shared = written(rows.groupBy("value").agg(F.count(F.lit(1)).alias("times")).where("times > 1"))
    ranked = rows.join(shared, "value").groupBy("node", "n", "held").agg(F.array_sort(F.collect_list(F.struct("times", "value"))).alias("v"))
    wanted, alone = F.col("held") - F.floor(F.col("held") / LEFT_OUT), F.col("held") - F.size("v")
    degree = F.aggregate("v", F.lit(0).cast("long"), lambda acc, x: acc + x["times"]).alias("degree")
    listed = ranked.select("node", "n", degree, F.explode(F.slice("v", 1, F.greatest(wanted - alone, F.lit(0)).cast("int"))).alias("v"))
    return listed.select(F.col("v.value").alias("value"), "node", "n", "degree")


def _alike(one: str, two: str) -> Column:
    """Whether the union of two sketches holds at least ``FLOOR`` of common values."""
    union = F.slice(F.sort_array(F.array_union(one, two)), 1, SKETCH)
    return F.size(F.array_intersect(union, F.array_intersect(one, two))) >= F.size(union) * F.lit(FLOOR)


def _bits(sketch: str) -> list[Column]:
    """The sketch as a set of bits, in words of 64."""
    none = F.lit(0).cast("long")

    def word(k: int) -> Column:
        def with_bit(held: Column, x: Column) -> Column:
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)))
            return F.when(F.shiftright(x, 6).bitwiseAND(F.lit(BIT_WORDS - 1)) == k, held.bitwiseOR(bit)).otherwise(held)

        return F.aggregate(sketch, none, with_bit)

    return [word(k) for k in range(BIT_WORDS)]


def _may_be_alike(one: str, two: str) -> Column:
    """True wherever ``_alike`` is, by the bits and sizes alone: each bit of one that the other lacks is a value that it lacks."""
    lacks = sum((F.bit_count(F.col(f"bits{k}_{one}").bitwiseAND(F.bitwise_not(f"bits{k}_{two}"))) for k in range(BIT_WORDS)), F.lit(0))
    return F.col(f"kept_{one}") - lacks >= F.greatest(f"kept_{one}", f"kept_{two}") * F.lit(FLOOR)


def _near(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb) that the sizes and the sketch of the union don't rule out."""
    sized = pairs.where(F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb"))
    sketch = nodes.select("node", "sketch")
    met = sized.join(sketch.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a").join(
        sketch.select(F.col("node").alias("b"), F.col("sketch").alias("sb")), "b"
    )
    return met.where(_alike("sa", "sb")).select("a", "b")


def _sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(node, members) for the nodes of ``wanted``, from the text of one document of each; ``twice`` marks those whose row repeats."""
    found = written(nodes.join(wanted, "node", "left_semi").select("node", "__id", "__hash", "twice"))
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("__hash"), "text")
    held = meet(texts, small(found, BROADCAST_ROWS), ["__id", "__hash"])
    # only rows that occur twice have to be told apart, and by their texts, not by their sets
    once = held.where("not twice").select("node", "text").unionByName(held.where("twice").select("node", "text").dropDuplicates(["node"]))
    return written(full_sets(once, width))


def _proved(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the pairs whose full sets have 100 * common >= percent * union."""
    sets = _sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), nodes, docs, width)
    met = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("ma")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("members").alias("mb")), "b"
    )
    common = F.size(F.array_intersect("ma", "mb"))
    return met.where(common * 100 >= (F.size("ma") + F.size("mb") - common) * percent).select("a", "b")


def _with_large(apart: DataFrame, labels: DataFrame, large: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between a node and members of the large groups whose lists it shares; one for each node and block of a group."""
    holds = apart.join(large.select("label"), "label").select("value", F.col("label").alias("group")).distinct()
    asked = apart.join(holds, "value").where("label <> `group`").select("node", "group").distinct()
    asked = written(asked.join(large.select(F.col("label").alias("group"), "blocks"), "group"))
    members = labels.withColumnRenamed("label", "group").join(asked.select("group", "blocks").distinct(), "group")
    members = written(members.select("group", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), "node"))
    sets = _sets(asked.select("node").unionByName(members.select("node")).distinct(), nodes, docs, width)

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        if len(left) and len(right):
            size = np.array([len(m) for m in right["members"]])
            values, owner = np.concatenate(list(right["members"])), np.repeat(np.arange(len(size)), size)
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            for node, own in zip(left["node"], left["own"], strict=True):
                first, after = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
                count = after - first
                at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
                common = np.bincount(owner[at], minlength=len(size))
                good = np.flatnonzero(common * 100 >= (len(own) + size - common) * percent)
                if len(good):
                    a.append(node), b.append(right["node"].iloc[int(good[0])])
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    spread = asked.select("group", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("block"), "node")
    left = spread.join(sets, "node").select(*[F.col(c).alias(c) for c in ("group", "block", "node")], F.col("members").alias("own"))
    right = members.join(sets, "node").select(*[F.col(c).alias(c) for c in ("group", "block", "node", "members")])
    return left.groupBy("group", "block").cogroup(right.groupBy("group", "block")).applyInPandas(compare, "a long, b long")


def linked_nodes(nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, label) for the nodes with links."""
    lists = written(inverted_lists(nodes))
    labels = None

    def apart() -> DataFrame:
        """List rows, with their group, of the lists whose nodes are in several groups."""
        named = lists.join(small(labels, BROADCAST_ROWS), "node", "left").withColumn("label", F.coalesce("label", "node"))
        mixed = named.groupBy("value").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 <> l1").select("value")
        return written(named.join(mixed, "value", "left_semi"))

    def led(rows: DataFrame, **leads: Column) -> DataFrame:
        """``rows`` with a node of each list and order of ``leads``, the one that comes last."""
        return rows.join(rows.groupBy("value").agg(*[F.max(F.struct(by.alias("by"), "node", "n", "label")).alias(c) for c, by in leads.items()]), "value")

    def proved(pairs: DataFrame) -> DataFrame:
        near = _near(pairs.where("lead.label <> label").select(F.col("node").alias("a"), F.col("lead.node").alias("b"), F.col("n").alias("na"), F.col("lead.n").alias("nb")), nodes, percent)
        return written(_proved(written(near), nodes, docs, width, percent))

    every = lists.withColumn("label", F.col("node"))
    links = proved(led(every, lead=F.col("degree")).groupBy("node", "n", "label").agg(F.max("lead").alias("lead")))
    labels = components(links)
    # of the leaders in a node's lists the one that leads most of them, so that pairs are no more than two a node
    often = led(apart(), most=F.col("degree"), any=F.xxhash64("node")).groupBy("node", "n", "label").agg(
        *[F.mode(F.when(F.col(f"{c}.label") != F.col("label"), F.col(c)), deterministic=True).alias(c) for c in ("most", "any")]
    )
    links = links.unionByName(proved(often.select("node", "n", "label", F.explode(F.array_distinct(F.array("most", "any"))).alias("lead"))))
    labels = components(links)

    rows = apart()
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("c"))
    large = written(sizes.where(F.col("c") >= LARGE).select("label", F.ceil(F.col("c") / BLOCK).alias("blocks")))
    by_group = written(_with_large(rows, labels, large, nodes, docs, width, percent))
    rest = rows.join(large, "label", "left_anti").select("value", "node", "n", "label")
    held = rest.groupBy("value").agg(F.min("label").alias("l0"), F.max("label").alias("l1"), F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    rest = written(rest.join(held.where("l0 <> l1").select("value", "tiles"), "value"))
    mine = rest.groupBy("node").agg(F.collect_set("value").alias("mine"))
    sketched = nodes.join(mine, "node").select("node", "mine", "sketch", F.size("sketch").alias("kept"), *[c.alias(f"bits{k}") for k, c in enumerate(_bits("sketch"))])
    rest = written(rest.join(sketched, "node"))
    # a long list is dealt over the squares of a grid, so that no task has all its pairs
    own, every = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    one, two = (
        rest.select("value", own.alias(f"tile_{s}"), every.alias(f"tile_{o}"), *[F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "label", "kept", *[f"bits{k}" for k in range(BIT_WORDS)], "sketch", "mine")])
        for s, o in (("a", "b"), ("b", "a"))
    )
    same = [F.col(f"one.{c}") == F.col(f"two.{c}") for c in ("value", "tile_a", "tile_b")]
    apart_yet = same[0] & same[1] & same[2] & (F.col("node_a") < F.col("node_b")) & (F.col("label_a") != F.col("label_b"))
    close = F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b")
    # a pair meets in every list it shares and is looked at in the least of them only
    first = F.col("one.value") == F.array_min(F.array_intersect("mine_a", "mine_b"))
    # within a case, as what an "and" repeats on its right is worked out for every pair
    alike = F.when(_may_be_alike("a", "b"), F.when(first, _alike("sketch_a", "sketch_b")).otherwise(False)).otherwise(False)
    met = one.alias("one").join(two.alias("two"), apart_yet & close & alike)
    pairs = met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    proved = written(_proved(written(pairs), nodes, docs, width, percent))
    return components(links.unionByName(by_group).unionByName(proved))


def groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per document row: __id, __hash, n (size of its set), component_id (smallest id that links reach)."""
    rows = written(sketches(docs, width, 2 if percent >= NEIGHBOURS_FROM else 1))
    repeated = rows.groupBy("__id", "__hash").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("__id", "__hash", F.lit(True).alias("twice"))
    single = meet(rows.where("n > 0").dropDuplicates(["print"]), small(written(repeated), BROADCAST_ROWS), ["__id", "__hash"], "left")
    nodes = written(single.withColumn("twice", F.coalesce("twice", F.lit(False))).withColumn("node", F.monotonically_increasing_id()))
    labels = nodes.select("print", "node").join(linked_nodes(nodes, docs, width, percent), "node", "left")
    labels = written(labels.select("print", F.coalesce("label", "node").alias("label")))
    named = rows.select("__id", "__hash", "n", "print").join(labels, "print", "left")
    least = written(named.where("n > 0").groupBy("label").agg(F.min("__id").alias("least")))
    met = named.join(least, "label", "left")
    return met.select("__id", "__hash", "n", F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("__id")).alias("component_id"))


def report(docs: DataFrame, width: int = 2, percent: int = 80) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id, kept."""
    return groups(docs, width, percent).select(
        F.col("__id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", F.col("__id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def dedup(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id. All columns stay; rows with an empty set stay."""
    found = groups(docs, width, percent)
    gone = written(found.where(~F.col("__id").eqNullSafe(F.col("component_id"))).select("__id", "__hash").distinct())
    twice = written(
        found.where("n > 0").groupBy("__id", "__hash").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("__id", "__hash")
    )
    names = [free(docs.columns, c) for c in ("__id", "__hash")]
    gone, twice = (df.withColumnsRenamed(dict(zip(("__id", "__hash"), names, strict=True))) for df in (gone, twice))
    own = (F.col("doc_id").cast("long"), F.coalesce(F.xxhash64("text"), F.lit(0)))
    keyed = docs.withColumns(dict(zip(names, own, strict=True)))
    kept = meet(keyed, small(gone, BROADCAST_ROWS), names, "left_anti")
    repeated = small(twice, BROADCAST_ROWS)
    single = meet(kept, repeated, names, "left_anti")
    row = F.struct(*docs.columns)
    once = meet(kept, repeated, names, "left_semi").groupBy(*names).agg(F.min_by(row, F.xxhash64(*docs.columns)).alias("__row"))
    return single.select(*docs.columns).unionByName(once.select("__row.*"))
