"""The prefix trie of conversations, by double-array tries over shards of it.

Method. A turn is known by 128 bits of its role and text, a path (all turns of a
conversation in order) and each of its prefixes by sums of hashes of (place,
turn), so running sums along a conversation name its prefixes. Equal
conversations are one path with a count. A prefix that more than ``CAP`` paths
share is an upper node; the first prefix of a path that is not heavy is the root
of a shard, and all paths below one root lie in one shard, so hot beginnings are
split and no node of a shard occurs elsewhere. Many small shards are packed
together into one double-array trie: turns get dense ids, nodes with several
children are fitted into the free cells of BASE and CHECK first, and nodes with
one child fill the rest. All paths then walk the arrays side by side, and the
places they come through are the nodes; CHECK leads their sums up again. Upper
nodes are merged from the roots of all shards and from the paths that go through
them, by partial aggregation.

Defined cases. Turns are ordered by turn (null first), role and text; a null role
or text is empty. Rows without a conv_id belong to no conversation. Repeated rows
are turns of their own. An empty table has no nodes, not even a root. Extra
columns are ignored. The digest of the conversations that end at a node is fed
from sorted rows one by one, in one partition for each node; one path is kept
whole in one worker, at some 100 bytes a turn, text not included.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from haulmark.llm.common import ranked, small
from haulmark.session import written

#: Paths below a node of a shard at most; turns of a packed trie about.
CAP, ROWS = 2000, 100_000
#: Conversations that share a beginning, and turns of it at most.
GROUP, MOST = 5, 8
BROADCAST_ROWS = 100_000
_SUMS = ["s1", "s2", "s3", "s4"]
_KEY = ["x1", "x2"]
_LOW = 0xFFFFFFFF
EMPTY = sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, k1, k2, bytes): each conversation's turns in order, a turn as 128 bits, with the bytes of its text."""
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    placed = rows.withColumn("__bin", F.coalesce(F.shiftright("turn", 6), F.lit(-(1 << 62))))
    numbered = ranked(placed, ["conv_id"], "__bin", ["turn", "role", "text"], "pos")
    return numbered.select(
        "conv_id", "pos", F.xxhash64("role", "text").alias("k1"), F.xxhash64(F.lit(1), "text", "role").alias("k2"), F.octet_length("text").cast("long").alias("bytes")
    )


def rebuilt(own: DataFrame) -> DataFrame:
    """Sequences (conv_id, depth, k1, k2, bytes) of ``turns`` where conversations begin like the first of their group; conversations without a turn have one row with depth null."""
    share = F.crc32(F.col("conv_id").cast("string")) % (MOST + 1)
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    heads = written(own.where((F.col("conv_id") % GROUP == 0) & (F.col("pos") <= MOST)).withColumnRenamed("conv_id", "base"))
    known = own.select("conv_id").distinct()
    near = F.explode(F.sequence(F.col("base") - GROUP + 1, F.col("base") + GROUP - 1))
    begun = heads.withColumn("conv_id", near).where((base == F.col("base")) & (F.col("pos") <= share))
    begun = begun.join(small(known, BROADCAST_ROWS), "conv_id").select("conv_id", F.col("pos").alias("depth"), "k1", "k2", "bytes")
    lengths = heads.groupBy("base").agg(F.count(F.lit(1)).alias("length"))
    rest = own.where(F.col("pos") > share).withColumn("base", base).join(small(lengths, BROADCAST_ROWS), "base", "left")
    kept = F.least(share, F.coalesce("length", F.lit(0)))
    tail = rest.select("conv_id", (kept + F.col("pos") - share).cast("long").alias("depth"), "k1", "k2", "bytes")
    none = known.select("conv_id", *[F.lit(None).cast("long").alias(c) for c in ("depth", "k1", "k2", "bytes")])
    return begun.unionByName(tail).unionByName(none)


def _with_parts(rows: DataFrame) -> DataFrame:
    """``rows`` with four numbers of 32 bits for each (depth, turn), 0 without a turn."""
    one, two = F.xxhash64("k1", "k2", "depth"), F.xxhash64(F.lit(3), "k2", "k1", "depth")
    parts = [one.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(one, 32), two.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(two, 32)]
    return rows.withColumns({name: F.when(F.col("depth").isNull(), F.lit(0)).otherwise(p) for name, p in zip(_SUMS, parts, strict=True)})


def _keys(depth: Column, sums: list[Column]) -> list[Column]:
    return [F.xxhash64(depth, *sums), F.xxhash64(*reversed(sums), depth)]


def _running(rows: DataFrame) -> DataFrame:
    """``rows`` with _SUMS as running sums along depth; a long conversation is cut into bins whose sums are added up first."""
    binned = rows.withColumn("__bin", F.shiftright("depth", 8))
    sums = binned.groupBy("conv_id", "__bin").agg(*[F.sum(s).alias(f"__{s}") for s in _SUMS])
    before = Window.partitionBy("conv_id").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("conv_id", "__bin", *[F.coalesce(F.sum(f"__{s}").over(before), F.lit(0)).alias(f"__from_{s}") for s in _SUMS])
    here = Window.partitionBy("conv_id", "__bin").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    met = binned.join(starts, ["conv_id", "__bin"])
    return met.select(*[c for c in rows.columns if c not in _SUMS], *[F.col(s).alias(f"own_{s}") for s in _SUMS], *[(F.col(f"__from_{s}") + F.sum(s).over(here)).alias(s) for s in _SUMS])


def _paths(sequences: DataFrame) -> DataFrame:
    """(conv_id, path): each conversation with the smallest conversation that has the same turns; written."""
    totals = _with_parts(sequences).groupBy("conv_id").agg(F.count("depth").alias("length"), *[F.sum(s).alias(s) for s in _SUMS])
    p1, p2 = _keys(F.col("length"), [F.col(s) for s in _SUMS])
    named = written(totals.select("conv_id", "length", p1.alias("p1"), p2.alias("p2")))
    first = named.groupBy("p1", "p2").agg(F.min("conv_id").alias("path"))
    return written(named.join(first, ["p1", "p2"]).select("conv_id", "path", "length"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a path from rows sorted by path and conv_id."""
    path, state = None, None
    out: tuple[list, list] = ([], [])
    for batch in batches:
        paths, ids = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        cuts = [0, *(np.flatnonzero(paths[1:] != paths[:-1]) + 1).tolist(), len(ids)] if len(ids) else []
        for a, b in zip(cuts, cuts[1:], strict=False):
            here = int(paths[a])
            if here == path:
                state.update(b",")
            else:
                if path is not None:
                    out[0].append(path)
                    out[1].append(state.hexdigest())
                path, state = here, sha256()
            state.update(",".join(ids[a:b]).encode())
        if len(out[0]) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1])], names=["tail", "ends_sha256"])
            out = ([], [])
    if path is not None:
        out[0].append(path)
        out[1].append(state.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string())], names=["tail", "ends_sha256"])


class DoubleArray:
    """A trie over dense labels in two arrays: the child of state s by label c is BASE[s] + c where CHECK says s."""

    def __init__(self, parent: np.ndarray, label: np.ndarray):
        """``parent`` and ``label`` of the nodes 1, 2, ...; node 0 is the root. Children of one node are given in a row."""
        count = len(parent) + 1
        self.base = np.zeros(1, np.int64)
        self.slot = np.zeros(count, np.int64)
        if not len(parent):
            self.check = np.full(1, -1)
            return
        edge = np.append(np.flatnonzero(np.diff(parent)) + 1, len(parent))
        first = np.append(0, edge[:-1])
        size = edge - first
        free = np.ones(2 * count + int(label.max()) + 2, bool)
        free[0] = False
        bases = np.zeros(count, np.int64)
        low = 1
        for group in np.argsort(-size, kind="stable").tolist():
            if size[group] < 2:
                break
            labels = label[first[group] : edge[group]]
            while not free[low]:
                low += 1
            bases[parent[first[group]]] = base = self._fit(free, labels, low)
            if base + labels[-1] >= len(free) // 2:
                free = np.concatenate([free, np.ones(len(free), bool)])
            free[base + labels] = False
            self.slot[first[group] + 1 : edge[group] + 1] = base + labels
        single = first[size == 1]
        cells = np.flatnonzero(free)[: len(single)]
        self.slot[single + 1] = cells
        bases[parent[single]] = cells - label[single]
        width = int(self.slot.max()) + 1
        self.base, self.check = np.zeros(width, np.int64), np.full(width, -1)
        self.base[self.slot] = bases
        self.check[self.slot[1:]] = self.slot[parent]

    @staticmethod
    def _fit(free: np.ndarray, labels: np.ndarray, low: int) -> int:
        """The least base, the first label not before ``low``, that puts all labels on free cells."""
        at, step = low, 32
        while True:
            starts = np.arange(at, at + step)
            cells = (starts - labels[0])[:, None] + labels
            ok = np.ones(cells.shape, bool)
            inside = cells < len(free)
            ok[inside] = free[cells[inside]]
            good = np.flatnonzero(ok.all(axis=1) & inside.all(axis=1))
            if len(good):
                return int(starts[good[0]] - labels[0])
            if at > len(free):
                raise AssertionError("no room")
            at, step = at + step, min(2 * step, max(32, 1_000_000 // len(labels)))

    def step(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """The children of ``state`` by ``label``; -1 where there is none."""
        to = self.base[state] + label
        ok = (to >= 0) & (to < len(self.check))
        ok[ok] = self.check[to[ok]] == state[ok]
        return np.where(ok, to, -1)


def _dense(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dense ids from 0 of pairs."""
    order = np.lexsort((b, a))
    new = np.ones(len(a), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    out = np.empty(len(a), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, tail long, y1 long, y2 long"


def _packed(table: pa.Table) -> pa.Table:
    """The nodes of the shards in ``table`` (path, n, depth, k1, k2, bytes, r1, r2, y1, y2): a double-array trie is built and walked by all paths."""
    col = {n: table.column(n).to_numpy() for n in table.column_names if n != "bucket"}
    order = np.lexsort((col["depth"], col["path"]))
    col = {n: c[order] for n, c in col.items()}
    begin = np.flatnonzero(np.append(True, col["path"][1:] != col["path"][:-1]))
    length = np.diff(np.append(begin, len(order)))
    top = np.zeros(len(order), bool)
    top[begin] = True
    # the first label of a path is its shard, the others are turns
    label = _dense(np.where(top, col["r1"], col["k1"]), np.where(top, col["r2"], col["k2"]))
    alphabet = int(label.max()) + 1
    by_length = np.argsort(-length, kind="stable")
    begin, length = begin[by_length], length[by_length]
    active = [int(np.searchsorted(-length, -j, "left")) for j in range(int(length[0]))]  # paths of more than j turns

    parents, labels, node, known = [], [], np.zeros(len(begin), np.int64), 1
    for j in range(int(length[0])):
        live = active[j]
        edges, place = np.unique(node[:live] * alphabet + label[begin[:live] + j], return_inverse=True)
        parents.append(edges // alphabet)
        labels.append(edges % alphabet)
        node[:live] = known + place
        known += len(edges)
    arrays = DoubleArray(np.concatenate(parents), np.concatenate(labels))

    width = len(arrays.check)
    convs, saved, leaves, children = (np.zeros(width, np.int64) for _ in range(4))
    least = np.full(width, np.iinfo(np.int64).max)
    row, end, level = np.zeros(width, np.int64), np.full(width, np.iinfo(np.int64).min), np.full(width, -1)
    state = np.zeros(len(begin), np.int64)
    for j in range(int(length[0])):
        live = active[j]
        at = begin[:live] + j
        state[:live] = arrays.step(state[:live], label[at])
        now = state[:live]
        np.add.at(convs, now, col["n"][at])
        np.minimum.at(least, now, col["path"][at])
        row[now], level[now] = at, j
    end[state] = col["path"][begin]

    slots = np.flatnonzero(level >= 0)
    slots = slots[np.argsort(level[slots], kind="stable")]
    np.add.at(children, arrays.check[slots], 1)
    leaves[slots] = children[slots] == 0
    saved[slots] = (convs[slots] - 1) * col["bytes"][row[slots]]
    cuts = np.searchsorted(level[slots], np.arange(int(length[0]) + 1))
    for j in range(int(length[0]) - 1, 0, -1):
        here = slots[cuts[j] : cuts[j + 1]]
        np.add.at(leaves, arrays.check[here], leaves[here])
        np.add.at(saved, arrays.check[here], saved[here])

    root = level[slots] == 0
    at = row[slots]
    parent = pa.array(least[arrays.check[slots]], mask=root)
    none = end[slots] == np.iinfo(np.int64).min
    return pa.table(
        [
            pa.array(least[slots]), pa.array(col["depth"][at]), parent, pa.array(convs[slots]), pa.array(children[slots]), pa.array(leaves[slots]),
            pa.array(saved[slots]), pa.array(end[slots], mask=none), pa.array(col["y1"][at], mask=~root), pa.array(col["y2"][at], mask=~root),
        ],
        names=["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "tail", "y1", "y2"],
    )


def nodes(sequences: DataFrame, cap: int = CAP, rows: int = ROWS) -> DataFrame:
    """The nodes of the trie of ``sequences`` (conv_id, depth from 1, k1, k2, bytes; depth null: a conversation with no turn of its own).

    Per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens (over its subtree, bytes times members
    but one) and ends_sha256 (of the members that end here).
    """
    sequences = written(sequences)
    paths = _paths(sequences)
    counts = paths.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.first("length").alias("length"))
    counts = written(counts)
    ends = paths.select("path", F.col("conv_id").cast("string").alias("name"), "conv_id").repartition("path").sortWithinPartitions("path", "conv_id")
    digests = ends.select("path", "name").mapInArrow(_digest, "tail long, ends_sha256 string")

    own = sequences.where("depth is not null").join(small(counts, BROADCAST_ROWS), sequences["conv_id"] == counts["path"])
    running = _running(_with_parts(own.select("conv_id", "n", "length", "depth", "k1", "k2", "bytes")))
    sums = [F.col(s) for s in _SUMS]
    x1, x2 = _keys(F.col("depth"), sums)
    y1, y2 = _keys(F.col("depth") - 1, [s - F.col(f"own_{n}") for s, n in zip(sums, _SUMS, strict=True)])
    steps = written(running.select(F.col("conv_id").alias("path"), "n", "length", "depth", "k1", "k2", "bytes", x1.alias("x1"), x2.alias("x2"), y1.alias("y1"), y2.alias("y2")))

    heavy = written(steps.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("paths")).where(F.col("paths") > cap).select(*_KEY, F.lit(True).alias("heavy")))
    marked = written(steps.join(small(heavy, BROADCAST_ROWS), _KEY, "left"))
    shard = marked.where("heavy is null").groupBy("path").agg(F.min(F.struct("depth", "x1", "x2")).alias("root"))
    shard = shard.select("path", F.col("root.x1").alias("r1"), F.col("root.x2").alias("r2"))
    buckets = max(1, ceil(marked.count() / rows))
    dealt = marked.where("heavy is null").join(small(shard, BROADCAST_ROWS), "path").withColumn("bucket", F.pmod(F.xxhash64("r1", "r2"), F.lit(buckets)))
    lower = written(
        dealt.select("bucket", "path", "n", "depth", "k1", "k2", "bytes", "r1", "r2", "y1", "y2").groupBy("bucket").applyInArrow(_packed, NODES)
    )

    upper = written(_upper(marked, counts, lower.where("y1 is not null")))
    parents = upper.select(F.col("x1").alias("y1"), F.col("x2").alias("y2"), F.col("conv_id").alias("above"))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "tail"]
    tops = lower.where("y1 is not null").unionByName(upper.select(*names, "y1", "y2")).join(small(parents, BROADCAST_ROWS), ["y1", "y2"], "left")
    tops = tops.select(*[F.col("above").alias(n) if n == "parent_conv_id" else n for n in names])
    found = lower.where("y1 is null").select(*names).unionByName(tops).join(digests, "tail", "left")
    return found.select(*names[:-1], F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


def _upper(marked: DataFrame, counts: DataFrame, roots: DataFrame) -> DataFrame:
    """The root and the heavy prefixes, merged from the paths through them and the shards below them, by key (x1, x2) and that of their parent (y1, y2)."""
    zero = [F.lit(0).cast("long")] * 4
    k1, k2 = _keys(F.lit(0).cast("long"), zero)
    none = F.lit(None).cast("long")
    tops = counts.select("path", "n", "length", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"), k1.alias("x1"), k2.alias("x2"), none.alias("y1"), none.alias("y2"))
    through = marked.where("heavy").select(*tops.columns).unionByName(tops)
    below = roots.select(F.col("conv_id").alias("path"), "n_leaves", F.col("saved_tokens").alias("saved"))
    met = written(through.join(small(below, BROADCAST_ROWS), "path", "left"))
    merged = met.groupBy(*_KEY).agg(
        F.min("path").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("n_leaves").alias("n_leaves"), F.coalesce(F.sum("saved"), F.lit(0)).alias("saved"),
        F.max(F.when(F.col("depth") == F.col("length"), F.col("path"))).alias("tail"), *[F.first(c).alias(c) for c in ("depth", "bytes", "y1", "y2")],
    )
    merged = written(merged.withColumn("alone", (F.col("n_convs") - 1) * F.col("bytes")))
    # what an upper node saves counts at every node above it; its smallest member's path names those
    lines = met.select("path", F.col("depth").alias("at"), *_KEY).join(
        small(merged.select(F.col("conv_id").alias("path"), F.col("depth").alias("low"), "alone"), BROADCAST_ROWS), "path"
    )
    inner = lines.where("at <= low").groupBy(*_KEY).agg(F.sum("alone").alias("inner"))
    parent = [F.col("y1").alias("x1"), F.col("y2").alias("x2")]
    born = roots.select(*parent).unionByName(merged.where("y1 is not null").select(*parent)).groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n_children"))
    whole = merged.join(born, _KEY, "left").join(inner, _KEY, "left")
    children = F.coalesce("n_children", F.lit(0))
    return whole.select(
        *_KEY, "y1", "y2", "conv_id", "depth", none.alias("parent_conv_id"), "n_convs", children.alias("n_children"),
        F.when(children == 0, F.lit(1)).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"), (F.col("saved") + F.col("inner")).alias("saved_tokens"), "tail",
    )


def report(conversations: DataFrame, cap: int = CAP, rows: int = ROWS) -> DataFrame:
    """The nodes of the trie of ``conversations`` whose beginnings are shared within groups."""
    return nodes(rebuilt(written(turns(conversations))), cap, rows)
