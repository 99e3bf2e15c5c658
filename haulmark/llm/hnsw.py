"""Near-duplicate vectors by one small-world graph per shard, every shard searched, links proved by cosine.

Method. Vectors are scaled to length 1; equal vectors become one node with a
count. Nodes are dealt by hash into shards, and each shard's task builds a
hierarchical navigable small-world graph over its own nodes: a node's level
falls off geometrically, each level links a node with its nearest neighbours
both ways, and the levels above lead to where the search on the ground begins.
All nodes are queries to every shard, in blocks. A query keeps a beam of the
best nodes met so far; where all it keeps at the end lies above the threshold
(less a slack), it may have more partners than the beam is wide, and its beam is
widened to the whole shard. Each task also audits its graph: some queries are
compared with the whole shard, and while the graph finds less than ``RECALL``
of their partners the beam is doubled for all. Found
pairs count only after their cosine in double precision.

Links leave a task as sums: how many a query has, and with whom it is joined in
the task's own spanning forest, so a group of thousands of near copies makes
rows in proportion to its members and not to its pairs.

Defined cases. Null vectors, vectors of zeros and vectors with null or
non-finite components are linked with nothing, and so are vectors of different
lengths with each other. Repeated rows, and rows that are multiples of each
other, are linked. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.components import components
from haulmark.session import written

NEIGHBOURS, BEAM, BLOCK, FIRST = 16, 48, 1024, 512
RECALL, AUDITED, SLACK = 0.999, 64, 0.05
#: One shard for this many nodes; beyond, shards grow with the cube root of the nodes.
SHARD_NODES = 1_000
LINK = 0.9


def _chosen(sims: np.ndarray, ids: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (best first, -1 empty) up to ``most`` that lie nearer to the row's node than to any chosen before, then the best of the rest."""
    rows, width = ids.shape
    among = np.einsum("rcd,red->rce", vectors[ids], vectors[ids])
    taken = np.zeros((rows, width), bool)
    nearest = np.full((rows, width), -2.0, np.float32)  # of each candidate to a chosen one
    for c in range(width):
        good = (ids[:, c] >= 0) & (sims[:, c] > nearest[:, c]) & (taken.sum(axis=1) < most)
        taken[:, c] = good
        nearest[good] = np.maximum(nearest[good], among[good, c])
    rank = np.argsort(~taken, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, rank, axis=1)


def _best(sims: np.ndarray, ids: np.ndarray, keep: int, marks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """The ``keep`` best distinct candidates of each row, best first; a candidate met before stays in its marked place."""
    order = np.argsort(ids * 2 + (0 if marks is None else ~marks), axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
    marks = None if marks is None else np.take_along_axis(marks, order, axis=1)
    again = np.zeros(ids.shape, bool)
    again[:, 1:] = ids[:, 1:] == ids[:, :-1]
    sims = np.where(again | (ids < 0), -2, sims)
    order = np.argsort(-sims, axis=1, kind="stable")[:, :keep]
    ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
    ids = np.where(sims > -2, ids, -1)
    return sims, ids, None if marks is None else np.take_along_axis(marks, order, axis=1)


class Level:
    """Links of one level: for each of its nodes up to 2 * NEIGHBOURS others, -1 where there are fewer."""

    def __init__(self, links: np.ndarray):
        self.links = links

    def search(self, queries: np.ndarray, entries: np.ndarray, vectors: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Best ``beam`` nodes for each query (similarities and numbers, best first), from its entry nodes."""
        sims = np.einsum("qd,qed->qe", queries, vectors[entries])
        sims = np.where(entries >= 0, sims, -2)
        sims, ids, done = _best(sims, entries, beam, np.zeros(entries.shape, bool))
        if ids.shape[1] < beam:
            more = beam - ids.shape[1]
            sims, ids = np.pad(sims, ((0, 0), (0, more)), constant_values=-2), np.pad(ids, ((0, 0), (0, more)), constant_values=-1)
            done = np.pad(done, ((0, 0), (0, more)))
        active = np.arange(len(queries))
        while len(active):
            waiting = (ids[active] >= 0) & ~done[active]
            active = active[waiting.any(axis=1)]
            if not len(active):
                break
            place = ((ids[active] >= 0) & ~done[active]).argmax(axis=1)
            done[active, place] = True
            new = self.links[ids[active, place]]
            near = np.einsum("qd,qed->qe", queries[active], vectors[new]).astype(np.float32)
            near = np.where((new >= 0) & (near > sims[active, -1:]), near, -2)
            some = (near > -2).any(axis=1)
            rows = active[some]
            if len(rows):
                merged = _best(
                    np.hstack([sims[rows], near[some]]),
                    np.hstack([ids[rows], np.where(near[some] > -2, new[some], -1)]),
                    beam,
                    np.hstack([done[rows], np.zeros((len(rows), new.shape[1]), bool)]),
                )
                sims[rows], ids[rows], done[rows] = merged
        return sims, ids


def _grown(vectors: np.ndarray, order: np.ndarray, entry) -> Level:
    """Link the nodes of one level in ``order``, block by block; ``entry(rows)`` gives nodes where their search begins."""
    links = np.full((len(vectors), 2 * NEIGHBOURS), -1, np.int64)
    level = Level(links)
    at = 0
    while at < len(order):
        new = order[at : at + (FIRST if at == 0 else min(BLOCK, at))]
        inside = vectors[new] @ vectors[new].T
        np.fill_diagonal(inside, -2)
        near = np.argsort(-inside, axis=1)[:, : min(2 * NEIGHBOURS, max(len(new) - 1, 1))]
        sims, ids = np.take_along_axis(inside, near, axis=1), new[near]
        ids = np.where(sims > -2, ids, -1)
        if at:
            s, i = level.search(vectors[new], entry(new), vectors, BEAM)
            sims, ids = np.hstack([sims, s]), np.hstack([ids, i])
        sims, ids, _ = _best(sims, ids, BEAM)
        links[new, :NEIGHBOURS] = -1
        got = _chosen(sims, ids, vectors, NEIGHBOURS)
        links[new, : got.shape[1]] = got
        # the other way: what each node now gets from the new ones, beside what it has
        source, target = np.repeat(new, got.shape[1]), got.reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        for some in np.array_split(np.arange(len(nodes)), max(1, len(nodes) // BLOCK)):
            if not len(some):
                continue
            wide = int(min(count[some].max(), 3 * NEIGHBOURS))
            cell = first[some, None] + np.arange(wide)
            given = np.where(np.arange(wide) < count[some, None], source[np.minimum(cell, len(source) - 1)], -1)
            both = np.hstack([links[nodes[some]], given])
            sims = np.where(both >= 0, np.einsum("rd,rcd->rc", vectors[nodes[some]], vectors[both]), -2)
            sims, both, _ = _best(sims, both, both.shape[1])
            kept = _chosen(sims, both, vectors, 2 * NEIGHBOURS)
            links[nodes[some]] = -1
            links[nodes[some], : kept.shape[1]] = kept
        at += len(new)
    return level


class Graph:
    """A hierarchical navigable small world over unit vectors (float32)."""

    def __init__(self, vectors: np.ndarray, levels: list[tuple[np.ndarray, Level]]):
        self.vectors, self.levels = vectors, levels  # highest level last; each with its nodes' numbers

    @classmethod
    def built(cls, vectors: np.ndarray, seed: int = 1) -> "Graph":
        height = np.floor(-np.log(np.random.default_rng(seed).random(len(vectors)) + 1e-12) / np.log(NEIGHBOURS)).astype(int)
        graph = cls(vectors, [])
        for h in range(int(height.max(initial=0)), -1, -1):
            nodes = np.flatnonzero(height >= h)
            order = np.argsort(-height[nodes], kind="stable")
            own = vectors[nodes]
            place = np.full(len(vectors), -1)
            place[nodes] = np.arange(len(nodes))

            def entry(rows: np.ndarray, own=own, place=place) -> np.ndarray:
                return place[graph.entries(own[rows])] if graph.levels else np.zeros((len(rows), 1), np.int64)

            graph.levels.append((nodes, _grown(own, order, entry)))
        return graph

    def entries(self, queries: np.ndarray) -> np.ndarray:
        """Nodes of the lowest level so far where the search below it begins."""
        at = np.zeros((len(queries), 1), np.int64)
        for k, (nodes, level) in enumerate(self.levels):
            if k:
                place = np.full(len(self.vectors), -1)
                place[nodes] = np.arange(len(nodes))
                at = place[at]
            _, ids = level.search(queries, at, self.vectors[nodes], 8)
            at = np.where(ids >= 0, nodes[ids], nodes[ids[:, :1]])
        return at

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        upper = Graph(self.vectors, self.levels[:-1])
        entries = upper.entries(queries) if upper.levels else np.zeros((len(queries), 1), np.int64)
        return self.levels[-1][1].search(queries, entries, self.vectors, beam)


def _unit(raw: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, scaled first so that no square over- or underflows."""
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def _partners(graph: Graph, exact: np.ndarray, queries: np.ndarray, link: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each query row its partners among the graph's nodes by proved cosine."""
    single = queries.astype(np.float32)
    low, beam = link - SLACK, BEAM
    audit = np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(int)
    whole = single[audit] @ graph.vectors.T >= link
    while beam < len(exact):
        _, ids = graph.search(single[audit], beam)
        full = whole.sum(axis=1) >= beam  # these are searched whole anyway
        met = np.take_along_axis(whole, np.maximum(ids, 0), axis=1) & (ids >= 0)
        if met[~full].sum() >= RECALL * whole[~full].sum():
            break
        beam *= 2
    for at in range(0, len(queries), BLOCK):
        own, rows = single[at : at + BLOCK], np.arange(at, min(at + BLOCK, len(queries)))
        if beam < len(exact):
            sims, ids = graph.search(own, beam)
            more = sims[:, -1] >= low
        else:
            more = np.ones(len(own), bool)
        for i in np.flatnonzero(~more):
            near = ids[i][(sims[i] >= low) & (ids[i] >= 0)]
            if len(near):
                near = near[exact[near] @ queries[rows[i]] >= link]
                if len(near):
                    yield int(rows[i]), near
        wide = np.flatnonzero(more)
        for part in np.array_split(wide, max(1, len(wide) // 128)):
            close = exact @ queries[rows[part]].T >= link if len(part) else np.zeros((0, 0), bool)
            for j, i in enumerate(part):
                near = np.flatnonzero(close[:, j])
                if len(near):
                    yield int(rows[i]), near


def _pack(graph: Graph) -> list[bytes]:
    out = [graph.vectors.tobytes()]
    for nodes, level in graph.levels:
        out += [nodes.astype(np.int64).tobytes(), level.links.astype(np.int32).tobytes()]
    return out


def _unpack(parts: list[bytes], size: int) -> Graph:
    levels = []
    for nodes, links in zip(parts[1::2], parts[2::2], strict=True):
        levels.append((np.frombuffer(nodes, np.int64), Level(np.frombuffer(links, np.int32).reshape(-1, 2 * NEIGHBOURS).astype(np.int64))))
    return Graph(np.frombuffer(parts[0], np.float32).reshape(-1, size), levels)


def vector_nodes(vectors: DataFrame) -> DataFrame:
    """(node, raw, size, copies): each distinct usable vector once, as bytes of doubles."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"vec_id": batch["vec_id"], "raw": [np.asarray(v, np.float64).tobytes() for v in batch["v"]]})

    usable = F.size("v") > 0
    clean = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select("vec_id", F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0)).alias("v")).where(usable & clean)
    return rows.mapInPandas(run, "vec_id long, raw binary").withColumn("node", F.xxhash64("raw"))


def linked(nodes: DataFrame, link: float = LINK, shards: int | None = None, blocks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(node, n) with the number of a node's links to rows of other nodes, and forest edges (a, b), of ``nodes`` (node, raw, copies)."""
    count = nodes.count()
    shards = shards or max(1, round((count / SHARD_NODES) ** (1 / 3)))
    blocks = blocks or max(1, round(2 * nodes.sparkSession.sparkContext.defaultParallelism / shards), count // 100_000)
    dealt = nodes.withColumns({"size": F.octet_length("raw"), "shard": F.pmod("node", F.lit(shards)).cast("int"), "block": F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int")})

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        exact = _unit(np.frombuffer(b"".join(frame["raw"]), np.float64).reshape(len(frame), -1))
        graph = Graph.built(exact.astype(np.float32))
        return pd.DataFrame(
            {"size": frame["size"].iloc[:1], "shard": frame["shard"].iloc[:1], "nodes": [frame["node"].to_numpy(np.int64).tobytes()], "copies": [frame["copies"].to_numpy(np.int64).tobytes()], "exact": [exact.tobytes()], "graph": [_pack(graph)]}
        )

    def search(key: tuple, asked: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"node": [], "n": [], "a": [], "b": []}
        if len(asked) and len(shard):
            held = shard.iloc[0]
            names, copies = np.frombuffer(held["nodes"], np.int64), np.frombuffer(held["copies"], np.int64)
            exact = np.frombuffer(held["exact"], np.float64).reshape(len(names), -1)
            graph = _unpack(list(held["graph"]), exact.shape[1])
            own = asked["node"].to_numpy(np.int64)
            label = np.arange(len(names))
            queries = _unit(np.frombuffer(b"".join(asked["raw"]), np.float64).reshape(len(asked), -1))
            for i, near in _partners(graph, exact, queries, link):
                near = near[names[near] != own[i]]
                if not len(near):
                    continue
                out["node"].append(own[i]), out["n"].append(int(copies[near].sum())), out["a"].append(None), out["b"].append(None)
                groups, first = np.unique(label[near], return_index=True)
                for g in groups[1:]:
                    label[label == g] = groups[0]
                for f in near[first]:
                    out["node"].append(None), out["n"].append(None), out["a"].append(own[i]), out["b"].append(names[f])
        return pd.DataFrame({k: pd.array(v, "Int64") for k, v in out.items()})

    graphs = written(
        dealt.groupBy("size", "shard").applyInPandas(build, "size int, shard int, nodes binary, copies binary, exact binary, graph array<binary>")
    )
    asked = dealt.select("size", "block", "node", "raw", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    offered = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["size", "shard", "block"]
    found = written(asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInPandas(search, "node long, n long, a long, b long"))
    return found.where("node is not null").groupBy("node").agg(F.sum("n").alias("n")), found.where("a is not null").select("a", "b")


def report(vectors: DataFrame, link: float = LINK) -> DataFrame:
    """Per vector row: vec_id, n_links, component_id, kept."""
    rows = written(vector_nodes(vectors))
    nodes = written(rows.groupBy("node", "raw").agg(F.count(F.lit(1)).alias("copies")))
    n, edges = linked(nodes, link)
    labels = components(edges)
    sizes = nodes.join(n, "node", "left").join(labels, "node", "left").select(
        "node", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("label", "node").alias("label")
    )
    named = written(rows.select("vec_id", "node").join(sizes, "node"))
    least = written(named.groupBy("label").agg(F.min("vec_id").alias("component_id")))
    met = named.join(least, "label").select("vec_id", "n_links", "component_id")
    rest = vectors.select("vec_id").exceptAll(met.select("vec_id")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return met.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
