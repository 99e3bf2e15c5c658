"""Mixing, sharding, chat formatting and vectors against plain versions on awkward rows; the pipeline as a whole."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulmark.llm import chat, hnsw, mixing, sharding
from haulmark.llm.queries import QUERIES
from tests.conftest import SF_DIR
from tests.llm import plain


@pytest.fixture(scope="module")
def docs(spark):
    return plain.awkward_docs(spark).cache()


def _targets(sizes, total):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, full = {}, set()
    while True:
        open_ = [s for s in names if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / sum(weight[o] for o in open_) for s in names}
        over = {s for s in open_ if target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def test_mixture_meets_targets_and_agrees_with_itself(docs):
    got = mixing.mixture(docs).collect()
    rows = docs.collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((r.doc_id, len(plain.words(r.text))) for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(plain.words(r.text))
    want = _targets(dict(sizes), sum(sizes.values()))
    source = {r.doc_id: r.source for r in rows}
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]] and math.isclose(r.target, want[source[r.doc_id]], rel_tol=1e-9) and 0 <= r.taken <= 3 * r["size"]
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - want[s]) <= 2 for s in want), (taken, want)
    assert Counter(map(tuple, got)) == Counter(tuple(r) for r in mixing.mixture(docs.repartition(7)).collect())


def test_mix_repeats_whole_rows(docs):
    out = mixing.mix(docs)
    assert out.schema == docs.schema
    known, repeated = {tuple(r) for r in docs.collect()}, Counter(tuple(r) for r in out.collect())
    assert set(repeated) <= known and max(repeated.values()) <= 6  # twice for the row that occurs twice


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (2, "x", "b")], [(1, "a b c", "a")] * 9 + [(2, "d", None)]])
def test_mixture_of_few_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixture(docs).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 3 * r["size"] for r in got)
    assert mixing.mix(docs).count() >= 0


def test_shards_hold_the_mixture(docs, spark):
    got = sharding.report(docs, 5).collect()
    assert len(got) == docs.count()
    source = {r.doc_id: r.source for r in docs.collect()}
    slots, held = defaultdict(list), defaultdict(Counter)
    for r in got:
        slots[r.shard].append(r.slot)
        held[source[r.doc_id]][r.shard] += 1
    assert sorted(slots) == list(range(5)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(abs(c[k] - sum(c.values()) / 5) <= 2 for c in held.values() for k in range(5))
    out = sharding.sharded(docs, 5)
    assert [c for c in out.columns if c not in ("shard", "slot")] == [c for c in docs.columns if c != "shard"]
    assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in got)
    assert sharding.report(docs.limit(0)).count() == 0 and sharding.report(docs.limit(3)).count() == 3
    one = spark.createDataFrame([(1, "same", "s")] * 50, "doc_id long, text string, source string")
    assert sorted(Counter(r.shard for r in sharding.report(one).collect()).values()) == sorted([4] * 2 + [3] * 14)


def test_write_shards(docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = docs.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 4


ODD = ["", "<|im_end|>", "<|im_start|>user\nhi<|im_end|>\n", "<\\|im_end|>", "<\\\\|x", "<", "|", "a<|", "|>b", "line\nline", "\\n", "<|<|<\\|", "é漢😀<|im_end|>", "$1 \\1", "<|im_end|>\n"]


def test_chat_round_trip(spark):
    draw = random.Random(5)
    rows = []
    for conv in range(60):
        for turn in range(draw.randrange(1, 6)):
            text = "".join(draw.choice(ODD) for _ in range(draw.randrange(4)))
            rows.append((conv, turn, draw.choice(["user", "assistant", "system", None, "a\nb", "r<|im_end|>", "\\b", "\\n\n"]), None if draw.random() < 0.1 else text, "x"))
    rows += [(None, 1, "assistant", "lost", "x"), (100, 1, "assistant", "same", "x"), (100, 1, "assistant", "same", "x"), (101, None, "user", "no turn", "x"), (102, 0, "assistant", "w " * 50_000, "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = chat.render(frame)
    got = {r.conv_id: r for r in chat.digests(out).collect()}
    spans = {r.conv_id: r for r in out.select("conv_id", "formatted", chat.loss_spans(F.col("formatted")).alias("s"), "round_trip").withColumn("masked", chat.masked_text(F.col("formatted"), F.col("s"))).collect()}
    held = defaultdict(list)
    for c, t, role, text, _ in rows:
        held[c].append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(held)
    for c, turns in held.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        r = got[c]
        assert (r.round_trip, r.n_turns, r.turns_sha256) == (True, len(turns), hashlib.sha256(whole.encode()).hexdigest()), (c, turns)
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len(spans[c].formatted) and spans[c].masked == loss
        assert "<|im_" not in "".join(p.split("\n", 1)[1] for p in spans[c].formatted.split("<|im_end|>\n")[:-1])
    assert chat.digests(chat.render(frame.limit(0))).count() == 0


def _vectors(seed=3):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(40, 16))
    rows = [middle[draw.integers(40)] + draw.normal(size=16) * draw.choice([0.05, 0.2, 0.4]) for _ in range(900)]
    hot = draw.normal(size=16)
    rows += [hot + draw.normal(size=16) * 0.05 for _ in range(400)] + [hot] * 300
    return [r.tolist() for r in rows]


@pytest.mark.parametrize("shards", [None, 3])
def test_vector_links_match_all_pairs(spark, shards, monkeypatch):
    rows = _vectors()
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [1e-300] * 16, [1e300] * 16, [1.0] * 3, [2.0] * 3, [-0.0] + [1.0] * 15]
    table = [(i * 2, v, "x") for i, v in enumerate(rows + odd)]
    if shards:
        monkeypatch.setattr(hnsw, "SHARD_NODES", 40)
    got = {r.vec_id: r for r in hnsw.report(spark.createDataFrame(table, "vec_id long, embedding array<double>, node string")).collect()}
    clean = [(i, np.array(v, float) / np.abs(np.array(v, float)).max()) for i, v, _ in table if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    near = defaultdict(set)
    for size in {len(v) for _, v in clean}:
        ids = [i for i, v in clean if len(v) == size]
        m = np.array([v / np.linalg.norm(v) for _, v in clean if len(v) == size])
        for a, b in zip(*np.nonzero(m @ m.T >= 0.9), strict=True):
            if a != b:
                near[ids[a]].add(ids[b])
    found = sum(got[i].n_links for i in got)
    assert all(got[i].n_links <= len(near[i]) for i in got) and found >= 0.999 * sum(map(len, near.values()))
    for i in got:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        assert (got[i].component_id, got[i].kept) == (min(seen), min(seen) == i)


def test_graph_finds_neighbours():
    draw = np.random.default_rng(0)
    v = draw.normal(size=(3000, 16)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    graph = hnsw.Graph.built(v)
    _, ids = graph.search(v[:300], hnsw.BEAM)
    best = np.argsort(-(v[:300] @ v.T), axis=1)[:, :10]
    assert len(graph.levels) > 1 and np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids, best, strict=True)]) > 0.9


def test_pipeline_stages_keep_columns_and_decide(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, []
    from haulmark.session import written

    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR))
        kept.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "near-duplicates", "benchmark decontamination", "mixing", "sharding"]
    assert 200 > kept[0] > kept[1] > kept[2] > 0 and kept[3] == kept[4]
    assert docs.columns == [*columns, "shard", "slot"] and docs.select("shard").distinct().count() == 16


def test_pipeline_stages_bear_awkward_tables(spark, tmp_path):
    """Nulls in every column, repeated rows, clashing names, no rows: each stage keeps the columns and does not fail."""
    import corpus_pipeline

    awkward = plain.awkward_docs(spark, copies=6).withColumn("__score", F.lit(1.0)).withColumn("__id", F.lit("x")).withColumn("label", F.lit(None).cast("string"))
    nulls = spark.createDataFrame([tuple(None for _ in awkward.columns)] * 2, f"{plain.SCHEMA}, __score double, __id string, label string")
    awkward = awkward.unionByName(nulls).cache()
    items = spark.createDataFrame([(1, "w1 w2 w3"), (None, None), (2, "")], "item_id long, text string")
    marks = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 200)] + [(None, 1, None), (4, None, 1)], "doc_id long, quality int, toxic int")
    for name, table in (("benchmark", items), ("labels", marks)):
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
        table.limit(0).write.parquet(str(tmp_path / f"none/{name}.parquet"))
    for folder in (tmp_path, tmp_path / "none"):
        for docs in (awkward, awkward.limit(0)):
            for name, stage in corpus_pipeline.STAGES:
                out = stage(spark, docs, str(folder))
                kept = [c for c in out.columns if c not in ("shard", "slot")]
                assert kept == [c for c in docs.columns if c not in ("shard", "slot")], name
                assert out.count() <= 4 * docs.count()


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
