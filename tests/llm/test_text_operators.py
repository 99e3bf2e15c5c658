"""Near-duplicates, decontamination, quality, language and LM scoring against plain versions on awkward rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from haulmark.llm import decontamination, language, lm, minhash, quality, text
from tests.llm import plain


@pytest.fixture(scope="module")
def docs(spark):
    return plain.awkward_docs(spark).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_word_hashes_agree_with_words():
    texts = ["a  b\tA", None, "", "é É b", " x", "ab b", "\u2003wide a"]
    [(first, after, data, offsets)] = list(text.pieces(pa.array(texts)))
    hashes, starts, _, _ = text.words(data, offsets)
    seen = {}
    for i, t in enumerate(texts):
        own = plain.words(t)
        assert starts[i + 1] - starts[i] == len(own)
        for h, w in zip(hashes[starts[i] : starts[i + 1]], own, strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen) and (first, after) == (0, len(texts))


def test_pieces_cover_all_rows(monkeypatch):
    monkeypatch.setattr(text, "PIECE_BYTES", 10)
    texts = ["a" * n for n in (0, 3, 30, 4, 4, 4, 0, 12)]
    got = [(data.tobytes().decode(), a, b) for a, b, data, _ in text.pieces(pa.array(["skip", *texts]).slice(1))]
    assert "".join(g[0] for g in got) == "".join(texts)
    assert [g[1] for g in got] == [0, *[g[2] for g in got[:-1]]] and got[-1][2] == len(texts)


def test_long_lists_are_compared_by_squares(docs, rows, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 2)
    sets = [(i, plain.shingle_set(t, 2)) for i, t in rows]
    expected = plain.groups(sets, lambda a, b: 100 * len(a & b) >= 80 * len(a | b))
    assert Counter((r.doc_id, r.component_id) for r in minhash.report(docs).collect()) == Counter((i, expected[i, s]) for i, s in sets)


def test_bits_rule_out_unlike_sketches_only(spark):
    draw, rows = random.Random(6), []
    for share in (0.0, 0.2, 0.5, 0.6, 0.8, 1.0) * 20:
        values = sorted(draw.sample(range(-(1 << 31), 1 << 31), 160))
        n, common = draw.choice([3, 20, 64]), int(share * 64)
        rows.append((sorted(values[:n]), sorted(values[: min(n, common)] + values[64 : 64 + max(n - common, 0)])))
    df = spark.createDataFrame(rows, "sketch_a array<int>, sketch_b array<int>")
    for s in "ab":
        df = df.withColumns({f"kept_{s}": minhash.F.size(f"sketch_{s}")} | {f"bits{k}_{s}": c for k, c in enumerate(minhash._bits(f"sketch_{s}"))})
    got = [tuple(r) for r in df.select(minhash._may_be_alike("a", "b"), minhash._alike("sketch_a", "sketch_b")).collect()]
    assert all(may or not alike for may, alike in got) and {(True, True), (False, False)} <= set(got)


@pytest.mark.parametrize(("width", "large", "block"), [(2, 2, 3), (5, 32, 2000)])
def test_near_duplicates_match_all_pairs(docs, rows, width, large, block, monkeypatch):
    monkeypatch.setattr(minhash, "LARGE", large)
    monkeypatch.setattr(minhash, "BLOCK", block)
    sets = [(i, plain.shingle_set(t, width)) for i, t in rows]
    expected = plain.groups(sets, lambda a, b: 100 * len(a & b) >= 80 * len(a | b))
    want = Counter((i, len(s), expected[i, s], expected[i, s] == i) for i, s in sets)
    assert Counter(tuple(r) for r in minhash.report(docs, width).select("doc_id", "n_shingles", "component_id", "kept").collect()) == want


def test_dedup_keeps_one_of_each_group_and_all_columns(docs, rows):
    sets = [(i, plain.shingle_set(t, 5)) for i, t in rows]
    group = plain.groups(sets, lambda a, b: 100 * len(a & b) >= 80 * len(a | b))
    out = minhash.dedup(docs)
    assert out.schema == docs.schema
    got = Counter(r.doc_id for r in out.collect())
    assert got == Counter({**{group[k]: 1 for k in group if k[1]}, **Counter(i for i, s in sets if not s)})


def test_leaders_ask_for_two_pairs_a_node_at_most(spark, monkeypatch):
    """Texts with a few of many common passages have a leader in each passage's lists; only the pairwise part may look at all of them."""
    draw = random.Random(5)
    passages = [" ".join(f"p{p}w{i}" for i in range(8)) for p in range(24)]
    texts = [" ".join([*draw.sample(passages, 6), *(f"d{i}w{j}" for j in range(30))]) for i in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked, near = [], minhash._near

    def seen(pairs, *more):
        asked.append(pairs.count())
        return near(pairs, *more)

    monkeypatch.setattr(minhash, "_near", seen)
    got = {r.doc_id: r.component_id for r in minhash.report(docs, 2).collect()}
    sets = [(i, plain.shingle_set(t, 2)) for i, t in enumerate(texts)]
    want = plain.groups(sets, lambda a, b: 100 * len(a & b) >= 80 * len(a | b))
    assert got == {i: want[i, s] for i, s in sets}
    assert asked and max(asked) <= 2 * len(texts), asked


def test_components_follow_chains_and_stars(spark):
    from haulmark.llm.components import components

    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 150), (150, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100), 150: 150, 200: 150}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _hits(rows, items):
    windows = {}
    for item, t in items:
        w = plain.TERM.findall((t or "").translate(plain.LOW))
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[s : s + n]), set()).add(item)
    for i, t in rows:
        w, hit, found = plain.TERM.findall((t or "").translate(plain.LOW)), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[tuple(w[s : s + n])]
        ids = sorted(str(x) for x in found if x is not None)
        yield i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)


def test_decontamination_matches_all_windows(spark):
    draw = random.Random(4)
    few = lambda n: " ".join(draw.choice("a b C d É 7".split()) for _ in range(n))
    items = [(1, few(14)), (2, few(30)), (2, few(30)), (3, "b"), (4, None), (5, ""), (6, "!! --"), (7, few(3)), (7, few(3)), (None, few(12)), (10, few(10)), (8, "zebra " * 12)]
    texts = [few(n) for n in (0, 3, 9, 10, 60, 200)] + [f"{few(5)} {t} {few(5)}" for _, t in items if t] + [None, "", ". . .", "(A)-b;c", "zebra " * 30, "b" * 5000]
    rows = [(i // 2 if i > 9 else i, t, "key", 3) for i, t in enumerate(texts)] + [(0, texts[4], "key", 3), (None, texts[7], "key", 3), (5, "b", "key", 3), (5, "b", "key", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, pos int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.report(docs, bench).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = list(_hits([r[:2] for r in rows], items))
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)
    kept = decontamination.decontaminate(docs, bench)
    assert kept.schema == docs.schema
    assert Counter(tuple(r) for r in kept.collect()) == Counter(r for r, w in zip(rows, want, strict=True) if not w[-1])


def test_decontamination_splits_the_items_once(spark, monkeypatch):
    """Lookups read the items' words and windows back; none has the way from the items' texts in its plan."""
    items = spark.createDataFrame([(1, "alpha one two omega")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "alpha one two omega"), (2, "alpha one")], "doc_id long, text string")
    found = []
    align = decontamination._alignments

    def seen(index, rarest, slop=0):
        found.append(rarest._jdf.queryExecution().optimizedPlan().toString())
        return align(index, rarest, slop)

    monkeypatch.setattr(decontamination, "_alignments", seen)
    assert [r.doc_id for r in decontamination.decontaminate(docs, items).collect()] == [2]
    assert len(found) == 1 and "Generate" not in found[0] and "Join" not in found[0]


def test_proximity_finds_words_a_little_apart(spark):
    items = spark.createDataFrame([(1, "alpha one two omega")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "alpha one x two omega one two"), (2, "alpha one x x x x x x two omega")], "doc_id long, text string")
    words = decontamination.item_words(items, 10)
    index = decontamination.build_index(docs, words)
    assert decontamination.phrase_spans(index, words).count() == 0
    assert 1 in [r["__id"] for r in decontamination.proximity(index, words).collect()]


def test_quality_learns_and_defines_odd_rows(spark):
    draw = random.Random(2)
    good = ["the river runs past a quiet mill and the old road".split(), 1]
    junk = ["$$$ win!!! cash### click&&& now!!! free$$$".split(), 0]
    rows, marks = [], []
    for i in range(600):
        kind, mark = good if i % 3 else junk
        rows.append((i, " ".join(draw.choice(kind) for _ in range(draw.randrange(5, 60))), 0.5, "s"))
        marks.append((i, mark, 0))
    rows += [(1000, None, 0.5, "s"), (1001, "  ", 0.5, "s"), (1002, " ".join(draw.choice(good[0]) for _ in range(40_000)), 0.5, "s"), (None, "the mill", 0.5, "s"), (3, rows[3][1], 0.5, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, mark string")
    labels = spark.createDataFrame([*marks, (5, 1, 1), (9, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.scores(docs, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    wrong = [r.doc_id for r in got if r.doc_id is not None and r.doc_id < 600 and r.held_out and r.predicted != int(r.doc_id % 3 > 0)]
    assert len(wrong) <= 3 and by[1000].score == by[1001].score == 0 and by[1002].predicted == 1 and 0 <= min(r.score for r in got) and max(r.score for r in got) <= 1
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    kept = quality.keep(docs, labels)
    assert kept.schema == docs.schema and kept.where("doc_id = 1000").count() == 0
    assert {r.score for r in quality.scores(docs.limit(5), labels.limit(0)).collect()} == {0.5}
    assert quality.scores(docs.limit(0), labels).count() == 0


def test_language_by_compression(spark):
    draw = random.Random(3)
    kinds = {"aa": "qua quo qui nunc tamen sed atque".split(), "bb": "zik zok wurt gragh zukk borz".split(), "cc": "éla ôme ùne îre çan ëll".split()}
    rows = [(i, " ".join(draw.choice(kinds[k]) for _ in range(draw.randrange(4, 80))), k, 1) for i, k in enumerate(sorted(kinds) * 60)]
    rows += [(500, None, "aa", 1), (501, "", "aa", 1), (502, "12 34 !!", "aa", 1), (503, "ZIK WURT!! GRAGH!! " * 3 + "borz zok", None, 1), (504, "nunc sed " * 30_000, None, 1), (2, rows[2][1], "cc", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = {r.doc_id: r for r in language.report(docs).collect()}
    assert all(got[i].lang_pred == k for i, _, k, _ in rows[:180]) and got[503].lang_pred == "bb" and got[504].lang_pred == "aa"
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (500, 501, 502))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.values())
    assert {r.lang_pred for r in language.report(docs.withColumn("lang", docs.lang.substr(9, 1)).where("lang <> ''")).collect()} == set()
    assert language.report(docs.limit(0)).count() == 0


def _network(seed=0):
    draw = np.random.default_rng(seed)
    return lm.Network(draw.normal(0, 0.3, lm.Network.SIZE)), draw


def test_gradient_matches_differences():
    net, draw = _network()
    net.flat = net.flat.astype(np.float64)
    net.parts = net.views(net.flat)
    tokens, targets = draw.integers(0, lm.START, (5, 3)), draw.integers(0, lm.START, (5, 3))
    live, state = draw.random((5, 3)) < 0.8, draw.normal(0, 0.5, (3, lm.HIDDEN))

    def loss():
        states, _ = net.run(tokens, state)
        rows = live.reshape(-1)
        return -net.log_probability(states.reshape(-1, lm.HIDDEN)[rows], targets.reshape(-1)[rows]).mean()

    grad, _ = net.gradient(tokens, targets, live, state)
    for at in np.argsort(-np.abs(grad))[:: max(1, int((grad != 0).sum()) // 25)][:25]:
        before = net.flat[at]
        net.flat[at] = before + 1e-2
        up = loss()
        net.flat[at] = before - 1e-2
        down = loss()
        net.flat[at] = before
        assert abs((up - down) / 2e-2 - grad[at]) < 2e-3 + 0.05 * abs(grad[at])


def test_probabilities_sum_to_one_and_state_runs_through_windows(monkeypatch):
    net, draw = _network(1)
    states = draw.normal(0, 0.5, (2, lm.HIDDEN)).astype(np.float32)
    every = np.arange(lm.START)
    for s in states:
        assert abs(np.exp(net.log_probability(np.repeat(s[None], lm.START, 0), every)).sum() - 1) < 1e-3
    lengths = [0, 3, 200, 31, 32, 33]
    numbers, starts = draw.integers(0, lm.START, sum(lengths)), np.concatenate([[0], np.cumsum(lengths)])
    whole = lm._scored_texts(net, numbers, starts)
    monkeypatch.setattr(lm, "WINDOW", 7)
    assert np.allclose(whole, lm._scored_texts(net, numbers, starts), atol=1e-3)
    alone = [lm._scored_texts(net, numbers[a:b], np.array([0, b - a]))[0] for a, b in zip(starts[:-1], starts[1:], strict=True)]
    assert np.allclose(whole, alone, atol=1e-3)


@pytest.mark.parametrize("held", [1 << 18, 30])
def test_lm_counts_and_beats_the_base(docs, rows, held, monkeypatch):
    monkeypatch.setattr(lm, "HELD_WORDS", held)
    got = lm.report(docs).collect()
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 10:
            counts.update([*plain.words(t), None])
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        own = [*plain.words(t), None]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        want.append((i, zlib.crc32(str(i).encode()) % 10 == 0, len(own), sum(counts[w] > 0 for w in own), total, round(base, 4)))
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == Counter(want)
    assert all(r.score < 0 for r in got) and sum(r.score for r in got) > 1.01 * sum(r.base_score for r in got)  # words without order leave nothing to learn


def test_lm_learns_order(spark):
    draw = random.Random(6)
    kinds = [[f"{k}{i}" for i in range(30)] for k in "abc"]
    rows = [(i, " ".join(draw.choice(kinds[i % 3]) for _ in range(draw.randrange(5, 90)))) for i in range(400)]
    got = lm.report(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").collect()
    assert sum(r.score for r in got) > 0.92 * sum(r.base_score for r in got)


def test_lm_without_training_rows(docs, spark):
    assert lm.report(docs.limit(0)).count() == 0
    [row] = lm.report(spark.createDataFrame([(11, "a b")], "doc_id long, text string").where("crc32(cast(doc_id as string)) % 10 >= 0")).collect()
    assert row.n_tokens == 3


def test_every_token_of_a_training_text_is_a_target(spark):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 63, 64, 700)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    counts = lm.word_counts(docs)
    vocabulary = lm.Vocabulary(counts, len(texts))
    rows = [np.frombuffer(r.tokens, np.int16) for r in lm.excerpts(docs, vocabulary).collect()]
    assert sum(int((row[1:] >= 0).sum()) for row in rows) == sum(n + 1 for n in (0, 1, 63, 64, 700))
    words = np.concatenate([row[1:][row[1:] > 0] for row in rows])
    assert len(words) == 1 + 63 + 64 + 700 and len(set(words.tolist())) == 700
