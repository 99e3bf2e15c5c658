"""Fingerprints, periodic runs and the conversation trie against brute force on awkward rows, and against their SQL twins."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from haulmark.llm import runs, text, trie, winnowing
from haulmark.llm.queries import CHECKS, QUERIES
from tests.conftest import SF_DIR
from tests.llm import plain
from tools.compare import compare


@pytest.fixture(scope="module")
def docs(spark):
    return plain.awkward_docs(spark).cache()


@pytest.mark.parametrize("name", ["op11_document_fingerprints", "op12_periodic_runs", "op13_conversation_trie"])
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    outcome = compare(QUERIES[name](spark, SF_DIR), con, CHECKS[name])
    assert outcome.startswith("ok") and "TYPES" not in outcome, outcome


# --- fingerprints


def marks(value, gram=16, window=16):
    value = value or ""
    if not value:
        return []
    runs = [value[i : i + gram] for i in range(len(value) - gram + 1)] if len(value) >= gram else [value]
    hashes = [zlib.crc32(r.encode()) for r in runs]
    chosen = {}
    for s in range(max(1, len(hashes) - window + 1)):
        part = hashes[s : s + window]
        at = s + max(j for j, h in enumerate(part) if h == min(part))
        chosen[at] = hashes[at]
    return sorted((at << 32) + h for at, h in chosen.items())


def test_marks_match_brute_force(spark):
    draw = random.Random(2)
    texts = ["", "a", "abc" * 4, "a" * 16, "ab" * 15, "ab" * 16, "a" * 3000, "é😀" * 600, "\n" * 40]
    texts += ["".join(draw.choice("abc é😀\n") for _ in range(n)) for n in (15, 16, 17, 30, 31, 32, 511, 512, 513, 526, 541, 542, 543, 1024, 1055, 2000)]
    frame = spark.createDataFrame(list(enumerate(texts)) + [(99, None)], "doc_id long, text string")
    for gram, window in ((16, 16), (8, 4)):
        got = {r.doc_id: r.m for r in frame.select("doc_id", winnowing.marks(F.col("text"), gram, window).alias("m")).collect()}
        assert got[99] == [] and all(got[i] == marks(t, gram, window) for i, t in enumerate(texts))


def test_shared_passages_share_a_mark(spark):
    draw = random.Random(3)
    passage = "".join(draw.choice("abcdef ") for _ in range(31))
    rows = [(i, "".join(draw.choice("uvwxyz ") for _ in range(draw.randrange(900))) + passage + "z" * i) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", winnowing.positions(winnowing.marks(F.col("text"))).alias("m"))
    held = [{m.hash for m in r.m if r.text.index(passage) <= m.position <= r.text.index(passage) + 15} for r in frame.collect()]
    assert set.intersection(*held)


def _follow(rows):
    """Expected report of rows with distinct ids."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (doc, value) in enumerate(order):
        value, after = value or "", order[(i + 1) % len(order)][1] or ""
        third = len(value) // 3
        edited = value[: len(value) - third] + after[:third]
        sets = [{m % 2**32 for m in marks(v)} for v in (value, edited, after)]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        out[doc] = (len(value), hashlib.sha256(edited.encode()).hexdigest(), *near, len(marks(value)))
    return out


@pytest.mark.parametrize("bin_rows", [500, 3])
def test_fingerprint_report_matches_brute_force(docs, spark, bin_rows, monkeypatch):
    monkeypatch.setattr(winnowing, "BIN_ROWS", bin_rows)
    rows = list({r.doc_id: (r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 5000}.values())
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("own", F.lit("clash")).repartition(5)
    got = winnowing.report(frame).collect()
    want = _follow(rows)
    assert {r.doc_id: (r.n_chars, r.edited_sha256, r.near_edited, r.near_next, r.n_marks) for r in got} == want
    prints = defaultdict(set)
    texts = dict(rows)
    for r in got:
        prints[texts[r.doc_id] or ""].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_fingerprints_of_hot_and_missing_ids(spark, monkeypatch):
    monkeypatch.setattr(winnowing, "BIN_ROWS", 5)
    rows = [(7, f"text {i % 40} of the hot id") for i in range(90)] + [(i, f"other {i}") for i in range(30, 60)] + [(None, f"none {i}") for i in range(20)] + [(-(2**63), "least"), (2**63 - 1, "most")]
    got = winnowing.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    value, after = "other 31", "other 30"
    assert by_id[31].edited_sha256 == hashlib.sha256((value[:-2] + after[:2]).encode()).hexdigest()
    assert by_id[2**63 - 1].edited_sha256 == hashlib.sha256(b"moso").hexdigest()


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "abc")], [(1, "same text of some length")] * 4])
def test_fingerprints_of_few_rows(spark, rows):
    got = winnowing.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and all(r.near_next == 1.0 for r in got)


# --- periodic runs


def plain_runs(w, shortest=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(i + 1, j)
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def _sequence(draw):
    letters, n = draw.choice([1, 2, 2, 3, 5, 50]), draw.choice([0, 1, 5, 12, 30, 100, 300])
    w = [draw.randrange(letters) for _ in range(n)]
    kind = draw.randrange(6)
    if kind == 1 and n:
        a = draw.randrange(n)
        p = 1 + (n - a) // (3 + draw.randrange(8))
        w = [w[i if i < a else a + (i - a) % p] for i in range(n)]
    if kind == 2:
        x, y = "a", "ab"
        while len(y) < n:
            x, y = y, y + x
        w = [ord(c) for c in y[:n]]
    if kind == 3:
        w = []
        while len(w) < n:
            w += ([draw.randrange(letters) for _ in range(draw.randrange(1, 30))] * draw.randrange(1, 8))[: draw.randrange(1, 200)]
        w = w + w[: draw.randrange(len(w) + 1)]
    if kind == 4:
        w = [0, 1]
        while len(w) < n:
            w = w + [1 - x for x in w]
        w = w[:n]
    if kind == 5:  # equal highly periodic halves, the gap of the synchronising sets
        p = draw.randrange(2, 8)
        half = ([draw.randrange(3) for _ in range(p)] * 20)[: draw.randrange(9 * p, 14 * p + 1)]
        w = [7] * draw.randrange(2) + half * draw.randrange(2, 4) + [9] * draw.randrange(3)
    return w


@pytest.mark.parametrize("seed", range(8))
def test_runs_match_brute_force(seed):
    draw = random.Random(seed)
    for _ in range(40):
        held = [_sequence(draw) for _ in range(draw.randrange(1, 5))]
        letters = text.mix(np.array([x + 1000 for w in held for x in w], np.uint64))
        starts = np.concatenate([[0], np.cumsum([len(w) for w in held])]).astype(np.int64)
        got = [tuple(r) for r in runs.find_runs(letters, starts).tolist()]
        assert got == [(s + o, e + o, q) for w, o in zip(held, starts.tolist(), strict=False) for s, e, q in plain_runs(w)]


def test_run_report_on_awkward_rows(docs, spark):
    hard = [(1000 + i, v) for i, v in enumerate([None, "", "  ", "a " * 30, "x\ty\n" * 20 + "z", "é 😀 " * 9, " ".join(f"w{i}" for i in range(700)) + " " + " ".join(f"w{i}" for i in range(700))])]
    table = docs.select("doc_id", "text", F.lit("clash").alias("runs")).unionByName(spark.createDataFrame(hard, "doc_id long, text string").withColumn("runs", F.lit("x")))
    table = table.unionByName(table.limit(3).withColumn("doc_id", F.lit(None).cast("long")))
    rows = table.collect()
    got = runs.report(table).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in rows)
    value = {r.doc_id: r.text for r in rows if r.doc_id is not None}
    for r in got:
        if r.doc_id is None or len(value[r.doc_id] or "") > 20_000:
            continue
        w = plain.WORD.findall(value[r.doc_id] or "")
        found = plain_runs(w)
        gone = {i for s, e, q in found for i in range(s + q, e)}
        top = min(((s - e, s, q) for s, e, q in found), default=None)
        assert r.n_runs == len(found) and r.n_words == len(w)
        assert (r.start, r.length, r.period) == ((top[1], -top[0], top[2]) if top else (None, None, None))
        assert r.exponent_milli == (1000 * -top[0] // top[2] if top else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{e - s},{q}\n" for s, e, q in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()
    assert runs.report(table.limit(0)).count() == 0 and runs.planted(table.limit(0)).count() == 0


def test_planted_rows_follow_the_rule(docs):
    held = {r.doc_id: r.text for r in docs.collect()}
    for r in runs.planted(docs).collect():
        w = plain.WORD.findall(held[r.doc_id] or "")
        h = zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            assert r.text == " ".join(w[i if i < a else a + (i - a) % p] for i in range(len(w)))
        else:
            assert r.text == held[r.doc_id]


# --- the trie


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, value in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", value or ""))
    seq = {}
    for c in own:
        own[c].sort()
    for c, held in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        seq[c] = [t[1:] for t in own.get(base, [])[:h] + held[h:]]
    members = defaultdict(list)
    for c, s in seq.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, held in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(held) - 1) * len(p[-1][1].encode()) if p else 0
    out = Counter()
    for p, held in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in held if len(seq[c]) == len(p)))
        out[min(held), len(p), min(members[p[:-1]]) if p else None, len(held), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


FIELDS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _conversations(draw, convs, hot=0):
    rows = []
    for c in range(convs):
        c = c - 7
        for t in range(draw.choice([1, 2, 3, 9, 12])):
            rows.append((c, draw.choice([t, t, t, None]), draw.choice(["user", "assistant", None]), draw.choice(["a", "b", "é", None, ""]), "clash"))
    rows += [(1000 + i * 5, t, "user", f"t{t}", "x") for i in range(hot) for t in range(4)]
    rows += [(2000 + i * 5, t, "user", f"t{t}" if t < 3 else f"own {i}", "x") for i in range(hot) for t in range(5)]
    rows += [(5000, t, "user", f"long {t}", "x") for t in range(700)] + [(5005, t, "user", f"long {t}", "x") for t in range(650)]
    rows += rows[:5] + [(None, 1, "user", "lost", "x"), (9001, 0, "user", "no base", "x"), (3, 0, "user", "again", "x")]
    return rows


@pytest.mark.parametrize(("cap", "bucket_rows"), [(2000, 100_000), (2, 100), (1, 10)])
def test_trie_matches_brute_force(spark, cap, bucket_rows):
    rows = _conversations(random.Random(cap), 60, 30)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth string").repartition(5)
    got = Counter(tuple(r[f] for f in FIELDS) for r in trie.report(frame, cap, bucket_rows).collect())
    want = plain_trie([r[:4] for r in rows])
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])


def test_trie_of_few_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert trie.report(spark.createDataFrame([], schema)).count() == 0
    rows = [(6, 0, "user", "x")]  # crc32 leaves it no turn of its own or one; both have a root
    got = Counter(tuple(r[f] for f in FIELDS) for r in trie.report(spark.createDataFrame(rows, schema)).collect())
    assert got == plain_trie(rows)


def test_double_array_finds_exactly_its_children():
    draw = random.Random(4)
    parent, label, taken = [], [], set()
    for node in range(400):
        for c in sorted(draw.sample(range(300), draw.choice([0, 1, 1, 1, 2, 40]))):
            if len(parent) < 2500:
                parent.append(node)
                label.append(c)
                taken.add((node, c))
        if len(parent) <= node:
            break
    arrays = trie.DoubleArray(np.array(parent), np.array(label))
    nodes = len(parent) + 1
    assert len(set(arrays.slot.tolist())) == nodes
    for node in range(nodes):
        to = arrays.step(np.full(300, arrays.slot[node]), np.arange(300))
        assert {(node, c) for c in np.flatnonzero(to >= 0).tolist()} == {t for t in taken if t[0] == node}
