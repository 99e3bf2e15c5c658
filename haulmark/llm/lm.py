"""Language-model scoring with a gated recurrent network and a class-factored softmax, in numpy.

Method. All workers count the words of the training texts; the counts stay a
distributed table. The ``EXPLICIT`` most frequent words and the end are words
of the network's own, in classes of ``CLASS_WORDS``; every other word belongs to
one of ``TAIL`` classes by its last two bytes. The network predicts the class,
and within an explicit class the word; within a tail class a word has its share
of the class's counts, which a join with the count table supplies. So each text
is scored whole, the recurrent state runs through all its windows, and known
words plus one unknown word per tail class share all probability.

Training is truncated backpropagation over every training text, cut into
excerpts of ``EXCERPT`` tokens that follow one another, so every token is a
target. Each task trains on its own excerpts, a third of them a round, and the
mean of all workers' weights starts the next round. Excerpts kept aside judge the weights of every round, the first
being plain word frequencies, and the best are used.

Defined cases. A null text is empty and has one token, its end. Without any
training text all counts are 0. Repeated rows are scored row by row. Long texts
are scored whole. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.quality import held_out
from haulmark.llm.sums import SCHEMA, blocks, summed
from haulmark.llm.text import mix, pieces, words
from haulmark.session import written

EXPLICIT, CLASS_WORDS, TAIL = 2048, 64, 32
HEAD = EXPLICIT // CLASS_WORDS
CLASSES = HEAD + TAIL
START = EXPLICIT + TAIL
HIDDEN = 16
WINDOW, EXCERPT = 32, 64
#: Texts scored side by side.
LANES = 1024
ROUNDS, STREAMS, STEPS = 3, 64, 120
#: One excerpt of so many only judges the weights; those of the best round are used.
JUDGES = 16
#: Words whose counts every task holds; the others' are joined.
HELD_WORDS = 1 << 18
_FLUSH = 1_000_000
#: Text scored at a time, which bounds a task's memory whatever the length of a batch.
_SCORED_BYTES = 4_000_000
#: Held words are found by the first bits of their hash.
_BUCKET_BITS = 18


def _tail_class(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Class of each word by its last two bytes, A-Z folded."""
    if not len(begin):
        return np.zeros(0, np.int64)
    last, before = data[end - 1].astype(np.int64), np.where(end - 2 >= begin, data[np.maximum(end - 2, 0)], 0).astype(np.int64)
    last, before = (np.where((x >= 65) & (x <= 90), x + 32, x) for x in (last, before))
    return (mix((last * 257 + before).astype(np.uint64)) % np.uint64(TAIL)).astype(np.int64)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, kind, c): occurrences of each word hash in the texts; ``kind`` is its tail class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            keys, first, place = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True)
            return keys, np.concatenate([h[1] for h in held])[first], np.bincount(place, np.concatenate([h[2] for h in held])).astype(np.int64)

        def out() -> pa.RecordBatch:
            keys, kinds, counts = merged()
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(kinds.astype(np.int32)), pa.array(counts)], names=["word", "kind", "c"])

        for batch in batches:
            for _, _, data, offsets in pieces(batch.column("text")):
                hashes, _, begin, end = words(data, offsets)
                keys, first, counts = np.unique(hashes, return_index=True, return_counts=True)
                held.append((keys, _tail_class(data, begin, end)[first], counts.astype(np.int64)))
                if sum(len(h[0]) for h in held) > _FLUSH:
                    held = [merged()]
                    if len(held[0][0]) > _FLUSH // 2:
                        yield out()
                        held = []
        if held:
            yield out()

    parts = docs.select("text").mapInArrow(run, "word long, kind int, c long")
    return parts.groupBy("word").agg(F.min("kind").alias("kind"), F.sum("c").alias("c"))


class Vocabulary:
    """Counts that every task holds: the most frequent words, the sums of the tail classes, and all tokens."""

    def __init__(self, counts: DataFrame, texts: int):
        top = counts.orderBy(F.desc("c"), "word").limit(HELD_WORDS).select("word", "kind", "c").toArrow()
        word = top.column("word").to_numpy().view(np.uint64) if top.num_rows else np.zeros(0, np.uint64)
        kind, c = (top.column(n).to_numpy().astype(np.int64) if top.num_rows else np.zeros(0, np.int64) for n in ("kind", "c"))
        explicit = min(EXPLICIT - 1, len(word))
        number = np.where(np.arange(len(word)) < explicit, np.arange(len(word)) + 1, EXPLICIT + kind)  # the end is word 0
        order = np.argsort(word)
        self.words, self.counts, self.numbers = word[order], c[order], number[order]
        self.starts = np.searchsorted(self.words, np.arange(1 << _BUCKET_BITS, dtype=np.uint64) << np.uint64(64 - _BUCKET_BITS))
        self.starts = np.append(self.starts, len(word))
        all_ = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
        self.texts, self.total, self.distinct = texts, (all_["n"] or 0) + texts, all_["v"] + (texts > 0)
        self.unigram = np.concatenate([[texts], c[:explicit], np.zeros(EXPLICIT - 1 - explicit)]).astype(float)
        kinds = {r["kind"]: (r["n"], r["v"]) for r in counts.groupBy("kind").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
        mass = np.array([kinds.get(k, (0, 0))[0] for k in range(TAIL)], float) - np.bincount(kind[:explicit], c[:explicit], minlength=TAIL)
        kept = np.array([kinds.get(k, (0, 0))[1] for k in range(TAIL)], float) - np.bincount(kind[:explicit], minlength=TAIL)
        self.mass, self.scale = mass, mass + 0.1 * (kept + 1)

    def find(self, hashes: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token number of each word, and its count; -1 where the count is not held."""
        if not len(self.words):
            return EXPLICIT + kinds, np.full(len(hashes), -1)
        bucket = hashes >> np.uint64(64 - _BUCKET_BITS)
        at, after = self.starts[bucket], self.starts[bucket + np.uint64(1)]
        found = np.zeros(len(hashes), bool)
        open_ = np.flatnonzero(at < after)
        while len(open_):
            same = self.words[at[open_]] == hashes[open_]
            found[open_[same]] = True
            open_ = open_[~same]
            at[open_] += 1
            open_ = open_[at[open_] < after[open_]]
        at = np.where(found, at, 0)
        return np.where(found, self.numbers[at], EXPLICIT + kinds), np.where(found, self.counts[at], -1)


class Network:
    """Gated recurrent units over token numbers; the weights are one flat array with named views."""

    SHAPES = (
        ("x", (START + 1, 3 * HIDDEN)),
        ("u", (HIDDEN, 3 * HIDDEN)),
        ("wc", (HIDDEN, CLASSES)),
        ("bc", (CLASSES,)),
        ("wo", (EXPLICIT, HIDDEN)),
        ("bo", (EXPLICIT,)),
    )
    SIZE = sum(int(np.prod(s)) for _, s in SHAPES)

    def __init__(self, flat: np.ndarray):
        self.flat = flat.astype(np.float32)
        self.parts = self.views(self.flat)

    @classmethod
    def views(cls, flat: np.ndarray) -> dict[str, np.ndarray]:
        at, out = 0, {}
        for name, shape in cls.SHAPES:
            out[name] = flat[at : at + int(np.prod(shape))].reshape(shape)
            at += int(np.prod(shape))
        return out

    @classmethod
    def begun(cls, vocabulary: Vocabulary, seed: int = 1) -> "Network":
        """Small random weights; the biases give each class and word its share of the counts."""
        draw = np.random.default_rng(seed)
        flat = np.zeros(cls.SIZE)
        v = cls.views(flat)
        v["x"][:] = draw.normal(0, 0.3, v["x"].shape)
        v["u"][:] = draw.normal(0, HIDDEN**-0.5, v["u"].shape)
        v["wc"][:] = draw.normal(0, 0.05, v["wc"].shape)
        v["wo"][:] = draw.normal(0, 0.05, v["wo"].shape)
        v["bo"][:] = np.log(vocabulary.unigram + 0.1)
        v["bc"][:] = np.log(np.concatenate([(vocabulary.unigram + 0.1).reshape(HEAD, CLASS_WORDS).sum(axis=1), vocabulary.mass + 0.1]))
        return cls(flat)

    def run(self, tokens: np.ndarray, state: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """States after each of the input tokens (time x texts), from ``state``."""
        u, n, trace = self.parts["u"], HIDDEN, []
        given = self.parts["x"][tokens]
        states = np.empty((*tokens.shape, n), np.float32)
        for t in range(len(tokens)):
            own = state @ u
            gates = given[t, :, : 2 * n] + own[:, : 2 * n]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            new = gates[:, n:] * own[:, 2 * n :]
            new += given[t, :, 2 * n :]
            np.tanh(new, out=new)
            if keep:
                trace.append((state, gates, new, own[:, 2 * n :]))
            state = new + gates[:, :n] * (state - new)
            states[t] = state
        return states, trace

    def log_probability(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log of the class, times that of the word where its class is explicit, for rows of states."""
        kind = np.where(targets < EXPLICIT, targets // CLASS_WORDS, targets - EXPLICIT + HEAD)
        out = _log_share(states, self.parts["wc"], self.parts["bc"], kind)
        for c, rows in _by_class(kind):
            own = slice(c * CLASS_WORDS, (c + 1) * CLASS_WORDS)
            out[rows] += _log_share(states[rows], self.parts["wo"][own].T, self.parts["bo"][own], targets[rows] % CLASS_WORDS)
        return out

    def gradient(self, tokens: np.ndarray, targets: np.ndarray, live: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient of the mean log loss over the live targets of one window, and the state after it."""
        n, p = HIDDEN, self.parts
        states, trace = self.run(tokens, state, keep=True)
        flat = np.zeros(self.SIZE, np.float32)
        g = self.views(flat)
        rows = np.flatnonzero(live.reshape(-1))
        if not len(rows):
            return flat, states[-1]
        h, want = states.reshape(-1, n)[rows], targets.reshape(-1)[rows]
        kind = np.where(want < EXPLICIT, want // CLASS_WORDS, want - EXPLICIT + HEAD)
        error = _softmax(h @ p["wc"] + p["bc"])
        error[np.arange(len(rows)), kind] -= 1
        error /= len(rows)
        g["wc"][:], g["bc"][:] = h.T @ error, error.sum(axis=0)
        down = error @ p["wc"].T
        for c, at in _by_class(kind):
            own = slice(c * CLASS_WORDS, (c + 1) * CLASS_WORDS)
            error = _softmax(h[at] @ p["wo"][own].T + p["bo"][own])
            error[np.arange(len(at)), want[at] % CLASS_WORDS] -= 1
            error /= len(rows)
            g["wo"][own], g["bo"][own] = error.T @ h[at], error.sum(axis=0)
            down[at] += error @ p["wo"][own]
        above = np.zeros((tokens.size, n), np.float32)
        above[rows] = down
        above = above.reshape(*tokens.shape, n)
        back = np.zeros_like(state)
        for t in range(len(tokens) - 1, -1, -1):
            before, gates, new, own = trace[t]
            back = back + above[t]
            z, r = gates[:, :n], gates[:, n:]
            d_new = back * (1 - z) * (1 - new * new)
            d_z = back * (before - new) * z * (1 - z)
            d_r = d_new * own * r * (1 - r)
            d_in = np.concatenate([d_z, d_r, d_new], axis=1)
            d_own = np.concatenate([d_z, d_r, d_new * r], axis=1)
            np.add.at(g["x"], tokens[t], d_in)
            g["u"] += before.T @ d_own
            back = back * z + d_own @ p["u"].T
        return flat, states[-1]


def _log_share(states: np.ndarray, weights: np.ndarray, bias: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Log softmax at one place of each row. States lie between -1 and 1, so subtracting the largest bias keeps exponents small."""
    logits = states @ weights
    logits += bias - bias.max()
    np.clip(logits, -80, 80, out=logits)
    out = logits[np.arange(len(wanted)), wanted]
    np.exp(logits, out=logits)
    return out - np.log(logits.sum(axis=1))


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _by_class(kind: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of each explicit class."""
    order = np.argsort(kind.astype(np.uint8), kind="stable")
    ends = np.searchsorted(kind[order], np.arange(HEAD + 1))
    for c in range(HEAD):
        if ends[c] < ends[c + 1]:
            yield c, order[ends[c] : ends[c + 1]]


def _numbered(data: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    hashes, starts, begin, end = words(data, offsets)
    kinds = _tail_class(data, begin, end)
    numbers, counts = vocabulary.find(hashes, kinds)
    return hashes, starts, kinds, numbers, counts


def excerpts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(tokens): numbers of up to ``EXCERPT`` + 1 tokens in a row, -1 behind the end of a text; the whole of every text, the last token of one excerpt being the first of the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, _, data, offsets in pieces(batch.column("text")):
                _, starts, _, numbers, _ = _numbered(data, offsets, vocabulary)
                for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    tokens = np.concatenate([[START], numbers[a:b], [0]]).astype(np.int16)
                    for at in range(0, len(tokens) - 1, EXCERPT):
                        piece = np.full(EXCERPT + 1, -1, np.int16)
                        own = tokens[at : at + EXCERPT + 1]
                        piece[: len(own)] = own
                        out.append(piece.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["tokens"])

    return docs.select("text").mapInArrow(run, "tokens binary")


def _batch_loss(net: Network, rows: np.ndarray) -> float:
    """Log loss of all targets in excerpts, summed."""
    loss = 0.0
    for at in range(0, len(rows), STREAMS):
        chosen = rows[at : at + STREAMS].T.astype(np.int64)
        states, _ = net.run(np.maximum(chosen[:-1], 0), np.zeros((chosen.shape[1], HIDDEN), np.float32))
        live = chosen[1:] >= 0
        loss -= float(net.log_probability(states[live], chosen[1:][live]).sum())
    return loss


def _trained_part(net: Network, rows: np.ndarray, turn: int) -> None:
    """Adam over the excerpts, ``STEPS`` windows at least; the state runs from window to window of an excerpt."""
    draw, rate = np.random.default_rng(turn), 0.02 / (1 + turn)
    first, second = np.zeros(net.SIZE, np.float32), np.zeros(net.SIZE, np.float32)
    steps = max(-(-len(rows) // STREAMS), STEPS // (EXCERPT // WINDOW))
    order = np.concatenate([draw.permutation(len(rows)) for _ in range(-(-steps * STREAMS // len(rows)))])
    done = 0
    for s in range(steps):
        chosen = rows[order[s * STREAMS : (s + 1) * STREAMS]].astype(np.int64)
        state = np.zeros((len(chosen), HIDDEN), np.float32)
        for w in range(0, EXCERPT, WINDOW):
            given, want = chosen[:, w : w + WINDOW].T, chosen[:, w + 1 : w + WINDOW + 1].T
            grad, state = net.gradient(np.maximum(given, 0), np.maximum(want, 0), (want >= 0) & (given >= 0), state)
            grad *= min(1.0, 1.0 / max(float(np.sqrt((grad * grad).sum())), 1e-9))
            done += 1
            first *= 0.9
            first += 0.1 * grad
            second *= 0.999
            second += 0.001 * grad * grad
            net.flat -= (rate / (1 - 0.9**done)) * first / (np.sqrt(second / (1 - 0.999**done)) + 1e-6)


def trained(pieces_of_text: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """The best weights of ``ROUNDS`` rounds of training by all workers and averaging."""
    flat = Network.begun(vocabulary).flat
    best, least = flat, np.inf
    for turn in range(ROUNDS + 1):
        start = flat.copy()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = [np.frombuffer(b"".join(batch.column("tokens").to_pylist()), np.int16).reshape(-1, EXCERPT + 1) for batch in batches if batch.num_rows]
            if not rows:
                return
            rows = np.concatenate(rows)
            aside = np.arange(len(rows)) % JUDGES == JUDGES - 1
            judges, mine = rows[aside], rows[~aside]
            mine = mine[turn % ROUNDS :: ROUNDS] if len(mine) >= ROUNDS else mine
            net = Network(start)
            told = [_batch_loss(net, judges), float((judges[:, 1:] >= 0).sum()), len(mine)]
            if turn < ROUNDS:
                _trained_part(net, mine, turn)
            yield blocks(np.append(net.flat.astype(np.float64) * len(mine), told))

        got = summed(pieces_of_text.mapInArrow(run, SCHEMA), Network.SIZE + 3)
        loss, n, weight = got[-3:]
        if (loss / n if n else -turn) < least:
            best, least = start, loss / n if n else -turn
        if not weight:
            break
        flat = (got[:-3] / weight).astype(np.float32)
    return best


def _scored_texts(net: Network, numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Natural log probability of classes and explicit words of each text with its end; texts of like length run side by side."""
    count = np.diff(starts)
    order = np.argsort(-count, kind="stable")
    out = np.zeros(len(count))
    for g in range(0, len(order), LANES):
        rows = order[g : g + LANES]
        length = count[rows] + 1
        state = np.zeros((len(rows), HIDDEN), np.float32)
        last = np.full(len(rows), START)
        for w in range(0, int(length[0]), WINDOW):
            live = int(np.searchsorted(-length, -w, "left"))  # lengths descend
            steps = min(WINDOW, int(length[0]) - w)
            at = starts[rows[:live], None] + np.arange(w, w + steps)
            inside = np.arange(w, w + steps) < (length[:live, None] - 1)
            wanted = np.where(inside, numbers[np.minimum(at, max(len(numbers) - 1, 0))] if len(numbers) else 0, 0)
            given = np.concatenate([last[:live, None], wanted[:, :-1]], axis=1)
            states, _ = net.run(given.T, state[:live])
            state, last = states[-1], wanted[:, -1]
            valid = np.arange(w, w + steps) < length[:live, None]
            logs = net.log_probability(states.transpose(1, 0, 2)[valid], wanted[valid])
            out[rows[:live]] += np.bincount(np.nonzero(valid)[0], logs, minlength=live)
    return out


def report(docs: DataFrame, parts: int = 10, part: int = 0) -> DataFrame:
    """Per document row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10); rows with crc32(doc_id) mod ``parts`` = ``part`` teach nothing."""
    training = docs.where(~held_out(F.col("doc_id"), parts, part))
    counts = written(word_counts(training))
    vocabulary = Vocabulary(counts, training.count())
    flat = trained(written(excerpts(training, vocabulary)), vocabulary)
    base = float(vocabulary.total + 0.1 * (vocabulary.distinct + 1))
    inside = np.log10(vocabulary.scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, row = Network(flat), TaskContext.get().partitionId() << 33
        slices = (batch.slice(a, b - a) for batch in batches for a, b, _, _ in pieces(batch.column("text"), _SCORED_BYTES))
        for batch in slices:
            tokens, base_logs, tail_logs, known, number, rest = [], [], [], [], [np.zeros(0, np.int16)], [np.zeros(0, np.int64)]
            rests = []
            for first, after, data, offsets in pieces(batch.column("text")):
                hashes, starts, _, numbers, counts = _numbered(data, offsets, vocabulary)
                n = after - first
                doc = np.repeat(np.arange(n), np.diff(starts))
                held, tail = counts >= 0, numbers >= EXPLICIT
                shown = np.where(held, np.log10(np.maximum(counts, 0) + 0.1), 0)
                tail_logs.append(np.bincount(doc, np.where(tail, shown - inside[np.where(tail, numbers - EXPLICIT, 0)], 0), minlength=n))
                base_logs.append(np.bincount(doc, shown, minlength=n))
                tokens.append(np.diff(starts))
                known.append(np.bincount(doc, held & (counts > 0), minlength=n))
                number.append(numbers.astype(np.int16))
                rest.append(hashes[~held].view(np.int64))
                rests.append(np.bincount(doc, ~held, minlength=n))
            n = batch.num_rows
            ends = np.concatenate([[0], np.cumsum(np.concatenate(tokens))])
            model = _scored_texts(net, np.concatenate(number).astype(np.int64), ends) / np.log(10) + np.concatenate(tail_logs)
            length = np.diff(ends) + 1
            local = np.concatenate(base_logs) + np.log10(vocabulary.texts + 0.1) - length * np.log10(base)
            cuts = np.concatenate([[0], np.cumsum(np.concatenate(rests))])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + n)),
                    batch.column("doc_id"),
                    pa.array(length.astype(np.int64)),
                    pa.array(np.concatenate(known).astype(np.int64) + (vocabulary.texts > 0)),
                    pa.array(local),
                    pa.array(model),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(rest))),
                ],
                names=["no", "doc_id", "n_tokens", "known", "base", "model", "rest"],
            )
            row += n

    schema = "no long, doc_id long, n_tokens long, known long, base double, model double, rest array<long>"
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema))
    rest = rows.select("no", F.explode("rest").alias("word"))
    met = rest.join(counts.select("word", "c"), "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    joined = met.groupBy("no").agg(
        F.sum(F.log10(F.col("c") + 0.1)).alias("logs"), F.count_if(F.col("c") > 0).alias("more")
    )
    logs = F.coalesce("logs", F.lit(0.0))
    return rows.drop("rest").join(joined, "no", "left").select(
        "doc_id",
        held_out(F.col("doc_id"), parts, part).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(vocabulary.total)).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("model") + logs).alias("score"),
    )
