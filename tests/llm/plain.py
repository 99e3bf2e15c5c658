"""Plain Python versions and awkward rows for the tests of the training-data operators."""

import math
import random
import re
import string

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, size string, node long, word string, taken int, shard string"


def sentence(draw: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{int(words * draw.random() ** 2)}" for _ in range(n))


def awkward_docs(spark, seed: int = 1, copies: int = 40):
    """Null, empty, blank, one-word and very long texts, case and accents, exact and near copies, a repeated row, null keys, clashing columns."""
    draw = random.Random(seed)
    base = sentence(draw, 120)
    texts = [None, "", " \t\n", "Alone", "alone", "two words", "Ünïcode ÉTÉ\x0bété", sentence(draw, 6000), base, base.upper(), "a b a b a b", "x\u00a0y z"]
    for _ in range(copies):
        words = base.split()
        for _ in range(draw.randrange(1, 6)):
            words[draw.randrange(len(words))] = f"z{draw.random()}"
        texts.append(" ".join(words))
    texts += [sentence(draw, draw.randrange(1, 200)) for _ in range(60)]
    chain = sentence(draw, 100, 100_000).split()
    for step in range(4):
        texts.append(" ".join(chain))
        for j in range(step * 5, step * 5 + 5):
            chain[j * 4] = f"c{j}"
    rows = [
        (i * 3 + 1, t, ["en", "de", None][i % 3], [None, "b", "a", "ä", "hot", "hot", "hot"][i % 7], None, i, "s", 0, "w", 1, "x") for i, t in enumerate(texts)
    ]
    rows.append(rows[20])
    rows.append(rows[0])
    return spark.createDataFrame(rows, SCHEMA)


def words(text):
    return WORD.findall((text or "").translate(LOW))


def shingle_set(text, width):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)])


def groups(rows, linked):
    """Smallest id that each (id, value) reaches over links of values."""
    values = list({v for _, v in rows if v})
    up = {v: v for v in values}

    def top(v):
        while up[v] != v:
            v = up[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if linked(a, b):
                up[top(a)] = top(b)
    least = {}
    for i, v in rows:
        if v:
            least[top(v)] = min(least.get(top(v), math.inf), i)
    return {(i, v): least[top(v)] if v else i for i, v in rows}
