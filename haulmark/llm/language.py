"""Language identification by compression with one zstandard dictionary per language.

Method. Of each language some labelled documents, chosen by a hash of their id,
are joined, up to ``DICTIONARY`` bytes, and become a raw-content dictionary. A
text is compressed whole with every dictionary, in pieces that each start from
the dictionary alone, since a long text would else teach its language to every
compressor; the smallest sum names the language. The margin, by which the
second smallest exceeds the smallest, relative to the smallest, is the
confidence; below ``narrow`` the answer is marked as rejected.

Defined cases. A null text, or one without any letter, is ``und`` with score 0.
Documents without a lang teach nothing. With no language learned everything is
``und``. A text longer than a ``SHORT``-th part of a dictionary teaches nothing,
so a language of long texts only is not learned. Ties go to the language first in code-point order. Repeated rows are
answered alike. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.quality import held_out

DICTIONARY = 256_000
#: About so many documents of a language come to the driver to fill its dictionary; none is longer than a ``SHORT``-th part of it.
DOCUMENTS = 256
SHORT = 32
LEVEL = 3
#: Texts are compressed in pieces of so many bytes, each from the dictionary alone, and the sizes added up.
SEGMENT = 1_000
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")


def _encoded(text: str) -> bytes:
    """Letters in lower case with single spaces for all else, so that case, digits and marks don't speak for a language."""
    return _OTHER.sub(" ", text.lower()).encode("utf-8", "replace")


def dictionaries(docs: DataFrame, size: int = DICTIONARY, documents: int = DOCUMENTS) -> dict[str, bytes]:
    """For each language of ``docs`` (text, lang; rows to learn from) at most ``size`` bytes of its texts.

    The driver gets about ``documents`` short texts of each language, however many rows there are.
    """
    rank = F.xxhash64(F.lit(9), "doc_id", "text")
    fitting = docs.where("lang is not null and octet_length(text) between 1 and " + str(size // SHORT))
    counts = fitting.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    bound = F.least(F.lit(documents) / F.col("n"), F.lit(1.0)) * F.lit(2.0**63)
    near = counts.select("lang", bound.alias("bound"))
    rows = fitting.select("lang", "text", rank.alias("rank")).join(near, "lang").where("abs(cast(rank as double)) <= bound")
    out: dict[str, bytes] = {}
    for row in sorted(rows.select("lang", "rank", "text").distinct().collect(), key=lambda r: (r["lang"], r["rank"], r["text"])):
        out[row["lang"]] = (out.get(row["lang"], b"") + _encoded(row["text"]) + b" ")[:size]
    return out


def predicted(rows: DataFrame, learned: dict[str, bytes], narrow: float = 0.01, level: int = LEVEL) -> DataFrame:
    """``rows`` (with a column text) plus __lang, __score (0 to 1, from the margin) and __rejected, which replace columns of these names."""
    rows = rows.drop("__lang", "__score", "__rejected")
    names = sorted(learned)
    bodies = [learned[n] for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = []
        for body in bodies:
            data = zstd.ZstdCompressionDict(body, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=level)
            tools.append(zstd.ZstdCompressor(dict_data=data, level=level, write_content_size=False, write_checksum=False))
        for batch in batches:
            langs, scores, rejected = [], [], []
            for text in batch.column("text"):
                text = text.as_py()
                if not tools or not text or not _LETTER.search(text):
                    langs.append(UNKNOWN), scores.append(0.0), rejected.append(True)
                    continue
                raw = _encoded(text)
                parts = [raw[i : i + SEGMENT] for i in range(0, len(raw), SEGMENT)]
                sizes = np.array([sum(len(t.compress(p)) for p in parts) for t in tools], float)
                best = int(np.argmin(sizes))
                margin = (np.partition(sizes, 1)[1] - sizes[best]) / sizes[best] if len(sizes) > 1 else 1.0
                langs.append(names[best]), scores.append(float(1 - 0.5 * np.exp(-20 * margin))), rejected.append(bool(margin < narrow))
            new = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, "__lang", "__score", "__rejected"])

    schema = rows.select("*", F.lit("").alias("__lang"), F.lit(0.0).alias("__score"), F.lit(True).alias("__rejected")).schema
    return rows.mapInArrow(run, schema)


def report(docs: DataFrame, parts: int = 3, part: int = 1) -> DataFrame:
    """Per document row: doc_id, held_out, lang_pred, score, rejected; rows with crc32(doc_id) mod ``parts`` = ``part`` teach nothing."""
    learned = dictionaries(docs.where(~held_out(F.col("doc_id"), parts, part) & F.col("doc_id").isNotNull()))
    return predicted(docs.select("doc_id", "text"), learned).select(
        "doc_id",
        held_out(F.col("doc_id"), parts, part).alias("held_out"),
        F.col("__lang").alias("lang_pred"),
        F.col("__score").alias("score"),
        F.col("__rejected").alias("rejected"),
    )
