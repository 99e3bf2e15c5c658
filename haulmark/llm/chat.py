"""Chat formatting checked by a grammar round trip, in DataFrame operations only.

Method: turns are rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``. A parser
in SQL functions reads the rendered text back under a grammar in which control
strings are structure wherever they stand. A turn that does not come back as it
was is rendered again with its content escaped, and the whole conversation is
parsed and compared once more.

Escaping puts one more backslash between ``<`` and ``|`` wherever only
backslashes stand between them, so no content holds ``<|`` and taking one
backslash away restores it. In roles, backslash and line feed become ``\\b``
and ``\\n`` first.

Defined cases. Null texts and roles are empty. Rows of a conversation are
ordered by turn (null first), role, text; repeated rows stay, each as a turn of
its own. Rows without a conv_id form one conversation. Empty tables give no
rows. Extra columns are ignored. A conversation is one output row and so is put
together in one task, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_CLOSE = r"<\|im_end\|>\n"
#: A turn without its end: a role in one line, then a text without control strings.
_TURN = r"(?s)\A<\|im_start\|>((?:(?!<\|)[^\n])*)\n((?:(?!<\|).)*+)\z"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parsed(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation as an array; a piece outside the grammar is a null element."""
    pieces = F.split(formatted, _CLOSE)
    closed = F.element_at(pieces, -1) == ""
    turns = F.transform(
        F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda p: F.when(
            p.rlike(_TURN),
            F.struct(_unescape_role(F.regexp_extract(p, _TURN, 1)).alias("role"), unescape(F.regexp_extract(p, _TURN, 2)).alias("text")),
        ),
    )
    return F.when(closed, turns)


def render(conversations: DataFrame) -> DataFrame:
    """Per conversation: conv_id, turns (the source), formatted, n_escaped (turns whose content needed it), round_trip (parsed equals source)."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    plain = _rendered(F.col("role"), F.col("text"))
    same = parsed(plain) == F.array(F.struct("role", "text"))
    checked = rows.withColumn("kept", F.coalesce(same, F.lit(False)))
    shown = F.when(F.col("kept"), plain).otherwise(_rendered(_escape_role(F.col("role")), escape(F.col("text"))))
    turns = checked.withColumn("shown", shown).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "kept", "shown"))).alias("t"))
    out = turns.select(
        "conv_id",
        F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
        F.array_join(F.transform("t", lambda t: t["shown"]), "").alias("formatted"),
        F.size(F.filter("t", lambda t: ~t["kept"])).alias("n_escaped"),
    )
    return out.withColumn("round_trip", F.coalesce(parsed(F.col("formatted")) == F.col("turns"), F.lit(False)))


def loss_spans(formatted: Column, role: str = "assistant") -> Column:
    """Where the loss counts: (start, length) in code points of the formatted text, one for each text of ``role``."""
    pieces = F.filter(F.split(formatted, _CLOSE), lambda p: p != "")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, piece: Column) -> Column:
        head = F.length(F.lit(START)) + F.length(F.regexp_extract(piece, _TURN, 1)) + 1
        span = F.struct((acc["at"] + head).alias("start"), (F.length(piece) - head).alias("length"))
        counts = _unescape_role(F.regexp_extract(piece, _TURN, 1)) == role
        return F.struct(
            (acc["at"] + F.length(piece) + F.length(F.lit(END)) + 1).alias("at"),
            F.when(counts, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
        )

    return F.aggregate(pieces, start, step, lambda acc: acc["spans"])


def masked_text(formatted: Column, spans: Column) -> Column:
    """The source text under the spans, put together in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def digests(rendered: DataFrame, role: str = "assistant") -> DataFrame:
    """What the formatted text holds, read back by the parser: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, round_trip."""
    back = rendered.withColumn("back", parsed(F.col("formatted")))
    whole = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("back", lambda t: t["role"] == role), lambda t: t["text"]), "")
    return back.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "round_trip",
    )
