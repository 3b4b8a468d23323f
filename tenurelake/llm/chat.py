"""Chat formatting: conversations to one marked-up text with loss spans, in Spark expressions only.

Turns are collected and sorted by (turn, role, text), neighbours with one role become one block, and
blocks are joined to ``<|turn|>role<|text|>text<|next|>text<|end|>\\n``. Control strings inside texts
are escaped in a way that ``unescape`` reverts, so ``read_turns`` gives every turn back, merged or not.

Defined results: a null text or role is empty, a null turn sorts first, repeated rows stay and count,
rows without a conversation id form one conversation of their own, and an empty table gives no rows.
A conversation is one row of the result, so the group that is collected is as large as its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "<|end|>\n"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Breaks up ``<|``, ``<s>``, ``</s>``, ``[INST]`` and ``[/INST]``; ``&`` marks what was replaced."""
    marked = F.replace(text, F.lit("&"), F.lit("&amp;"))
    marked = F.regexp_replace(marked, r"<(?=\||/?s>)", "&lt;")
    return F.regexp_replace(marked, r"\[(?=/?INST\])", "&#91;")


def unescape(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&#91;"), F.lit("["))
    return F.replace(plain, F.lit("&amp;"), F.lit("&"))


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    loss_role: str = LOSS_ROLE,
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``loss_spans``, the code-point ranges
    [start, end) of ``formatted`` that a model is trained on. Other columns are ignored."""
    filled = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    row = F.struct(F.col(f"`{turn}`").alias("turn"), filled(role).alias("role"), filled(text).alias("text"))
    sorted_turns = turns.groupBy(F.col(f"`{conv}`").alias("conv_id")).agg(F.sort_array(F.collect_list(row)).alias("turns"))
    at = lambda i: F.get("turns", i)
    first = lambda i: (i == 0) | (at(i).role != at(i - 1).role)
    started = sorted_turns.withColumn("n", F.size("turns")).withColumn(
        "starts", F.filter(F.sequence(F.lit(0), F.col("n") - 1), first)
    )
    block = lambda s, k: F.struct(
        at(s).role.alias("role"),
        F.transform(
            F.slice("turns", s + 1, F.coalesce(F.get("starts", k + 1), F.col("n")) - s), lambda t: escape(t.text)
        ).alias("texts"),
    )
    merged = started.select("conv_id", F.transform("starts", block).alias("blocks"))
    opened = lambda b: F.concat(F.lit(TURN), escape(b.role), F.lit(TEXT))
    written = merged.withColumn(
        "formatted",
        F.array_join(
            F.transform("blocks", lambda b: F.concat(opened(b), F.array_join(b.texts, NEXT), F.lit(END))), ""
        ),
    )
    # Pieces of the text in order with whether they carry loss; spans follow from their lengths.
    piece = lambda n, loss: F.struct(n.cast("long").alias("n"), loss.alias("loss"))
    pieces = F.flatten(F.transform("blocks", lambda b: F.concat(
        F.array(piece(F.length(opened(b)), F.lit(False))),
        F.flatten(F.transform(b.texts, lambda t, i: F.array(
            piece(F.when(i == 0, 0).otherwise(len(NEXT)), F.lit(False)),
            piece(F.length(t), b.role == loss_role),
        ))),
        F.array(piece(F.lit(len(END)), F.lit(False))),
    )))
    return written.withColumn("pieces", pieces).select(
        "conv_id", "formatted", _spans(F.col("pieces"), F.size("pieces")).alias("loss_spans")
    )


def _spans(pieces: Column, n: Column) -> Column:
    """The ranges of the pieces that carry loss, pieces lying end to end.

    Arrays are added to by copying, so positions are summed up in runs of about the square root of
    ``n`` pieces, and the runs then moved to where they start.
    """
    width = F.ceil(F.sqrt(n)).cast("int")
    runs = F.transform(F.sequence(F.lit(0), n - 1, width), lambda at: F.slice(pieces, at + 1, width))
    none = lambda kind: F.array().cast(f"array<{kind}>")
    zero = F.lit(0).cast("long")
    span = lambda a, p: F.struct(a.at.alias("start"), (a.at + p.n).alias("end"))
    of_run = lambda run: F.aggregate(
        run, F.struct(zero.alias("at"), none("struct<start:bigint,end:bigint>").alias("spans")),
        lambda a, p: F.struct(
            (a.at + p.n).alias("at"), F.when(p.loss, F.concat(a.spans, F.array(span(a, p)))).otherwise(a.spans).alias("spans"),
        ),
    )
    placed = F.aggregate(
        F.transform(runs, of_run), F.struct(zero.alias("at"), none("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda a, r: F.struct((a.at + r.at).alias("at"), F.concat(a.spans, F.array(F.transform(
            r.spans, lambda s: F.struct((s.start + a.at).alias("start"), (s.end + a.at).alias("end"))))).alias("spans")),
    )
    return F.flatten(placed.spans)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as array<struct<role, text>>, unescaped."""
    literal = lambda s: r"\Q" + s + r"\E"
    blocks = F.slice(F.split(formatted, literal(END)), 1, F.greatest(F.size(F.split(formatted, literal(END))) - 1, F.lit(0)))
    turn = lambda role, text: F.struct(unescape(role).alias("role"), unescape(text).alias("text"))
    read = lambda halves: F.transform(
        F.split(F.get(halves, F.lit(1)), literal(NEXT)), lambda t: turn(F.substring(F.get(halves, F.lit(0)), len(TURN) + 1, 2**31 - 1), t)
    )
    return F.flatten(F.transform(F.transform(blocks, lambda b: F.split(b, literal(TEXT))), read))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss spans, unescaped, with nothing between."""
    cut = lambda s: unescape(F.substr(formatted, (s.start + 1).cast("int"), (s.end - s.start).cast("int")))
    return F.array_join(F.transform(spans, cut), "")
