r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are its
context and only that reply is trainable.  All examples of a conversation are
prefixes of one formatted text, so that text is stored once, as a segment per
turn, and an example is a row of spans over it (the prefix's end, the reply's
start and end): the output grows with the conversation, not with its square.
:func:`example_texts` gives the examples written out.

Template: ``### <role>: <text></turn>\n``.  Inside texts and roles, ``\`` is
written ``\\``, ``#`` before ``##`` is ``\h`` and ``<`` before ``/turn>`` is
``\l`` (and ``:`` in a role ``\c``), so the marks ``###`` and ``</turn>`` cannot
occur inside, and :func:`unescape` gives the text back exactly.

Edge cases: null text or role is empty; turns are ordered by (turn, role, text),
nulls first, so ties and repeated rows have one order and are all kept; null
conversation ids form one conversation; a conversation without an assistant turn
has segments and no example; an empty reply is an example with an empty span.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, MARK, CLOSE = "### ", ": ", "</turn>\n"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.regexp_replace(out, r"#(?=##)", r"\\h")
    return F.regexp_replace(out, r"<(?=/turn>)", r"\\l")


def unescape(text: Column) -> Column:
    """The inverse.  Pairs of backslashes are split off first, from the left, so
    that a lone one left over always starts ``\\h``, ``\\l`` or ``\\c``."""
    def plain(x: Column) -> Column:
        for code, char in (("\\h", "#"), ("\\l", "<"), ("\\c", ":")):
            x = F.replace(x, F.lit(code), F.lit(char))
        return x
    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def segments(turns: DataFrame) -> DataFrame:
    """(conv_id, turn_no, segment, seg_start, seg_end, target) from
    (conv_id, turn, role, text): one row per turn, spans in characters of the
    conversation's formatted text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    role = F.coalesce("role", F.lit(""))
    head = F.concat(F.lit(OPEN), F.replace(escape(role), F.lit(":"), F.lit("\\c")), F.lit(MARK))
    seg = F.concat(head, escape(F.coalesce("text", F.lit(""))), F.lit(CLOSE))
    return (turns.select("conv_id", "turn", "role", "text")
            .withColumn("segment", seg)
            .withColumn("turn_no", F.row_number().over(order))
            .withColumn("seg_end", F.sum(F.length("segment").cast("long")).over(
                order.rowsBetween(Window.unboundedPreceding, 0)))
            .select("conv_id", "turn_no", "segment",
                    (F.col("seg_end") - F.length("segment")).alias("seg_start"), "seg_end",
                    (role == "assistant").alias("target")))


def examples(segs: DataFrame) -> DataFrame:
    """(conv_id, turn_no, example_end, loss_start, loss_end): one row per
    assistant turn; the example is the text up to example_end, the loss mask the
    reply's span."""
    head = F.instr("segment", MARK) + len(MARK) - 1
    return segs.where("target").select(
        "conv_id", "turn_no", F.col("seg_end").alias("example_end"),
        (F.col("seg_start") + head).alias("loss_start"),
        (F.col("seg_end") - len(CLOSE)).alias("loss_end"))


def example_texts(segs: DataFrame, exs: DataFrame) -> DataFrame:
    """The examples written out: (conv_id, turn_no, text, loss_start, loss_end).

    Size: the sum over replies of all text before them; for export only.
    """
    e = exs.select("conv_id", F.col("turn_no").alias("_at"), "loss_start", "loss_end").alias("e")
    s = segs.alias("s")
    part = s.join(e, F.expr("s.conv_id <=> e.conv_id AND s.turn_no <= e._at"))
    return (part.groupBy("s.conv_id", "_at", "loss_start", "loss_end")
            .agg(F.array_sort(F.collect_list(F.struct("turn_no", "segment"))).alias("parts"))
            .select("conv_id", F.col("_at").alias("turn_no"),
                    F.array_join(F.col("parts.segment"), "").alias("text"), "loss_start", "loss_end"))


def parsed(segs: DataFrame, exs: DataFrame) -> DataFrame:
    """(conv_id, turn_no, role, text, chars, loss): each turn read back from its
    segment, and the text under the example's mask (null: not trainable)."""
    body = F.substr("segment", F.lit(len(OPEN) + 1), F.length("segment") - len(OPEN) - len(CLOSE))
    at = F.instr("body", MARK)
    spans = exs.select(F.col("conv_id").alias("_conv"), F.col("turn_no").alias("_turn"), "loss_start", "loss_end")
    loss = F.substr("segment", (F.col("loss_start") - F.col("seg_start") + 1).cast("int"),
                    (F.col("loss_end") - F.col("loss_start")).cast("int"))
    return (segs.join(spans, F.expr("conv_id <=> _conv AND turn_no = _turn"), "left")
            .withColumn("body", body)
            .select("conv_id", "turn_no",
                    unescape(F.substr("body", F.lit(1), at - 1)).alias("role"),
                    unescape(F.substr("body", at + len(MARK), F.length("body"))).alias("text"),
                    F.length("segment").cast("long").alias("chars"),
                    unescape(loss).alias("loss")))


def _digest(batches):
    """Rows sorted by conversation and turn -> one row per conversation.

    Digests grow turn by turn, so memory does not depend on a conversation's
    length; a conversation may go on in the next batch.
    """
    key, now = object(), None

    def row():
        return [now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]]

    cols = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    for b in batches:
        out = []
        for conv, role, text, chars, loss in zip(b["conv_id"], b["role"], b["text"], b["chars"], b["loss"]):
            conv = None if pd.isna(conv) else int(conv)
            if now is None or conv != key:
                if now is not None:
                    out.append(row())
                key, now = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            now[1] += 1
            now[2].update(f"{role}\n{text}\n".encode())
            if loss is not None:
                now[3] += len(loss)
                now[4].update(loss.encode())
            now[5] += int(chars)
        yield pd.DataFrame(out, columns=cols).astype({"conv_id": "Int64"})
    if now is not None:
        yield pd.DataFrame([row()], columns=cols).astype({"conv_id": "Int64"})


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation from :func:`parsed` turns."""
    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn_no")
            .select("conv_id", "role", "text", "chars", "loss")
            .mapInPandas(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                  "loss_sha256 string, formatted_chars long"))
