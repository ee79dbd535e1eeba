"""Chat formatting with DataFrame expressions only.

Turns of a conversation are collected as structs and sorted; adjacent turns of
one role become one block; blocks are concatenated under a template.

Template (fixed): a block is ``<im ROLE>TEXT<and>TEXT...<end>`` and a newline;
``<and>`` stands between the merged turns of a block.  In texts ``&`` and ``<``
are written ``&amp;`` and ``&lt;`` (in roles ``>`` is ``&gt;`` too), so ``<`` only
ever begins a mark, whatever a text says, and reading back is exact.

Defined cases: null text and null role are empty; turns are ordered by turn,
then role, then text, null turns first; repeated rows are turns of their own;
rows of a null conversation id form one conversation; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MARK_END, AND, END = "<im ", ">", "<and>", "<end>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(c: Column) -> Column:
    c = F.replace(F.replace(c, F.lit("&gt;"), F.lit(">")), F.lit("&lt;"), F.lit("<"))
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def format_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", loss_role: str = "assistant") -> DataFrame:
    """``(conv_id, formatted, segments)`` per conversation.  ``segments`` is the formatted text cut
    into runs ``(text, loss)``; ``loss`` marks the runs a model is trained on, the texts of
    ``loss_role``.  Their texts, joined, are ``formatted``."""
    rows = df.select(df[conv].alias("conv_id"), F.struct(
        df[turn].alias("turn"), F.coalesce(df[role].cast("string"), F.lit("")).alias("role"),
        F.coalesce(df[text].cast("string"), F.lit("")).alias("text")).alias("t"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    t, n = F.col("turns"), F.size("turns")
    starts = turns.withColumn("starts", F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"])))
    s = F.col("starts")
    blocks = starts.select("conv_id", F.transform(s, lambda at, k: F.struct(
        F.get(t, at)["role"].alias("role"),
        F.transform(F.slice(t, at + 1, F.coalesce(F.get(s, k + 1), n) - at), lambda x: escape(x["text"])).alias("texts"),
    )).alias("blocks"))
    no = F.lit(False)

    def block(b: Column) -> Column:
        head = F.concat(F.lit(OPEN), F.replace(escape(b["role"]), F.lit(">"), F.lit("&gt;")), F.lit(MARK_END))
        body = F.flatten(F.transform(b["texts"], lambda x, k: F.when(k > 0, F.array(
            _segment(F.lit(AND), no), _segment(x, b["role"] == loss_role))).otherwise(
            F.array(_segment(x, b["role"] == loss_role)))))
        return F.concat(F.array(_segment(head, no)), body, F.array(_segment(F.lit(END), no)))

    segments = blocks.select("conv_id", F.flatten(F.transform("blocks", block)).alias("segments"))
    return segments.select(
        "conv_id", F.array_join(F.transform("segments", lambda x: x["text"]), "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of ``(role, text)`` structs."""
    def block(b: Column) -> Column:
        body = F.substring_index(b, END, 1)
        role = F.substring_index(body, MARK_END, 1)
        texts = F.split(F.substr(body, F.length(role) + 2), AND)
        return F.transform(texts, lambda x: F.struct(unescape(role).alias("role"), unescape(x).alias("text")))

    parts = F.split(formatted, OPEN)
    return F.flatten(F.transform(F.slice(parts, F.lit(2), F.size(parts)), block))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped and joined."""
    return F.array_join(F.transform(F.filter(segments, lambda x: x["loss"]), lambda x: unescape(x["text"])), "")
