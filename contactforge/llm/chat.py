"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns up to and with it, of which only that reply is
trainable. A conversation that ends on another role adds one *open* example without a target, so that no turn
is lost. A turn is written as ``<|start|>role<|sep|>text<|end|>``; control strings inside texts or roles get a
backslash after their first character and every backslash is doubled, so that no text can forge a mark and the
texts can be read back exactly.

Defined results: null roles and texts count as empty, null conversation ids are one conversation, ties of the
turn number are ordered by role and text, repeated rows are turns of their own, an empty table gives no
example. Other columns are ignored. A conversation is one cell of the output, so it has to fit into one.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

START, SEPARATOR, END = "<|start|>", "<|sep|>", "<|end|>"
#: Strings that may not appear in a formatted text: the own marks and those of other common templates.
CONTROL = [START, SEPARATOR, END, "<s>", "</s>", "[INST]", "[/INST]"]


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def prefix_examples(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", target: str = "assistant",
) -> DataFrame:
    """``conv_id, example_no, text, loss_start, loss_chars``: one row per target turn, and open ends.

    ``loss_start`` counts code points from 0; an open example has ``loss_chars`` null.
    """
    rows = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    escaped = escape(F.col("body"))
    marked = rows.select(
        "conv_id", (F.col("role") == target).alias("hit"), F.length(escaped).alias("reply"),
        F.concat(F.lit(START), escape(F.col("role")), F.lit(SEPARATOR), escaped, F.lit(END)).alias("segment"),
        F.row_number().over(order).alias("example_no"), F.lead("role").over(order).isNull().alias("last"),
        "turn", "role", "body",
    )
    written = marked.withColumn("text", F.array_join(F.collect_list("segment").over(upto), ""))
    kept = written.filter(F.col("hit") | F.col("last"))
    reply = F.when(F.col("hit"), F.col("reply"))
    return kept.select(
        "conv_id", "example_no", "text", (F.length("text") - F.lit(len(END)) - reply).alias("loss_start"), reply.alias("loss_chars"),
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted text, as an array of ``role, text``."""
    pieces = F.split(text, r"<\|end\|>", -1)

    def turn(piece: Column) -> Column:
        parts = F.split(F.substr(piece, F.lit(len(START) + 1)), r"<\|sep\|>", -1)
        return F.struct(unescape(F.get(parts, F.lit(0))).alias("role"), unescape(F.get(parts, F.lit(1))).alias("text"))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def trainable_text(text: Column, start: Column, chars: Column) -> Column:
    """What the loss sees of an example, unescaped; empty for an open example."""
    return F.coalesce(unescape(F.substr(text, start + 1, chars)), F.lit(""))


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation what can be read back from its examples: turns, trainable text and length."""
    seen = examples.withColumn("loss", trainable_text(F.col("text"), F.col("loss_start"), F.col("loss_chars")))
    whole = seen.groupBy("conv_id").agg(
        F.max_by("text", "example_no").alias("text"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example_no", "loss"))), lambda x: x["loss"]), "").alias("loss"),
        F.sum(F.length("text")).alias("formatted_chars"),
    )
    lines = F.transform(read_turns(F.col("text")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return whole.select(
        "conv_id", F.size(lines).cast("long").alias("n_turns"), F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )
