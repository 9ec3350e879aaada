"""Conversations as training examples, one per assistant turn.

Each turn becomes ``<|role|>``, a line end, its text, ``</s>`` and a line end. Inside roles and
texts every backslash is doubled and a backslash is put after the first character of each
control string, so that none of them is left and the texts can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Control strings of this template and of other common ones (fixed values).
CONTROL = ["<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
END = "</s>\n"
TARGET = "assistant"


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for s in CONTROL:
        c = F.replace(c, F.lit(s), F.lit(s[0] + "\\" + s[1:]))
    return c


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def examples(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per assistant turn: all turns up to it as text, only its own reply trainable.

    Columns: the conversation, ``example_no`` from 0, ``text``, ``loss_start`` and ``loss_end``
    (code points, end exclusive), ``whole`` (the text holds every turn). Turns behind the last
    assistant turn, or of a conversation without one, make a last example with nothing
    trainable. Null texts and roles count as empty; turns of equal number stand in the order of
    role and text, null numbers first, repeated rows are kept; rows without a conversation form
    one of their own. An empty table gives no example. A conversation, and each example, is one
    value of a row, however long its texts are.
    """
    blank = F.lit("")
    said = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), blank).alias("role"), F.coalesce(F.col(text), blank).alias("text"))
    whole = df.groupBy(F.col(conversation).alias("__id")).agg(F.sort_array(F.collect_list(said)).alias("turns"))
    opened = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit("<|"), escape(t["role"]), F.lit("|>\n")).alias("head"), escape(t["text"]).alias("body"), (t["role"] == TARGET).alias("target")))
    n = F.size("turns")
    ends = F.filter(F.sequence(F.lit(1), n), lambda i: F.get("turns", i - 1)["target"] | (i == n))
    cut = whole.select("__id", opened.alias("turns")).select("__id", "turns", F.posexplode(ends).alias("example_no", "upto"))
    before = F.array_join(F.transform(F.slice("turns", 1, F.col("upto") - 1), lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    cut = cut.select("__id", "example_no", (F.col("upto") == n).alias("whole"), F.get("turns", F.col("upto") - 1).alias("last"), before.alias("before"))
    start = F.length("before") + F.length("last.head")
    return cut.select(
        F.col("__id").alias(conversation), F.col("example_no").cast("long").alias("example_no"),
        F.concat("before", F.col("last.head"), F.col("last.body"), F.lit(END)).alias("text"),
        start.cast("long").alias("loss_start"), (start + F.when(F.col("last.target"), F.length("last.body")).otherwise(0)).cast("long").alias("loss_end"), "whole")


def turns_of(text: str) -> Column:
    """Roles and texts read back from a formatted example."""
    parts = F.split(text, END)
    head = lambda p: F.substring_index(p, "|>\n", 1)
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.struct(
        unescape(F.substr(head(p), F.lit(3))).alias("role"), unescape(F.substr(p, F.length(head(p)) + 4)).alias("text")))


def read_back(made: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Per conversation: turns and trainable text as the examples say them, as counts and digests.

    Expects the rows of ``examples``: one example of each conversation is ``whole``, and
    ``example_no`` orders the others. An empty text has the digest of nothing; a conversation
    without assistant turns has an empty trainable text; rows without a conversation are one of
    their own. Repeated turns count each. An empty table gives no row. The trainable text of a
    conversation is one value of a row, however long it is.
    """
    loss = unescape(F.substr("text", (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int")))
    said = F.when(F.col("whole"), turns_of("text"))
    rows = made.select(conversation, "example_no", F.length("text").alias("chars"), loss.alias("loss"), F.size(said).alias("n_turns"),
                       F.sha2(F.array_join(F.transform(said, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"))
    whole = rows.groupBy(conversation).agg(
        F.max(F.when(F.col("n_turns") >= 0, F.col("n_turns"))).cast("long").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example_no", "loss"))), lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"), F.count(F.lit(1)).alias("n_examples"))
    return whole.select(conversation, "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                        "formatted_chars", "n_examples")
