"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, the reply as the
only trainable span. A conversation that does not end with an assistant turn also gets one
context-only example (no trainable span), so no turn is lost.

Turns are written as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts, each ``<``
followed by backslashes (none or more) and ``|`` gets one more backslash, so no text can hold a
control string and ``unescape`` restores it exactly; line breaks and backslashes of a role are
escaped as well.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    parts = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def format_examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text", trainable: str = "assistant") -> DataFrame:
    """One row per example: conv, ``target`` (index of the trainable turn; of the last turn for a
    context-only example), ``formatted``, ``loss_start`` (code points before the trainable span; null
    for a context-only example) and ``loss_length``.

    Turns are ordered by turn number (null first), then role, then text, so ties and repeated rows
    have one defined order and all stay. Null roles and texts count as empty; rows with a null
    conversation id form a conversation of their own.
    """
    rows = turns.select(F.col(conv).alias("_conv"), F.struct(
        F.col(turn).alias("t"), F.coalesce(F.col(role), F.lit("")).alias("r"),
        F.coalesce(F.col(text), F.lit("")).alias("x")).alias("_turn"))
    convs = rows.groupBy("_conv").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    written = convs.select("_conv", F.transform("_turns", lambda t: F.struct(
        t["r"].alias("role"), F.concat(F.lit(START), escape_role(t["r"]), F.lit("\n")).alias("head"),
        escape(t["x"]).alias("body"))).alias("_turns"))
    last = F.size("_turns") - 1
    targets = F.filter(F.sequence(F.lit(0), last), lambda i: (F.get("_turns", i)["role"] == trainable) | (i == last))
    one = written.select("_conv", "_turns", F.explode(targets).alias("target"))
    whole = lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))
    context = F.array_join(F.transform(F.slice("_turns", F.lit(1), F.col("target")), whole), "")
    cut = one.select("_conv", "target", context.alias("_context"), F.get("_turns", F.col("target")).alias("_t"))
    trained = F.col("_t.role") == trainable
    return cut.select(
        F.col("_conv").alias(conv), "target", F.concat("_context", whole(F.col("_t"))).alias("formatted"),
        F.when(trained, F.length("_context") + F.length("_t.head")).alias("loss_start"),
        F.when(trained, F.length("_t.body")).otherwise(F.lit(0)).alias("loss_length"))


def read_back(examples: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Per conversation, from the formatted examples alone: its turns (from the longest example) and
    the trainable texts in order. The digests are over ``role \\n text \\n`` per turn and over the
    unescaped text under the masks."""
    span = F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_length"))
    got = examples.select(conv, "target", "formatted", unescape(span).alias("_loss"))
    convs = got.groupBy(conv).agg(
        F.max_by("formatted", "target").alias("_all"),
        F.sort_array(F.collect_list(F.when(F.col("_loss").isNotNull(), F.struct("target", "_loss")))).alias("_losses"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"))
    # nothing inside a turn can hold START or END
    turns = F.transform(F.slice(F.split("_all", r"<\|im_start\|>", -1), F.lit(2), F.size(F.split("_all", r"<\|im_start\|>", -1))),
                        lambda s: F.substring_index(s, END, 1))
    parsed = convs.select(conv, "_losses", "formatted_chars", turns.alias("_turns"))
    role = lambda s: unescape_role(F.substring_index(s, "\n", 1))
    body = lambda s: unescape(F.substring(s, F.instr(s, "\n") + 1, F.length(s)))
    loss = F.array_join(F.transform("_losses", lambda x: x["_loss"]), "")
    return parsed.select(
        conv, F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("_turns", lambda s: F.concat(role(s), F.lit("\n"), body(s), F.lit("\n"))), ""), 256)
        .alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
