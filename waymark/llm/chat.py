"""Chat formatting by prefix-target expansion (DataFrame functions only).

Every assistant turn becomes one training example: all turns before it are its
context, and only its own text lies under the loss mask. Turns that follow the
last assistant turn are kept in one closing example without a target, so that
nothing of a conversation is lost.

Template of a turn: ``<s>role[INST]text</s>``. Control strings that occur inside
a role or a text are broken by a backslash after their first character and
backslashes are doubled, so that reading back is exact and no text can forge a
turn.

Defined results: null role or text counts as empty; a null ``turn`` sorts first;
rows that tie on ``turn`` are ordered by role, then text; repeated rows are turns
of their own; a row with null ``conv_id`` is a conversation of its own; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, HEAD, CLOSE = "<s>", "[INST]", "</s>"


def escape(text: Column) -> Column:
    """Break control strings by a backslash after their first character; double backslashes."""
    broken = F.regexp_replace(text, r"\\", r"\\\\")
    broken = F.regexp_replace(broken, r"<(?=/?s>|\|)", r"<\\")
    return F.regexp_replace(broken, r"\[(?=/?INST\])", r"[\\")


def unescape(text: Column) -> Column:
    """Inverse of :func:`escape`."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chat(turns: DataFrame) -> DataFrame:
    """Examples of all conversations of ``turns`` (conv_id, turn, role, text).

    Returns conv_id, conv_key (tells conversations with null conv_id apart),
    example_no (from 0), n_turns (turns in the example), formatted, loss_start and
    loss_length (code points of ``formatted`` under the loss mask; length 0 and
    start null in a closing example), is_last (its conversation's last example).
    """
    empty = F.lit("")
    rows = turns.select(
        "conv_id",
        F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1)).alias("conv_key"),
        F.struct(
            "turn",
            F.coalesce("role", empty).alias("role"),
            F.coalesce("text", empty).alias("text"),
        ).alias("t"),
    )
    whole = rows.groupBy("conv_id", "conv_key").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    whole = whole.select(
        "conv_id",
        "conv_key",
        F.transform(
            "turns",
            lambda t: F.struct(
                (t["role"] == "assistant").alias("reply"),
                escape(t["text"]).alias("body"),
                F.concat(F.lit(OPEN), escape(t["role"]), F.lit(HEAD)).alias("head"),
            ),
        ).alias("turns"),
    )
    ends = F.filter(
        F.transform("turns", lambda t, i: F.when(t["reply"] | (i == F.size("turns") - 1), i + 1)),
        lambda i: i.isNotNull(),
    )
    example = whole.select("conv_id", "conv_key", "turns", F.size(ends).alias("n"), F.posexplode(ends).alias("example_no", "end"))
    target = F.element_at("turns", F.col("end"))
    formatted = F.array_join(
        F.transform(F.slice("turns", 1, F.col("end")), lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), ""
    )
    return example.select(
        "conv_id",
        "conv_key",
        "example_no",
        F.col("end").alias("n_turns"),
        formatted.alias("formatted"),
        F.when(target["reply"], F.length(target["body"])).otherwise(0).alias("loss_length"),
        target["reply"].alias("_reply"),
        (F.col("example_no") == F.col("n") - 1).alias("is_last"),
    ).select(
        "conv_id",
        "conv_key",
        "example_no",
        "n_turns",
        "formatted",
        F.when(F.col("_reply"), F.length("formatted") - len(CLOSE) - F.col("loss_length")).alias("loss_start"),
        "loss_length",
        "is_last",
    )


def read_turns(formatted: Column) -> Column:
    """``array<struct<role, text>>`` parsed back from a formatted example."""
    parts = F.split(formatted, CLOSE, -1)
    parts = F.slice(parts, 1, F.size(parts) - 1)
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.substring_index(F.substring(p, len(OPEN) + 1, 2147483647), HEAD, 1)).alias("role"),
            unescape(F.substring(p, F.instr(p, HEAD) + len(HEAD), 2147483647)).alias("text"),
        ),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, what its formatted examples say: digests of turns and of the text under the loss mask."""
    masked = F.when(
        F.col("loss_length") > 0,
        unescape(F.expr("substring(formatted, loss_start + 1, loss_length)")),
    ).otherwise("")
    said = F.array_join(
        F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    parts = examples.select(
        "conv_id",
        "conv_key",
        F.struct("example_no", masked.alias("masked")).alias("loss"),
        F.when(F.col("is_last"), F.size(read_turns(F.col("formatted")))).alias("n_turns"),
        F.when(F.col("is_last"), F.sha2(said, 256)).alias("turns_sha256"),
        F.length("formatted").alias("chars"),
    )
    whole = parts.groupBy("conv_id", "conv_key").agg(
        F.max("n_turns").cast("long").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.array_join(F.transform(F.sort_array(F.collect_list("loss")), lambda x: x["masked"]), "").alias("masked"),
        F.sum("chars").alias("formatted_chars"),
        F.count("*").alias("n_examples"),
    )
    return whole.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
    )
