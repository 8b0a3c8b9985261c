"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Each assistant turn becomes an example of its own: all turns before it are context, only its text is trainable. Turns
after the last assistant turn form one more example without a target, so that no turn is lost.

A turn is written as ``### Role: text </turn>`` and a line end. Inside roles and texts a backslash goes before each
backslash, ``#`` and ``<``, so neither marker can come up within a turn, and removing the backslashes gives the
original back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SEPARATOR, CLOSE = "### ", ": ", " </turn>\n"
TARGET = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\#<])", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\#<:])", "$1")


def escaped_role(role: Column) -> Column:
    """A role also escapes colons, as the first plain colon ends it."""
    return F.regexp_replace(role, r"([\\#<:])", r"\\$1")


def examples(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, example (from 0), n_turns, formatted, and loss: the code points of `formatted` that are trainable.

    loss is a struct of start and length, from 0; null in an example without a target. Null roles and texts count as
    empty; turns with a null number come first, ties go by role and text; repeated rows are turns like any other; rows
    with a null conversation form one conversation. An empty table gives no example. A conversation is put together in
    one row, since its last example holds all of it; the number of examples, not of rows, is what grows.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    lead = F.concat(F.lit(OPEN), escaped_role(role), F.lit(SEPARATOR))
    body = escaped(text)
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.concat(lead, body, F.lit(CLOSE)).alias("written"),
        F.length(lead).alias("lead"),
        F.length(body).alias("body"),
    )
    whole = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    ends = F.expr(
        f"filter(sequence(1, size(turns)), i -> turns[i - 1].role = '{TARGET}' or i = size(turns))"
    )
    at = whole.select("conv_id", "turns", F.posexplode(ends).alias("example", "n_turns"))
    formatted = F.array_join(F.expr("transform(slice(turns, 1, n_turns), t -> t.written)"), "")
    last = F.expr("turns[n_turns - 1]")
    before = F.expr("aggregate(slice(turns, 1, n_turns - 1), 0L, (s, t) -> s + length(t.written))")
    loss = F.struct((before + last["lead"]).alias("start"), last["body"].cast("long").alias("length"))
    return at.select("conv_id", "example", "n_turns", formatted.alias("formatted"), F.when(last["role"] == TARGET, loss).alias("loss"))


def read_back(formatted: Column) -> Column:
    """Array of role and text of the turns in a formatted text, unescaped."""
    parts = F.split(F.substring(formatted, 1, F.length(formatted) - len(CLOSE)), CLOSE, -1)

    def turn(part: Column) -> Column:
        role = F.regexp_extract(part, r"(?s)\A### ([^\\:]*+(?:\\.[^\\:]*+)*+): ", 1)
        start = F.length(role) + len(OPEN) + len(SEPARATOR) + 1
        text = F.substring(part, start, F.length(part))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(parts, turn)


def digest(made: DataFrame) -> DataFrame:
    """Per conversation, from the examples alone: its turns, its trainable text and the size of all examples."""
    target = F.substring(F.col("formatted"), (F.col("loss.start") + 1).cast("int"), F.col("loss.length").cast("int"))
    by_example = made.select(
        "conv_id",
        "example",
        "n_turns",
        F.length("formatted").cast("long").alias("chars"),
        F.coalesce(unescaped(target), F.lit("")).alias("target"),
        F.struct("n_turns", "formatted").alias("prefix"),
    )
    by_conv = by_example.groupBy("conv_id").agg(
        F.max("prefix").alias("longest"),
        F.array_sort(F.collect_list(F.struct("example", "target"))).alias("targets"),
        F.sum("chars").alias("formatted_chars"),
    )
    turns = F.transform(read_back(F.col("longest.formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    trained = F.array_join(F.transform("targets", lambda t: t["target"]), "")
    return by_conv.select(
        "conv_id", turns.alias("turns"), trained.alias("trained"), "formatted_chars"
    ).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        "formatted_chars",
    )
