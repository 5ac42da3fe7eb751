"""Chat formatting with a grammar round trip.

A turn is ``<s>role[INST]text[/INST]</s>``; ``<s|e>`` opens a turn whose role and text are escaped. A conversation is
first rendered as it is, reparsed and compared to the source. Where that fails, turns that hold a control string are
escaped, then all turns, until the parsed turns are identical.

Defined cases: null role or text is empty; null conv_id is one conversation; turns sort by turn (null first), then role
and text; repeated rows are turns of their own; an empty table gives an empty result; other columns are ignored.
A conversation is one row, since its digest and its formatted text are one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = r"<s>|<s\|e>|\[INST\]|\[/INST\]|</s>"
TURN = r"(?s)<s(?:\|e)?>.*?\[INST\].*?\[/INST\]</s>"
PARTS = r"(?s)^<s(\|e)?>(.*?)\[INST\](.*)\[/INST\]</s>$"


def escape(text: Column) -> Column:
    """Leaves no ``<`` or ``[``, so no control string can stand in the result."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\b"))


def unescape(text: Column) -> Column:
    """Reverses ``escape``: pieces between escaped backslashes are turned back on their own."""
    pieces = F.split(text, r"\\\\")
    plain = F.transform(
        pieces, lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("["))
    )
    return F.array_join(plain, "\\")


def render(turns: Column, level: int) -> Column:
    def one(t: Column) -> Column:
        role, text = t["role"], t["text"]
        plain = F.concat(F.lit("<s>"), role, F.lit("[INST]"), text, F.lit("[/INST]</s>"))
        safe = F.concat(F.lit("<s|e>"), escape(role), F.lit("[INST]"), escape(text), F.lit("[/INST]</s>"))
        if level == 0:
            return plain
        if level == 2:
            return safe
        return F.when(F.concat(role, F.lit("\n"), text).rlike(CONTROL), safe).otherwise(plain)

    return F.array_join(F.transform(turns, one), "")


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation; null where it breaks the grammar."""

    def one(turn: Column) -> Column:
        escaped = F.regexp_extract(turn, PARTS, 1) != ""
        role, text = F.regexp_extract(turn, PARTS, 2), F.regexp_extract(turn, PARTS, 3)
        return F.struct(
            F.when(escaped, unescape(role)).otherwise(role).alias("role"),
            F.when(escaped, unescape(text)).otherwise(text).alias("text"),
            (role.rlike(CONTROL) | text.rlike(CONTROL)).alias("broken"),
        )

    turns = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))
    whole = F.length(F.array_join(turns, "")) == F.length(formatted)
    read = F.transform(turns, one)
    sound = whole & ~F.exists(read, lambda t: t["broken"])
    return F.when(sound, F.transform(read, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, level (0 as it is, 1 conflicts escaped, 2 all escaped), turns as parsed from ``formatted``,
    and mask: runs of code points with their loss flag, which cover ``formatted`` from left to right."""
    turn = F.struct(
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    source = (
        conversations.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(turn)).alias("_rows"))
        .select(
            "conv_id",
            F.transform("_rows", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("_source"),
        )
    )
    level = F.lit(2)
    for tried in (1, 0):
        back = parse(render(F.col("_source"), tried))
        level = F.when(back.eqNullSafe(F.col("_source")), tried).otherwise(level)
    out = source.withColumn("level", level).withColumn(
        "formatted",
        F.when(F.col("level") == 0, render(F.col("_source"), 0))
        .when(F.col("level") == 1, render(F.col("_source"), 1))
        .otherwise(render(F.col("_source"), 2)),
    )
    formatted = F.col("formatted")
    return out.select("conv_id", formatted, "level", parse(formatted).alias("turns"), loss_mask(formatted).alias("mask"))


def loss_mask(formatted: Column) -> Column:
    """Runs (chars, loss): in each turn the opening, the text (loss where the role is assistant) and the closing."""

    def runs(turn: Column) -> Column:
        text = F.length(F.regexp_extract(turn, PARTS, 3))
        close = F.lit(len("[/INST]</s>"))
        run = lambda n, loss: F.struct(n.alias("chars"), loss.alias("loss"))
        return F.array(
            run(F.length(turn) - text - close, F.lit(False)),
            run(text, F.regexp_extract(turn, PARTS, 2) == "assistant"),
            run(close, F.lit(False)),
        )

    return F.flatten(F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), runs))


def under_loss(turns: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
