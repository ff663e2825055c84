"""Chat formatting with a grammar round trip.

A turn reads ``<|im_start|>role``, a line feed, its text, ``<|im_end|>``, a line feed. A deterministic parser
reads rendered turns back; a turn whose text or role doesn't come back as it was is escaped and
read again, until it does. Escaping puts one backslash into every run ``<``, backslashes, ``|``; reading
takes one out, so control strings never occur inside a text and nothing else changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """As a text, and without line feeds: backslash and line feed become two characters each."""
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # An even run of backslashes halves; an odd one before n ends in a line feed.
    parts = F.split(role, r"\\\\", -1)
    return unescape(F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\"))


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parse(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation; null where the grammar doesn't fit.

    The start string opens a turn, the first line feed ends its role, the first end string its text, and only
    a line feed may follow.
    """
    pieces = F.split(formatted, r"<\|im_start\|>", -1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(role) + 2, F.length(piece))
        text = F.substring_index(body, END, 1)
        fits = piece == F.concat(role, F.lit("\n"), text, F.lit(END + "\n"))
        return F.when(fits, F.struct(unescape_role(role).alias("role"), unescape(text).alias("text")))

    turns = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))), turn)
    # A slice may not be longer than what is left, so its length is no matter.
    whole = (F.element_at(pieces, 1) == "") & ~F.exists(turns, lambda t: t.isNull())
    return F.when(whole, turns)


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text; other columns are ignored).

    Returns conv_id, formatted, loss_spans (start, length; code points from 1; one for each assistant turn), n_turns,
    escaped_turns. Turns go by number, null last, ties by role and text; repeated rows are turns of their own.
    Null role or text: empty. The null conv_id is a conversation. An empty table gives no rows.
    A conversation's turns meet in one row, since its formatted text is one value; it needs that much memory.
    The read-back of each formatted conversation is compared to its source; a difference raises an error.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # Round 1: as it is. Round 2: text escaped. Round 3: role too.
    forms = [(F.col("role"), F.col("text")), (F.col("role"), escape(F.col("text"))), (escape_role(F.col("role")), escape(F.col("text")))]
    source = F.array(F.struct("role", "text"))
    choice = F.lit(None).cast("int")
    for level in (1, 0):
        choice = F.when(parse(render(*forms[level])).eqNullSafe(source), F.lit(level)).otherwise(choice)
    rows = rows.withColumn("level", F.coalesce(choice, F.lit(2)))
    pick = [F.when(F.col("level") == 0, a).when(F.col("level") == 1, b).otherwise(c) for a, b, c in zip(*forms)]
    rows = rows.withColumns({"shown_role": pick[0], "shown_text": pick[1]})
    order = [F.col("turn").asc_nulls_last(), F.col("role"), F.col("text")]
    up_to = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("segment", render(F.col("shown_role"), F.col("shown_text"))).withColumns({
        "at": F.coalesce(F.sum(F.length("segment").cast("bigint")).over(up_to), F.lit(0)),
        "nth": F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)),
    })
    start = F.col("at") + F.length("shown_role") + len(START) + 2
    rows = rows.withColumn("span", F.when(F.col("role") == LOSS_ROLE, F.struct(start.alias("start"), F.length("shown_text").cast("bigint").alias("length"))))
    # nth comes first and is unique within a conversation, so sorting never reaches the rest.
    whole = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("nth", "segment", "span", "role", "text", "level"))).alias("turns"))
    whole = whole.select("conv_id", "turns", F.array_join("turns.segment", "").alias("formatted"))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    same = parse(F.col("formatted")).eqNullSafe(source)
    checked = F.when(same, F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation doesn't read back as it was")).cast("string"))
    return whole.select(
        "conv_id", checked.alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.size(F.filter("turns", lambda t: t["level"] > 0)).cast("bigint").alias("escaped_turns"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted text says: turns by the parser, text under the loss mask by its spans."""
    turns = parse(F.col("formatted"))
    under = F.transform("loss_spans", lambda s: F.substring(F.col("formatted"), s["start"].cast("int"), s["length"].cast("int")))
    read = formatted.select("conv_id", "formatted", "escaped_turns", turns.alias("turns"), F.array_join(F.transform(under, unescape), "").alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"), "escaped_turns",
    )
