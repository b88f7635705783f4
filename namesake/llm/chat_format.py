"""Chat formatting in Spark expressions only.

A conversation's turn structs are collected and sorted, adjacent turns of one role are merged into a block by array
aggregation over the sorted structs, and array functions concatenate the pieces:

    <turn|ROLE>text<sep>text of the next turn of the same role</turn>\n

Texts and roles are escaped, reversibly, so that no `<` of theirs is left: \\ becomes \\b and < becomes \\l (in roles
also > becomes \\g).  The loss mask is a list of spans over the formatted text: the texts of the trained role, without
markers.

Cases: null text or role is empty; turns of equal number are ordered by role and text, null numbers first; rows that
repeat a turn are turns of their own; an empty table gives none; a null conv_id is a conversation; further columns are
ignored; a conversation and its formatted text must each fit one row; formatting takes near linear
time in a conversation's length, and reading looks for each masked span from the start of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namesake.llm.common import let, running_sums

END = "</turn>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def format_chats(df: DataFrame, trained: str = "assistant", conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, formatted, loss (array of start from 1, length, in code points): one row for each conversation."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(""))
    turn = F.struct(F.col(f"`{turn_col}`").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    chats = df.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), turn.alias("one")).groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("turns"))
    chats = chats.select("conv_id", "turns", merged("turns").alias("blocks"))
    head = lambda b, nth: F.concat(F.when(nth > 0, F.lit(END)).otherwise(""), F.lit("<turn|"), F.replace(escaped(b["role"]), F.lit(">"), F.lit("\\g")), F.lit(">"))
    piece = lambda b, nth, t, i: F.struct(F.when(i == 0, head(b, nth)).otherwise("<sep>").alias("mark"), escaped(t).alias("body"), (b["role"] == trained).alias("masked"))
    pieces = F.transform("blocks", lambda b, nth: F.transform(b["texts"], lambda t, i: piece(b, nth, t, i)))
    chats = chats.select("conv_id", F.flatten(pieces).alias("pieces"))
    sizes = F.transform("pieces", lambda p: (F.length(p["mark"]) + F.length(p["body"])).cast("long"))
    chats = chats.withColumn("sizes", sizes).withColumn("before", running_sums(F.col("sizes")))
    formatted = F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["mark"], p["body"])), ""), F.lit(END))
    spans = F.transform("pieces", lambda p, i: F.when(p["masked"], F.struct((F.get("before", i) + F.length(p["mark"]) + 1).alias("start"), F.length(p["body"]).cast("long").alias("length"))))
    return chats.select("conv_id", formatted.alias("formatted"), F.filter(spans, lambda s: s.isNotNull()).alias("loss"))


def merged(turns: str) -> Column:
    """Blocks (role, texts) of adjacent turns of one role, from sorted turn structs: each from where the role changes to
    the next such place."""
    role = lambda i: F.get(turns, i)["role"]
    heads = F.filter(F.sequence(F.lit(0), F.size(turns) - 1), lambda i: (i == 0) | (role(i) != role(i - 1)))

    def blocks(found: Column) -> Column:
        until = lambda k: F.coalesce(F.get(found, k + 1), F.size(turns))
        texts = lambda i, k: F.transform(F.slice(turns, i + 1, until(k) - i), lambda t: t["text"])
        return F.transform(found, lambda i, k: F.struct(role(i).alias("role"), texts(i, k).alias("texts")))

    return let(heads, blocks)


def read_chats(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text), loss_text (what the spans of the mask cover, unescaped), formatted_chars.

    No text holds a "<", so "</turn>\\n" ends a block and every other "<" starts a head or a separator.
    """
    blocks = F.filter(F.split("formatted", "</turn>\n", -1), lambda b: b != "")

    def role(block: Column) -> Column:
        written = F.regexp_extract(block, r"^<turn\|([^>]*)>", 1)
        return unescaped(F.replace(F.replace(written, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")))

    def of_block(block: Column) -> Column:
        pieces = F.filter(F.split(block, "<", -1), lambda p: p != "")
        return F.transform(pieces, lambda p: F.struct(role(block).alias("role"), unescaped(F.regexp_replace(p, r"^(?:turn\|[^>]*|sep)>", "")).alias("text")))

    turns = F.flatten(F.transform(blocks, of_block))
    masked = F.transform("loss", lambda s: F.substring(F.col("formatted"), s["start"].cast("int"), s["length"].cast("int")))
    return formatted.select("conv_id", turns.alias("turns"), unescaped(F.array_join(masked, "")).alias("loss_text"), F.length("formatted").cast("long").alias("formatted_chars"))
