"""Chat formatting with a grammar round trip, in DataFrame functions alone.

A turn is rendered as ``### role: text</turn>\\n``. Control strings inside roles and texts are escaped, so that no
text can open or end a turn. A deterministic parser cuts the rendered text at each ``</turn>\\n``, takes what follows
``### `` up to the first ``: `` as the role, and undoes the escapes. What it gives back is held against the turn; a turn
that isn't identical raises an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arkspark.llm.common import only

HEAD, SEP, END = "### ", ": ", "</turn>\n"
#: Control string and its escape, in the order of escaping; undone in reverse.
ESCAPES = (("\\", "\\0"), ("</turn>", "\\1"), ("###", "\\2"), (":", "\\3"))
TEXT_ESCAPES, ROLE_ESCAPES = ESCAPES[:3], ESCAPES
LOSS_ROLE = "assistant"


def escape(text: Column, escapes=TEXT_ESCAPES) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, escapes=TEXT_ESCAPES) -> Column:
    for plain, code in reversed(escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), role, F.lit(SEP), text, F.lit(END))


def parse_turns(formatted: Column) -> Column:
    """Of a whole formatted conversation: array of (role, text)."""
    pieces = F.filter(F.split(formatted, F.lit("</turn>\\n"), -1), lambda x: x != "")

    def turn(x: Column) -> Column:
        body = F.substring(x, F.lit(len(HEAD) + 1), F.length(x))
        at = F.locate(SEP, body)
        return F.struct(unescape(F.substring(body, F.lit(1), at - 1), ROLE_ESCAPES).alias("role"), unescape(F.substring(body, at + len(SEP), F.length(body))).alias("text"))

    return F.transform(pieces, turn)


def _round_trip(role: Column, text: Column, to_role: Column, to_text: Column) -> Column:
    """Whether the parser gives exactly this one turn back from its rendering."""
    back = parse_turns(render_turn(to_role, to_text))
    return (F.size(back) == 1) & (F.element_at(back, 1)["role"] == role) & (F.element_at(back, 1)["text"] == text)


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, formatted, loss_spans, roundtrip) from (conv_id, turn, role, text); other columns are ignored.

    loss_spans holds (start, length), in code points from 0, of the assistant texts inside ``formatted``; roundtrip
    says that the whole text, parsed again, gives the turns back. ``###``, ``</turn>`` and ``\\`` never stand in
    ``formatted`` as part of a text: they are escaped. Rows are ordered by turn, ties by role and text,
    null turns first; repeated rows are turns of their own. A null role or text is empty. A null conv_id is a
    conversation as any other. Empty texts give turns without text; an empty table gives no rows. A conversation is
    one output value, so that its turns must fit into one row.
    """
    df = only(conversations, conv_id="long", turn="long", role="string", text="string").withColumn("role", F.coalesce("role", F.lit(""))).withColumn("text", F.coalesce("text", F.lit("")))
    role, text = F.col("role"), F.col("text")
    df = df.withColumns({"to_role": escape(role, ROLE_ESCAPES), "to_text": escape(text)})
    to_role, to_text = F.col("to_role"), F.col("to_text")
    checked = F.when(_round_trip(role, text, to_role, to_text), render_turn(to_role, to_text)).otherwise(F.raise_error(F.lit("a turn doesn't survive the round trip")))
    df = df.select("conv_id", "turn", "role", "text", F.length("to_text").alias("text_length"), (F.length(to_role) + len(HEAD) + len(SEP)).alias("head_length"), checked.alias("piece"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    df = df.withColumn("ord", F.row_number().over(order)).withColumn("end", F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    span = F.when(role == LOSS_ROLE, F.struct((F.col("end") - len(END) - F.col("text_length")).alias("start"), F.col("text_length").cast("long").alias("length")))
    rows = df.select("conv_id", F.struct("ord", "role", "text", "piece", span.alias("span")).alias("r"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("r")).alias("r"))
    out = grouped.select(
        "conv_id",
        F.size("r").cast("long").alias("n_turns"),
        F.array_join(F.transform("r", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(F.filter("r", lambda x: x["span"].isNotNull()), lambda x: x["span"]).alias("loss_spans"),
        F.transform("r", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"),
    )
    return out.withColumn("roundtrip", parse_turns(F.col("formatted")) == F.col("turns")).drop("turns")


def chat_digest(formatted: DataFrame) -> DataFrame:
    """The digest columns, all read back from ``formatted`` and its loss spans."""
    turns = parse_turns(F.col("formatted"))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    df = formatted.select("conv_id", F.col("formatted"), turns.alias("turns"), loss.alias("loss"), "roundtrip")
    return df.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "roundtrip",
    )
