"""Chat formatting by quotation linking, with DataFrame functions only.

Lines that begin with ``>`` quote an earlier message, one level per ``>``. Neighbouring
quoted lines of one level are a passage. Passages, and each of their lines, are normalised
(lower case, white space to one space) and hashed, and so are the messages' own texts: whole,
by paragraph and by line. The *original* of a passage is the first message of its conversation
that says it; equal keys are reduced to that one turn before the join, so a sentence said a
million times in one conversation is one row there. A message replies to the original of its
outermost passage (whole passages before single lines, earlier lines first).

A message's thread is the message that its chain of replies begins with, found by pointer
jumping. The conversation's order is by thread, then turn: a reply stands after what it
replies to and with the rest of its thread. Positions come from one range sort of all
messages with partition offsets, so a conversation that holds a third of all messages is
spread over many tasks.

Cases: a null text is empty; a message of quotes alone has an empty text; quotes without an
original stay unlinked; rows without a conversation or turn link with nothing and stand in a
thread of their own; repeated rows share links and get positions of their own; an empty table
gives an empty result; other columns are not read. Without quotes the order is by turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.positions import with_row_number
from .common import picked, stored

_QUOTED = r"^[ \t]*>"
_MARKS = r"^[ \t]*(?:>[ \t]?)+"


def _normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _key(text: Column) -> Column:
    return F.md5(_normal(text).cast("binary"))


def own_text(text: Column) -> Column:
    """The text without its quoted lines, and without blank lines at its ends."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: ~x.rlike(_QUOTED))
    return F.regexp_replace(F.array_join(lines, "\n"), r"^\s+|\s+$", "")


def quoted_passages(messages: DataFrame) -> DataFrame:
    """(conv, turn, level, pos, whole, key) of messages (conv, turn, text): every quoted
    passage (whole = 0) and its single lines (whole = 1)."""
    quoting = messages.where(F.col("text").rlike(r"(?m)" + _QUOTED)).distinct().withColumn("name", F.md5(F.col("text").cast("binary")))
    lines = quoting.select("conv", "turn", "name", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    marks = F.regexp_extract("line", _MARKS, 0)
    lines = lines.select("conv", "turn", "name", "pos", F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
                         F.regexp_replace("line", _MARKS, "").alias("body"))
    text = Window.partitionBy("conv", "turn", "name").orderBy("pos")  # one message's lines
    lines = lines.withColumn("new", F.coalesce(F.lag("level").over(text) != F.col("level"), F.lit(True)).cast("int"))
    lines = lines.withColumn("run", F.sum("new").over(text)).where("level > 0")
    runs = lines.groupBy("conv", "turn", "name", "run", "level").agg(F.sort_array(F.collect_list(F.struct("pos", "body"))).alias("l"))
    whole = runs.select("conv", "turn", "level", F.element_at("l", 1)["pos"].alias("pos"), F.lit(0).alias("whole"),
                        F.array_join(F.transform("l", lambda x: x["body"]), "\n").alias("body"))
    single = lines.select("conv", "turn", "level", "pos", F.lit(1).alias("whole"), "body")
    every = whole.unionByName(single).where(_normal(F.col("body")) != "")
    return every.select("conv", "turn", "level", "pos", "whole", _key(F.col("body")).alias("key"))


def originals(messages: DataFrame) -> DataFrame:
    """(conv, key, said): the first turn of each conversation that says a text, paragraph or
    line as its own."""
    own = messages.select("conv", "turn", own_text(F.col("text")).alias("own"))
    units = F.array_distinct(F.concat(F.array("own"), F.split("own", r"\n\s*\n"), F.split("own", "\n")))
    said = own.select("conv", "turn", F.explode(units).alias("unit")).where(_normal(F.col("unit")) != "")
    return said.groupBy("conv", _key(F.col("unit")).alias("key")).agg(F.min("turn").alias("said"))


def replies(messages: DataFrame) -> DataFrame:
    """(conv, turn, reply_to, quotes, linked): per quoting message its link and counts."""
    found = quoted_passages(messages).join(originals(messages), ["conv", "key"], "left")
    found = found.withColumn("said", F.when(F.col("said") < F.col("turn"), F.col("said")))
    best = F.min(F.when(F.col("said").isNotNull(), F.struct("level", "whole", "pos", "said")))
    passages = F.count_if(F.col("whole") == 0)
    linked = F.count_if((F.col("whole") == 0) & F.col("said").isNotNull())
    return found.groupBy("conv", "turn").agg(best["said"].alias("reply_to"), passages.alias("quotes"), linked.alias("linked"))


def threads(links: DataFrame) -> DataFrame:
    """(conv, turn, thread, depth) of the messages that reply to another."""
    state = stored(links.where("reply_to is not null").select("conv", "turn", F.col("reply_to").alias("thread"), F.lit(1).alias("depth")), "chat-links")
    while True:
        up = state.select("conv", F.col("turn").alias("thread"), F.col("thread").alias("above"), F.col("depth").alias("more"))
        met = state.join(up, ["conv", "thread"], "left")
        state = stored(met.select("conv", "turn", F.coalesce("above", "thread").alias("thread"),
                                  (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                                  F.col("above").isNotNull().alias("moved")), "chat-threads")
        if not state.where("moved").limit(1).count():
            return state.drop("moved")
        state = state.drop("moved")


def format_conversations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, position, turn, role, reply_to, thread, depth, n_quotes, n_linked, text,
    formatted) per message; positions count from 0 in each conversation."""
    rows = picked(messages, conv_col, turn_col, role_col, text_col)
    rows = rows.select(F.col("c0").alias("conv"), F.col("c1").cast("bigint").alias("turn"), F.col("c2").alias("role"), F.col("c3").alias("text"))
    told = rows.where("conv is not null and turn is not null").select("conv", "turn", "text")
    links = stored(replies(told), "chat-replies")
    tree = threads(links)
    shaped = rows.join(links, ["conv", "turn"], "left").join(tree, ["conv", "turn"], "left")
    shaped = shaped.select(
        "conv", "turn", "role", "reply_to", F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).alias("depth"),
        F.coalesce("quotes", F.lit(0)).cast("bigint").alias("n_quotes"), F.coalesce("linked", F.lit(0)).cast("bigint").alias("n_linked"), own_text(F.col("text")).alias("text"))
    numbered = with_row_number(shaped, "n", order_by=["conv", "thread", "turn", "role", "text"])
    first = numbered.groupBy("conv").agg(F.min("n").alias("first"))
    numbered = numbered.join(first.withColumnRenamed("conv", "of"), F.col("conv").eqNullSafe(F.col("of")))
    formatted = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>\n"))
    return numbered.select(F.col("conv").alias("conv_id"), (F.col("n") - F.col("first")).alias("position"), "turn", "role", "reply_to", "thread",
                           F.col("depth").cast("bigint").alias("depth"), "n_quotes", "n_linked", "text", formatted.alias("formatted"))
