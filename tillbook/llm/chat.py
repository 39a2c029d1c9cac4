"""Chat formatting with cumulative-snapshot collapse.

A logged conversation is often a snapshot of one that went on: its turns are the
first turns of a longer one.  Turns are numbered within their conversation; each
turn has the rolling hash of the turns up to it (two 64-bit hashes of place,
role and text, summed without overflow along the conversation).  A conversation
whose full hash equals the hash of a proper prefix of another one falls to an
anti-join; of equal conversations the one with the smallest conv_id stays.  What
is left, the maximal conversations, is rendered in a chat markup.

DataFrame operations only.  The numbered turns are written once.  Prefix hashes are reduced to distinct ones before
the anti-join, so a first turn that a third of all conversations share is one
row; the turns of one conversation come together only to be rendered.

Defined cases: turns stand in order of turn (null first), role and text; null
roles and texts differ from empty ones in comparisons and are rendered as empty;
rows that repeat a turn are turns of their own; a null conv_id is one
conversation, after every other; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillbook.llm.common import stored

#: Around each turn: start, role, line end, text, end.
START, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>\n"


def numbered(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """(conv, place, n_turns, role, text, a, b): place from 1, rolling hashes a and b; conv
    is (null or not, conv_id)."""
    t = turns.select(F.struct(F.col(conv_id).cast("long").isNull().alias("none"),
                              F.col(conv_id).cast("long").alias("id")).alias("conv"),
                     F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"),
                     F.col(text).cast("string").alias("text"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    t = t.withColumn("place", F.row_number().over(order))
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)

    def rolled(seed: int) -> Column:
        each = F.xxhash64(F.lit(seed), "place", F.col("role").isNull(), "role", F.col("text").isNull(), "text")
        return F.sum(each.cast("decimal(20,0)")).over(so_far)
    every = F.count(F.lit(1)).over(Window.partitionBy("conv"))
    return t.select("conv", "place", every.alias("n_turns"), "role", "text", rolled(1).alias("a"), rolled(2).alias("b"))


def maximal(turns: DataFrame) -> DataFrame:
    """(conv, n_turns, copies) of conversations that no longer one begins with, from
    :func:`numbered` turns; copies counts the equal ones."""
    whole = turns.filter("place = n_turns")
    one = whole.groupBy("place", "a", "b").agg(F.min("conv").alias("conv"),
                                               F.count(F.lit(1)).alias("copies"))
    prefixes = turns.filter("place < n_turns").select("place", "a", "b").distinct()
    return one.join(prefixes, ["place", "a", "b"], "left_anti").select(
        "conv", F.col("place").alias("n_turns"), "copies")


def rendered(turns: DataFrame) -> Column:
    """The chat markup of a conversation, as an aggregate over its numbered turns."""
    part = F.concat(F.lit(START), F.coalesce("role", F.lit("")), F.lit(MIDDLE),
                    F.coalesce("text", F.lit("")), F.lit(END))
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", part.alias("s")))),
                                    lambda x: x["s"]), "")


def conversations(turns: DataFrame, **columns) -> DataFrame:
    """One row per maximal conversation: conv_id, n_turns, copies, chat."""
    t = stored(numbered(turns, **columns), "numbered-turns")     # read by three branches below
    keep = maximal(t)
    chats = t.select("conv", "place", "role", "text").join(keep, "conv").groupBy("conv").agg(
        F.max("n_turns").alias("n_turns"), F.max("copies").alias("copies"), rendered(t).alias("chat"))
    return chats.select(F.col("conv.id").alias("conv_id"), F.col("n_turns").cast("long").alias("n_turns"),
                        F.col("copies").cast("long").alias("copies"), "chat")
