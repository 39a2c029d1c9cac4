"""Conversation prefix trie by fixed-length block hashing.

Every distinct sequence of first turns is a node.  Grouping conversations turn by
turn would shuffle a row for each turn; here they are grouped by blocks of
``BLOCK`` turns first:

1. Turns get their place, and become two 64-bit hashes; texts are not shuffled.
2. ``BLOCK`` turns of one conversation are one row.  The hash of a prefix is the XOR
   of its turns' hashes (place and content), so a block row knows the hash of all
   turns before it and up to its end.
3. Conversations are grouped by the digest up to a block's end.  What comes out, one
   row per distinct block in its context, with its members counted, is a *variant*.
4. Where a parent block has one variant only, nobody diverges within the block and
   its turns are nodes with the variant's members.  Where sibling variants stand side
   by side, their turns (of the variants, not of the conversations) are grouped by
   the prefix up to each turn: that finds the boundaries at which they part.
5. Subtree sums without walking the trie: each node belongs to the variant of its
   smallest member.  A variant adds what it owns from a turn on, inside itself, and
   what its members own in later blocks; both are running sums along one
   conversation's blocks, and a node's sum is the sum over the variants it is in.
   So the rows are linear in the turns, at any depth.

Groups are pre-aggregated (the root holds every conversation).  The digest of the
ids that end at a node has to read them in order: ids are first joined to texts of
at most 4,096 ids, in parallel, and then streamed through one hash per node.

Defined cases: turns stand in order of turn (null first), then role, then a hash of
their text; null role and text count as empty; rows that repeat a turn are turns
of their own; turns with a null conv_id are one conversation, after every other
(its conv_id is null in results, and empty among the ids that end at a node); an
empty table gives an empty result, without a root; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillbook.llm.common import stored

#: Turns of a block.
BLOCK = 8
#: Turn numbers that are sorted together: a conversation of any length is numbered in parts.
SPAN_BITS = 10
#: Ids that end at a node are joined in ranges of 2^12.
ENDS_BITS = 12
#: The query's rule for rebuilt conversations: heads of fewer than HEAD turns from every GROUP-th.
HEAD, GROUP = 4, 20

WORD = r"[^\x20\x09-\x0D]+"
KEY = ["depth", "a", "b"]
SELF = ["k", "m", "a_end", "b_end"]        # a variant


# --- turns ---------------------------------------------------------------------
def numbered(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """(conv, place, x, y, words): place from 1, two hashes of role and text, words of the text."""
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = turns.select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), r.alias("role"),
        F.xxhash64(F.lit(1), r, t).alias("x"), F.xxhash64(F.lit(2), t, r).alias("y"),
        F.regexp_count(t, F.lit(WORD)).cast("long").alias("words"))
    rows = rows.withColumn("span", F.shiftright("turn", SPAN_BITS))
    order = Window.partitionBy("conv", "span").orderBy(F.asc_nulls_first("turn"), "role", "x", "y")
    before = Window.partitionBy("conv").orderBy(F.asc_nulls_first("span")).rowsBetween(
        Window.unboundedPreceding, -1)
    base = rows.groupBy("conv", "span").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("conv").alias("c"), F.col("span").alias("s"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    at = rows.withColumn("row", F.row_number().over(order))
    return at.join(base, at["conv"].eqNullSafe(base["c"]) & at["span"].eqNullSafe(base["s"])).select(
        "conv", (F.col("base") + F.col("row")).alias("place"), "x", "y", "words")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after the heads are exchanged: conversation c gets the first
    h turns of conversation c - c % GROUP in place of its own first h, h = crc32(c) % HEAD.

    ``rows`` are :func:`numbered` turns; conversations are (conv, n), turnless ones too.
    """
    h = F.coalesce(F.crc32(F.col("conv").cast("string")) % HEAD, F.lit(0))
    heads = rows.filter((F.col("conv") % GROUP == 0) & (F.col("place") < HEAD)).groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("place", "x", "y", "words"))).alias("head")).select(
        F.col("conv").alias("source"), "head")
    plan = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("own")).withColumns(
        {"h": h, "source": F.col("conv") - F.col("conv") % GROUP}).join(heads, "source", "left").select(
        "conv", "h", F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h").cast("int")).alias("head"), "own")
    plan = stored(plan.withColumn("taken", F.size("head").cast("long")), "trie-plan")
    p = plan.select(F.col("conv").alias("c"), "h", "taken")
    kept = rows.join(p, rows["conv"].eqNullSafe(p["c"])).filter("place > h").select(
        "conv", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "x", "y", "words")
    taken = plan.select("conv", F.explode("head").alias("t")).select("conv", "t.*")
    convs = plan.select("conv", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))
    return kept.unionByName(taken), convs


# --- blocks ----------------------------------------------------------------------
def blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per block of a conversation: conv, k (block), m (turns), turns (a, b, words of
    each), a_start, b_start, a_end, b_end (hashes of all turns before it, and up to its end),
    last."""
    t = rows.select("conv", F.expr(f"(place - 1) div {block}").alias("k"), "place", "words",
                    F.xxhash64(F.lit(3), "place", "x", "y").alias("a"),
                    F.xxhash64(F.lit(4), "place", "y", "x").alias("b"))
    each = t.groupBy("conv", "k").agg(
        F.count(F.lit(1)).alias("m"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"),
        F.array_sort(F.collect_list(F.struct("place", "a", "b", "words"))).alias("turns"))
    along = Window.partitionBy("conv").orderBy("k")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    return each.select(
        "conv", "k", "m", "turns", F.bit_xor("a").over(so_far).alias("a_end"),
        F.bit_xor("b").over(so_far).alias("b_end"), F.lead("k").over(along).isNull().alias("last"),
        "a", "b").select(
        "conv", "k", "m", "turns", F.col("a_end").bitwiseXOR(F.col("a")).alias("a_start"),
        F.col("b_end").bitwiseXOR(F.col("b")).alias("b_start"), "a_end", "b_end", "last")


def variants(at: DataFrame) -> DataFrame:
    """Distinct blocks in their context, with their members counted and their owner, the
    smallest of these; siblings: whether the parent has other variants."""
    found = stored(at.groupBy(*SELF, "a_start", "b_start").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("owner"),
        F.any_value("turns").alias("turns")), "trie-variants")
    parents = found.groupBy("k", "a_start", "b_start").agg(F.count(F.lit(1)).alias("children")).filter(
        "children > 1").select("k", "a_start", "b_start", F.lit(True).alias("siblings"))
    return found.join(parents, ["k", "a_start", "b_start"], "left").withColumn(
        "siblings", F.coalesce("siblings", F.lit(False)))


def turn_rows(found: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row per turn of each variant, with its prefix (depth, a, b) and its parent's (a, b)."""
    def up_to(start: str, part: str, i: Column) -> Column:
        return F.aggregate(F.slice("turns", F.lit(1), i), F.col(start),
                           lambda acc, t: acc.bitwiseXOR(t[part]))
    steps = F.transform(F.sequence(F.lit(1), F.col("m").cast("int")), lambda i: F.struct(
        i.alias("j"), up_to("a_start", "a", i).alias("a"), up_to("b_start", "b", i).alias("b"),
        F.element_at("turns", i)["a"].alias("a_turn"), F.element_at("turns", i)["b"].alias("b_turn"),
        F.element_at("turns", i)["words"].alias("words")))
    return found.withColumn("s", F.explode(steps)).select(
        *SELF, "n", "owner", "siblings", "s.j", (F.col("k") * block + F.col("s.j")).alias("depth"),
        "s.a", "s.b", F.col("s.a").bitwiseXOR(F.col("s.a_turn")).alias("a_parent"),
        F.col("s.b").bitwiseXOR(F.col("s.b_turn")).alias("b_parent"), "s.words")


def nodes(steps: DataFrame) -> DataFrame:
    """(depth, a, b, a_parent, b_parent, n_convs, conv_id, words) of every node but the root."""
    columns = [*KEY, "a_parent", "b_parent"]
    alone = steps.filter("NOT siblings").select(*columns, F.col("n").alias("n_convs"),
                                                F.col("owner").alias("conv_id"), "words")
    parted = steps.filter("siblings").groupBy(*columns).agg(
        F.sum("n").alias("n_convs"), F.min("owner").alias("conv_id"), F.any_value("words").alias("words"))
    return alone.unionByName(parted)


# --- what a subtree holds ----------------------------------------------------------
def subtree_sums(steps: DataFrame, valued: DataFrame, at: DataFrame) -> DataFrame:
    """(depth, a, b, n_leaves, saved_tokens) summed over each node's subtree; ``valued``
    nodes have their own leaf and saved."""
    mine = F.col("owner").eqNullSafe(F.col("conv_id"))
    own = steps.select(*SELF, "owner", "j", *KEY).join(valued.select(*KEY, "conv_id", "leaf", "saved"), KEY)
    from_turn = Window.partitionBy(*SELF).orderBy(F.desc("j")).rowsBetween(Window.unboundedPreceding, 0)
    inside = stored(own.select(*SELF, "owner", "j", *KEY, *[
        F.sum(F.when(mine, F.col(c)).otherwise(0)).over(from_turn).alias(c) for c in ("leaf", "saved")]),
        "trie-inside")
    # what a conversation owns in the blocks after each of its blocks
    owned = inside.filter("j = 1").select("owner", F.col("k").alias("at"), "leaf", "saved")
    later = Window.partitionBy("conv").orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, -1)
    path = at.select("conv", *SELF).join(
        owned, F.col("conv").eqNullSafe(F.col("owner")) & (F.col("k") == F.col("at")), "left")
    beyond = path.select(*SELF, *[
        F.coalesce(F.sum(F.coalesce(F.col(c), F.lit(0))).over(later), F.lit(0)).alias(f"{c}_later")
        for c in ("leaf", "saved")]).filter("leaf_later != 0 OR saved_later != 0").groupBy(*SELF).agg(
        *[F.sum(f"{c}_later").alias(f"{c}_later") for c in ("leaf", "saved")])
    return inside.join(beyond, SELF, "left").groupBy(*KEY).agg(*[
        F.sum(F.col(c) + F.coalesce(f"{c}_later", F.lit(0))).alias(name)
        for c, name in (("leaf", "n_leaves"), ("saved", "saved_tokens"))])


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per run of equal keys; the runs may go over batches."""
    now, digest = None, None
    for batch in batches:
        done = []
        for *key, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != now:
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = key, sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield _digest_rows(done)
    if now is not None:
        yield _digest_rows([(*now, digest.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]),
                                       pa.array(columns[3], pa.string())], [*KEY, "ends_sha256"])


def ends(rows: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) from the (depth, a, b, conv) at which conversations end."""
    part = rows.withColumn("part", F.shiftright("conv", ENDS_BITS)).groupBy(*KEY, "part").agg(
        F.array_join(F.array_sort(F.collect_list("conv")), ",").alias("ids"))
    return part.repartition(*KEY).sortWithinPartitions(*KEY, F.asc_nulls_last("part")).select(
        *KEY, "ids").mapInArrow(_digest_batches, "depth long, a long, b long, ends_sha256 string")


# --- the trie ------------------------------------------------------------------------
def trie(rows: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    ``rows`` are turns (conv, place, x, y, words) and ``convs`` all conversations (conv, n).
    """
    at = stored(blocks(rows, block), "trie-blocks")
    steps = turn_rows(stored(variants(at), "trie-siblings"), block)
    found = stored(nodes(steps), "trie-nodes")
    top = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id")).filter("n_convs > 0")
    root = top.select(*[F.lit(0).cast("long").alias(c) for c in (*KEY, "a_parent", "b_parent")],
                      "n_convs", "conv_id", F.lit(0).cast("long").alias("words"))
    kids = found.groupBy((F.col("depth") - 1).alias("depth"), F.col("a_parent").alias("a"),
                         F.col("b_parent").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    valued = stored(found.unionByName(root).join(kids, KEY, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)),
        "leaf": F.col("n_children").isNull().cast("long"),
        "saved": (F.col("n_convs") - 1) * F.col("words")}), "trie-valued")
    sums = subtree_sums(steps, valued, at)
    sums = sums.unionByName(valued.agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
                            .select(*[F.lit(0).cast("long").alias(c) for c in KEY], "n_leaves", "saved_tokens"))
    ended = at.filter("last").select((F.col("k") * block + F.col("m")).alias("depth"), F.col("a_end").alias("a"),
                                     F.col("b_end").alias("b"), "conv").unionByName(
        convs.filter("n = 0").select(*[F.lit(0).cast("long").alias(c) for c in KEY], "conv"))
    above = valued.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("a_parent"),
                          F.col("b").alias("b_parent"), F.col("conv_id").alias("parent_conv_id"))
    return valued.join(sums, KEY).join(above, ["depth", "a_parent", "b_parent"], "left").join(
        ends(ended), KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def prefixes(turns: DataFrame, block: int = BLOCK, **columns) -> DataFrame:
    """The trie of conversations as they are."""
    rows = stored(numbered(turns, **columns), "trie-turns")
    return trie(rows, rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), block)


def rebuilt_prefixes(turns: DataFrame, block: int = BLOCK, **columns) -> DataFrame:
    """The trie of the conversations that :func:`rebuilt` makes."""
    rows, convs = rebuilt(stored(numbered(turns, **columns), "trie-turns"))
    return trie(rows, convs, block)
