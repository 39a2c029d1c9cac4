"""MinHash near-dedup with SetSketch registers.

1. **Sets.** A document's set is its distinct word shingles, as 64-bit hashes;
   a 128-bit hash of the sorted set tells equal sets, which become one class.
2. **Registers.** Each element is a Poisson process of points at random
   registers; a register's least point over a set is an exponential minimum, kept
   as ``floor(1 - log_b(minimum / a))``, truncated to 8 bits.  Registers of a
   union are the maxima of registers, and two sets agree in one with about their
   Jaccard similarity.  Few points are ever made: an element stops where all
   registers of its document are filled.
3. **Bands** of 5 registers put classes into buckets.  A pair at 0.8 shares
   none of the 45 with probability 2e-8.
4. **Links, without all pairs of a bucket.**  Each bucket's pivot, its member
   that shares most buckets (the middle of a group of near copies), is compared with
   the others.  A bucket whose other members now stand in one component is
   done: no further link could change the components.  In the rest only
   members of different components can matter: in buckets of up to ``FEW``
   members these pairs are compared too, and larger buckets are cut by set size and
   into blocks of bounded bytes, and a pair is compared in the first band it shares.
   Each pair of blocks is a task of its own: by their
   registers first, and with the sets of those members that have likely partners it
   returns a spanning forest of the links.
5. A compared pair is first judged by the likelihood of its registers, jointly
   with both set sizes: it goes on unless similarity 0.8 is e^20 times less likely than
   the best one.  What is left is **verified** on the full sets.
6. Components of the links give the groups.

Defined cases: a null or empty text, or one without words, has the empty set
(no shingles), linked with nothing, not even with its like; a text with fewer words than a
shingle has its whole word sequence as its one shingle; a null doc_id stands after every
other; repeated rows are repeated in the result; ties of pivots go to the smaller row number;
an empty table gives an empty result; other columns, whatever their names, are not read
(:func:`keep_one` hands them on).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import (distinct, slices, spans_to_array, stored, text_buffer,
                                 word_spans)
from tillbook.llm.components import components

WORDS, SIMILARITY = 2, 80                  # words of a shingle, per cent
REGISTERS, ROWS, BANDS = 256, 5, 45        # of a sketch (a power of two), of a band, and bands
#: Base, rate and largest value of the registers.
BASE, RATE, TOP = 1.11, 20.0, 2**8 - 1
#: How much less likely (as a logarithm) the wanted similarity may be than the best one.
SLACK = 20.0
#: Members of a bucket whose pairs across components are compared one by one.
FEW = 16
#: Bytes of sets and registers that a block holds.
BLOCK_BYTES = 8 << 20
#: Pairs of a block that are judged at once.
PAIRS = 8192
#: Points of an element process that are made at once.
POINTS = 1 << 17

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(z: np.ndarray) -> np.ndarray:
    """The finisher of splitmix64 (fixed constants), in place of a fresh random number."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


GAMMA = np.uint64(0x9E3779B97F4A7C15)      # the increment of splitmix64


# --- sets ------------------------------------------------------------------------
def shingle_sets(column: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    data, off = text_buffer(column)
    data = _LOWER[data]
    starts, ends, bounds = word_spans(data, off)
    codes, known = distinct(spans_to_array(data, starts, ends))
    word = np.array([xxhash.xxh64_intdigest(w) for w in known.to_pylist()], np.uint64)[codes]
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        k = min(words, b - a)
        if not k:
            out.append(np.zeros(0, np.uint64))
            continue
        h = np.full(b - a - k + 1, k, np.uint64)        # the number of words tells shorter ones apart
        for i in range(k):
            h = mix(h * GAMMA + word[a + i:b - k + 1 + i])
        out.append(np.unique(h))
    return out


# --- registers ---------------------------------------------------------------------
def minima(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """(sets, registers) least points of the elements of each (non-empty) set."""
    sizes = np.array([len(s) for s in sets])
    least = np.full(len(sets) * registers, np.inf)
    seed, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    until = (math.log(registers) + 3) / sizes           # few sets have a register without a point by then
    time, made = np.zeros(len(seed)), np.zeros(len(seed), np.uint64)

    def advance(part: np.ndarray, steps: int) -> np.ndarray:
        """Make the next points of these elements; those that have more before ``until``."""
        number = made[part, None] + np.arange(1, steps + 1, dtype=np.uint64)
        draw = mix(seed[part, None] + number * GAMMA)
        at = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        at = np.cumsum(-np.log(at) / registers, axis=1) + time[part, None]
        here = doc[part]
        ok = at < until[here, None]
        to = (here * registers)[:, None] + (draw & np.uint64(registers - 1)).astype(np.int64)
        np.minimum.at(least, to[ok], at[ok])
        count = ok.sum(axis=1)
        made[part] += count.astype(np.uint64)
        some = count > 0
        time[part[some]] = at[some, count[some] - 1]
        return part[count == steps]

    todo = np.arange(len(seed))
    while len(todo):
        while len(todo):
            left = np.log2(np.maximum((until[doc[todo]] - time[todo]) * registers, 1))
            size, more = np.minimum(np.ceil(left).astype(np.int64) + 1, 10), []
            for e in np.unique(size).tolist():
                group, rows = todo[size == e], max(1, POINTS >> e)
                more += [advance(group[i:i + rows], 1 << e) for i in range(0, len(group), rows)]
            todo = np.concatenate(more)
        short = np.isinf(least.reshape(len(sets), registers)).any(axis=1)
        until[short] *= 1.5
        todo = np.flatnonzero(short[doc])
    return least.reshape(len(sets), registers)


def registers_of(least: np.ndarray) -> np.ndarray:
    """Exponentially spaced, truncated registers of the minima."""
    return np.clip(np.floor(1 - np.log(least / RATE) / math.log(BASE)), 0, TOP).astype(np.uint8)


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    return registers_of(minima(sets)) if sets else np.zeros((0, REGISTERS), np.uint8)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """(sketches, BANDS) hash of each band's number and registers."""
    parts = regs[:, :BANDS * ROWS].astype(np.uint64).reshape(len(regs), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(regs), BANDS))
    for i in range(ROWS):
        key = mix(key * GAMMA + parts[:, :, i])
    return key.view(np.int64)


def likely(ku: np.ndarray, kv: np.ndarray, nu: np.ndarray, nv: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of registers and set sizes may have the similarity, by the joint
    likelihood of the registers that are greater, less and equal."""
    # with a quarter of the registers fewer equal than the similarity says, the similarity
    # is more than e^40 times less likely than the best one
    maybe = np.flatnonzero(100 * (ku == kv).sum(axis=1) >= (percent - 25) * ku.shape[1])
    out = np.zeros(len(ku), bool)
    out[maybe] = _joint(ku[maybe], kv[maybe], nu[maybe], nv[maybe], percent)
    return out


def _joint(ku: np.ndarray, kv: np.ndarray, nu: np.ndarray, nv: np.ndarray, percent: int) -> np.ndarray:
    plus, minus = (ku > kv).sum(axis=1), (ku < kv).sum(axis=1)
    same = ku.shape[1] - plus - minus
    u = nu / (nu + nv)
    v = 1 - u
    top = np.minimum(u / v, v / u)

    def chance(x):                                      # that the side with x of the union is ahead
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    def log_of(count, p):
        with np.errstate(divide="ignore"):
            return np.where(count > 0, count * np.log(np.where(count > 0, p, 1)), 0)

    def log_likelihood(j):
        p, q = chance(u - v * j), chance(v - u * j)
        return log_of(plus, p) + log_of(minus, q) + log_of(same, np.maximum(1 - p - q, 1e-300))
    low, high = np.zeros(len(u)), top.copy()
    for _ in range(40):                                 # concave in j: narrow in on the best
        a, b = low + (high - low) / 3, high - (high - low) / 3
        up = log_likelihood(a) < log_likelihood(b)
        low, high = np.where(up, a, low), np.where(up, high, b)
    best, wanted = (low + high) / 2, np.minimum(percent / 100, top)
    return (best >= wanted) | (log_likelihood(wanted) >= log_likelihood(best) - SLACK)


def near(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact check on two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


# --- tasks -------------------------------------------------------------------------
def _sketch_batches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        for batch in slices(batches):
            sets = shingle_sets(batch.column("text"), words)
            n = np.array([len(s) for s in sets], np.int64)
            regs = sketch([s for s in sets if len(s)])
            filled = iter(regs)
            raw = [s.astype("<u8").tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row, row + len(sets)), pa.int64()), batch.column("doc_id"),
                batch.column("xx"), pa.array(n, pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s) if s else None for s in raw], pa.binary()),
                pa.array([next(filled).tobytes() if s else None for s in raw], pa.binary()),
                pa.array(raw, pa.binary())],
                ["row", "doc_id", "xx", "n", "digest", "regs", "shingles"])
            row += len(sets)
    return run


SKETCHES = "row long, doc_id long, xx long, n long, digest binary, regs binary, shingles binary"


def sketches(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS) -> DataFrame:
    """A row per document: row (a number of its own), doc_id, xx (hash of the text), n (set
    size), digest of the set, regs and shingles; the last three empty without words."""
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                    F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("xx"),
                    F.col(text).cast("string").alias("text"))
    return d.mapInArrow(_sketch_batches(words), SKETCHES)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, REGISTERS)


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "regs"):
        keys = band_keys(_matrix(batch.column("regs")))
        off = np.arange(0, keys.size + 1, BANDS, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("n"),
             pa.ListArray.from_arrays(pa.array(off), pa.array(keys.ravel()))], ["node", "n", "keys"])


def _likely_batches(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "cu"):
            sizes = [batch.column(c).to_numpy().astype(np.float64) for c in ("nu", "nv")]
            ok = likely(_matrix(batch.column("cu")), _matrix(batch.column("cv")), *sizes, percent)
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(ok))
    return run


def _near_batches(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "cu"):
            pairs = zip(batch.column("cu").to_pylist(), batch.column("cv").to_pylist(), strict=True)
            ok = [near(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), percent) for a, b in pairs]
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(
                pa.array(ok, pa.bool_()))
    return run


def _candidates(members: pd.DataFrame, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (x, y) of likely pairs between members of two blocks (of one block, between
    its own) that stand in different components, some at a time."""
    n, group = members["n"].to_numpy().astype(np.float64), members["component"].to_numpy()
    regs = np.frombuffer(b"".join(members["regs"]), np.uint8).reshape(-1, REGISTERS)
    mine, cross = members["part"].to_numpy(), members["i"].iloc[0] != members["j"].iloc[0]
    lower = members["class"].to_numpy() < members["band"].to_numpy()      # these met in their own class
    band = int(members["t"].iloc[0])
    pairs, waiting = [], 0
    for x in range(len(n)):
        y = np.flatnonzero(group[x + 1:] != group[x]) + x + 1
        if cross:
            y = y[mine[y] != mine[x]]
        y = y[(100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x])) & ~(lower[x] & lower[y])]
        pairs.append((np.full(len(y), x), y))
        waiting += len(y)
        if waiting >= PAIRS or x == len(n) - 1:
            u, v = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
            # a pair that shares an earlier band was compared there, or needs no comparison
            early = (regs[u, :ROWS * band] == regs[v, :ROWS * band]).reshape(len(u), band, ROWS).all(axis=2).any(axis=1)
            u, v = u[~early], v[~early]
            ok = likely(regs[u], regs[v], n[u], n[v], percent)
            yield u[ok], v[ok]
            pairs, waiting = [], 0


def _block_members(percent: int):
    def run(members: pd.DataFrame) -> pd.DataFrame:
        """The members that have a likely partner."""
        some = np.zeros(len(members), bool)
        for u, v in _candidates(members, percent):
            some[u] = some[v] = True
        return members[some]
    return run


def _block_links(percent: int):
    def run(members: pd.DataFrame) -> pd.DataFrame:
        """A spanning forest of the links."""
        node, sets = members["node"].to_numpy(), [np.frombuffer(s, "<u8") for s in members["shingles"]]
        _, group = np.unique(members["component"].to_numpy(), return_inverse=True)
        out = []
        for u, v in _candidates(members, percent):
            for a, b in zip(u.tolist(), v.tolist(), strict=True):
                if group[a] != group[b] and near(sets[a], sets[b], percent):
                    group[group == group[b]] = group[a]
                    out.append((node[a], node[b]))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")
    return run


# --- links ---------------------------------------------------------------------------
def _needed(rows: DataFrame, ids: DataFrame, *columns: str) -> DataFrame:
    """Rows of these numbers.  Only they are shuffled later, where the numbers are few
    enough for Spark to broadcast."""
    named = stored(ids.distinct(), "near-named")
    return rows.select("row", *columns).join(named, "row", "left_semi")


def _beside(pairs: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """Pairs (u, v) with the set sizes and one column of both."""
    own = _needed(rows, pairs.select(F.explode(F.array("u", "v")).alias("row")), "n", column)
    for side in ("v", "u"):
        pairs = pairs.join(own.select(F.col("row").alias(side), F.col("n").alias(f"n{side}"),
                                      F.col(column).alias(f"c{side}")), side)
    return pairs


def verified(pairs: DataFrame, rows: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """Those pairs (u, v) of row numbers whose sets are similar."""
    pairs = stored(pairs, "near-pairs")
    maybe = stored(_beside(pairs, rows, "regs").mapInArrow(_likely_batches(percent), "u long, v long"),
                   "near-likely")
    return stored(_beside(maybe, rows, "shingles").mapInArrow(_near_batches(percent), "u long, v long"),
                  "near-links")


def _fits(a: str, b: str, percent: int) -> F.Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def buckets(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(t, key, node, n, size) of classes in buckets of two and more, t the band's number."""
    own = rows.select("row", "n", "regs").join(classes.select("row"), "row")
    keyed = stored(own.mapInArrow(_key_batches, "node long, n long, keys array<long>"), "near-bands").select(
        "node", "n", F.posexplode("keys").alias("t", "key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return stored(keyed.join(shared, "key"), "near-buckets")


def _pivot_links(met: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) of members and the pivots they meet (node, pivot, score of the pivot).

    A member of a group of near copies meets another pivot in nearly every bucket.  So each
    is compared with the best of its pivots first, and with another only if the two do
    not stand in one component by then.
    """
    met = stored(met.withColumns({"u": F.least("node", "pivot"), "v": F.greatest("node", "pivot")}).distinct(),
                 "near-met")
    best = stored(met.groupBy("node").agg(F.max_by(F.struct("u", "v"), F.struct("score", -F.col("pivot"))).alias(
        "p")).select("p.u", "p.v").distinct(), "near-best")
    first = verified(best, rows, percent)
    found = stored(components(first), "near-first")
    rest = met.select("u", "v").distinct().join(best, ["u", "v"], "left_anti")
    for side in ("u", "v"):
        rest = rest.join(found.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")), side, "left")
    rest = rest.filter(F.coalesce("cu", "u") != F.coalesce("cv", "v")).select("u", "v")
    return stored(first.unionByName(verified(rest, rows, percent)), "near-pivot-links")


def links(rows: DataFrame, classes: DataFrame, percent: int = SIMILARITY, few: int = FEW,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(u, v) of classes: their components are those of all similar pairs."""
    members = buckets(rows, classes)
    score = members.groupBy("node").agg(F.sum("size").alias("score"))
    pivots = stored(members.join(score, "node").groupBy("key").agg(F.max(
        F.struct("score", (-F.col("node")).alias("less"), "n")).alias("p")).select(
        "key", (-F.col("p.less")).alias("pivot"), F.col("p.n").alias("pivot_n"), "p.score"), "near-pivots")
    others = members.join(pivots, "key").filter("node != pivot")
    first = _pivot_links(others.filter(_fits("n", "pivot_n", percent)).select("node", "pivot", "score"), rows, percent)
    # buckets whose members, the pivot aside, stand in several components
    found = stored(components(first).withColumnRenamed("node", "of"), "near-components")
    labelled = stored(others.filter("size > 2").select("key", "t", "node", "n").join(
        found, F.col("node") == F.col("of"), "left").select(
        "key", "t", "node", "n", F.coalesce("component", "node").alias("component")), "near-labelled")
    # a smaller set within the ratio has at most one size class less
    wide = labelled.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent)))
    open_ = wide.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                    F.count(F.lit(1)).alias("left")).filter("low != high")
    rest = stored(wide.join(open_.select("key", "left"), "key"), "near-open")
    small = rest.filter(F.col("left") <= few)
    a, b = (small.select("key", F.col("node").alias(s), F.col("n").alias(f"n{s}"),
                         F.col("component").alias(f"c{s}")) for s in ("u", "v"))
    second = verified(a.join(b, "key").filter("u < v AND cu != cv").filter(_fits("nu", "nv", percent)).select(
        "u", "v").distinct(), rows, percent)
    # large ones: neighbouring size classes meet, in pairs of blocks; the members of a class
    # go only where they meet one of another component in it or in a neighbouring class
    wanted = rest.filter(F.col("left") > few).withColumn(
        "band", F.explode(F.array("class", F.col("class") + 1)))
    met = wanted.groupBy("key", "band").agg(
        F.max("class").alias("upper"), F.min("component").alias("low"), F.max("component").alias("high"),
        F.sum(F.col("n") * 8 + REGISTERS).alias("bytes")).filter("upper = band AND low != high")
    large = wanted.join(met.select("key", "band", "bytes"), ["key", "band"]).withColumns({
            "blocks": F.ceil(F.col("bytes") / block_bytes)}).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("blocks")))
    meets = large.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "key", "t", "band", "class", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
        "part", "node", "component", "n")
    meets = stored(meets, "near-blocks")
    block = ["key", "band", "i", "j"]

    def beside(part: DataFrame, column: str) -> DataFrame:
        return part.join(_needed(rows, part.select(F.col("node").alias("row")), column),
                         F.col("node") == F.col("row")).drop("row")
    heavy = beside(meets, "regs")
    some = stored(heavy.groupBy(*block).applyInPandas(_block_members(percent), heavy.schema), "near-block-members")
    third = beside(some, "shingles").groupBy(*block).applyInPandas(_block_links(percent), "u long, v long")
    return first.unionByName(second).unionByName(stored(third.distinct(), "near-block-links"))


# --- groups ----------------------------------------------------------------------------
def near_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS,
                percent: int = SIMILARITY, **options) -> DataFrame:
    """One row per document: row, doc_id, xx, n_shingles, component_id."""
    rows = stored(sketches(docs, text, doc_id, words), "near-sketches")
    classes = stored(rows.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min("row").alias("row"), F.min("doc_id").alias("id")), "near-classes")
    found = stored(components(links(rows, classes, percent, **options)).withColumnRenamed("node", "row"),
                   "near-found")
    linked = classes.join(found, "row")
    least = linked.groupBy("component").agg(F.min("id").alias("component_id"))
    moved = linked.select("digest", "component").join(least, "component").select("digest", "component_id")
    label = stored(classes.join(moved, "digest", "left").select(
        "digest", F.coalesce("component_id", "id").alias("component_id")), "near-labels")
    light = rows.select("row", "doc_id", "xx", F.col("n").alias("n_shingles"), "digest")
    empty = light.filter("digest IS NULL").withColumn("component_id", F.col("doc_id")).drop("digest")
    return light.join(label, "digest").drop("digest").unionByName(empty)


def groups(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return near_groups(docs, **options).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of their group, as they are."""
    keep = near_groups(docs, text, doc_id, **options).filter(
        F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("id"), "xx").distinct().alias("keep")
    d = docs.alias("docs")
    return d.join(keep, F.col(f"docs.`{doc_id}`").cast("long").eqNullSafe(F.col("keep.id")) & (F.xxhash64(
        F.coalesce(F.col(f"docs.`{text}`").cast("string"), F.lit(""))) == F.col("keep.xx")), "left_semi")
