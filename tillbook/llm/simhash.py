"""SimHash near-dedup with covering locality-sensitive hashing.

Fingerprints: 64 majority bits over the XXH64 (seed 42) of each word shingle.

Candidates: with radius r, every bit position i gets a vector phi(i) in
{0,1}^(r+1); each of the 2^(r+1) - 1 non-zero vectors v gives one table, whose
mask keeps the bits with <phi(i), v> = 1 (mod 2).  Any r positions leave some
v orthogonal to all their vectors, so each pair within the radius agrees on the
masked bits of some table: no pair is missed.

Links inside a bucket, without pairs: a member x stands at each point z that
differs from it in at most floor(r/2) of the bits that the table's mask leaves
free.  For r = 2, two members of a bucket are within the radius exactly when
some point within one bit of both exists, and all members at one point are
within two bits of each other; so a link from each to the least of them is
exact, no row per pair is made, and a point has at most 65 members however
large the bucket is.  (The radius has to be even.)

Fingerprints, not documents, are linked: copies share one.  Components of the
links come from :mod:`tillbook.llm.components`.

Defined cases: a null text counts as empty; without words the fingerprint is
zero; a null doc_id stands after every other (as documents without an id cannot
be told apart by it, :func:`keep_one` keeps one row for each of their
fingerprints that no document with an id is linked to); repeated rows are
repeated in the result; an empty table gives an empty result; other columns ride
along.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import slices, stored
from tillbook.llm.components import components

SHINGLE, RADIUS, SEED, BITS = 3, 2, 42, 64


def masks(radius: int = RADIUS) -> list[int]:
    """The covering masks: 2^(radius + 1) - 1 of them."""
    codes = 2 ** (radius + 1) - 1
    phi = [1 + i % codes for i in range(BITS)]         # non-zero vectors, used evenly
    return [sum(1 << i for i in range(BITS) if (phi[i] & v).bit_count() % 2)
            for v in range(1, codes + 1)]


def text_fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()                       # both are ASCII-only on bytes
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(shingle, len(words))
    starts = [0, *(ends[:len(words) - k] + 1).tolist()]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in
                       zip(starts, ends[k - 1:].tolist(), strict=True)])
    n, ones = len(starts), np.zeros(BITS, np.int64)
    raw = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for at in range(0, n, 4096):
        ones += np.unpackbits(raw[at:at + 4096], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            found = [text_fingerprint(t or b"", shingle) for t in texts]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("xx"), pa.array(signed, pa.int64())],
                ["doc_id", "xx", "fp"])
    return run


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, xx, fp) of each row; xx a hash of the text, fp as a signed long."""
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _text_hash(text).alias("xx"),
                    F.col(text).cast("string").alias("text"))
    return d.mapInArrow(_fingerprint_batches(shingle), "doc_id long, xx long, fp long")


def _text_hash(text: str) -> F.Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v) of nodes (fp, node) whose fingerprints are within the radius, as
    stars: their components are those of all links."""
    if radius % 2:
        raise ValueError("the radius has to be even: points lie radius / 2 bits from both ends")
    buckets = fps.select("fp", "node", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")) for m in masks(radius)])).alias("t", "key"))
    shared = buckets.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = buckets.join(shared.select("t", "key"), ["t", "key"])
    # the tables of a member, in one row: points it stands at are then made once
    members = members.groupBy("fp", "node").agg(F.bit_or(F.expr("shiftleft(1, t)")).alias("tables"))
    flips = []                                          # (bits to flip, tables that leave them free)
    for k in range(radius // 2 + 1):
        for bits in combinations(range(BITS), k):
            flip = sum(1 << b for b in bits)
            free = sum(1 << t for t, m in enumerate(masks(radius)) if not m & flip)
            flips.append((_signed(flip), free))
    points = F.transform(
        F.filter(F.array(*[F.struct(F.lit(f).cast("long").alias("f"), F.lit(t).alias("t")) for f, t in flips]),
                 lambda x: x["t"].bitwiseAND(F.col("tables")) != 0),
        lambda x: F.col("fp").bitwiseXOR(x["f"]))
    at = members.select("node", F.explode(points).alias("z"))
    least = at.groupBy("z").agg(F.min("node").alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return at.join(least, "z").filter("node != v").select(F.col("node").alias("u"), "v").distinct()


def near_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, xx, fp (long), component_id."""
    rows = stored(fingerprints(docs, text, doc_id, shingle), "fingerprints")
    ids = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")        # null stands last
    fps = stored(rows.groupBy("fp").agg(F.min(ids).alias("id")), "fingerprint-classes")
    found = stored(components(links(fps.withColumn("node", F.col("fp")), radius)).withColumnRenamed(
        "node", "fp"), "fingerprint-components")
    least = found.join(fps, "fp").groupBy("component").agg(F.min("id").alias("component_id"))
    linked = found.join(least, "component").select("fp", "component_id")
    # stored, so that the last join reads straight from shuffles and AQE can split a hot one
    label = stored(fps.join(linked, "fp", "left").select(
        "fp", F.coalesce("component_id", "id")["doc_id"].alias("component_id")), "fingerprint-labels")
    return rows.join(label, "fp").select("doc_id", "xx", "fp", "component_id")


def groups(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id."""
    return near_groups(docs, **options).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The row of each group with the smallest doc_id, with its columns.

    Of rows that share this doc_id one stays, that of the least text hash.
    """
    first = near_groups(docs, text, doc_id, **options).filter(
        F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id", "fp", "xx").agg(
        F.count(F.lit(1)).alias("n"))
    # a null doc_id names no single group; its rows are groups by fingerprint
    keep = first.groupBy("doc_id", F.when(F.col("doc_id").isNull(), F.col("fp"))).agg(
        F.min(F.struct("xx", "n")).alias("r")).select(
        F.col("doc_id").alias("keep"), F.col("r.xx").alias("keep_xx"), F.col("r.n").alias("repeats"))
    # the input row travels whole in one column, so its names meet none of these
    d = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("long").alias("id"), _text_hash(text).alias("xx"))
    d = d.join(keep, F.col("id").eqNullSafe(F.col("keep")) & (F.col("xx") == F.col("keep_xx")))
    once = d.filter("repeats = 1").select("row.*")
    again = d.filter("repeats > 1").dropDuplicates(["id", "xx"]).select("row.*")
    return once.unionByName(again)
