"""Exact dedup by a heavy-hitter split.

Texts are equal when they are identical without the characters
``[\\x20\\x09-\\x0D]``; SHA-256 of the rest (UTF-8) stands for the text.

1. One scan writes (doc_id, n_points, digest) to the shared folder.
2. Misra-Gries summaries of ``counters`` entries per task, merged by key, give
   at most ``counters`` candidate digests: every digest with more than
   rows / (counters + 1) rows is among them.
3. An exact count over the digests, joined with the broadcast candidates and
   pre-aggregated per task, verifies them and finds their winners.
4. Rows of verified digests get their winner map-side, from a broadcast of at
   most ``counters`` rows; the remaining digests, none of which holds more than
   a ``1 / (counters + 1)`` share, go through an ordinary shuffle.

Defined cases: a null text counts as empty; a null doc_id sorts after every
other; rows that repeat doc_id and text are one document (each gets its output
row; the stage writes one of them); an empty table gives an empty result; other
columns, whatever their names, ride along in :func:`drop_copies` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import SPACES, stored

#: Entries of a Misra-Gries summary: bounds what is broadcast and collected.
COUNTERS = 1000


def normalised(text: str = "text") -> F.Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), SPACES, "")


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_points, digest) of each row."""
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.char_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_points"),
        F.unhex(F.sha2(normalised(text), 256)).alias("digest"))


def misra_gries(counts: dict[bytes, int], keys: list[bytes], times: list[int],
                counters: int) -> None:
    """Add weighted keys to a summary, then take the (counters + 1)-th count off all."""
    for k, n in zip(keys, times, strict=True):
        counts[k] = counts.get(k, 0) + n
    if len(counts) > counters:
        cut = int(np.partition(np.fromiter(counts.values(), np.int64), -counters - 1)[-counters - 1])
        for k in [k for k, n in counts.items() if n <= cut]:
            del counts[k]
        for k in counts:
            counts[k] -= cut


def _summaries(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            seen = batch.column(0).value_counts()
            misra_gries(counts, seen.field(0).to_pylist(), seen.field(1).to_pylist(), counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            ["digest", "n"])
    return run


def heavy_candidates(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests that include every one with more than
    rows / (counters + 1) rows."""
    each = rows.select("digest").mapInArrow(_summaries(counters), "digest binary, n long")
    merged = each.groupBy("digest").agg(F.sum("n").alias("n"))
    # the merge of Misra-Gries summaries: keep what exceeds the (counters + 1)-th count
    top = merged.orderBy(F.desc("n"), "digest").limit(counters + 1).collect()
    cut = top[counters]["n"] if len(top) > counters else 0
    keep = [(bytes(r["digest"]),) for r in top if r["n"] > cut]
    return rows.sparkSession.createDataFrame(keep, "digest binary")


def _order() -> F.Column:
    """Least for the row that stays: most code points, then smallest doc_id."""
    return F.struct((-F.col("n_points")).alias("points"), F.col("doc_id").isNull().alias("null_id"),
                    F.col("doc_id").alias("id"))


def winners(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, keep_points, group_size) per digest."""
    return rows.groupBy("digest").agg(F.min(_order()).alias("w"),
                                      F.count(F.lit(1)).alias("group_size")).select(
        "digest", F.col("w.id").alias("keep_id"), (-F.col("w.points")).alias("keep_points"),
        "group_size")


def heavy_winners(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Verified winners of the frequent digests: at most ``counters`` rows, held
    by the driver, so that broadcasting them is safe at any input size."""
    candidates = heavy_candidates(rows, counters)
    share = rows.count() / (counters + 1)
    heavy = winners(rows.join(F.broadcast(candidates), "digest")).filter(
        F.col("group_size") > share)
    return rows.sparkSession.createDataFrame(heavy.collect(), heavy.schema)


def assign(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """Each row of :func:`digests` with its winner; ``rows`` is read several times."""
    hot = rows.join(F.broadcast(heavy), "digest")
    rest = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    rest = rest.join(winners(rest), "digest")
    return hot.unionByName(rest).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))
        & (F.col("n_points") == F.col("keep_points")))


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
           counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stored(digests(docs, text, doc_id), "exact-digests")
    return assign(rows, heavy_winners(rows, counters)).select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they were.

    Losers of frequent digests go map-side, before any text is shuffled.
    """
    rows = stored(digests(docs, text, doc_id), "exact-digests")
    heavy = heavy_winners(rows, counters)
    stay = assign(rows, heavy).filter("kept").groupBy("doc_id", "digest").agg(
        F.max("n_points").alias("stay_points"), F.count(F.lit(1)).alias("repeats"))
    stay = stay.withColumnsRenamed({"doc_id": "stay_id", "digest": "stay"})
    # the input row travels whole in one column, so its names meet none of these
    d = docs.select(
        F.struct("*").alias("row"), F.unhex(F.sha2(normalised(text), 256)).alias("digest"),
        F.col(doc_id).cast("long").alias("id"),
        F.char_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("points"))
    h = heavy.select(F.col("digest").alias("hot"), F.col("keep_id").alias("hot_id"),
                     F.col("keep_points").alias("hot_points"))
    d = d.join(F.broadcast(h), F.col("digest") == F.col("hot"), "left").filter(
        F.col("hot").isNull() | (F.col("id").eqNullSafe(F.col("hot_id"))
                                 & (F.col("points") == F.col("hot_points"))))
    d = d.join(stay, (F.col("digest") == F.col("stay"))
               & F.col("id").eqNullSafe(F.col("stay_id"))
               & (F.col("points") == F.col("stay_points")))
    once = d.filter("repeats = 1").select("row.*")
    again = d.filter("repeats > 1").dropDuplicates(["digest", "id"]).select("row.*")
    return once.unionByName(again)
