"""Exact top-k search with multi-resolution segment statistics.

Vectors become integers, floor(256 x); the score is their inner product.  As
2 <q, x> = |q|^2 + |x|^2 - |q - x|^2, a lower bound of the squared distance is an
upper bound of the score.  For vectors cut into segments, each segment of length
m contributes at least m ((mean_q - mean_x)^2 + (dev_q - dev_x)^2) to the
distance; halving the segments only raises the bound.

Queries and candidates are dealt into blocks of a bounded number of rows.  For
each pair of blocks one task bounds all scores with few segments, takes a first
threshold from the exact scores of each query's most promising candidates, drops
candidates whose bound is below it, repeats with finer segments, and scores the
survivors exactly.  Each pair of blocks yields at most k rows per query; a rank
over those gives the result.  Bounds carry a rounding allowance, so no true
neighbour is lost; ties go to the smaller id.

Defined cases: a null vector, or one that holds a null or non-finite component,
takes no part, nor does a row with a null id; components of any finite size are scaled
and multiplied exactly, and scores beyond a long are cut to its range (those at an end of
the range tie); vectors of
different lengths have no score together; repeated rows are candidates each (a query is not a candidate of
itself, by id); an id that repeats among the queries is one query per row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillbook.llm.common import bucket_count, stored

SCALE, K, SEGMENTS = 256, 5, (4, 16)
QUERY_ROWS, CANDIDATE_ROWS = 1024, 8192


def sound(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """(vec_id, v array<double>, dim) of the rows that take part."""
    d = vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                       F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return d.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite).withColumn(
        "dim", F.size("v"))


def integers(row: np.ndarray, scale: int) -> list[int]:
    """floor(scale * c) of each component, of any size; from 2^52 on a double is whole."""
    return [math.floor(c * scale) if abs(c) < 2.0**52 else int(c) * scale for c in row.tolist()]


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose squared distances are the segment lower bounds of the rows of x."""
    parts = np.array_split(np.arange(x.shape[1]), min(segments, x.shape[1]))
    out = [np.stack([np.sqrt(len(p)) * x[:, p].mean(1), np.sqrt(len(p)) * x[:, p].std(1)], 1) for p in parts]
    return np.concatenate(out, 1)


def block_top(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int,
              segments=SEGMENTS, scale: int = SCALE) -> list[tuple[int, int, int]]:
    """(row of q, id, score): the k best of x for each row of q, ties to smaller ids."""
    order = np.argsort(x_ids, kind="stable")
    x, x_ids = x[order], x_ids[order]
    dim = q.shape[1]
    with np.errstate(over="ignore"):                     # what overflows is neither exact nor bounded
        qf, xf = np.floor(q * float(scale)), np.floor(x * float(scale))
        largest = [float(np.abs(m).max(initial=0)) for m in (qf, xf)]
        exact = dim * largest[0] * largest[1] < 2.0**52
        qq, xx = (qf * qf).sum(1), (xf * xf).sum(1)

    def scores(i: int, at: np.ndarray) -> np.ndarray:
        if exact:
            return (xf[at] @ qf[i]).astype(np.int64)
        own = integers(q[i], scale)
        return np.array([min(max(sum(a * b for a, b in zip(integers(x[j], scale), own, strict=True)), -2**63),
                             2**63 - 1) for j in at.tolist()], np.int64)

    def bound(stat_q, stat_x, square_q, square_x):
        gap = (stat_q * stat_q).sum(-1) + (stat_x * stat_x).sum(-1) - 2 * (stat_x @ stat_q)
        # rounding of sums of this size, far above one unit in the last place
        return (square_q + square_x - gap) / 2 + 1e-9 * (square_q + square_x) + 1

    bounded = max(largest) < 2.0**400                    # squares and their sums stay finite
    levels = [(statistics(qf, s), statistics(xf, s)) for s in segments if 0 < s < dim and bounded]
    out = []
    for i in range(len(q)):
        at = np.flatnonzero(x_ids != q_ids[i])
        floor = None
        for stat_q, stat_x in levels:
            if len(at) <= k:
                break
            upper = bound(stat_q[i], stat_x[at], qq[i], xx[at])
            first = at[np.argpartition(-upper, k - 1)[:k]]
            least = scores(i, first).min()
            floor = least if floor is None else max(floor, least)
            if floor > -2**63:                           # at the end of a long's range all tie
                at = at[upper >= floor]
        score = scores(i, at)
        if len(at) > k:                                  # ids rise, so a stable sort keeps small ids first
            cut = np.partition(score, -k)[-k]
            at, score = at[score >= cut], score[score >= cut]
            best = np.argsort(-score, kind="stable")[:k]
            at, score = at[best], score[best]
        out += [(i, int(x_ids[j]), int(s)) for j, s in zip(at, score, strict=True)]
    return out


def _matrix(table: pa.Table) -> np.ndarray:
    v = table.column("v").combine_chunks()
    return v.flatten().to_numpy().reshape(len(table), -1)


def _pairs(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        rows = []
        if len(queries) and len(candidates):
            ids, keys = queries.column("vec_id").to_numpy(), queries.column("row").to_numpy()
            rows = [(int(keys[i]), int(ids[i]), j, s) for i, j, s in block_top(
                _matrix(queries), ids, _matrix(candidates), candidates.column("vec_id").to_numpy(), k)]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["row", "query_id", "vec_id", "score"])
    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = K, vector: str = "embedding",
           vec_id: str = "vec_id", query_rows: int = QUERY_ROWS,
           candidate_rows: int = CANDIDATE_ROWS) -> DataFrame:
    """One row per query and neighbour: query_id, rank, vec_id, score."""
    number = F.monotonically_increasing_id()              # fixed by being stored
    x = stored(sound(vectors, vector, vec_id).withColumn("row", number), "vectors")
    q = stored(sound(queries, vector, vec_id).withColumn("row", number), "queries")
    x_blocks, q_blocks = bucket_count(x.count(), candidate_rows), bucket_count(q.count(), query_rows)
    x = x.withColumn("xb", F.pmod(F.xxhash64("row"), F.lit(x_blocks)))
    q = q.withColumn("qb", F.pmod(F.xxhash64("row"), F.lit(q_blocks)))
    x = x.withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))))
    q = q.withColumn("xb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(x_blocks - 1).cast("long"))))
    found = q.groupBy("qb", "xb", "dim").cogroup(x.groupBy("qb", "xb", "dim")).applyInArrow(
        _pairs(k), "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
