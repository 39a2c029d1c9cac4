"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

Inputs of a document, as sparse features: its words, hashed, with damped and
length-normalised counts; statistics of its structure (shares of character
kinds, word lengths, repetition, line lengths), cut into quantile bins; and the
metadata column n_chars, binned (the text's own length where it is null).
labels, lang, source and doc_id are never inputs.

The score is linear in the number of features: the pairwise term
sum_{i<j} <v_i, v_j> x_i x_j equals half of sum_f (sum_i v_if x_i)^2 -
sum_i (v_if x_i)^2.

Learning uses a bounded sample: at most ``max_rows`` labelled rows, those with
the least hash of doc_id, whose features (not texts) come to the driver; bins
and weights are fitted there with numpy, always in the same order.  Scoring
reads every whole text, without a shuffle.

Defined cases: null and empty texts are scored (by their bins and the bias); a
doc_id labelled twice counts with its lowest quality; without labels the score is
0.5, with labels of one kind it is near that label; repeated rows get the same
score; the columns of the input, whatever their names, stay in :func:`keep_good`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import (
    _flags,
    distinct,
    held_out,
    least_places,
    slices,
    spans_to_array,
    text_buffer,
    word_spans,
)

#: Labelled rows that are learned from, at most.
MAX_ROWS = 10_000
WORD_BITS, BINS, RANK, BATCH, RATE, DECAY = 14, 16, 8, 64, 0.05, 1e-5
#: Passes over the sample, and batches at least.
EPOCHS, STEPS = 8, 1200
THRESHOLD = 0.3

_KINDS = [_flags(range(65, 91)), _flags(range(97, 123)), _flags(range(48, 58)),
          _flags(b" \t\n\x0b\x0c\r"), _flags(b"\n"), _flags(b".,;:?'\"()-"),
          _flags(set(range(33, 127)) - set(b".,;:?'\"()-") - set(range(48, 58))
                 - set(range(65, 91)) - set(range(97, 123))),
          _flags(range(128, 256))]
N_STATS = len(_KINDS) + 8


def _per_document(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def features(text: pa.Array, n_chars: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bounds, word buckets, their weights, statistics): a document's words are
    ``bounds[i]:bounds[i + 1]``, its statistics row i."""
    data, off = text_buffer(text)
    starts, ends, words_at = word_spans(data, off)
    codes, words = distinct(spans_to_array(data, starts, ends))
    docs, n = len(off) - 1, np.maximum(np.diff(words_at), 1)
    size = np.maximum(np.diff(off), 1)
    doc = np.repeat(np.arange(docs), np.diff(words_at))
    mask = (1 << WORD_BITS) - 1
    bucket = np.array([xxhash.xxh3_64_intdigest(w) & mask for w in words.to_pylist()], np.int64)

    hashed, count = np.unique((doc << WORD_BITS) | bucket[codes], return_counts=True)
    weight = np.log1p(count)
    bounds = np.searchsorted(hashed, np.arange(docs + 1) << WORD_BITS)
    norm = np.sqrt(np.maximum(_per_document(weight * weight, bounds), 1e-9))
    weight = (weight / np.repeat(norm, np.diff(bounds))).astype(np.float32)

    stats = np.zeros((docs, N_STATS), np.float64)
    for k, kind in enumerate(_KINDS):
        stats[:, k] = _per_document(kind[data], off) / size
    k, length = len(_KINDS), ends - starts
    exact, times = np.unique(doc * max(1, len(words)) + codes, return_counts=True)
    at = np.searchsorted(exact, np.arange(docs + 1) * max(1, len(words)))
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
    stats[:, k] = _per_document(length, words_at) / n
    stats[:, k + 1] = np.diff(at) / n                                # distinct words
    if len(times):
        top = np.maximum.reduceat(np.append(times, 0), np.minimum(at[:-1], len(times)))
        stats[:, k + 2] = np.where(np.diff(at) > 0, top, 0) / n      # most frequent word
    stats[:, k + 3] = _per_document(same, words_at) / n              # repeated at once
    stats[:, k + 4] = _per_document(length <= 2, words_at) / n
    stats[:, k + 5] = _per_document(length >= 14, words_at) / n
    stats[:, k + 6] = np.log1p(np.diff(words_at))
    stats[:, k + 7] = np.log1p(pc.fill_null(n_chars, -1).to_numpy(zero_copy_only=False).clip(-1) + 1)
    missing = pc.is_null(n_chars).to_numpy(zero_copy_only=False)
    own = np.log1p(_per_document((data & 0xC0) != 0x80, off) + 1)
    stats[:, k + 7] = np.where(missing, own, stats[:, k + 7])
    return bounds, hashed & mask, weight, stats


@dataclass
class Model:
    """A fitted machine: bin edges per statistic, bias, weights, factors."""
    edges: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def rows(self, bounds, bucket, weight, stats):
        """(bounds, feature index, value) of all documents, bins after the words."""
        docs = len(stats)
        bins = np.stack([np.searchsorted(e, stats[:, j], "right") for j, e in enumerate(self.edges)], 1)
        bins += (1 << WORD_BITS) + np.arange(stats.shape[1]) * BINS
        size = np.diff(bounds)
        out = np.zeros(docs + 1, np.int64)
        np.cumsum(size + stats.shape[1], out=out[1:])
        word_at = np.arange(len(bucket)) + np.repeat(out[:-1] - bounds[:-1], size)
        bin_at = (out[1:] - stats.shape[1])[:, None] + np.arange(stats.shape[1])
        index = np.zeros(out[-1], np.int64)
        value = np.full(out[-1], 1 / np.sqrt(stats.shape[1]), np.float32)
        index[word_at], value[word_at] = bucket, weight
        index[bin_at] = bins
        return out, index, value

    def logits(self, bounds, index, value) -> np.ndarray:
        if not len(index):
            return np.zeros(0)
        first = bounds[:-1]
        linear = np.add.reduceat(self.weights[index] * value, first)
        part = self.factors[index] * value[:, None]
        sums, squares = np.add.reduceat(part, first), np.add.reduceat(part * part, first)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(1)

    def score(self, text: pa.Array, n_chars: pa.Array) -> np.ndarray:
        z = self.logits(*self.rows(*features(text, n_chars))).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _edges(stats: np.ndarray) -> np.ndarray:
    if not len(stats):
        return np.zeros((N_STATS, BINS - 1))
    return np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T


def fit(bounds, bucket, weight, stats, label) -> Model:
    """Logistic loss, Adagrad over small batches in a fixed order."""
    rng = np.random.default_rng(7)
    width = (1 << WORD_BITS) + N_STATS * BINS
    model = Model(_edges(stats), 0.0, np.zeros(width, np.float32),
                  rng.normal(0, 0.02, (width, RANK)).astype(np.float32))
    if not len(label):
        model.factors[:] = 0
        return model
    base = np.clip(label.mean(), 0.01, 0.99)
    model.bias = float(np.log(base / (1 - base)))
    bounds, index, value = model.rows(bounds, bucket, weight, stats)
    seen_w, seen_v, seen_b = np.full(width, 1e-3, np.float32), np.full((width, RANK), 1e-3, np.float32), 1e-3
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(label)))):
        order = rng.permutation(len(label))
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            size = np.diff(bounds)[some]
            ends = np.append(0, np.cumsum(size))
            take = np.repeat(bounds[some] - ends[:-1], size) + np.arange(ends[-1])
            i, x = index[take], value[take]
            part = model.factors[i] * x[:, None]
            sums = np.add.reduceat(part, ends[:-1])
            z = model.bias + np.add.reduceat(model.weights[i] * x, ends[:-1]) + 0.5 * (
                sums * sums - np.add.reduceat(part * part, ends[:-1])).sum(1)
            error = 1 / (1 + np.exp(-z)) - label[some]
            each = np.repeat(error, size).astype(np.float32) * x
            used, where = np.unique(i, return_inverse=True)
            rising = np.argsort(where, kind="stable")
            runs = np.searchsorted(where[rising], np.arange(len(used)))
            gw = np.add.reduceat(each[rising], runs) + DECAY * model.weights[used]
            gv = np.add.reduceat((each[:, None] * (np.repeat(sums, size, axis=0) - part))[rising], runs)
            gv += DECAY * model.factors[used]
            seen_w[used] += gw * gw
            seen_v[used] += gv * gv
            model.weights[used] -= RATE * gw / np.sqrt(seen_w[used])
            model.factors[used] -= RATE * gv / np.sqrt(seen_v[used])
            gb = float(error.mean())
            seen_b += gb * gb
            model.bias -= RATE * gb / np.sqrt(seen_b)
    return model


# --- the plan ---------------------------------------------------------------
def _inputs(docs: DataFrame, text: str, n_chars: str, *more) -> DataFrame:
    length = F.col(n_chars).cast("long") if n_chars in docs.columns else F.lit(None).cast("long")
    return docs.select(*more, F.col(text).cast("string").alias("text"), length.alias("n_chars"))


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        bounds, bucket, weight, stats = features(batch.column("text"), batch.column("n_chars"))
        cut = pa.array(bounds.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"),
             pa.ListArray.from_arrays(cut, pa.array(bucket.astype(np.int32))),
             pa.ListArray.from_arrays(cut, pa.array(weight)),
             pa.ListArray.from_arrays(pa.array(np.arange(len(stats) + 1, dtype=np.int32) * N_STATS),
                                      pa.array(stats.ravel()))],
            ["doc_id", "label", "bucket", "weight", "stats"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text",
          doc_id: str = "doc_id", n_chars: str = "n_chars", max_rows: int = MAX_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fold."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    present = known.groupBy("doc_id").agg(F.min("label").alias("label")).join(
        docs.select(F.col(doc_id).cast("long").alias("doc_id")), "doc_id", "left_semi")
    chosen = least_places(present, "doc_id", max_rows).collect()
    sample = F.broadcast(spark.createDataFrame(           # at most max_rows pairs of numbers
        [(r["doc_id"], r["label"]) for r in chosen], "__doc long, label int"))
    d = docs.withColumn("__doc", F.col(doc_id).cast("long")).join(sample, "__doc")
    rows = _inputs(d, text, n_chars, F.col("__doc").alias("doc_id"), "label").mapInArrow(
        _feature_batches, "doc_id long, label int, bucket array<int>, weight array<float>, stats array<double>")
    one = rows.groupBy("doc_id").agg(F.min(F.struct("label", "stats", "bucket", "weight")).alias("r"))
    found = one.select("doc_id", "r.*").toArrow().sort_by("doc_id")
    bucket, weight, stats = (_flat(found[c]) for c in ("bucket", "weight", "stats"))
    size = pc.list_value_length(found["bucket"]).to_numpy()
    model = fit(np.append(0, np.cumsum(size, dtype=np.int64)), bucket.astype(np.int64), weight,
                stats.reshape(-1, N_STATS), found["label"].to_numpy().astype(np.float64))
    del found, bucket, weight, stats, size
    pa.default_memory_pool().release_unused()             # the driver runs on with the model only
    return model


def _flat(lists: pa.ChunkedArray) -> np.ndarray:
    return pc.list_flatten(lists).to_numpy()


def scores(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id",
           n_chars: str = "n_chars") -> DataFrame:
    """(doc_id, score) of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(batch.column("text"), batch.column("n_chars")))],
                ["doc_id", "score"])
    return _inputs(docs, text, n_chars, F.col(doc_id).cast("long").alias("doc_id")).mapInArrow(
        run, "doc_id long, score double")


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    return scores(docs, train(docs, labels, **options)).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text",
              n_chars: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with their columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            n = batch.column(n_chars).cast(pa.int64()) if n_chars in batch.schema.names else \
                pa.nulls(len(batch), pa.int64())
            good = model.score(batch.column(text), n) >= threshold
            yield batch.filter(pa.array(good))
    return docs.mapInArrow(run, docs.schema)
