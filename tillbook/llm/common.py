"""Helpers shared by the training-data operators.

Driver side: table paths, intermediate tables in the cluster's shared folder.
Task side: Arrow batches cut to a byte bound, and words or tokenizer segments
found with numpy over the batch's UTF-8 buffer, so that per-word Python work
runs once per distinct word of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.session import scratch_dir

#: Text bytes that a task holds at once (a single longer text counts as one).
SLICE_BYTES = 2 << 20

#: Range of :func:`place`.
PLACES = 1 << 40

#: The white space that splits words: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage at a table that every executor can read, so a lost
    executor costs its running tasks only.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucket_count(rows: int, per_bucket: int) -> int:
    """Buckets that hold about ``per_bucket`` rows each."""
    return max(1, -(-int(rows) // per_bucket))


def held_out(doc_id) -> F.Column:
    """True for the fold that no model learns from: crc32(doc_id as text) mod 5 = 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def place(col) -> F.Column:
    """A hash of an id, evenly spread over 0 to PLACES - 1."""
    return F.pmod(F.xxhash64(col), F.lit(PLACES))


def share_below(rows, of) -> F.Column:
    """The place below which about twice ``rows`` (and some) of ``of`` rows lie: whoever
    looks for the ``rows`` least places reads no more than these, at any table size."""
    return F.least(F.lit(1.0), (F.lit(2.0 * rows) + 1000) / of) * PLACES


def least_places(df: DataFrame, doc_id: str, rows: int) -> DataFrame:
    """The ``rows`` rows of ``df`` whose ids have the least places."""
    few = df.filter(place(doc_id) < share_below(rows, F.lit(max(1, df.count()))))
    return few.orderBy(place(doc_id), doc_id).limit(rows)


# --- inside tasks -----------------------------------------------------------
def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds at most ``limit`` bytes (or one row)."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(size), 0
        while at < len(size):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
    pa.default_memory_pool().release_unused()             # the worker lives on with other tasks


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    column = column.cast(pa.large_binary())
    column = pc.fill_null(column, b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def _flags(codes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(codes)] = True
    return out


_SPACE = _flags(SPACES.encode())


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bounds): bytes of each word ``[^\\x20\\x09-\\x0D]+``; document
    ``i`` has the words ``bounds[i]:bounds[i + 1]``."""
    n = len(data)
    inner = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True                         # a word never runs over a document's end
    first, last = inner.copy(), inner.copy()
    first[1:] &= ~inner[:-1] | edge[1:n]
    last[:-1] &= ~inner[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def spans_to_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte spans as a binary array (gaps between spans are squeezed out)."""
    n = len(data)
    step = np.zeros(n + 1, np.int8)
    step[starts] = 1
    step[ends] -= 1
    kept = data[np.cumsum(step[:n], dtype=np.int8).astype(bool)]
    off = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=off[1:])
    return binary_array(off, kept)


def binary_array(off: np.ndarray, data: np.ndarray) -> pa.Array:
    off = np.ascontiguousarray(off, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(off) - 1,
                                 [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data))])


def distinct(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(code of each word, distinct words)."""
    enc = words.dictionary_encode()
    return enc.indices.to_numpy(zero_copy_only=False), enc.dictionary


def words_of(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(code of each word, distinct words, bounds) of a text column."""
    data, off = text_buffer(column)
    starts, ends, bounds = word_spans(data, off)
    codes, words = distinct(spans_to_array(data, starts, ends))
    return codes, words, bounds
