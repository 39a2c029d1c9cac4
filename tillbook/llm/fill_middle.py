"""Fill-in-middle transformation by displacement scatter.

A document is cut into n code points; two hashes of its id choose where its
prefix and its middle end, two more whether it stays plain and in which order
its parts stand.  No document is rebuilt by itself.  For a batch of documents
the cuts are read off a scan of the bytes that start a code point, and a
difference array notes, where each part starts, by how much its bytes move more
than the bytes before.  Its cumulative sum is the shift of every byte of the
batch; one numpy scatter builds all outputs, the markers written between.

:func:`restored` goes the other way: it scans the outputs for the three markers
of each document (the parts hold none, or the document would be plain, and no
marker can start in a part and end in a marker), makes the same differences for
the parts that follow them, and gathers every byte from its shifted place.

Each row depends on itself alone, so there is no shuffle and a task holds the
batches of one slice at a time.

Defined cases: a null text counts as empty, and an empty text is plain; a null
doc_id is hashed as the text ``1:``; repeated rows are repeated in the result;
texts of any length are cut whole; other columns, whatever their names, are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import slices, text_buffer

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3                                   # bytes of a marker
#: Of a hundred documents, how many are transformed, and how many of these suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)
#: The parts prefix, middle, suffix (0, 1, 2) in the order in which each form has them.
ORDER = np.array([[0, 1, 2], [0, 2, 1], [2, 0, 1]])

OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def hashes(doc_id: str) -> list[Column]:
    """h1 to h4: the first four 8-digit groups of the hex SHA-256 of ``1:<doc_id>``."""
    sha = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(sha, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


# --- one batch ---------------------------------------------------------------
def markers(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sorted byte positions at which a marker starts within one document."""
    if len(data) < MARK:
        return np.zeros(0, np.int64)
    letter = (data[1:-1] == PREFIX[1]) | (data[1:-1] == SUFFIX[1]) | (data[1:-1] == MIDDLE[1])
    at = np.flatnonzero((data[:-2] == PREFIX[0]) & letter & (data[2:] == PREFIX[2]))
    end = off[np.searchsorted(off, at, "right")]       # of the document that holds the position
    return at[at + MARK <= end]


def code_points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte at which each code point starts, then the end; code points before each document)."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    return np.append(starts, len(data)), np.searchsorted(starts, off)


def shifts(length: int, at: np.ndarray, moved: np.ndarray) -> np.ndarray:
    """The shift of each of ``length`` bytes.  Part ``i`` starts at byte ``at[i]`` and moves
    by ``moved[i]``; the parts come in order of their bytes, and empty ones are allowed."""
    steps = np.zeros(length + 1, np.int64)
    np.add.at(steps, at, np.diff(moved, prepend=0))
    return np.cumsum(steps[:length])


def places(form: np.ndarray, sizes: np.ndarray, out_off: np.ndarray) -> np.ndarray:
    """(documents, 3) where prefix, middle and suffix start in the outputs."""
    marked = np.where(form == PLAIN, 0, MARK)[:, None]
    order = ORDER[form]
    ends = np.cumsum(np.take_along_axis(sizes, order, 1) + marked, axis=1)
    begin = np.concatenate([np.zeros((len(form), 1), np.int64), ends[:, :-1]], axis=1) + marked
    out = np.empty_like(begin)
    np.put_along_axis(out, order, begin, 1)
    return out + out_off[:-1, None]


def scatter(data: np.ndarray, off: np.ndarray, cut: np.ndarray, form: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the outputs; ``cut`` (documents, 2) has the bytes at which
    middle and suffix start."""
    starts = np.concatenate([off[:-1, None], cut], axis=1)
    sizes = np.diff(np.concatenate([starts, off[1:, None]], axis=1), axis=1)
    out_off = np.zeros(len(off), np.int64)
    np.cumsum(np.diff(off) + np.where(form == PLAIN, 0, 3 * MARK), out=out_off[1:])
    to = places(form, sizes, out_off)
    out = np.empty(out_off[-1], np.uint8)
    out[np.arange(len(data)) + shifts(len(data), starts.ravel(), (to - starts).ravel())] = data
    moved = to[form != PLAIN]
    for part, marker in enumerate((PREFIX, MIDDLE, SUFFIX)):
        for i, byte in enumerate(marker):
            out[moved[:, part] - MARK + i] = byte
    return out, out_off


def gathered(out: np.ndarray, out_off: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts that the outputs of these forms were made from."""
    begin = np.repeat(out_off[:-1, None], 3, axis=1)
    sizes = np.zeros((len(form), 3), np.int64)
    sizes[:, 0] = np.diff(out_off)
    changed = np.flatnonzero(form != PLAIN)
    at = markers(out, out_off)
    doc = np.searchsorted(out_off, at, "right") - 1
    at = at[form[doc] != PLAIN].reshape(-1, 3)          # three markers a document, in order
    ends = np.concatenate([at[:, 1:], out_off[changed + 1][:, None]], axis=1)
    order = ORDER[form[changed]]
    first, size = np.empty_like(at), np.empty_like(at)
    np.put_along_axis(first, order, at + MARK, 1)
    np.put_along_axis(size, order, ends - at - MARK, 1)
    begin[changed], sizes[changed] = first, size
    off = np.zeros(len(out_off), np.int64)
    np.cumsum(sizes.sum(1), out=off[1:])
    starts = off[:-1, None] + np.cumsum(sizes, axis=1) - sizes
    return out[np.arange(off[-1]) + shifts(off[-1], starts.ravel(), (begin - starts).ravel())], off


def _strings(data: np.ndarray, off: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(data)
    return pa.Array.from_buffers(pa.large_string(), len(off) - 1,
                                 [None, pa.py_buffer(off), pa.py_buffer(data)]).cast(pa.string())


def _transform_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        data, off = text_buffer(batch.column("text"))
        h1, h2, h3, h4 = (batch.column(f"h{i}").to_numpy(zero_copy_only=False) for i in range(1, 5))
        starts, before = code_points(data, off)
        n = np.diff(before)
        ends = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)], axis=1), axis=1)
        form = np.where(h4 % 100 < SUFFIX_FIRST, SPM, PSM)
        form[(n == 0) | (h3 % 100 >= TRANSFORMED)] = PLAIN
        form[np.searchsorted(off, markers(data, off), "right") - 1] = PLAIN
        out, out_off = scatter(data, off, starts[before[:-1, None] + ends], form)
        plain = form == PLAIN
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(FORMS).take(pa.array(form)),
             pa.array(ends[:, 0], pa.int64(), mask=plain),
             pa.array(ends[:, 1] - ends[:, 0], pa.int64(), mask=plain), _strings(out, out_off)],
            ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def _restore_batches(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "output"):
            out, out_off = text_buffer(batch.column("output"))
            form = np.array([FORMS.index(f) for f in batch.column("form").to_pylist()], np.int64)
            texts = _strings(*gathered(out, out_off, form))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*names, "restored"])
    return run


# --- tables ------------------------------------------------------------------
def transformed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n (code points), form, prefix_chars, middle_chars, output."""
    h = [c.alias(f"h{i}") for i, c in enumerate(hashes("doc_id"), 1)]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.select("doc_id", "text", *h).mapInArrow(_transform_batches, OUT)


def restored(rows: DataFrame) -> DataFrame:
    """Rows of :func:`transformed` with the text rebuilt from ``form`` and ``output``."""
    schema = rows.schema.simpleString()[len("struct<"):-1] + ",restored:string"
    return rows.mapInArrow(_restore_batches(rows.columns), schema)


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows of :func:`transformed` with SHA-256 digests of the output and of the text
    restored from it."""
    return restored(transformed(docs, text, doc_id)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
