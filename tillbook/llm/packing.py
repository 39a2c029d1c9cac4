"""Packing documents into training sequences: shortest-pack-first over the
length histogram.

1. One scan tokenises whole texts, adds the end id, and cuts each document into
   pieces: whole sequences of ``size`` ids, then the rest.  Only the pieces'
   places, lengths and checksums are written, to the shared folder.
2. The histogram of piece lengths (at most ``size`` rows, whatever the input)
   comes to the driver.  Lengths are placed longest first, each into the packs
   with most room left; packs that hold the same lengths are one pattern with a
   count, so the work follows the number of lengths, not of documents.
3. Every placement is a range of ranks within a length; pieces are ranked within
   their length and joined with the ranges, which are broadcast: their number
   is bounded by the sequence size.

Ranks need no task that sees a whole length (a third of all rows may share
one): pieces are numbered within (length, bucket), with the bucket's offset
from the counts per (length, bucket).

Defined cases: the added tokens of the tokenizer's file are matched where a text has
them as they stand, before it is normalised, as the tokenizer itself does; a null or empty text is the end id alone; repeated rows are
packed each; ties of length go by bucket, doc_id, start and checksum; an empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillbook.llm.common import bucket_count, slices, stored, text_buffer
from tillbook.llm.tokens import Memo, encode_words, one_thread, segments

SIZE, END_ID, BUCKET_ROWS = 2048, 1, 2_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _plain() -> np.ndarray:
    """Bytes as the tokenizer sees them anyway: lower case, newline as space."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    out[10] = 32
    return out


def _tokenizer(path: str):
    """The tokenizer for segments as plain text; _Added finds the added tokens in whole texts."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def _encoder(tokenizer):
    """Segments to ids; the tokens that end a word are known by the model's suffix."""
    vocabulary = tokenizer.get_vocab()
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    ends = np.zeros(max(vocabulary.values()) + 1 if suffix else 0, bool)
    if suffix:
        ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
    return lambda words: encode_words(tokenizer, words, ends, last=True)


class _Added:
    """Added tokens of the tokenizer's file, found in texts before these are normalised."""

    def __init__(self, tokenizer):
        self.ids = {t.content.encode(): i for i, t in tokenizer.get_added_tokens_decoder().items()}
        longest = sorted(self.ids, key=len, reverse=True)
        self.pattern = re.compile(b"|".join(map(re.escape, longest))) if longest else None

    def spans(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """((start, end) of each occurrence, its id); none runs over a document's end."""
        buffer, found = memoryview(data), []
        if self.pattern and self.pattern.search(buffer):
            for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                found += [(*m.span(), self.ids[m.group()]) for m in self.pattern.finditer(buffer, a, b)]
        out = np.array(found, np.int64).reshape(-1, 3)
        return out[:, :2], out[:, 2]


def document_ids(batch: pa.RecordBatch, memo: Memo, plain: np.ndarray, added: _Added
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all documents, bounds) without the end id."""
    data, off = text_buffer(batch.column("text"))
    spans, ids = added.spans(data, off)
    data, edges = plain[data], off
    if len(spans):                                       # segments of their own: nothing is cut in zeros
        edges = np.unique(np.concatenate([off, spans.ravel()]))
        for a, b in spans.tolist():
            data[a:b] = 0
    codes, words, bounds = segments(data, edges)
    places = memo(words)[codes]
    if len(spans):
        bounds, starts = bounds[np.searchsorted(edges, off)], bounds[np.searchsorted(edges, spans[:, 0])]
        # no UTF-8 text has the byte FF
        places[starts] = [memo.fixed(b"\xff%d" % i, i) for i in ids.tolist()]
    return memo.gather(places, bounds)


def _piece_batches(path: str, size: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        tokenizer, plain = _tokenizer(path), _plain()
        memo, added = Memo(_encoder(tokenizer)), _Added(tokenizer)
        for batch in slices(batches):
            ids, bounds = document_ids(batch, memo, plain, added)
            rows: list[tuple] = []
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), bounds[:-1].tolist(),
                                 bounds[1:].tolist(), strict=True):
                own = np.append(ids[a:b], np.uint32(END_ID)).astype("<u4")
                for at in range(0, len(own), size):
                    piece = own[at:at + size]
                    rows.append((doc, at, len(piece), zlib.crc32(piece.tobytes()), len(own),
                                 piece.view(np.int32) if with_ids else None))
            columns = list(zip(*rows, strict=True))
            out = [pa.array(c, pa.int64()) for c in columns[:5]]
            if with_ids:
                out.append(pa.array(columns[5], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(
                out, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][:len(out)])
    return run


def pieces(docs: DataFrame, path: str, size: int = SIZE, text: str = "text",
           doc_id: str = "doc_id", with_ids: bool = False) -> DataFrame:
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                    F.col(text).cast("string").alias("text"))
    return d.mapInArrow(_piece_batches(path, size, with_ids),
                        PIECES + (", ids array<int>" if with_ids else ""))


def shortest_pack_first(histogram: dict[int, int], size: int = SIZE) -> list[tuple]:
    """Placements (length, first rank, end rank, first sequence, copies per
    sequence, offset): rank r of the length stands in sequence
    first + (r - first rank) // copies at offset + length * ((r - first rank) % copies).

    A length opens at most two patterns and splits at most one, so there are at most
    3 * size patterns of at most sqrt(2 * size) different lengths: a bound on the
    placements that does not know the input's size.
    """
    packs: list[tuple[int, int, int]] = []             # (-room, first sequence, how many)
    placed, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left and packs and -packs[0][0] >= length:
            room, first, n = heapq.heappop(packs)
            room, now = -room, min(left, n)
            placed.append((length, rank, rank + now, first, 1, size - room))
            if room > length:
                heapq.heappush(packs, (length - room, first, now))
            if now < n:
                heapq.heappush(packs, (-room, first + now, n - now))
            left, rank = left - now, rank + now
        copies = size // length
        for n, each in ((left // copies, copies), (1, left % copies)):
            if n and each:
                placed.append((length, rank, rank + n * each, sequences, each, 0))
                if size > length * each:
                    heapq.heappush(packs, (length * each - size, sequences, n))
                sequences, rank = sequences + n, rank + n * each
    return placed


def pack(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """``cut`` (stored pieces) with sequence_id and offset."""
    buckets = bucket_count(cut.count(), BUCKET_ROWS)
    at = cut.withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    counts = stored(at.groupBy("length", "__bucket").agg(F.count(F.lit(1)).alias("__n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in
                 counts.groupBy("length").agg(F.sum("__n").alias("n")).collect()}  # <= size rows
    placed = cut.sparkSession.createDataFrame(
        shortest_pack_first(histogram, size),
        "__length long, __from long, __to long, __first long, __copies long, __offset long")
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    base = counts.select("length", "__bucket",
                         F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    order = Window.partitionBy("length", "__bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = at.withColumn("__row", F.row_number().over(order) - 1).join(
        base, ["length", "__bucket"]).withColumn("__rank", F.col("__base") + F.col("__row"))
    step = F.col("__rank") - F.col("__from")
    return ranked.join(
        F.broadcast(placed), (F.col("length") == F.col("__length")) & (step >= 0)
        & (F.col("__rank") < F.col("__to"))).withColumns({
            "sequence_id": F.col("__first") + F.expr("(__rank - __from) div __copies"),
            "offset": F.col("__offset") + F.col("length") * (step % F.col("__copies"))}).select(
        *cut.columns, "sequence_id", "offset")


def packed(docs: DataFrame, path: str, size: int = SIZE, **options) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens (, ids),
    sequence_id, offset."""
    return pack(stored(pieces(docs, path, size, **options), "pieces"), size)
