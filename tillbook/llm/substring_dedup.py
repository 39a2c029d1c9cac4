"""Substring dedup with repeated-phrase automata.

A window is ``window`` consecutive words of one document; each word goes that a
window covers whose words also start in a document with a smaller doc_id.

1. Phrases: of each window, the phrase of ``phrase`` words with the least hash
   stands for it (about one phrase in twenty words).  Equal windows have equal
   phrases, so windows that recur lie around phrases that recur.  One scan
   writes each document's phrase hashes; texts with the same words are joined
   into one, and phrases of one document only fall away.
2. Locating: a join of the fingerprints gives documents that hold recurring
   phrases the list of theirs; other documents are not read again.  Each shard of
   documents (a few MB of text) compiles one Aho-Corasick automaton of the phrases
   at the places so found and streams its documents through, which re-checks those
   places by their words and adds none.  The automata grow with the text, not with
   its square: a shard never meets phrases that are not in it.
3. Confirmation: windows whose least phrase was found carry a 128-bit hash of
   their words; the smallest doc_id per hash is worked out with map-side
   aggregation and joined back, and what a window of another document covers is
   removed.

A hot phrase, passage or copied text is never gathered: groups are reduced to
their smallest doc_id, and joins back are split by AQE.  The lists that are
gathered belong to one document.

Defined cases: a null text has no words; a null doc_id stands after every
other; rows that repeat a doc_id remove nothing from each other; repeated rows
are repeated in the result; other columns ride along in :func:`drop_repeats`.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import (
    SLICE_BYTES,
    distinct,
    slices,
    spans_to_array,
    stored,
    text_buffer,
    word_spans,
)

WINDOW, PHRASE = 50, 8
_TOP = np.uint64(2**64 - 1)


# --- inside tasks -----------------------------------------------------------
def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def rolling(x: np.ndarray, k: int, factor: int) -> np.ndarray:
    """Polynomial hash of ``x[i:i + k]`` at each i; the last k - 1 places are no whole runs.

    Runs of 1, 2, 4... are doubled up and put together by the bits of k.
    """
    def join(left, size, right, span):                  # runs of size, then of span
        out = left * np.uint64(pow(factor, span, 2**64))
        out[:max(0, len(x) - size)] += right[size:]
        return out

    out, size, block, span = None, 0, x, 1
    while span <= k:
        if k & span:
            out = block if out is None else join(out, size, block, span)
            size += span
        block = join(block, span, block, span)
        span *= 2
    return out


def sliding(x: np.ndarray, width: int, pick, back: bool = False) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over ``x[i:i + width]``, or ``x[i - width + 1:i + 1]``
    if ``back``; shorter runs at the end (start)."""
    out, span, n = x.copy(), 1, len(x)
    while span < width:
        s = min(span, width - span)
        if s < n:
            shifted = out.copy()
            if back:
                shifted[s:] = pick(out[s:], out[:n - s])
            else:
                shifted[:n - s] = pick(out[:n - s], out[s:])
            out = shifted
        span += s
    return out


class Words:
    """The words of a slice of texts, with hashes of words, phrases and windows."""

    def __init__(self, column: pa.Array, window: int, phrase: int):
        self.window, self.phrase = window, phrase
        data, off = text_buffer(column)
        starts, ends, self.bounds = word_spans(data, off)
        words = spans_to_array(data, starts, ends)
        self.codes, self.distinct = distinct(words)
        self.lengths = ends - starts
        self.n = len(self.codes)
        self.counts = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(column)), self.counts)
        # all words of a document joined by one space, documents by a newline
        plain = np.zeros(int(self.lengths.sum()) + self.n, np.uint8)
        self.ends = np.cumsum(self.lengths + 1) - 1      # place of the space after each word
        if self.n:
            body = np.ones(len(plain), bool)
            body[self.ends] = False
            plain[body] = np.frombuffer(words.buffers()[2], np.uint8)[:int(self.lengths.sum())]
            plain[self.ends] = 32
        self.plain = plain
        both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.distinct.to_pylist())),
                             np.uint64).reshape(-1, 2)
        self.hi, self.lo = both[self.codes, 0], both[self.codes, 1]
        if self.n >= phrase:
            self.phrases = np.clip(
                _mixed(rolling(self.hi, phrase, 0x9E3779B97F4A7C15)), 1, _TOP - np.uint64(1))
        else:
            self.phrases = np.zeros(self.n, np.uint64)
        self.valid = np.zeros(self.n, bool)              # a window starts here
        if self.n >= window:
            self.valid[:self.n - window + 1] = self.doc[:self.n - window + 1] == self.doc[window - 1:]
        self.least = sliding(self.phrases, window - phrase + 1, np.minimum)

    def joined(self, i: int) -> bytes:
        """Words of document i joined by one space."""
        a, b = self.bounds[i], self.bounds[i + 1]
        if a == b:
            return b""
        start = 0 if a == 0 else self.ends[a - 1] + 1
        return self.plain[start:self.ends[b - 1]].tobytes()

    def anchors(self) -> np.ndarray:
        """Places of phrases that are the least of some window."""
        least = np.where(self.valid, self.least, np.uint64(0))
        top = sliding(least, self.window - self.phrase + 1, np.maximum, back=True)
        return np.flatnonzero((top == self.phrases) & (top > 0))


def _scan(window: int, phrase: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = Words(batch.column("text"), window, phrase)
            at = w.anchors()
            hashes = [np.unique(x) for x in np.split(
                w.phrases[at].view(np.int64), np.searchsorted(at, w.bounds[1:-1]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("xx"), pa.array(w.counts.astype(np.int64)),
                 pa.array([sha256(w.joined(i)).digest() for i in range(len(w.counts))], pa.binary()),
                 pa.array(hashes, pa.list_(pa.int64()))], ["key", "xx", "n_words", "sha", "phrases"])
    return run


def _locate(window: int, phrase: int):
    """Automaton of a shard's recurring phrases over its documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick
        import zstandard

        pack = zstandard.ZstdCompressor(3).compress
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, "ztext", SLICE_BYTES // 4):
            texts = [unpack(z) for z in batch.column("ztext").to_pylist()]
            w = Words(pa.array(texts, pa.large_binary()), window, phrase)
            known = np.unique(np.concatenate(batch.column("phrases").to_numpy(zero_copy_only=False)))
            at = w.anchors()
            at = at[np.isin(w.phrases[at].view(np.int64), known)]
            # latin-1: one character per byte, so places are byte places
            breaks = w.bounds[1:-1][(w.bounds[1:-1] > 0)] - 1
            stream = w.plain.copy()
            stream[w.ends[breaks]] = 10                  # no phrase runs over a document's end
            text = "\n" + stream.tobytes().decode("latin-1")
            begin = np.zeros(w.n, np.int64)              # place before each word, in text
            begin[1:] = w.ends[:-1] + 1
            automaton = ahocorasick.Automaton()
            for p in at.tolist():
                body = text[begin[p] + 1:w.ends[p + phrase - 1] + 1]
                automaton.add_word(body, len(body))
            found = np.zeros(w.n, bool)
            if len(automaton):
                automaton.make_automaton()
                hits = np.array([(e - n, e) for e, n in automaton.iter(text)], np.int64).reshape(-1, 2)
                # whole words only: from a word's place to the end of the phrase-th word
                first = np.searchsorted(begin, hits[:, 0])
                ok = (first + phrase <= w.n)
                first, hits = first[ok], hits[ok]
                ok = (begin[first] == hits[:, 0]) & (w.ends[first + phrase - 1] == hits[:, 1])
                found[first[ok]] = True
            least = sliding(np.where(found, w.phrases, _TOP), window - phrase + 1, np.minimum)
            places = np.flatnonzero(w.valid & (least == w.least))
            hi = rolling(w.hi, window, 0xD1342543DE82EF95)[places].view(np.int64)
            lo = rolling(w.lo, window, 0xAF251AF3B0F025B5)[places].view(np.int64)
            cut = np.searchsorted(places, w.bounds)
            ends = pa.array(cut.astype(np.int32))
            where = (places - np.repeat(w.bounds[:-1], np.diff(cut))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (where, hi, lo)]
            out = pa.RecordBatch.from_arrays(
                [batch.column("sha"), batch.column("key"),
                 pa.array([pack(t) for t in texts], pa.binary()), *lists],
                ["sha", "key", "ztext", "at", "hi", "lo"])
            yield out.filter(pa.array(np.diff(cut) > 0))
    return run


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compress texts before they are shuffled."""
    import zstandard

    pack = zstandard.ZstdCompressor(3).compress
    for batch in slices(batches):
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("xx"), pa.array([pack(t or b"") for t in texts], pa.binary())],
            ["key", "xx", "ztext"])


def kept_words(words: list[bytes], starts: np.ndarray, window: int) -> tuple[int, bytes]:
    """(removed words, kept words joined by one space)."""
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + window, -1)
    gone = np.cumsum(step[:-1]) > 0
    return int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def _remove(window: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, "ztext", SLICE_BYTES // 4):
            done = [kept_words(unpack(z).split(), np.array(s, np.int64), window) for z, s in
                    zip(batch.column("ztext").to_pylist(), batch.column("starts").to_pylist(), strict=True)]
            out = [batch.column("sha"), pa.array([n for n, _ in done], pa.int64()),
                   pa.array([sha256(t).hexdigest() for _, t in done])]
            if with_text:
                out.append(pa.array([t.decode() for _, t in done], pa.string()))
            yield pa.RecordBatch.from_arrays(out, ["sha", "n_removed", "kept_sha256", "kept_text"][:len(out)])
    return run


# --- the plan ---------------------------------------------------------------
def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("key"),
                       F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("xx"),
                       F.col(text).cast("string").alias("text"))


def _several(least: str, most: str, none: str) -> str:
    """Some document of the group comes after its first one: a null key comes last."""
    return f"{least} < {most} OR ({none} AND {least} IS NOT NULL)"


def judged(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW,
           phrase: int = PHRASE, with_text: bool = False) -> DataFrame:
    """One row per document: key (doc_id), xx (hash of the
    text), n_words, n_removed, kept_sha256 and, ``with_text``, kept_text (null where
    nothing is removed)."""
    d = _keyed(docs, text, doc_id)
    rows = stored(d.mapInArrow(_scan(window, phrase), "key long, xx long, n_words long, "
                               "sha binary, phrases array<long>"), "phrases")
    # texts with the same words: the first by key stands for all
    texts = rows.filter(F.col("n_words") >= window).groupBy("sha").agg(
        F.min(F.struct(F.col("key").isNull().alias("none"), "key", "xx")).alias("r"), F.first("phrases").alias("phrases")).select(
        "sha", "r.key", "r.xx", "phrases")
    each = texts.select("sha", "key", "xx", F.explode("phrases").alias("h"))
    # what hot keys are joined with is stored first: then both sides of the join come
    # straight from shuffles, and AQE can split the partition of a hot key
    none = F.bool_or(F.col("key").isNull()).alias("none")
    recurring = stored(each.groupBy("h").agg(F.min("key").alias("a"), F.max("key").alias("b"), none)
                       .filter(_several("a", "b", "none")).select("h"), "recurring")
    known = each.join(recurring, "h").groupBy("sha", "key", "xx").agg(
        F.collect_list("h").alias("phrases")).withColumnsRenamed({"key": "known_key", "xx": "known_xx"})
    squeezed = d.mapInArrow(_squeeze, "key long, xx long, ztext binary")
    located = stored(
        squeezed.join(known, F.col("key").eqNullSafe(F.col("known_key")) & (F.col("xx") == F.col("known_xx"))).select("sha", "key", "ztext", "phrases").mapInArrow(
            _locate(window, phrase), "sha binary, key long, ztext binary, at array<int>, "
            "hi array<long>, lo array<long>"), "windows")
    windows = located.select("sha", "key", F.inline(F.arrays_zip("at", "hi", "lo")))
    least = stored(windows.groupBy("hi", "lo").agg(F.min("key").alias("first_key"), F.max("key").alias("b"), none)
                   .filter(_several("first_key", "b", "none")).select("hi", "lo", "first_key"), "window-owners")
    starts = windows.join(least, ["hi", "lo"]).filter("key > first_key OR key IS NULL").groupBy("sha").agg(
        F.collect_set("at").alias("starts"))
    changed = located.select("sha", "ztext").dropDuplicates(["sha"]).join(starts, "sha").mapInArrow(
        _remove(window, with_text), "sha binary, n_removed long, kept_sha256 string"
        + (", kept_text string" if with_text else ""))
    first = stored(texts.select("sha", F.col("key").alias("first_key"), F.lit(True).alias("windowed")).join(changed, "sha", "left"),
                   "judged-texts")
    both = rows.select("key", "xx", "n_words", "sha").join(first, "sha", "left")
    copy = F.col("windowed") & F.coalesce(F.col("key") > F.col("first_key"), F.col("first_key").isNotNull())
    out = {"n_removed": F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))),
           "kept_sha256": F.when(copy, F.sha2(F.lit(""), 256)).otherwise(
               F.coalesce("kept_sha256", F.lower(F.hex("sha"))))}
    if with_text:
        out["kept_text"] = F.when(copy, F.lit("")).otherwise(F.col("kept_text"))
    return both.select("key", "xx", "n_words", *[c.alias(n) for n, c in out.items()])


def removals(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    return judged(docs, **options).select(
        F.col("key").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def drop_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n_chars: str = "n_chars",
                 **options) -> DataFrame:
    """``docs`` with the kept words, joined by one space, as the text of documents that
    lose words (and its length as their n_chars, if there is such a column); the others
    keep their row as it is.  No row is dropped."""
    found = judged(docs, text, doc_id, with_text=True, **options).filter("n_removed > 0").groupBy(
        F.col("key").alias("found_key"), F.col("xx").alias("found_xx")).agg(F.first("kept_text").alias("kept"))
    # the input row travels whole in one column, so its names meet none of these
    joined = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("long").alias("key"),
                         F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("xx")).join(
        found, F.col("key").eqNullSafe(F.col("found_key")) & (F.col("xx") == F.col("found_xx")), "left")
    new = {text: F.coalesce("kept", F.col("row")[text])}
    if n_chars in docs.columns:
        kind = docs.schema[n_chars].dataType
        new[n_chars] = F.coalesce(F.char_length("kept").cast(kind), F.col("row")[n_chars])
    return joined.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
