"""Byte-level BPE encoding and decoding with the tokenizers library.

A rank file (token bytes, rank) becomes a BPE model over the byte alphabet of
byte-level tokenizers: each byte stands as one printable character, and every
split of a token into two tokens is a merge, in rank order, so merges are
applied lowest rank first as the rank file means them.  A piece that is a token
itself is that token.  Texts are split by the given pattern, each match is
encoded on its own, over Arrow batches.

Decoding reverses the byte table per token and joins the bytes before any UTF-8
is read, so characters split over tokens come back whole.  :func:`offsets` maps
token ends to character positions: a token that ends inside a character points
at the start of that character.

Defined cases: null and empty texts have no ids and decode to no bytes; ids of
texts with invalid surrogates cannot occur (texts are UTF-8); special tokens'
strings are ordinary text; repeated rows, ties and other columns are untouched.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import slices, text_buffer
from tillbook.llm.tokens import Memo, encode_words, one_thread, segments, spread


def byte_characters() -> dict[int, str]:
    """The byte alphabet of byte-level tokenizers: printable bytes stand for
    themselves, the others follow from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in table]
    return table | {b: chr(256 + i) for i, b in enumerate(hidden)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """Every split of every token into two tokens, by rank of the token.

    Equal ranks go leftmost first in the rank file's sense.  Two overlapping
    pairs can make the same token only if it has a period: the split after the
    period is the left one, and listed first.
    """
    out = []
    for token, rank in ranks.items():
        out += [(rank, token[i:] != token[:-i], i, token)
                for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
    return [(token[:i], token[i:]) for _, _, i, token in sorted(out)]


class ByteBPE:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        self.ranks = read_ranks(path)
        self.bytes_of = {i: t for t, i in self.ranks.items()}
        chars = byte_characters()
        show = lambda t: "".join(map(chars.__getitem__, t))
        self.tokenizer = Tokenizer(models.BPE(
            vocab={show(t): i for t, i in self.ranks.items()},
            merges=[(show(a), show(b)) for a, b in merges_of(self.ranks)],
            ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])

        # a word that follows a space starts with a token that has it
        self.starts = np.zeros(max(self.bytes_of) + 1, bool)
        self.starts[[i for i, t in self.bytes_of.items() if t.startswith(b" ")]] = True

    def segments(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids) of segments."""
        return encode_words(self.tokenizer, words, self.starts, last=False)

    def encode(self, texts: list[bytes]) -> list[list[int]]:
        return [self.tokenizer.encode(t.decode(), add_special_tokens=False).ids for t in texts]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def offsets(model: ByteBPE, text: str) -> tuple[list[int], list[int]]:
    """(ids, ends): the character position that each token ends at."""
    ids = model.encode([text.encode()])[0]
    raw = np.frombuffer(text.encode(), np.uint8)
    starts = (raw & 0xC0) != 0x80                        # first byte of each character
    ends = np.cumsum([len(model.bytes_of[i]) for i in ids], dtype=np.int64)
    whole = np.append(np.cumsum(starts) - starts, len(text))
    # inside a character, the count of characters begun is one too many
    inside = np.append(~starts, False)
    return ids, (whole[ends] - inside[ends]).tolist()


class Shown:
    """What each id stands for, as bytes: text of ids is one gather."""

    def __init__(self, table: dict[int, bytes]):
        known = [table.get(i, b"") for i in range(max(table) + 1)]
        self.size = np.array([len(x) for x in known], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.raw = np.frombuffer(b"".join(known), np.uint8)

    def of(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids in order, bounds of documents in them)."""
        return spread(self.start[ids], self.size[ids], self.raw, ends)


def _digest_batches(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        model = ByteBPE(path, pattern)
        memo = Memo(model.segments)
        shown = Shown({i: f"{i},".encode() for i in model.bytes_of}), Shown(model.bytes_of)
        for batch in slices(batches):
            codes, words, bounds = segments(*text_buffer(batch.column("text")))
            ids, ends = memo.gather(memo(words)[codes], bounds)
            digests = []
            for table, trim in zip(shown, (1, 0), strict=True):
                raw, at = table.of(ids, ends)
                raw = memoryview(raw)
                digests.append([sha256(raw[a:max(a, b - trim)]).hexdigest()
                                for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(ends)),
                 pa.array(digests[0]), pa.array(digests[1])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text",
            doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256."""
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                    F.col(text).cast("string").alias("text"))
    return d.mapInArrow(_digest_batches(path, pattern), "doc_id long, n_tokens long, "
                        "ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text",
           into: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text`` in the column ``into`` (array of int)."""
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        memo = Memo(ByteBPE(path, pattern).segments)
        for batch in slices(batches, text):
            codes, words, bounds = segments(*text_buffer(batch.column(text)))
            ids, ends = memo.gather(memo(words)[codes], bounds)
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)),
                                             pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, into])
    keep = docs.drop(into)
    return keep.mapInArrow(run, StructType([*keep.schema, StructField(
        into, ArrayType(IntegerType(), False), False)]))


def decode(encoded: DataFrame, path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """``encoded`` with the text of ``ids`` in ``into``; bytes that are no UTF-8 (ids
    cut inside a character) become U+FFFD, null ids null."""
    from pyspark.sql.types import StringType, StructField, StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {i: t for t, i in read_ranks(path).items()}
        for batch in batches:
            texts = [None if x is None else b"".join(map(table.__getitem__, x)).decode(
                errors="replace") for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             [*batch.schema.names, into])
    keep = encoded.drop(into)
    return keep.mapInArrow(run, StructType([*keep.schema, StructField(into, StringType())]))
