"""Token ids of whole texts, worked out once per distinct segment of a batch.

Both tokenizers split text before they merge, so ids of a text are the ids of
its segments in order, wherever a segment ends at a place that the split never
spans.  :func:`segments` finds such places with numpy; only the distinct
segments of a batch go through the tokenizer, and a batch's ids are gathered
from theirs.
"""

from __future__ import annotations

import os
import re
from itertools import chain, repeat

import numpy as np

from tillbook.llm.common import _flags, binary_array, distinct, text_buffer

#: Bytes of segments and their values that a task remembers; each has about ENTRY more.
MEMO_BYTES, ENTRY = 40 << 20, 160

#: Words that one call of the tokenizer encodes together.
JOINED = 200

_LETTER = _flags(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_SIGN = _flags([0x97, 0xB7])               # U+00D7 and U+00F7, after the byte C3
_PRINT = _flags(range(33, 127))
_BREAK = _flags(b" \n")
_PUNCT = _flags(b",.!?;:*%$#&|")
#: A space and letters of ASCII or U+00C0 to U+00FF.
_WORD = re.compile(rb" (?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+")


def cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sorted byte positions where segments start or end, 0 and the end included.

    A cut stands before a space or newline that follows a printable ASCII
    character or one of U+00C0 to U+00FF, and between a letter of either range
    and one of ``,.!?;:*%$#&|``; neither the split patterns nor Unicode
    composition reach over these.
    """
    n = len(data)
    mark = np.zeros(n + 1, bool)
    if n > 1:
        before, here = data[:-1], data[1:]
        letter = _LETTER[before]
        latin = np.zeros(n - 1, bool)
        latin[1:] = data[:-2] == 0xC3
        mark[1:n] = _BREAK[here] & (_PRINT[before] | latin)
        mark[1:n] |= _PUNCT[here] & (letter | latin & ~_SIGN[before])
    mark[off] = True
    mark[0] = mark[n] = True
    return np.flatnonzero(mark)


def segments(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(code of each segment, distinct segments, bounds): document ``i`` is the
    segments ``bounds[i]:bounds[i + 1]`` put together."""
    if not len(data):
        return np.zeros(0, np.int32), [], np.zeros(len(off), np.int64)
    at = cuts(data, off)
    codes, words = distinct(binary_array(at, data))
    raw, edges = text_buffer(words)
    raw, edges = raw.tobytes(), edges.tolist()           # much quicker than to_pylist
    return codes, [raw[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)], np.searchsorted(at, off)


def one_thread() -> None:
    """A task has one core: the tokenizer's own threads would take those of others."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


class Memo:
    """Values of distinct segments in one growing array, kept for a task up to a bound of
    bytes.  When it is full, segments that were met again since it was last full stay."""

    def __init__(self, compute, dtype=np.uint32, limit: int = MEMO_BYTES):
        self.compute, self.limit = compute, limit       # compute: segments -> (sizes, values)
        self.known: dict[bytes, int] = {}               # place of a segment's start in off
        self.values, self.off = np.zeros(1024, dtype), np.zeros(1024, np.int64)
        self.again, self.bytes = np.zeros(1024, bool), 0

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """The place of each segment, good until the next call."""
        if self.bytes > self.limit:
            self._keep()
        place = self.known.get
        at = np.fromiter(map(place, words, repeat(-1)), np.int64, len(words))
        self.again[at[at >= 0]] = True
        new = np.flatnonzero(at < 0)
        if len(new):
            missing = [words[i] for i in new.tolist()]
            at[new] = self.add(missing, *self.compute(missing))
        return at

    def add(self, words: list[bytes], sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
        n = len(self.known)
        end = self.off[n] + len(values)
        self.values = _room(self.values, end)
        self.values[self.off[n]:end] = values
        self.off = _room(self.off, n + len(words) + 1)
        self.again = _room(self.again, n + len(words))
        self.again[n:n + len(words)] = False
        self.off[n + 1:n + len(words) + 1] = self.off[n] + np.cumsum(sizes)
        at = np.arange(n, n + len(words))
        self.known.update(zip(words, at.tolist(), strict=True))
        self.bytes += sum(map(len, words)) + values.nbytes + ENTRY * len(words)
        return at

    def fixed(self, word: bytes, value: int) -> int:
        """The place of a segment whose one value is given."""
        if word not in self.known:
            self.add([word], np.ones(1, np.int64), np.array([value], self.values.dtype))
        return self.known[word]

    def _keep(self) -> None:
        old, off, again = self.known, self.off, self.again
        kept = [(w, i) for w, i in old.items() if again[i]]
        places = np.array([i for _, i in kept], np.int64)
        sizes = off[places + 1] - off[places]
        if int(sizes.sum()) * self.values.itemsize + sum(len(w) + ENTRY for w, _ in kept) > self.limit // 2:
            kept, places, sizes = [], places[:0], sizes[:0]
        values, _ = spread(off[places], sizes, self.values, np.zeros(1, np.int64))
        self.known, self.bytes = {}, 0
        self.off[0] = 0
        self.add([w for w, _ in kept], sizes, values)

    def gather(self, places: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values of the segments at these places in order, bounds of documents in them)."""
        starts = self.off[places]
        return spread(starts, self.off[places + 1] - starts, self.values, bounds)


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    out = np.zeros(max(size, 2 * len(array)), array.dtype)
    out[:len(array)] = array
    return out


def encode_words(tokenizer, words: list[bytes], marked: np.ndarray, last: bool
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, ids) of segments.

    Segments of a space and plain letters are words of their own wherever they stand (a cut
    is allowed between them), so many are encoded as one text.  ``marked`` ids, the
    ``last`` (else first) of each word, part them again; if their number is not that of
    the words, they are encoded one by one, as all other segments are.
    """
    plain = [i for i, w in enumerate(words) if _WORD.fullmatch(w)] if len(marked) else []
    groups = [plain[i:i + JOINED] for i in range(0, len(plain), JOINED)]
    texts = [b"".join([words[i] for i in g]).decode() for g in groups]
    order, sizes, ids = [], [], []                       # in the order of encoding
    for group, found in zip(groups, tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        flat = np.array(found.ids, np.uint32)
        at = np.flatnonzero(marked[flat])
        edges = np.append(0, at + 1) if last else np.append(at, len(flat))
        if len(at) == len(group) and edges[0] == 0 and edges[-1] == len(flat):
            order += group
            sizes.append(np.diff(edges))
            ids.append(flat)
    alone = np.ones(len(words), bool)
    alone[order] = False
    rest = np.flatnonzero(alone).tolist()
    one = [e.ids for e in tokenizer.encode_batch_fast([words[i].decode() for i in rest], add_special_tokens=False)]
    sizes.append(np.fromiter(map(len, one), np.int64, len(one)))
    ids.append(np.fromiter(chain.from_iterable(one), np.uint32, int(sizes[-1].sum())))
    size, start = np.zeros((2, len(words)), np.int64)
    size[order + rest] = found_sizes = np.concatenate(sizes)
    start[order + rest] = np.cumsum(found_sizes) - found_sizes
    return size, spread(start, size, np.concatenate(ids), np.zeros(1, np.int64))[0]


def spread(starts: np.ndarray, sizes: np.ndarray, values: np.ndarray, bounds: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray]:
    """(the runs of values one after another, bounds of documents in them)."""
    ends = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    at = np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])
    return values[at], ends[bounds]
