"""Language ID by prediction by partial matching.

Per language a variable-order context tree over the bytes of words: every word,
lower-cased and with a space at both ends, is coded byte by byte; a byte's
contexts are up to ``ORDER`` bytes before it, back to the word's start.  With n
the count of a byte after a context, T the context's total and q its number of
different bytes, the byte costs -log2(n / (T + q)) bits in the longest known
context where it was seen, plus -log2(q / (T + q)) bits of escape for each
longer known context; a byte unknown without context costs its escape and 8
bits.  Statistics are frozen after learning, and a text's code length is the
exact sum over all its words; the language with the least wins.

As no context reaches over a word's start, a word costs the same wherever it
stands: the distinct words of a slice are coded once and their lengths gathered.

Learning uses a bounded sample: the ``rows_per_language`` rows of each language
with the least hash of doc_id outside the held-out fold.

Defined cases: ``und`` with score 0 for a null text, one without a letter, and
where no language could be learned; ties go to the first language by name;
repeated rows get the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillbook.llm.common import SPACES, held_out, place, share_below, slices, stored, words_of

ORDER = 4
#: Labelled rows of each language that are learned from, at most.
ROWS_PER_LANGUAGE = 500
UNKNOWN = "und"


def framed(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the words, lower-cased, a space before and after each."""
    texts = [b" " + w.decode().lower().encode() + b" " for w in words]
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=off[1:])
    return np.frombuffer(b"".join(texts), np.uint8), off


def coded(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(places of coded bytes, known bytes before each, keys by order): a key is the
    order, the context's bytes and the byte in one number."""
    depth = np.arange(len(data)) - np.repeat(off[:-1], np.diff(off))
    at = np.flatnonzero(depth > 0)                       # the first space is not coded
    wide = data.astype(np.int64)
    keys = []
    for order in range(ORDER + 1):
        key = wide[at]
        for back in range(1, order + 1):
            key = key | wide[np.maximum(at - back, 0)] << (8 * back)
        keys.append(key | order << 8 * (ORDER + 1))
    return at, depth[at], keys


class Tree:
    """Frozen statistics of one language: bits of (context, byte) and of escapes."""

    def __init__(self, pairs: np.ndarray, bits: np.ndarray, contexts: np.ndarray, escapes: np.ndarray):
        self.pairs, self.bits, self.contexts, self.escapes = pairs, bits, contexts, escapes

    def arrays(self) -> tuple:
        return self.pairs, self.bits, self.contexts, self.escapes

    @classmethod
    def learn(cls, words: list[bytes], times: np.ndarray) -> Tree:
        data, off = framed(words)
        at, depth, keys = coded(data, off)
        weight = np.repeat(times, np.diff(off) - 1)
        every = np.concatenate([k[depth >= o] for o, k in enumerate(keys)])
        counts = np.concatenate([weight[depth >= o] for o in range(ORDER + 1)])
        pairs, where = np.unique(every, return_inverse=True)
        n = np.bincount(where, counts, len(pairs))
        contexts, inside = np.unique(pairs >> 8, return_inverse=True)
        total = np.bincount(inside, n, len(contexts))
        kinds = np.bincount(inside, minlength=len(contexts))
        return cls(pairs, -np.log2(n / (total + kinds)[inside]), contexts, -np.log2(kinds / (total + kinds)))

    def lengths(self, off: np.ndarray, depth: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
        """Bits of each word."""
        bits = np.zeros(len(depth))
        open_ = np.arange(len(depth))
        for order in range(ORDER, -1, -1):
            mine = depth[open_] >= order
            now = open_[mine]
            found = self._find(self.pairs, keys[order][now])
            hit = found >= 0
            bits[now[hit]] += self.bits[found[hit]]
            missed = now[~hit]
            known = self._find(self.contexts, keys[order][missed] >> 8)
            bits[missed[known >= 0]] += self.escapes[known[known >= 0]]
            open_ = np.concatenate([open_[~mine], missed])
        bits[open_] += 8
        return np.add.reduceat(bits, off[:-1] - np.arange(len(off) - 1)) if len(off) > 1 else bits

    @staticmethod
    def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return np.where(table[at] == keys, at, -1)


def code_lengths(trees: dict[str, Tree], words: list[bytes]) -> np.ndarray:
    """Bits of each word (rows) under each language (columns, by name)."""
    if not words or not trees:
        return np.zeros((len(words), len(trees)))
    data, off = framed(words)
    _, depth, keys = coded(data, off)
    return np.stack([trees[name].lengths(off, depth, keys) for name in sorted(trees)], 1)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
          rows_per_language: int = ROWS_PER_LANGUAGE) -> dict[str, Tree]:
    """Trees by language, from the words of the sampled rows."""
    d = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(lang).alias("lang"),
                    F.col(text).cast("string").alias("text"))
    d = d.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("id"))
    # few rows of a language stay before they are ranked, and ids only: no task sees them all;
    # the counts are stored, so that their size is known and rows need no shuffle to meet them
    per = stored(d.groupBy("lang").agg(F.count(F.lit(1)).alias("of")), "language-counts")
    few = d.select("id", "lang", F.xxhash64("text").alias("t")).join(per, "lang").filter(
        place("id") < share_below(rows_per_language, F.col("of")))
    order = Window.partitionBy("lang").orderBy(place("id"), "id", "t")
    pick = few.select("id", "lang", "t").distinct().withColumn(
        "n", F.row_number().over(order)).filter(F.col("n") <= rows_per_language)
    # a stored table of known size: Catalyst broadcasts it below the threshold, so that no
    # text is shuffled, and shuffles it if there are that many languages
    pick = stored(pick.select("id", "lang", "t"), "language-sample")
    sample = d.withColumn("t", F.xxhash64("text")).join(pick, ["id", "lang", "t"]).select(
        "id", "lang", "text").distinct()
    counts = sample.select("lang", F.explode(F.split("text", f"[{SPACES}]+")).alias("word")).filter(
        "word != ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")).toArrow()
    trees = {}
    names = counts["lang"].to_numpy()
    for name in sorted(set(names)):
        own = counts.filter(pa.array(names == name)).sort_by("word")
        trees[name] = Tree.learn(own["word"].cast(pa.binary()).to_pylist(), own["n"].to_numpy())
    return trees


def predictions(docs: DataFrame, trees: dict[str, Tree], text: str = "text",
                doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score): the score is the language's share of 2^-bits."""
    names = [*sorted(trees), UNKNOWN]
    model = docs.sparkSession.sparkContext.broadcast(        # bounded by the sample
        {name: tree.arrays() for name, tree in trees.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = {name: Tree(*arrays) for name, arrays in model.value.items()}
        for batch in slices(batches):
            codes, words, bounds = words_of(batch.column("text"))
            bits = code_lengths(trees, words.to_pylist())[codes]
            total = np.zeros((len(codes) + 1, len(trees)))
            np.cumsum(bits, axis=0, out=total[1:])
            doc = total[bounds[1:]] - total[bounds[:-1]]
            known = batch.column("letter").to_numpy(zero_copy_only=False).astype(bool)
            best, score = np.full(len(doc), len(trees)), np.zeros(len(doc))
            if trees:
                best = np.where(known, doc.argmin(1), best)
                rest = np.exp2(-np.minimum(doc - doc.min(1, keepdims=True), 1000)).sum(1)
                score = np.where(known, 1 / rest, 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(names, object)[best], pa.string()),
                 pa.array(score)], ["doc_id", "lang_pred", "score"])
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return d.withColumn("letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def judged(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    return predictions(docs, train(docs, rows_per_language=rows_per_language)).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
