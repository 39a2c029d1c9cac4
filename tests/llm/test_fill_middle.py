"""Fill-in-middle against a document-by-document version, and its round trip."""
import random
from hashlib import sha256

from pyspark.sql import functions as F

import brute
from made import docs_of  # noqa: F401
from tillbook.llm import fill_middle

EDGES = [(0, None), (1, ""), (2, "a"), (3, "é"), (4, "中文 <P> x"), (5, "<S>"), (6, "<P"), (7, "<M <S"),
         (8, "><P"), (9, "🙂🙂é́"), (10, "word é " * 60_000), (11, "<<<>>><P<S<M"), (12, "P><S"),
         (-5, "negative id"), (2**63 - 1, "last id"), (None, "no id at all"), (13, "x\x00y"), (14, "  \n\t ")]


def texts(seed, n):
    rng = random.Random(seed)
    alphabet = ["a", "é", "中", "🙂", "<", ">", "P", "S", "M", "<P", "S>", " "]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(12))) for _ in range(n)]


def held(df, docs):
    got = {(r.doc_id, r.restored): r for r in fill_middle.restored(fill_middle.transformed(df)).collect()}
    for i, t in docs:
        r = got[i, t or ""]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute.fill_middle(i, t), (i, t)


def test_edges(docs_of):
    held(docs_of(EDGES), EDGES)
    held(docs_of(EDGES).coalesce(1), EDGES)


def test_many_short_texts_in_one_batch(docs_of):
    docs = list(enumerate(texts(5, 3000)))
    held(docs_of(docs).coalesce(1), docs)
    assert {brute.fill_middle(i, t)[1] for i, t in docs} == {"plain", "psm", "spm"}


def test_digests_repeated_rows_and_clashing_columns(docs_of):
    docs = [(1, "some text here"), (1, "some text here"), (2, "other")]
    df = docs_of(docs).withColumns({"h1": F.lit("x"), "n": F.lit(9), "output": F.lit(None), "form": F.lit(0)})
    got = fill_middle.digests(df).collect()
    want = [(i, *brute.fill_middle(i, t)[:4], sha256(brute.fill_middle(i, t)[4].encode()).hexdigest(),
             sha256(t.encode()).hexdigest()) for i, t in docs]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_other_column_names_and_empty_table(spark, docs_of):
    df = docs_of([(7, "renamed columns")]).withColumnsRenamed({"text": "body", "doc_id": "key"})
    assert fill_middle.digests(df, "body", "key").first().n == 15
    none = spark.createDataFrame([], "doc_id long, text string")
    assert fill_middle.digests(none).collect() == []


def test_parts_that_look_like_markers_at_their_edges():
    """A part's end and a marker's start never make a marker of their own."""
    import numpy as np
    parts = ["", "<", "<P", "P>", ">", "S>", "M", "<<", ">>"]
    docs = [(a, m, z) for a in parts for m in parts for z in parts
            if not any(x in a + m + z for x in ("<P>", "<S>", "<M>")) and a + m + z]
    for form in (1, 2):
        data = np.frombuffer("".join(a + m + z for a, m, z in docs).encode(), np.uint8)
        sizes = np.array([[len(x) for x in d] for d in docs], np.int64)
        off = np.append(0, np.cumsum(sizes.sum(1)))
        cut = off[:-1, None] + np.cumsum(sizes, axis=1)[:, :2]
        forms = np.full(len(docs), form)
        out, out_off = fill_middle.scatter(data, off, cut, forms)
        back, back_off = fill_middle.gathered(out, out_off, forms)
        assert bytes(back) == bytes(data) and list(back_off) == list(off)
