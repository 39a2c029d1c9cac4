"""Quality classifier and language ID: held-out accuracy, formulas, edge cases."""
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from made import docs_of  # noqa: F401
from tillbook.llm import langid, quality
from tillbook.llm.common import held_out

SF = "/root/testdata/sf0.01"
EDGES = [(1, None), (2, ""), (3, " \n"), (4, "x"), (5, "123 ... !!"), (6, "the " * 60_000), (7, "中文 字")]


def out_of(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_fold(spark):
    rows = spark.range(200).withColumn("h", held_out("id")).collect()
    assert all(r.h == out_of(r.id) for r in rows)


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def machine(tables):
    return quality.train(*tables)


def test_quality_on_held_out_labels(tables, machine):
    docs, _ = tables
    truth = dict(brute.rows(SF, "labels", "doc_id, quality"))
    got = {r.doc_id: r.score for r in quality.scores(docs, machine).collect()}
    assert set(got) == {i for i, in brute.rows(SF, "documents", "doc_id")}
    fold = [i for i in truth if out_of(i)]
    assert np.mean([(got[i] >= quality.THRESHOLD) == truth[i] for i in fold]) > 0.95
    good, bad = [[got[i] for i in fold if truth[i] == y] for y in (1, 0)]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97


def test_quality_never_sees_the_held_out_fold(tables, machine):
    docs, labels = tables
    flipped = labels.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(
        F.col("quality")))
    again = quality.train(docs, flipped)
    assert again.bias == machine.bias and np.array_equal(again.factors, machine.factors)


def test_quality_ignores_lang_source_and_id(tables, machine):
    docs, _ = tables
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None), "doc_id": -F.col("doc_id")})
    a = {r.doc_id: r.score for r in quality.scores(docs, machine).collect()}
    b = {-r.doc_id: r.score for r in quality.scores(other, machine).collect()}
    assert a == b


def test_sum_of_squares_identity(machine):
    text = pa.array(["of the same words and the other Words !!", "", "a a a"])
    b, i, x = machine.rows(*quality.features(text, pa.array([None, 0, 5], pa.int64())))
    got = machine.logits(b, i, x)
    for d in range(3):
        n = range(b[d], b[d + 1])
        want = machine.bias + sum(float(machine.weights[i[p]] * x[p]) for p in n) + sum(
            float(machine.factors[i[p]] @ machine.factors[i[q]] * x[p] * x[q]) for p in n for q in n if p < q)
        assert got[d] == pytest.approx(want, abs=1e-3)


def test_quality_edges_and_columns(docs_of, machine):
    df = docs_of(EDGES, {"score": F.lit("s"), "label": F.lit(3), "__doc": F.lit(4)})
    got = quality.scores(df, machine).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    assert quality.keep_good(df, machine, threshold=0.0).collect() == df.collect()
    assert quality.keep_good(df.drop("n_chars"), machine, threshold=1.1).columns == df.drop("n_chars").columns


def test_quality_without_labels_and_with_odd_ones(spark, docs_of):
    df = docs_of([(i, f"w{i}") for i in range(20)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.judged(df, none).collect()} == {0.5}
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (99, 0), (3, 1)], "doc_id long, quality int")
    assert quality.judged(df, odd).count() == 20
    assert quality.judged(df.limit(0), odd).collect() == []


def test_quality_sample_is_bounded(tables):
    docs, labels = tables
    model = quality.train(docs.unionByName(docs), labels, max_rows=40)
    assert model.edges.shape == (quality.N_STATS, quality.BINS - 1)


# --- language ID ------------------------------------------------------------
def plain_bits(words, probe):
    """Code length of ``probe`` after learning ``words``, byte by byte."""
    seen = defaultdict(lambda: defaultdict(int))
    for w in words:
        w = b" " + w + b" "
        for p in range(1, len(w)):
            for o in range(min(p, langid.ORDER) + 1):
                seen[w[p - o:p]][w[p]] += 1
    bits, probe = 0.0, b" " + probe + b" "
    for p in range(1, len(probe)):
        for o in range(min(p, langid.ORDER), -1, -1):
            after = seen.get(probe[p - o:p])
            if after is None:
                continue
            total, kinds = sum(after.values()), len(after)
            if probe[p] in after:
                bits -= math.log2(after[probe[p]] / (total + kinds))
                break
            bits -= math.log2(kinds / (total + kinds))
        else:
            bits += 8
    return bits


@pytest.mark.parametrize("seed", range(3))
def test_code_lengths(seed):
    rng = random.Random(seed)
    make = lambda: bytes(rng.choice(b"abcde") for _ in range(rng.randint(1, 7)))
    words, probes = [make() for _ in range(60)], [make() for _ in range(40)] + [b"zzz", b"a" * 50, b"abq"]
    kinds = sorted(set(words))
    tree = langid.Tree.learn(kinds, np.array([words.count(w) for w in kinds]))
    got = langid.code_lengths({"x": tree}, probes)[:, 0]
    assert got == pytest.approx([plain_bits(words, p) for p in probes])


def test_language_on_held_out_documents(tables):
    docs, _ = tables
    truth = dict(brute.rows(SF, "documents", "doc_id, lang"))
    got = {r.doc_id: r for r in langid.judged(docs).collect()}
    fold = [i for i in truth if out_of(i)]
    assert set(got) == set(truth) and all(got[i].held_out == out_of(i) for i in truth)
    assert np.mean([got[i].lang_pred == truth[i] for i in fold]) > 0.98


def test_language_learns_outside_the_fold_from_text_and_lang_alone(tables):
    docs, _ = tables
    changed = docs.withColumn("lang", F.when(held_out("doc_id"), F.lit("zz")).otherwise(F.col("lang"))) \
        .withColumn("source", F.lit("other"))
    rows = lambda df: sorted(map(tuple, langid.judged(df, 60).collect()))
    assert rows(docs) == rows(changed)


def test_language_edges(docs_of):
    train = [(i, "the cat and the dog" if i % 2 else "der hund und die katze") for i in range(100, 140)]
    df = docs_of(EDGES + train, {"lang": F.expr(
        "CASE WHEN doc_id < 100 THEN NULL WHEN doc_id % 2 = 1 THEN 'en' ELSE 'de' END"), "letter": F.lit(1)})
    got = {r.doc_id: r for r in langid.judged(df).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 5)] == ["und"] * 4 and got[1].score == 0
    assert got[6].lang_pred == "en" and got[7].lang_pred in {"de", "en"} and 0 <= got[7].score <= 1
    assert all(got[i].lang_pred == ("en" if i % 2 else "de") for i, _ in train)


def test_language_without_labels(docs_of):
    df = docs_of([(1, "text"), (None, "more")]).withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in langid.judged(df).collect()} == {("und", 0.0)}
    assert langid.judged(df.limit(0)).collect() == []
