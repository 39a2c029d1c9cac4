"""The registered queries, and the pipeline against its brute-force stages."""
import pytest
from oracle import compare
from pyspark.sql import functions as F

import __spark_entry__ as E
import brute
import corpus_pipeline
from tillbook.llm import quality, registry
from tillbook.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_operators_and_the_pipeline_are_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(registry.QUERIES[name](spark, SF), SF, registry.ORACLE[name])
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_query_returns_every_row(spark, name):
    got = registry.QUERIES[name](spark, SF)
    if name == "op8_url_filter":
        assert got.count() == len(brute.rows(SF, "pages", "page_id"))
    else:
        assert got.select("doc_id").distinct().count() == len(brute.rows(SF, "documents", "doc_id"))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    by_name = dict(corpus_pipeline.STAGES)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = {r.doc_id: r.predicted for r in quality.judged(docs, labels).collect()}
    now = stored(by_name["quality"](spark, docs, SF), "test")
    assert now.columns == docs.columns
    assert {r.doc_id for r in now.select("doc_id").collect()} == {i for i, p in scores.items() if p}

    def pairs(df):
        return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    exact = stored(by_name["exact_dedup"](spark, now, SF), "test")
    groups = brute.exact_groups(pairs(now))
    assert {i for i, _ in pairs(exact)} == {i for i, g in groups.items() if g[0] == i}
    near = stored(by_name["simhash_near_dedup"](spark, exact, SF), "test")
    groups = brute.near_groups(pairs(exact))
    assert {i for i, _ in pairs(near)} == {i for i, g in groups.items() if g[1] == i}
    cut = stored(by_name["substring_dedup"](spark, near, SF), "test")
    want = brute.substring(pairs(near))
    again = brute.substring(pairs(cut))
    assert {i: w[0] - w[1] for i, w in want.items()} == {i: w[0] for i, w in again.items()}
    assert cut.columns == docs.columns and cut.filter("n_chars != char_length(text)").count() == 0
    assert {i: t for i, t in pairs(cut) if want[i][1] == 0} == {i: t for i, t in pairs(near) if want[i][1] == 0}
    packed = by_name["packing"](spark, cut, SF)
    assert packed.select("doc_id").distinct().count() == cut.count()


def test_pipeline_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and out.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
