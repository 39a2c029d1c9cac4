"""Exact, near and substring dedup against brute force, and their edge cases."""
import random

import pytest
from pyspark.sql import functions as F

import brute
from made import docs_of  # noqa: F401
from tillbook.llm import components, exact_dedup, simhash, substring_dedup

SF = "/root/testdata/sf0.001"
EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "a b"), (6, "A b"), (7, "a  b"), (8, "ab"),
         (9, "é ß 中 文 x"), (10, "word " * 60_000), (11, "word " * 60_000), (12, "same same same")]


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


# --- exact dedup ------------------------------------------------------------
def exact(df, **options):
    return {r.doc_id: (r.keep_id, r.group_size, r.text_sha256)
            for r in exact_dedup.groups(df, **options).collect()}


def test_exact_edges(docs_of):
    assert exact(docs_of(EDGES)) == brute.exact_groups(EDGES)


def test_exact_few_counters_split_heavy_digests(docs_of):
    rng = random.Random(3)
    docs = [(i, rng.choice(["hot text", "hot  text", "warm", f"rare {i}", f"pair {i // 2}"]))
            for i in range(600)]
    want = brute.exact_groups(docs)
    for counters in (1, 3, 1000):
        assert exact(docs_of(docs).repartition(5), counters=counters) == want


def test_heavy_candidates_include_every_frequent_digest(docs_of):
    docs = [(i, "hot" if i % 3 == 0 else f"t{i}") for i in range(900)]
    rows = exact_dedup.digests(docs_of(docs).repartition(7))
    got = exact_dedup.heavy_candidates(rows, 4)
    hot = rows.filter(F.col("doc_id") == 0).first()["digest"]
    assert got.count() <= 4 and bytes(hot) in {bytes(r[0]) for r in got.collect()}


def test_misra_gries_bound():
    rng = random.Random(1)
    stream = [rng.choice([b"a", b"a", b"b", bytes([rng.randrange(256), rng.randrange(256)])])
              for _ in range(4000)]
    counts = {}
    for at in range(0, len(stream), 100):
        part = stream[at:at + 100]
        keys = sorted(set(part))
        exact_dedup.misra_gries(counts, keys, [part.count(k) for k in keys], 9)
    assert len(counts) <= 9
    for k in set(stream):
        n = stream.count(k)
        assert n - len(stream) / 10 <= counts.get(k, 0) <= n


def test_exact_null_and_repeated_ids(docs_of):
    df = docs_of([(None, "x"), (5, "x"), (5, "x"), (7, "y "), (None, "z")])
    rows = sorted(str((r.doc_id, r.keep_id, r.group_size, r.kept)) for r in
                  exact_dedup.groups(df).collect())
    assert rows == ["(5, 5, 3, True)", "(5, 5, 3, True)", "(7, 7, 1, True)",
                    "(None, 5, 3, False)", "(None, None, 1, True)"]
    left = sorted(str(r.doc_id) for r in exact_dedup.drop_copies(df).collect())
    assert left == ["5", "7", "None"]


def test_exact_stage_keeps_columns_and_longest(docs_of):
    df = docs_of([(1, "a b"), (2, "a  b"), (3, "c"), (4, "ab")], {
        "digest": F.lit("mine"), "kept": F.lit(1), "n_points": F.lit(0), "keep_id": F.lit(9)})
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [2, 3]
    assert {r.digest for r in out.collect()} == {"mine"}


# --- SimHash near-dedup -----------------------------------------------------
def near(df):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.groups(df).collect()}


def test_near_edges(docs_of):
    assert near(docs_of(EDGES)) == brute.near_groups(EDGES)


def test_near_documents(spark):
    docs = brute.rows(SF, "documents", "doc_id, text")
    assert near(spark.read.parquet(f"{SF}/documents.parquet")) == brute.near_groups(docs)


@pytest.mark.parametrize("radius", [2, 4])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks = simhash.masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    rng = random.Random(radius)
    for _ in range(500):
        flip = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not m & flip for m in masks)


@pytest.mark.parametrize("radius", [2, 4])
def test_links_are_exact_over_random_fingerprints(spark, radius):
    rng = random.Random(radius)
    fps = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(8):
            x ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
            fps.add(x)
    node = {f: i for i, f in enumerate(sorted(fps))}
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f, i) for f, i in node.items()],
                               "fp long, node long")
    got = {r.node: r.component for r in
           components.components(simhash.links(df, radius)).collect()}
    back = {i: f for f, i in node.items()}
    want = brute.groups_of(list(back), lambda a, b: (back[a] ^ back[b]).bit_count() <= radius)
    assert {i: got.get(i, i) for i in back} == want


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1, 1)], "fp long, node long"), 3)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(300, k) for k in range(301, 400)] + [(500, 500)]
    random.Random(2).shuffle(edges)
    got = {r.node: r.component for r in components.components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 300 for i in range(300, 400)}}


def test_near_null_and_repeated_ids(docs_of):
    df = docs_of([(None, "a b c"), (3, "a b c"), (3, "a b c"), (None, "something else here"),
                  (9, "q"), (None, "and one more text"), (None, "something else here")])
    got = sorted(str((r.doc_id, r.component_id)) for r in simhash.groups(df).collect())
    assert got == ["(3, 3)", "(3, 3)", "(9, 9)", "(None, 3)"] + 3 * ["(None, None)"]
    kept = sorted((str(r.doc_id), r.text) for r in simhash.keep_one(df).collect())
    assert kept == [("3", "a b c"), ("9", "q"), ("None", "and one more text"), ("None", "something else here")]


def test_near_stage_keeps_columns(docs_of):
    df = docs_of([(1, "a b c d"), (2, "A b c d"), (3, "other words are here")],
                 {"fp": F.lit(1), "component_id": F.lit("x"), "node": F.lit(2)})
    out = simhash.keep_one(df)
    assert out.columns == df.columns and sorted(r.doc_id for r in out.collect()) == [1, 3]


# --- substring dedup --------------------------------------------------------
def substring(df, **options):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
            for r in substring_dedup.removals(df, **options).collect()}


def test_substring_edges(docs_of):
    assert substring(docs_of(EDGES)) == brute.substring(EDGES)


def test_substring_documents(spark):
    docs = brute.rows(SF, "documents", "doc_id, text")
    assert substring(spark.read.parquet(f"{SF}/documents.parquet")) == brute.substring(docs)


@pytest.mark.parametrize("seed", range(4))
def test_substring_passages_of_all_lengths(docs_of, seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "the", "é", "#", "word", "Word", "x y"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(6, 40))] for _ in range(4)]
    docs = []
    for i in range(40):
        words = []
        while len(words) < rng.randint(0, 120):
            words += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(vocabulary)]
        docs.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
    rng.shuffle(docs)
    got = substring(docs_of(docs).repartition(3), window=12, phrase=4)
    assert got == brute.substring(docs, 12)


def test_substring_null_and_repeated_ids(docs_of):
    text = " ".join(f"w{i}" for i in range(60))
    df = docs_of([(None, text), (4, text), (4, text), (4, text + " tail"), (8, "head " + text)])
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in
                 substring_dedup.removals(df).collect())
    assert got == [("4", 60, 0), ("4", 60, 0), ("4", 61, 0), ("8", 61, 60), ("None", 60, 60)]


def test_substring_stage_keeps_rows_and_columns(docs_of):
    text = " ".join(f"w{i}" for i in range(55))
    df = docs_of([(1, f"a  {text}"), (2, f"b {text}  c"), (3, None), (4, " untouched  text ")],
                 {"key": F.lit("k"), "sha": F.lit(0), "n_removed": F.lit(7)})
    out = {r.doc_id: r for r in substring_dedup.drop_repeats(df).collect()}
    assert substring_dedup.drop_repeats(df).columns == df.columns
    assert out[1].text == f"a  {text}" and out[2].text == "b c" and out[2].n_chars == 3
    assert out[3].text is None and out[4].text == " untouched  text " and out[2].key == "k"


CLASHES = ["__id", "__xx", "__key", "__keep", "__digest", "__points", "__kept", "__repeats", "id", "row", "key", "xx",
           "digest", "points", "keep", "repeats", "hot", "stay", "kept", "found_key"]


@pytest.mark.parametrize("stage", [exact_dedup.drop_copies, simhash.keep_one, substring_dedup.drop_repeats])
def test_stages_leave_columns_of_any_name_alone(spark, stage):
    words = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, words), (2, words), (3, "other text"), (3, "other text"), (None, "x y z"),
                                  (LAST, "alone here")], "doc_id long, text string")
    docs = docs.withColumns({c: F.concat(F.lit(c), F.coalesce("doc_id", F.lit(0))) for c in CLASHES})
    got = stage(docs)
    assert got.columns == docs.columns and got.schema["text"].dataType == docs.schema["text"].dataType
    rows = got.collect()
    assert {r.doc_id for r in rows} >= {1, 3, None, LAST}
    for r in rows:
        assert all(r[c] == f"{c}{r.doc_id or 0}" for c in CLASHES)


LAST = 2**63 - 1


def test_largest_id_stands_before_a_null_one(docs_of):
    words = " ".join(f"w{i}" for i in range(60))
    docs = docs_of([(LAST, words), (None, words), (LAST - 1, "q " + words)])
    near = simhash.near_groups(docs_of([(LAST, "a b c d"), (None, "a b c d")])).collect()
    assert {r.doc_id: r.component_id for r in near} == {LAST: LAST, None: LAST}
    assert [r.component_id for r in simhash.near_groups(docs_of([(LAST, "a b c d")])).collect()] == [LAST]
    got = {r.doc_id: r.n_removed for r in substring_dedup.removals(docs).collect()}
    assert got == {LAST - 1: 0, LAST: 60, None: 60}
    two = {r.doc_id: r.n_removed for r in substring_dedup.removals(docs_of([(LAST, words), (None, words)])).collect()}
    assert two == {LAST: 0, None: 60}
    part = docs_of([(None, "start " + words + " end"), (LAST, "other " + words)])
    assert {r.doc_id: r.n_removed for r in substring_dedup.removals(part).collect()} == {LAST: 0, None: 60}


@pytest.mark.parametrize("run", [exact_dedup.groups, exact_dedup.drop_copies, simhash.groups,
                                 simhash.keep_one, substring_dedup.removals, substring_dedup.drop_repeats])
def test_empty_tables(spark, run):
    assert run(empty(spark)).collect() == []
