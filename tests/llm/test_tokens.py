"""Byte-level BPE against tiktoken, packing against the tokenizer itself."""
import random
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from made import docs_of  # noqa: F401
from tillbook.llm import byte_bpe, packing, registry, tokens

SF = "/root/testdata/sf0.001"
RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
EDGES = [(1, None), (2, ""), (3, " "), (4, "\n\n \t"), (5, "a  b\n\nc's 'S we'll. THE,the"), (6, "é É ß× ÷,x¿"),
         (7, "中文 字 😀😀 e\u0301 \u00a0x\u2003y"), (8, "deded dedeD aaaaa ----- ,,, a,b;c"), (9, "İ Σας K"),
         (10, "word " * 40_000), (11, "x" * 5000), (12, "<|endoftext|> a<|startoftext|>"), (13, "\r\n a\x0bb\x1cc\x85d")]


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def model():
    return byte_bpe.ByteBPE(RANKS, P.PATTERN)


def digests(tik, docs):
    out = {}
    for i, t in docs:
        ids = tik.encode_ordinary(t or "")
        out[i] = (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(),
                  sha256((t or "").encode()).hexdigest())
    return out


def coded(df):
    return {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256)
            for r in byte_bpe.digests(df, RANKS, P.PATTERN).collect()}


def test_bpe_edges(docs_of, tik):
    assert coded(docs_of(EDGES)) == digests(tik, EDGES)


def test_bpe_documents(spark, tik):
    docs = brute.rows(SF, "documents", "doc_id, text")
    assert coded(spark.read.parquet(f"{SF}/documents.parquet")) == digests(tik, docs)


def test_bpe_ids_over_random_texts(model, tik):
    rng = random.Random(5)
    parts = ["a", "th", "ded", "de", "ed", "é", "ñ", "中", "😀", " ", "  ", "\n", "\t", "!", "...", "1", "23", "'s", "'",
             "A", "THE", "$$$", "×", "aba", "ana", "nen", "ror", "\u0301"]
    for _ in range(3000):
        s = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert model.encode([s.encode()])[0] == tik.encode_ordinary(s)


def test_bpe_round_trip_and_split_characters(docs_of):
    df = docs_of([e for e in EDGES if e[0] != 10], {"ids": F.lit("clash")})
    enc = byte_bpe.encode(df, RANKS, P.PATTERN)
    back = byte_bpe.decode(enc.drop("text"), RANKS)
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in EDGES if i != 10}
    cut = byte_bpe.decode(enc.filter("doc_id = 7").select("doc_id", F.slice("ids", 1, 2).alias("ids")), RANKS)
    assert cut.first().text is not None


def test_bpe_offsets(model):
    text = "a😀b中é x"
    ids, ends = byte_bpe.offsets(model, text)
    assert ends[-1] == len(text) and ends == sorted(ends) and len(ids) == len(ends)
    for n, end in enumerate(ends):
        whole = model.decode(ids[:n + 1])
        assert whole.decode(errors="ignore") == text[:end]


# --- packing ----------------------------------------------------------------
def tokens_of(docs):
    t = Tokenizer.from_file(WORDS)
    return {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in docs}


def check_packing(rows, ids, size):
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(docs) == set(ids)
    for i, own in ids.items():
        at = 0
        for r in sorted(docs[i], key=lambda r: r.start):
            piece = np.array(own[r.start:r.start + r.length], "<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(own), zlib.crc32(piece.tobytes()))
            at += r.length
        assert at == len(own)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
        padding += size - at if at & (at - 1) else 0
    return padding


@pytest.mark.parametrize("size", [2048, 64])
def test_packing_edges(docs_of, size):
    rows = packing.packed(docs_of(EDGES), WORDS, size).collect()
    check_packing(rows, tokens_of(EDGES), size)


MARKED = [(1, "see <|endoftext|> here"), (2, "a<|startoftext|>b<|endoftext|><|endoftext|>\u0301x"), (3, "<|ENDOFTEXT|> Cut"),
          (4, "<|endoftext|>"), (5, "a <|endof"), (6, "text|> b"), (7, None), (8, "<|<|endoftext|>|> é<|startoftext|>é, c"),
          (9, "<|endoftext|" * 3 + ">"), (10, "\x00\x00 <|endoftext|>\n<|endoftext |>"), (11, ""), (12, "no mark, at all")]


def test_packing_added_tokens_as_the_tokenizer_has_them(docs_of):
    t = Tokenizer.from_file(WORDS)
    ids = {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in MARKED}
    assert ids[1] == [862, 49407, 763, 1]
    for n in (1, 4):
        rows = packing.packed(docs_of(MARKED).coalesce(n), WORDS, 64).collect()
        check_packing(rows, ids, 64)


@pytest.mark.parametrize("name", ["op4_packing", "pipeline"])
def test_packing_queries_match_added_tokens(spark, docs_of, tmp_path, name):
    docs_of(MARKED).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out = registry.QUERIES[name](spark, str(tmp_path)) if name in registry.QUERIES else dict(
        corpus_pipeline.STAGES)["packing"](spark, docs, str(tmp_path))
    t = Tokenizer.from_file(WORDS)
    check_packing(out.collect(), {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in MARKED}, 2048)


def test_packing_documents_with_little_padding(spark):
    docs = brute.rows(SF, "documents", "doc_id, text")
    ids = tokens_of(docs)
    rows = packing.packed(spark.read.parquet(f"{SF}/documents.parquet"), WORDS).collect()
    assert check_packing(rows, ids, 2048) < 0.03 * sum(map(len, ids.values()))


def test_packing_ranks_in_buckets(docs_of, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 7)
    docs = [(i, "a " * (i % 3)) for i in range(200)]
    check_packing(packing.packed(docs_of(docs).repartition(5), WORDS, 16).collect(), tokens_of(docs), 16)


def test_packing_repeated_and_null_ids(docs_of):
    rows = packing.packed(docs_of([(1, "a b"), (1, "a b"), (None, "c"), (None, None)]), WORDS).collect()
    assert sorted(str((r.doc_id, r.length)) for r in rows) == ["(1, 3)", "(1, 3)", "(None, 1)", "(None, 2)"]
    assert sorted(r.offset for r in rows) == [0, 3, 6, 8] and {r.sequence_id for r in rows} == {0}


def test_packing_with_ids(docs_of):
    rows = packing.packed(docs_of([(1, "a b c")]), WORDS, 2, with_ids=True).collect()
    assert [i for r in sorted(rows, key=lambda r: r.start) for i in r.ids] == tokens_of([(1, "a b c")])[1]


@pytest.mark.parametrize("seed", range(5))
def test_shortest_pack_first_places_every_rank_once(seed):
    rng = random.Random(seed)
    histogram = {n: rng.choice([1, 2, 7, 1000]) for n in rng.sample(range(1, 65), rng.randint(1, 64))}
    fill, seen = defaultdict(set), defaultdict(set)
    for length, a, b, first, copies, offset in packing.shortest_pack_first(histogram, 64):
        for r in range(a, b):
            assert r not in seen[length]
            seen[length].add(r)
            s, at = first + (r - a) // copies, offset + length * ((r - a) % copies)
            place = set(range(at, at + length))
            assert at + length <= 64 and not place & fill[s]
            fill[s] |= place
    assert {n: len(v) for n, v in seen.items()} == histogram
    assert sorted(fill) == list(range(len(fill)))
    assert all(max(v) + 1 == len(v) for v in fill.values())


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed(empty, WORDS).collect() == []
    assert byte_bpe.digests(empty, RANKS, P.PATTERN).collect() == []


def test_memo_keeps_what_it_met_again_when_it_is_full():
    calls = []

    def compute(words):
        calls.append(list(words))
        return np.array([len(w) for w in words]), np.frombuffer(b"".join(words), np.uint8).astype(np.uint32)
    memo = tokens.Memo(compute, limit=40 * (tokens.ENTRY + 20))
    rng = random.Random(4)
    for n in range(30):
        words = [b"often", b"", *(b"w%d" % rng.randrange(10**6) for _ in range(n))]
        values, bounds = memo.gather(memo(words), np.arange(len(words) + 1))
        assert bytes(values.astype(np.uint8)) == b"".join(words)
        assert np.diff(bounds).tolist() == [len(w) for w in words]
        assert memo.bytes < 80 * (tokens.ENTRY + 20)
    assert sum(b"often" in c for c in calls) == 1 and memo.gather(np.array([memo.fixed(b"\xff7", 7)]),
                                                                  np.array([0, 1]))[0].tolist() == [7]
