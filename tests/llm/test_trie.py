"""The conversation prefix trie against a plain one."""
import random

import pytest
from pyspark.sql import functions as F

import brute
from tillbook.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, convs):
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def nodes(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def want(convs):
    return sorted(brute.prefix_trie(convs).values(), key=str)


def made(seed, n, longest):
    """Conversations that share prefixes of all lengths, some equal to or prefixes of others."""
    rng = random.Random(seed)
    out = {}
    for c in range(n):
        turns = [("user" if i % 2 == 0 else "assistant", rng.choice(["hi", "hello there", "a b c", ""]))
                 for i in range(rng.randrange(1, longest))]
        if out and rng.random() < .6:
            other = out[rng.choice(list(out))]
            turns = other[:rng.randrange(len(other) + 1)] + turns * (rng.random() < .7) or other
        out[c * 3 - 20] = turns
    return out


@pytest.mark.parametrize("block", [1, 3, 8])
def test_nodes_of_any_block_length(spark, block):
    convs = made(block, 60, 14)
    assert nodes(trie.prefixes(table(spark, convs), block)) == want(convs)


def test_rebuilt_conversations(spark):
    convs = made(9, 120, 5)
    convs.update({1003: [("user", "only turn")], 2**63 - 1: [("user", "x"), ("user", "y")]})
    assert any(not t for t in brute.rebuilt(convs).values())          # a turnless one is a member of the root
    assert nodes(trie.rebuilt_prefixes(table(spark, convs))) == want(brute.rebuilt(convs))


def test_long_conversations_numbered_in_spans(spark, monkeypatch):
    monkeypatch.setattr(trie, "SPAN_BITS", 3)
    convs = {c: [("user", f"turn {i} of {c // 2 if i > 40 else 0}") for i in range(90 + c)] for c in range(4)}
    assert nodes(trie.prefixes(table(spark, convs))) == want(convs)


def test_many_copies_end_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(trie, "ENDS_BITS", 3)                          # several parts a node
    convs = {c - 50: [("user", "same"), ("assistant", "copy")] for c in range(300)}
    convs[400] = [("user", "same")]
    assert nodes(trie.prefixes(table(spark, convs))) == want(convs)


def test_nulls_repeated_rows_ties_and_clashing_columns(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, "x"), (1, 0, None, "x"), (1, 2, "user", None),
            (2, 1, "b", "tie"), (2, 1, "a", "tie"), (None, 0, "user", "no id"), (None, 1, "user", ""),
            (2**63 - 1, 7, "user", "first"), (3, 5, "", "x " * 50_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {"conv": F.lit("mine"), "a": F.lit(1), "k": F.lit(None), "place": F.lit(0), "words": F.lit("w")})
    convs = {1: [("user", "first"), ("", "x"), ("", "x"), ("user", "")], 2: [("a", "tie"), ("b", "tie")],
             None: [("user", "no id"), ("user", "")], 2**63 - 1: [("user", "first")], 3: [("", "x " * 50_000)]}
    assert nodes(trie.prefixes(df)) == want(convs)
    assert nodes(trie.rebuilt_prefixes(df)) == want(brute.rebuilt(convs))


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert nodes(trie.prefixes(none)) == [] and nodes(trie.rebuilt_prefixes(none)) == []
