"""The conversation trie against a plain one."""

from collections import Counter

import numpy as np
import pytest

import brute
from linkrank import llm
from linkrank.llm import burst_trie

SMALL = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn int, role string, text string, depth int, container string, n string, seq string"


def nodes(frame):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return Counter(tuple(r[n] for n in names) for r in frame.collect())


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", "n", "s") for r in rows], TURNS).repartition(3)


ODD = [
    *[(1, 0, "user", "hello"), (1, 1, "assistant", "hi"), (1, 1, "assistant", "hi")],  # a repeated row
    *[(0, None, None, "first"), (0, 0, "user", None), (0, 5, "user", ""), (0, 2, "äö", "日本")],
    *[(2, 3, "user", "b"), (2, 3, "user", "a"), (2, 3, "tool", "a")],  # ties
    *[(None, 0, "user", "no conversation"), (-3, 0, "user", "x"), (-7, 0, "user", "x"), (-5, 0, "user", "x")],
    *[(7, i, "user", "again") for i in range(40)],
    *[(8, 0, "user", "long " * 30_000), (9, 0, None, None), (9, 1, None, None), (12, 0, "us", "erx"), (14, 0, "user", "x")],
]


@pytest.mark.parametrize("limit", [None, 1, 2])
def test_odd_conversations(spark, limit):
    assert nodes(burst_trie.prefix_trie(turns(spark, ODD), limit)) == Counter(brute.trie(ODD))


def test_no_conversations(spark):
    assert burst_trie.prefix_trie(turns(spark, [])).count() == 0
    assert burst_trie.prefix_trie(turns(spark, [(None, 0, "user", "x")]), 1).count() == 0


@pytest.mark.parametrize("limit", [None, 3, 40])
def test_shared_beginnings(spark, limit):
    """A third of the conversations are equal, a third share a long beginning; every limit gives the same nodes."""
    rng = np.random.default_rng(3)
    rows = []
    for c in range(0, 900, 3):
        rows += [(c, t, "user", f"same {t}") for t in range(6)]
        rows += [(c + 1, t, "user", f"start {t}" if t < 9 else f"own {c} {t}") for t in range(11)]
        rows += [(c + 2, t, "user", f"word {rng.integers(3)}") for t in range(int(rng.integers(1, 7)))]
    assert nodes(burst_trie.prefix_trie(turns(spark, rows), limit)) == Counter(brute.trie(rows))


def test_query_against_brute_force(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    assert nodes(llm.queries()["op13_burst_trie"](spark, SMALL)) == Counter(brute.trie(rows))
