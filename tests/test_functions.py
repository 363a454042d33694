"""URL parts and md5 buckets."""

import hashlib

import pytest
from pyspark.sql import functions as F

from linkrank.functions import first_character_bucket, md5_bucket, url_domain, url_protocol
from linkrank.operators import (
    adjacency,
    annotate_ranks,
    bucket_sizes,
    join_url_parts,
    neighbour_contributions,
)
from linkrank.plans import pagerank

URLS = [
    ("<http://www.example.org/resource/X>", "<http:", "", "example.org", "http"),
    ("http://www.example.org/resource/X", "example.org", "http", "example.org", "http"),
    ("https://www.ththin.example.com/fr/31", "ththin.example.com", "https", "ththin.example.com", "https"),
    ("ftp://h/x", "ftp:", "", "ftp:", ""),
    ("e.org", "e.org", "", "e.org", ""),
    ("", "", "", "", ""),
    (None, None, None, None, None),
]


def test_url_parts(spark):
    df = spark.createDataFrame([(u,) for u, *_ in URLS], "url STRING").select(
        "url",
        url_domain(F.col("url")),
        url_protocol(F.col("url")),
        url_domain(F.col("url"), strip_brackets=True),
        url_protocol(F.col("url"), strip_brackets=True),
    )
    assert {tuple(r) for r in df.collect()} == set(URLS)


@pytest.mark.parametrize("buckets", [1, 7, 100, 2**31 - 1])
def test_md5_bucket(spark, buckets):
    keys = [f"<http://e.org/{i}>" for i in range(2000)] + ["", "é", "<"]
    got = spark.createDataFrame([(k,) for k in keys], "k STRING").select("k", md5_bucket(F.col("k"), buckets))
    want = {k: int(hashlib.md5(k.encode()).hexdigest(), 16) % buckets for k in keys}
    assert dict(tuple(r) for r in got.collect()) == want


def test_first_character_bucket_is_one_bucket(spark):
    keys = spark.range(1000).select(F.concat(F.lit("<http://e.org/"), "id", F.lit(">")).alias("source"))
    assert [r[0] for r in keys.select(first_character_bucket(F.col("source"), 100)).distinct().collect()] == [68]
    sizes = {}
    for row in bucket_sizes(keys, 8).collect():
        sizes.setdefault(row.key_rule, []).append(row.n_rows)
    assert sizes["first_character"] == [1000]
    assert len(sizes["whole_key"]) == 8 and sum(sizes["whole_key"]) == 1000


@pytest.mark.parametrize("buckets", [0, 2**31])
def test_bad_bucket_count(buckets):
    with pytest.raises(ValueError):
        md5_bucket(None, buckets)


@pytest.mark.parametrize("strip", [False, True])
def test_annotation_equals_join(spark, strip):
    edges = [("<http://www.a.org/1>", "<https://b.org/2>"), ("<https://b.org/2>", "<http://c.org/3>")]
    edges += [("<http://www.a.org/1>", "<http://c.org/3>")] * 3 + [("d", "<http://www.a.org/1>"), (None, "d"), ("d", None)]
    df = spark.createDataFrame(edges, "source STRING, target STRING")
    ranks = pagerank(df, 2)
    annotated = [tuple(r) for r in annotate_ranks(ranks, strip).collect()]
    joined = [tuple(r) for r in join_url_parts(ranks, df, strip).collect()]
    key = lambda row: tuple("" if v is None else str(v) for v in row)
    assert sorted(annotated, key=key) == sorted(joined, key=key)
    by_page = {r[0]: r[2:] for r in annotated}
    assert by_page["<http://c.org/3>"] == (None, None)
    assert by_page["<http://www.a.org/1>"] == (("a.org", "http") if strip else ("<http:", ""))


@pytest.mark.parametrize("block", [1, 4, 1000])
def test_adjacency_blocks_hold_each_neighbour_once(spark, block):
    rows = [("hub", f"t{i}") for i in range(200)] * 2 + [("a", "b"), ("a", "c"), ("b", None), (None, "b")]
    df = spark.createDataFrame(rows, "source STRING, target STRING")
    blocks = adjacency(df, block).collect()
    got = sorted((b.page, n) for b in blocks for n in b.neighbours)
    assert got == sorted({r for r in rows if None not in r})
    assert all(b.degree == {"hub": 200, "a": 2}[b.page] for b in blocks)
    assert all(list(b.neighbours) == sorted(b.neighbours) for b in blocks)
    if block == 1000:
        assert {b.block for b in blocks} == {0}
    else:
        assert sum(b.page == "hub" for b in blocks) > 1


@pytest.mark.parametrize("broadcast_bytes", [0, 40, 10_000])
def test_hot_sources_beyond_the_broadcast_bound(spark, monkeypatch, broadcast_bytes):
    """Hubs, warm pages and plain pages get the same blocks either way."""
    from linkrank.operators import graph

    rows = [("hub", f"t{i}") for i in range(300)] + [(f"w{i % 20}", f"t{i}") for i in range(240)] + [("a", "b")]
    df = spark.createDataFrame(rows, "source STRING, target STRING")
    monkeypatch.setattr(graph, "MAX_BROADCAST_BYTES", broadcast_bytes)
    blocks = adjacency(df, 10).collect()
    assert sorted((b.page, n) for b in blocks for n in b.neighbours) == sorted(rows)
    assert sum(b.page == "hub" for b in blocks) > 5 and sum(b.page == "w3" for b in blocks) == 2


@pytest.mark.parametrize("block", [2, 1000])
def test_contributions_of_blocks(spark, block):
    rows = [("hub", f"t{i}") for i in range(50)] + [("a", "t1"), ("a", "t2"), ("b", "t1")]
    df = spark.createDataFrame(rows, "source STRING, target STRING")
    ranks = spark.createDataFrame([("hub", 2.0), ("a", 3.0), ("t1", 9.0)], "page STRING, pagerank DOUBLE")
    got = neighbour_contributions(adjacency(df, block, ranks)).collect()
    want = [(f"t{i}", 2.0 / 50) for i in range(50)] + [("t1", 1.5), ("t2", 1.5)]
    assert sorted(tuple(r) for r in got) == sorted(want)
