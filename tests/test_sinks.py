"""Layouts on disk, save modes, and reading back."""

import ast
import bz2
import os
import re
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from linkrank import RankSemantics, pagerank, read_ranks, write_ranks
from linkrank.operators import report_lines, top_k
from linkrank.sinks import CSV, LAYOUTS, TEXT, URL

SCHEMA = "page STRING, pagerank DOUBLE, out_degree BIGINT"
ROWS = [
    ("http://a.org/x,y", 1.5, 1),
    ('http://b.org/"q"', 2.25, 2),
    ("http://c.org/O'Brien", 3.0, 1),
    ("http://d.org/'\"\\mixed", 0.5, 0),
    ("https://www.a.org/back\\slash", 1e-9, 3),
    ("plain", 0.0, 1),
    ("", 7.0, 1),
]


@pytest.fixture(scope="module")
def ranks(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def text_of(path):
    files = sorted(p for p in Path(path).rglob("part-*"))
    return "".join(bz2.decompress(p.read_bytes()).decode() if p.suffix == ".bz2" else p.read_text() for p in files)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_round_trip(spark, ranks, tmp_path, layout):
    path = str(tmp_path / "out")
    write_ranks(ranks, path, layout)
    got = {r.page or "": r.pagerank for r in read_ranks(spark, path, layout).collect()}
    assert got == {page: rank for page, rank, _ in ROWS}


def test_csv_lines(ranks, tmp_path):
    small = ranks.where("page LIKE '%x,y' OR page = 'plain'").union(ranks.selectExpr("'tiny'", "1e-9D", "0L").limit(1))
    write_ranks(small, str(tmp_path / "out"))
    lines = text_of(tmp_path / "out").splitlines()
    assert sorted(lines) == ['"http://a.org/x,y,1.5"', '"plain,0.0"', '"tiny,1.0E-9"']
    assert all(p.suffix == ".bz2" for p in (tmp_path / "out").glob("part-*"))


def test_null_pages_give_no_csv_line(spark, tmp_path):
    rows = [(None, 0.0, 2), ("a", 1.0, 1), (None, 0.5, 0)]
    write_ranks(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "out"))
    assert [line for line in text_of(tmp_path / "out").splitlines() if line] == ['"a,1.0"']


def test_text_lines_are_sorted_python_tuples(ranks, tmp_path):
    write_ranks(ranks, str(tmp_path / "out"), TEXT)
    lines = text_of(tmp_path / "out").splitlines()
    assert [ast.literal_eval(line) for line in lines] == sorted(((p, r) for p, r, _ in ROWS), key=lambda x: -x[1])
    assert "('http://a.org/x,y', 1.5)" in lines
    assert [repr((p, 1.5))[:-6] for p, _, _ in ROWS] == [
        re.sub(r", [^,]*$", "", next(x for x in lines if ast.literal_eval(x)[0] == p)) for p, _, _ in ROWS
    ]


def test_url_directories(spark, ranks, tmp_path):
    path = tmp_path / "out"
    write_ranks(ranks.withColumn("page", F.concat(F.lit("<"), "page", F.lit(">"))), str(path), URL)
    assert (path / "domain=<http%3A" / "protocol=__HIVE_DEFAULT_PARTITION__").is_dir()
    write_ranks(ranks, str(path), URL)  # replaces what was there
    names = {p.name for p in path.iterdir() if p.is_dir()}
    assert names == {"domain=a.org", "domain=b.org", "domain=c.org", "domain=plain", "domain=__HIVE_DEFAULT_PARTITION__"}
    rows = read_ranks(spark, str(path), URL)
    assert {tuple(r) for r in rows.where("domain = 'a.org'").collect()} == {
        ("http://a.org/x,y", 1.5, "a.org", "http"),
        ("https://www.a.org/back\\slash", 1e-9, "a.org", "https"),
    }
    plan = rows.where("domain = 'a.org'")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*domain", plan)


def scanned(rows):
    """The plan of a scan, and how many files it read."""
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan()
    metrics = plan.collectLeaves().head().metrics()
    return plan.toString(), metrics.apply("numFiles").value() if metrics.contains("numFiles") else 0


def test_domains_are_read_from_their_directories(spark, ranks, tmp_path):
    path = str(tmp_path / "out")
    write_ranks(ranks, path, URL)
    whole = read_ranks(spark, path, URL)
    _, all_files = scanned(whole)
    for domains in (["a.org"], ["b.org", "a.org", "a.org"], [None], ["", "plain"], ["nowhere"], []):
        rows = read_ranks(spark, path, URL, domains)
        plan, files = scanned(rows)
        known = {d or None for d in domains}
        assert sorted(map(str, rows.collect())) == sorted(str(r) for r in whole.collect() if r.domain in known)
        assert files < all_files and (not domains or re.search(r"PartitionFilters: \[[^\]]*domain", plan))
    with pytest.raises(ValueError, match="domains"):
        read_ranks(spark, path, CSV, ["a.org"])


def test_a_domain_of_digits_stays_text(spark, tmp_path):
    write_ranks(spark.createDataFrame([("http://0123/x", 1.0, 1)], SCHEMA), str(tmp_path / "out"), URL)
    assert read_ranks(spark, str(tmp_path / "out"), URL).first().domain == "0123"


def test_few_files_per_directory(spark, tmp_path):
    rows = spark.range(0, 20000, 1, 16).select(
        F.concat(F.lit("http://d"), F.col("id") % 5, F.lit(".org/"), "id").alias("page"),
        F.rand(1).alias("pagerank"),
        F.lit(1).cast("bigint").alias("out_degree"),
    )
    write_ranks(rows, str(tmp_path / "out"), URL)
    assert len(list((tmp_path / "out").rglob("part-*.csv"))) == 5


@pytest.mark.parametrize("layout,mode", [(CSV, None), (TEXT, None), (URL, "error")])
def test_existing_path(ranks, tmp_path, layout, mode):
    path = str(tmp_path / "out")
    write_ranks(ranks, path, layout)
    with pytest.raises(AnalysisException):
        write_ranks(ranks, path, layout, mode)
    write_ranks(ranks.limit(2), path, layout, "overwrite")
    assert text_of(path).count("\n") == 2


def test_unknown_layout(spark, ranks):
    with pytest.raises(ValueError):
        write_ranks(ranks, "/nowhere", "orc")
    with pytest.raises(ValueError):
        read_ranks(spark, "/nowhere", "orc")


def test_top_k_and_report(spark):
    rows = [("b", 2.0), ("a", 2.0), ("c", 3.1234567), ("d", 0.1)]
    df = spark.createDataFrame(rows, "page STRING, pagerank DOUBLE")
    assert [r.page for r in top_k(df, 3).collect()] == ["c", "a", "b"]
    assert [r.line for r in report_lines(df, 2).orderBy("position").collect()] == [
        "1. c has rank: 3.123457",
        "2. a has rank: 2.000000",
    ]
    plan = top_k(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


@pytest.mark.parametrize("semantics", RankSemantics)
def test_saved_ranks_equal_ranks(spark, tmp_path, semantics):
    edges = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
        *(F.concat(F.lit("http://e.org/"), c).alias(n) for c, n in (("l_orderkey", "source"), ("l_partkey", "target")))
    )
    ranks = pagerank(edges, 3, semantics=semantics)
    want = {r.page: r.pagerank for r in ranks.collect()}
    for layout in LAYOUTS:
        path = os.path.join(tmp_path, layout)
        write_ranks(ranks, path, layout)
        assert {r.page: r.pagerank for r in read_ranks(spark, path, layout).collect()} == want
