"""Odd pages in directories by URL, with and without adaptive execution."""

import pytest

from linkrank.sinks import URL, write_ranks
from linkrank.sinks import ranks as sink
from linkrank.sources import read_ranks


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_odd_pages_come_back(spark, tmp_path, monkeypatch, adaptive):
    monkeypatch.setattr(sink, "SPLIT_FILES", 4)
    pages = ["", " ", "a,b", 'q"q', "http://x.org/1", "null", "\\N"] + [f"http://big.org/{i}" for i in range(400)]
    rows = spark.createDataFrame([(p, 1.5, 1) for p in pages], "page STRING, pagerank DOUBLE, out_degree BIGINT")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        write_ranks(rows, str(tmp_path / "out"), URL)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sorted(r.page for r in read_ranks(spark, str(tmp_path / "out"), URL).collect()) == sorted(pages)
    files = list((tmp_path / "out" / "domain=big.org").rglob("part-*"))
    assert len(files) > (adaptive == "false") and len(files) <= 8


def test_a_large_directory_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """Ranked pages are compressed so well that the session's size for a task holds millions of them."""
    monkeypatch.setattr(sink, "SPLIT_BYTES", 1 << 14)
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting, None)
    rows = spark.range(0, 40000, 1, 16).selectExpr("concat('http://big.org/', id) AS page", "0.0D AS pagerank", "1L AS out_degree")
    write_ranks(rows, str(tmp_path / "out"), URL)
    assert 4 <= len(list((tmp_path / "out" / "domain=big.org").rglob("part-*.csv"))) <= 16
    assert read_ranks(spark, str(tmp_path / "out"), URL).select("page").distinct().count() == 40000
    assert spark.conf.get(setting, None) == before
