"""Both readers, line by line, and compressed input."""

import bz2

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from linkrank.sources import (
    TRIPLE_SCHEMA,
    links_from_lines,
    read_triples_csv,
    read_triples_text,
    rejected_lines,
)

# line, (source, target) of the CSV reader, (source, target) of the whitespace reader
LINES = [
    ("<a> <p> <b> .", ("<a>", "<b>"), ("<a>", "<b>")),
    ("<a>  <p> <b> .", ("<a>", "<p>"), ("<a>", "<b>")),
    ("<a>\t<p>\t<b> .", ("<a>\t<p>\t<b>", None), ("<a>", "<b>")),
    ("", None, None),
    ("<z> <p>", ("<z>", None), None),
    ('<l> <p> "two words"@en .', ("<l>", '"two words"@en'), ("<l>", '"two')),
    ("# started 2012-06-06T10:00:00Z", ("#", "2012-06-06T10:00:00Z"), ("#", "2012-06-06T10:00:00Z")),
    (" <a> <p> <b>", (None, "<p>"), ("", "<p>")),
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("triples")


@pytest.mark.parametrize("number", range(len(LINES)))
def test_one_line(spark, folder, number):
    line, csv, text = LINES[number]
    path = folder / f"line{number}.nt"
    path.write_text(line + "\n")
    found = read_triples_csv(spark, str(path))
    assert found.schema == TRIPLE_SCHEMA
    assert [(r.source, r.target) for r in found.collect()] == ([csv] if csv else [])
    assert [tuple(r) for r in read_triples_text(spark, str(path)).collect()] == ([text] if text else [])


def test_short_lines_are_counted(spark, folder):
    path = folder / "all.nt"
    path.write_text("\n".join(line for line, _, _ in LINES) + "\n")
    seen = Observation("seen")
    assert read_triples_text(spark, str(path), seen).count() == 6
    assert seen.get == {"rejected_lines": 2}
    assert sorted(r.value for r in rejected_lines(spark, str(path)).collect()) == ["", "<z> <p>"]


def test_gaps_of_any_whitespace(spark):
    """The gap is what a Python ``\\s+`` matches."""
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    rows = [(f"<a>{gap}<p>{gap}{gap}<b>{gap}.",) for gap in spaces]
    found = links_from_lines(spark.createDataFrame(rows, "value STRING")).distinct().collect()
    assert [tuple(r) for r in found] == [("<a>", "<b>")]


def test_bz2_and_several_files(spark, folder):
    lines = [f"<http://e.org/{i}> <p> <http://e.org/{i * 7 % 100}> ." for i in range(3000)]
    (folder / "part.nt.bz2").write_bytes(bz2.compress(("\n".join(lines[:2000]) + "\n").encode()))
    (folder / "rest.nt").write_text("\n".join(lines[2000:]) + "\n")
    paths = [str(folder / "part.nt.bz2"), str(folder / "rest.nt")]
    want = {(f"<http://e.org/{i}>", f"<http://e.org/{i * 7 % 100}>") for i in range(3000)}
    for read in (read_triples_csv, read_triples_text):
        found = read(spark, paths).select("source", "target").collect()
        assert len(found) == 3000 and {tuple(r) for r in found} == want


def test_only_needed_columns_are_parsed(spark, folder):
    path = folder / "pruned.nt"
    path.write_text("<a> <p> <b> .\n")
    plan = read_triples_csv(spark, str(path)).select("source", "target")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<source:string,target:string>" in plan
    assert read_triples_text(spark, str(path)).where(F.col("source") == "<a>").count() == 1
