"""The pipeline, stage by stage, against plain rules."""

import brute
import corpus_pipeline
from linkrank.llm import bm25_wand, common, odd_sketch
from linkrank.llm.common import stored
from linkrank.session import BROADCAST_SETTING

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "benchmark_decontamination", "source_mix", "sharding"]
    tables = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL))
        tables[name] = docs
    assert all(tables[n].columns == columns for n in names[:-1])
    rows = {n: [(r.doc_id, r.text) for r in t.collect()] for n, t in tables.items() if n != "sharding"}
    clean = rows["toxicity"]
    assert set(clean) <= set(rows[""])
    groups = brute.components(clean, corpus_pipeline.NEAR_PERCENT)
    assert sorted(rows["near_duplicates"]) == sorted(r for r in clean if groups[r][1] == r[0])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    held = [{i for i, own in items if set(bm25_wand.shingles(bm25_wand.words_of(own))) <= set(bm25_wand.shingles(bm25_wand.words_of(t)))} for _, t in rows["near_duplicates"]]
    assert sorted(rows["benchmark_decontamination"]) == sorted(r for r, h in zip(rows["near_duplicates"], held, strict=True) if not h)
    assert set(rows["source_mix"]) <= set(rows["benchmark_decontamination"])
    assert max(rows["source_mix"].count(r) for r in set(rows["source_mix"])) <= 3
    assert tables["sharding"].count() == len(rows["source_mix"])


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 100


def test_odd_documents_pass_through(spark, odd_docs, no_docs):
    for given in (odd_docs, no_docs):
        docs, kept = given, None
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SMALL))
            rows = [(r.doc_id, r.text) for r in docs.collect()] if name != "sharding" else docs.collect()
            if name == "sharding":
                assert len(rows) == len(kept)
                continue
            assert docs.columns == given.columns
            if kept is not None:
                assert set(rows) <= set(kept)
            if name == "near_duplicates":
                assert len(rows) == len(set(rows))  # a repeated row is one document here
            kept = rows
        if given is no_docs:
            assert not rows


def test_near_duplicates_broadcast_no_large_table(spark, monkeypatch):
    """No job of the stage joins by a broadcast that a session allows for but the driver could not hold dozens of."""
    allowed, collected = [], []

    def noted(frame):
        allowed.append(int(spark.conf.get(BROADCAST_SETTING)))
        return stored(frame)

    for module in (common, odd_sketch):
        monkeypatch.setattr(module, "collect_garbage", lambda s: collected.append(s))
    monkeypatch.setattr(common, "stored", noted)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = spark.conf.get(BROADCAST_SETTING)
    try:
        for given, most in (("10m", 256 << 10), ("1000", 1000), ("-1", -1)):
            spark.conf.set(BROADCAST_SETTING, given)
            allowed.clear()
            collected.clear()
            corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)
            assert set(allowed) == {most} and len(allowed) > 5 and len(collected) >= 3
            assert spark.conf.get(BROADCAST_SETTING) == given
    finally:
        spark.conf.set(BROADCAST_SETTING, before)
