"""The registered queries on the given tables: against SQL, brute force or held-out rows."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as registered
import brute
from linkrank import llm

SMALL, SF_DIR = "/root/testdata/sf0.001", os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLE = llm.queries(), llm.oracle_sql()


def table(spark, name, sf_dir=SMALL):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def normal(frame):
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(registered.queries())


@pytest.mark.parametrize("name", list(ORACLE))
def test_against_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    rows = QUERIES[name](spark, SMALL).toArrow()
    got, want = normal(duck.from_arrow(rows).df()), normal(duck.sql(ORACLE[name]).df())
    assert len(want)
    assert [str(t) for t in got.dtypes] == [str(t) for t in want.dtypes]
    pd.testing.assert_frame_equal(got, want, check_exact=True)


def test_main_text_is_the_article(spark):
    got = {r.page_id: r for r in QUERIES["op1_text_density"](spark, SMALL).collect()}
    pages = table(spark, "pages").collect()
    assert len(got) == len(pages)
    for page in pages:
        text = got[page.page_id].text
        assert got[page.page_id].n_chars == len(text) > 0
        footer = page.html.split("<footer>")[1]
        assert "&copy;" not in text and "track(" not in text and footer[:30] not in text


def test_language_of_held_out_texts(spark):
    got = QUERIES["op2_centroid_language"](spark, SF_DIR)
    rows = got.join(table(spark, "documents", SF_DIR).select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_neighbours_against_brute_force(spark):
    got = QUERIES["op3_prefix_forest"](spark, SF_DIR).toPandas()
    rows = table(spark, "embeddings", SF_DIR).orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    assert set(got["query_id"]) == {i for i in ids if i % 20 == 0}
    hits = 0
    for query, found in got.sort_values("rank").groupby("query_id"):
        at = np.flatnonzero(ids == query)[0]
        score = x @ x[at]
        score[at] = -np.inf
        best = np.lexsort((ids, -score))[:20]
        assert list(found["rank"]) == list(range(1, 21)) and query not in set(found["vec_id"])
        assert np.allclose(found["score"], [score[ids == v][0] for v in found["vec_id"]], atol=1e-12)
        hits += len(set(ids[best]) & set(found["vec_id"]))
    assert hits / len(got) >= 0.9


def test_toxicity_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op5_weak_toxicity"](spark, sf)
    rows = got.join(table(spark, "labels", sf).select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    toxic, clean = [r.predicted for r in rows if r.toxic], [r.predicted for r in rows if not r.toxic]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.02
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_repeats_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    want = brute.kept_words(docs)
    got = QUERIES["op7_de_bruijn_dedup"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == {i: v for (i, _), v in want.items()}
    assert any(r.n_removed for r in got)


def test_near_duplicates_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    want = brute.components(docs)
    got = QUERIES["op8_odd_sketch_dedup"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: v for (i, _), v in want.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_token_counts_are_the_library_s(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in QUERIES["op10_token_counts"](spark, SMALL).collect()}
    for r in table(spark, "documents").collect():
        n = len(tokenizer.encode(r.text, add_special_tokens=False).ids)
        assert (got[r.doc_id].n_bytes, got[r.doc_id].n_tokens, got[r.doc_id].over_limit) == (len(r.text.encode()), n, n > 512)


def test_shards_and_growth(spark):
    rows = QUERIES["op4_hash_tree_sharding"](spark, SF_DIR).collect()
    for shard, n in Counter(r.shard for r in rows).items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    assert {r.grown_shard for r in rows if r.grown_shard != r.shard} == {8}
    assert {r.shard for r in rows} == set(range(8))


def test_mix_comes_near_its_targets(spark):
    rows = QUERIES["op6_source_mixing"](spark, SF_DIR).toPandas()
    source = table(spark, "documents", SF_DIR).select("doc_id", "source").toPandas()
    by_source = rows.merge(source, on="doc_id").groupby("source").agg({"taken": "sum", "target": "first", "size": ["sum", "max"]})
    assert abs(by_source["target", "first"].sum() - rows["size"].sum()) < 1
    assert (abs(by_source["taken", "sum"] - by_source["target", "first"]) <= by_source["size", "max"]).all()
    assert (rows["taken"] <= 3 * rows["size"]).all()
