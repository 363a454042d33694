"""Tokenizer alignment against a byte-by-byte version."""

from collections import Counter

import public_tokenizers
import pytest

import brute
from conftest_rows import odd_rows
from linkrank import llm
from linkrank.llm import tokenizer_alignment, units

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"
TEXTS = [
    *["", " ", "  ", "a", " a", "a ", "  a  b  ", " \n a", "a\t b \tc", "a\x1c b \x1c c", "\x00 a \x00b", "a\xa0 b \xa0c"],
    *["x<|endoftext|> y <|endoftext|>z", "<s> a </s> <unk> <0x41>", "don't  stop ' s 's", "日本 語 a 🙂🙂 b", "á ́b", " " * 40 + "y"],
    *["a" + " " * 40, "1 2  3 ４ ٣", "a▁b c", "▁", "aaaa " * 30, "x" * 700, "\n\n a \n\n b\n \n", "the cat\r\nsat"],
]


def as_rows(frame):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return Counter(tuple(r[n] for n in names) for r in frame.collect())


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = as_rows(llm.queries()["op11_identity_alignment"](spark, SMALL))
    assert got == Counter(brute.alignments(docs, A, B))


@pytest.mark.parametrize("head, table_bytes, task_pairs", [(None, None, None), (0, 2_000, 40), (60, 1, 1)])
def test_odd_documents(spark, odd_docs, head, table_bytes, task_pairs, monkeypatch):
    """Rare pairs joined, tables that start anew, sums passed on early: nothing changes."""
    rows = [r[:2] for r in odd_rows()] + [(100 + i, t) for i, t in enumerate(TEXTS)]
    extra = spark.createDataFrame([(i, t, 1, 2) for i, t in rows[len(odd_rows()) :]], "doc_id long, text string, row int, pair int")
    docs = odd_docs.select("doc_id", "text").unionByName(extra, allowMissingColumns=True)
    if head is not None:
        monkeypatch.setattr(units, "SLICE_CHARS", 50)
    got = tokenizer_alignment.align_tokenizers(docs, A, B, head, table_bytes, task_pairs)
    assert as_rows(got) == Counter(brute.alignments(rows, A, B))


def test_empty_tables(spark, no_docs):
    assert tokenizer_alignment.align_tokenizers(no_docs, A, B).count() == 0
    blank = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    zeros = (0, 0, 0, 0, 0, 0, "")
    assert as_rows(tokenizer_alignment.align_tokenizers(blank, A, B)) == {(1, *zeros): 1, (None, *zeros): 1}


def test_only_vocabularies_that_units_suit():
    with pytest.raises(ValueError):
        tokenizer_alignment.Vocabularies(public_tokenizers.path("word_bpe_49k.json"), B)
    v = tokenizer_alignment.Vocabularies(A, B)
    assert all(v.a_bytes[a] == v.b_bytes[b] for a, b in enumerate(v.identity) if b >= 0) and (v.identity >= 0).sum() > 10_000
