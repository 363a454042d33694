"""From raw documents to a sharded training corpus, stage by stage.

Every stage works on all that the one before has kept and is written before the
next reads it. The last stage returns the places in the shards; the others
return the columns of the documents. What a stage has written is removed once
the next one has written its own.

All stages take null ids and texts, empty and very long texts, repeated rows, empty
tables and further columns of any name. A repeated row is several documents in all
stages but the second, which keeps one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkrank.llm.bm25_wand import clean_documents
from linkrank.llm.common import read_table
from linkrank.llm.hash_tree import shard_documents
from linkrank.llm.mixing import mixed_corpus
from linkrank.llm.odd_sketch import without_duplicates
from linkrank.llm.toxicity import without_toxic
from linkrank.session import remove, scratch_path


# Percent of the union of two shingle sets that near duplicates share.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learned from all labels, does not find toxic.

    Null and empty texts score like a text that holds no sign of either; equal texts
    all stay or all go.
    """
    return without_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id, null ids last.

    Of equal ids the smaller text hash decides. Texts without words are nobody's
    duplicates and stay, but of rows equal in id and text one stays.
    """
    return without_duplicates(docs, NEAR_PERCENT)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item; null and empty texts hold none, nor does any text if there are no items."""
    return clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the target mix, some of them several times, some not at all.

    The id's hash decides how often (a null id: the text's), so equal ids go together, and
    documents without words count nothing. A null source is a source of its own, the last one.
    """
    return mixed_corpus(docs)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each document of the mix.

    Repeated rows get slots of their own; a null text has size 1, a null id is a key like any other.
    """
    return shard_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("source_mix", mix_sources),
    ("sharding", place_in_shards),
]

# The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents."""
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
