"""One query for each operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.llm.bm25_wand import find_leaks
from linkrank.llm.burst_trie import prefix_trie
from linkrank.llm.common import id_remainder, read_table
from linkrank.llm.de_bruijn import remove_repeats
from linkrank.llm.hash_tree import shard_documents
from linkrank.llm.html_text import extract_pages
from linkrank.llm.langid import identify_languages
from linkrank.llm.mixing import mix_documents
from linkrank.llm.odd_sketch import near_duplicates
from linkrank.llm.prefix_forest import nearest
from linkrank.llm.token_counts import count_tokens
from linkrank.llm.tokenizer_alignment import align_tokenizers
from linkrank.llm.toxicity import score_toxicity
from linkrank.llm.url_filters import judge_urls

TOKENIZER, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
Query = Callable[[SparkSession, str], DataFrame]


def _with_fold(results: DataFrame, modulus: int, held_out: int, *columns: str) -> DataFrame:
    fold = (id_remainder(F.col("doc_id"), modulus) == held_out).alias("held_out")
    return results.select("doc_id", fold, *columns)


def op1_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages"))


def op2_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    learned_from = docs.where(id_remainder(F.col("doc_id"), 5) != 0)
    return _with_fold(identify_languages(docs, learned_from), 5, 0, "lang_pred", "score", "rejected")


def op3_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op4_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"))


def op5_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    learned_from = labels.where(id_remainder(F.col("doc_id"), 4) != 2)
    return _with_fold(score_toxicity(docs, learned_from), 4, 2, "score", "predicted")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_documents(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_de_bruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(read_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_odd_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return leaks.drop("score")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op11_identity_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    return align_tokenizers(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES))


def op12_viterbi_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages"))


def op13_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Query]:
    return {
        "op1_text_density": op1_text_density,
        "op2_centroid_language": op2_centroid_language,
        "op3_prefix_forest": op3_prefix_forest,
        "op4_hash_tree_sharding": op4_hash_tree_sharding,
        "op5_weak_toxicity": op5_weak_toxicity,
        "op6_source_mixing": op6_source_mixing,
        "op7_de_bruijn_dedup": op7_de_bruijn_dedup,
        "op8_odd_sketch_dedup": op8_odd_sketch_dedup,
        "op9_benchmark_leaks": op9_benchmark_leaks,
        "op10_token_counts": op10_token_counts,
        "op11_identity_alignment": op11_identity_alignment,
        "op12_viterbi_url_filter": op12_viterbi_url_filter,
        "op13_burst_trie": op13_burst_trie,
    }
