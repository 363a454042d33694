"""How evenly a key spreads rows over buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.functions.keys import first_character_bucket, md5_bucket


def place_by_bucket(edges: DataFrame, buckets: int) -> DataFrame:
    """The rows of ``edges`` in ``buckets`` partitions: each in the one whose number is the md5 bucket of its source.

    A NULL source has no bucket and lies in partition 0. All rows of a page lie
    together, so a page of a third of all rows fills one partition: this is for
    work that asks for that placement. ``prepare_graph`` splits such pages.
    """
    bucket = F.coalesce(md5_bucket(F.col("source").cast("string"), buckets), F.lit(0))
    return edges.repartitionById(buckets, bucket.cast("int"))


def partition_sizes(placed: DataFrame) -> DataFrame:
    """``partition, n_rows`` of the partitions that hold rows, as they lie."""
    rows = placed.select(F.spark_partition_id().cast("bigint").alias("partition"))
    return rows.groupBy("partition").agg(F.count(F.lit(1)).alias("n_rows"))


def bucket_sizes(edges: DataFrame, buckets: int) -> DataFrame:
    """``key_rule, bucket, n_rows``: rows per bucket of the source page.

    ``whole_key`` hashes the page, ``first_character`` only its first
    character. Buckets without rows are not listed.
    """
    # Rows are counted by bucket and first character before the second hash,
    # which then has few rows left to look at.
    source = F.col("source").cast("string")
    counted = edges.groupBy(
        md5_bucket(source, buckets).alias("whole_key"), F.substring(source, 1, 1).alias("start")
    ).agg(F.count(F.lit(1)).alias("n_rows"))
    rules = F.create_map(
        F.lit("whole_key"),
        F.col("whole_key"),
        F.lit("first_character"),
        first_character_bucket(F.col("start"), buckets),
    )
    return (
        counted.select(F.explode(rules).alias("key_rule", "bucket"), "n_rows")
        .groupBy("key_rule", "bucket")
        .agg(F.sum("n_rows").alias("n_rows"))
    )
