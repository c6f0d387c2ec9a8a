"""The operators as queries over whole tables."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.clustering import clusters
from sluiceway.llm.exact_dedup import exact_dedup
from sluiceway.llm.minhash import near_duplicates
from sluiceway.llm.neighbours import nearest
from sluiceway.llm.oracles import ORACLES
from sluiceway.llm.packing import pack
from sluiceway.llm.periodic_runs import periodic_runs
from sluiceway.llm.quality import COUNTS, quality
from sluiceway.llm.sentencepiece_sampling import sampled_segmentations
from sluiceway.llm.sharding import shard_manifest
from sluiceway.llm.substrings import substring_dedup
from sluiceway.llm.suffix_dedup import suffix_dedup
from sluiceway.llm.token_counts import token_counts
from sluiceway.llm.warc import archive_round_trip

SHARDS = 40
TOKEN_LIMIT = 2048
VOCABULARY = "word_bpe_49k.json"


#: The folder of the package, for Python workers that start elsewhere.
ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document into one of 40 shards; a 41st would take rows only into itself."""
    manifest = shard_manifest(table(spark, sf_dir, "documents"), "doc_id", "text", [1.0] * SHARDS)
    return manifest.withColumn("law", F.lit("key")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and trees fitted on the labels, over every document."""
    judged = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by five-word shingles of similarity 0.85 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its words in repeated windows."""
    return substring_dedup(table(spark, sf_dir, "documents")).drop("kept_text")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), size=TOKEN_LIMIT)


def op6_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op7_sampled_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four distinct sampled segmentations of every whole text."""
    return sampled_segmentations(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), count=4
    )


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings of documents with smaller numbers."""
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("kept_bytes")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found for every twentieth vector, among all others."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, count=20)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text, by pair merging."""
    return token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), TOKEN_LIMIT
    )


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays of those with its text, white space aside."""
    return exact_dedup(table(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector in one of 40 clusters, after five rounds."""
    return clusters(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every whole text, periodic tails planted in some."""
    return periodic_runs(table(spark, sf_dir, "documents"))


__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    query.__name__: query
    for query in (
        op1_rendezvous_shards,
        op2_quality_rules,
        op3_minhash_near_dedup,
        op4_substring_dedup,
        op5_best_fit_packing,
        op6_warc_round_trip,
        op7_sampled_segmentations,
        op8_suffix_array_dedup,
        op9_nearest_neighbours,
        op10_token_counts,
        op11_exact_dedup,
        op12_centroid_clustering,
        op13_periodic_runs,
    )
}
