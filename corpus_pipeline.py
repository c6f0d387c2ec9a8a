"""A corpus from raw documents to packed sequences, in stages that are each written before the next.

Stages take the session, documents and the folder of the tables, and return the columns of the
documents with the stage's decisions carried out; the last returns the packed pieces. Rows with a
null key are judged like others; as copies they go before rows with a key. An empty table stays empty.
"""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.minhash import near_duplicates
from sluiceway.llm.packing import pack
from sluiceway.llm.quality import quality
from sluiceway.llm.shared import Staged
from sluiceway.llm.substrings import substring_dedup

#: Hundredths of five-word shingles in common from which documents are near copies.
NEAR_PERCENT = 80
SEQUENCE_TOKENS = 2048
ROOT = str(Path(__file__).resolve().parent)


def plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents under names that clash with none of an operator's, and those names."""
    names = {name: f"document_{n}" for n, name in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the trees are fitted on the labels of the tables."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    body, names = plain(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumnRenamed("doc_id", names["doc_id"])
    judged = quality(body, labels, names["doc_id"], names["text"], keep=[*names.values()])
    return judged.where("kept").select(*(F.col(own).alias(name) for name, own in names.items()))


def near_key(key: str, text: str) -> Column:
    """A number for each key and text, in the order of the keys; null keys come last."""
    # 2 to the 63rd is above every key, and 62 bits of the text's hash are below the key's
    own = F.coalesce(F.col(key).cast("decimal(20,0)"), F.lit(str(2**63)).cast("decimal(20,0)"))
    low = F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 2).cast("decimal(20,0)")
    return (own * F.lit(str(2**62)).cast("decimal(20,0)") + low).cast("decimal(38,0)")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies exactly one row, one of the smallest key.

    Different texts of one key are documents of their own, and null keys are larger than any other.
    Of rows with one key and one text, which one stays is not fixed.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    body, names = plain(docs)
    text = names["text"]
    body = body.withColumn("near_key", near_key(names["doc_id"], text))
    judged = near_duplicates(body, "near_key", text, percent=NEAR_PERCENT)
    notes = judged.groupBy("near_key").agg(F.min("kept").alias("stays"), F.count(F.lit(1)).alias("n"))
    notes = Staged(notes.where("n > 1 OR NOT stays"), "near-copies").read()
    once = body.join(notes, "near_key", "left_anti").select(*body.columns)
    several = body.join(notes.where("stays"), "near_key", "left_semi").select(*body.columns)
    kept = once.unionByName(several.dropDuplicates(["near_key", text]))
    return kept.select(*(F.col(own).alias(name) for name, own in names.items()))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated passages; one that loses every word stays, with an empty text.

    ``n_chars`` follows the text.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    body, names = plain(docs)
    shorter = substring_dedup(body, names["doc_id"], names["text"], keep=[*names.values()])
    new = {name: F.col(own) for name, own in names.items()} | {"text": F.col("kept_text")}
    if "n_chars" in names:
        own = F.col(names["n_chars"])
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(own).cast(docs.schema["n_chars"].dataType)
    return shorter.select(*(new[name].alias(name) for name in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), size=SEQUENCE_TOKENS)


STAGES = [
    ("quality rules", keep_good),
    ("MinHash near-dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("best-fit packing", pack_sequences),
]

#: The trees of the first stage are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = Staged(stage(spark, docs, sf_dir), name.replace(" ", "-")).read()
    return STAGES[-1][1](spark, docs, sf_dir)
