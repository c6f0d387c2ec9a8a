"""Weighted rendezvous hashing of record keys over shards, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.shared import Staged, part_count

#: Rows numbered together by one window task.
BLOCK_ROWS = 50_000


def uniform(text: Column) -> Column:
    """A number strictly between 0 and 1 from 52 bits of a text's MD5."""
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(2**52)


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard whose draw for the key is smallest; a struct of ``score`` and ``shard``.

    Each shard draws from an exponential law with its weight as rate, so it wins rows in proportion
    to its weight, and a further shard takes rows only into itself. Equal draws go to the smaller
    number. A null key counts as the empty text.
    """
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.array_min(
        F.array(
            *(
                F.struct(
                    (-F.log(uniform(F.concat(F.lit(f"{shard}:"), text))) / weight).alias("score"),
                    F.lit(shard).alias("shard"),
                )
                for shard, weight in enumerate(weights)
            )
        )
    )


def with_shard(records: DataFrame, key: str, weights: list[float], name: str = "shard") -> DataFrame:
    """Records with the number of their shard in a column of the given name."""
    return records.withColumn(name, rendezvous(F.col(key), weights)["shard"])


def shard_manifest(
    records: DataFrame, key: str, text: str, weights: list[float], block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """A row per record: key, ``size``, ``text_crc32``, ``shard``, ``slot``, ``grown_shard``.

    ``slot`` numbers the records of a shard without gaps, in the order of a hash of the row.
    ``grown_shard`` is the shard with one more of weight 1. A null text has no bytes; a null key is
    the empty key; equal rows get slots of their own; no rows give none. Other columns of the
    records are not read.

    Only keys and digests are shuffled. Equal rows are counted before the shuffle. Rows are
    numbered in blocks of the hash's range, and only the blocks' counts are added up by shard.
    """
    spark = records.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    digests = (
        records.select(
            F.col(key).alias("key"),
            (F.octet_length(body).cast("long") + 16).alias("size"),
            F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        )
        .groupBy("key", "size", "text_crc32")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    base = rendezvous(F.col("key"), weights)
    more = F.struct(
        (-F.log(uniform(F.concat(F.lit(f"{len(weights)}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))))).alias(
            "score"
        ),
        F.lit(len(weights)).alias("shard"),
    )
    placed = Staged(
        digests.withColumn("best", base)
        .withColumn("more", more)
        .select(
            "key",
            "size",
            "text_crc32",
            "copies",
            F.md5(
                F.concat_ws("|", F.coalesce(F.col("key").cast("string"), F.lit("")), "text_crc32", "size")
            ).alias("place"),
            F.col("best.shard").alias("shard"),
            F.least("best", "more")["shard"].alias("grown_shard"),
        ),
        "shards",
    ).read()
    blocks = part_count(spark, placed.count(), block_rows)
    block = F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * blocks / F.lit(2**32)).cast("int")
    placed = placed.withColumn("block", block)
    counts = placed.groupBy("shard", "block").agg(F.sum("copies").alias("rows"))
    starts = counts.select(
        "shard",
        "block",
        (F.sum("rows").over(Window.partitionBy("shard").orderBy("block")) - F.col("rows")).alias("start"),
    )
    before = Window.partitionBy("shard", "block").orderBy("place", "key").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("within", F.coalesce(F.sum("copies").over(before), F.lit(0)))
        .join(starts, ["shard", "block"])
        .withColumn("first", F.col("start") + F.col("within"))
        .select(
            F.col("key").alias(key),
            "size",
            "text_crc32",
            "shard",
            F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1)).alias("slot"),
            "grown_shard",
        )
    )
