"""Exact duplicates, against dictionaries; the hash alone, histories, hot groups and odd rows."""

import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
from corpus_fixtures import documents, nothing, texts  # noqa: F401  (fixtures)
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceway.llm import exact_dedup
from sluiceway.llm.exact_dedup import PerfectHash, digested, words_of, write_history


def digest(n):
    return hashlib.sha256(str(n).encode()).digest()


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 10_000), max_size=400))
def test_hash_is_minimal_and_perfect(numbers):
    words = words_of(pa.array([digest(n) for n in sorted(numbers)], pa.binary()))
    hashed = PerfectHash.build(words)
    assert sorted(hashed.slots(words).tolist()) == list(range(len(numbers)))
    others = hashed.slots(words_of(pa.array([digest(-n) for n in range(1, 50)], pa.binary())))
    assert others.min() >= -1 and others.max() < max(1, len(numbers))


def test_digests_that_differ_in_one_word_part():
    words = np.zeros((200, 4), np.uint64)
    words[:, 2] = np.arange(200)
    assert sorted(PerfectHash.build(words).slots(words).tolist()) == list(range(200))


def plain(rows):
    """Rows of ``exact_dedup`` but for which of equal rows stays."""
    groups = collections.defaultdict(list)
    strip = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    for key, text in rows:
        groups[strip(text)].append((-len(text or ""), key is None, key or 0, key))
    out = collections.Counter()
    for text, members in groups.items():
        keep = min(members)[3]
        for n, member in enumerate(sorted(members)):
            out[member[3], keep, len(members), n == 0, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


def test_rows(documents, texts, nothing):
    found = exact_dedup.exact_dedup(documents)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert collections.Counter(map(tuple, found.collect())) == plain(texts)
    assert exact_dedup.exact_dedup(nothing).collect() == []


def test_white_space_length_and_ties(spark):
    rows = [
        (5, "a b"), (4, "a  b"), (3, "a \t b"), (2, "a\x0b\n b"), (9, " a b"), (None, "a \t b"), (7, ""), (8, " "),
        (6, None), (None, None), (11, "x" * 300_000), (10, "x" * 300_000), (12, "é"), (13, "é"), (1, "a\x0b\n b"), (1, "a\x0b\n b"),
    ]
    frame = spark.createDataFrame(rows, "keep_id long, row string").repartition(5)
    found = exact_dedup.exact_dedup(frame, "keep_id", "row", bucket_rows=3)
    assert collections.Counter(tuple(r) for r in found.collect()) == plain(rows)


def test_one_text_of_a_third_of_all_rows(spark):
    frame = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the same")).otherwise(F.concat(F.lit("own "), F.col("id"))).alias("text"),
    )
    found = exact_dedup.exact_dedup(frame, bucket_rows=50)
    assert found.where("kept").count() == 4001
    assert {(r.keep_id, r.group_size) for r in found.where("group_size > 1").collect()} == {(0, 2000)}


def test_histories(spark, tmp_path):
    """Texts of earlier batches are repeats of the rows located there; others form a history of their own."""
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    first = [(1, "one"), (2, "o n e"), (3, "two")]
    history = write_history(digested(frame(first)), str(tmp_path / "first"), bucket_rows=1, least=1)
    second = [(4, "one "), (5, "three"), (6, "thr ee"), (7, "o  n  e")]
    new = str(tmp_path / "second")
    found = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(frame(second), history=[history], new_history=new).collect()}
    # the longer text of the second batch stays out: its history has published the row that stays
    assert found == {4: (2, 2, False), 7: (2, 2, False), 5: (6, 2, False), 6: (6, 2, True)}
    later = exact_dedup.History(spark, new, exact_dedup.LEAST_BUCKETS)
    third = [(8, "two"), (9, "three"), (10, "four"), (11, None)]
    found = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.exact_dedup(frame(third), history=[history, later]).collect()}
    assert found == {8: (3, False), 9: (6, False), 10: (10, True), 11: (11, True)}


def test_lookup_compares_whole_digests(spark, tmp_path):
    """A digest that draws a slot but is not the one kept there is unknown."""
    rows = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    history = write_history(digested(rows), str(tmp_path / "h"), least=1)
    bucket = exact_dedup.Bucket(history.path, 0)
    strangers = pa.array([digest(n) for n in range(300)], pa.binary())
    assert (bucket.hashed.slots(words_of(strangers)) >= 0).sum() > 100
    assert bucket.find(strangers)[1].null_count == 300
