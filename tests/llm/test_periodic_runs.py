"""Periodic runs, against a search over all periods; the transform alone; long and odd texts."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from corpus_fixtures import documents, nothing, texts  # noqa: F401  (fixtures)
from conftest import TESTDATA
from hypothesis import given, settings
from hypothesis import strategies as st

from sluiceway.llm import periodic_runs
from sluiceway.llm.periodic_runs import mismatches, numbered
from sluiceway.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def all_runs(words):
    """Start, length and period of each run: every period is tried on every place."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        same = np.zeros(len(words) - q + 2, np.int8)
        same[1:-1] = [words[i] == words[i + q] for i in range(len(words) - q)]
        change = np.diff(same)
        for low, high in zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist(), strict=True):
            if high - low + q >= max(12, 2 * q):
                found.setdefault((low, high - low + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain(key, text):
    words = WORD.findall(text or "")
    n = len(words)
    if key is not None and n and (h := zlib.crc32(str(key).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = all_runs(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    return (
        key, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


@pytest.mark.parametrize("size", [2, 8, 64])
def test_transform_is_exact(size):
    draw = np.random.default_rng(size)
    for largest in (1, 50, 10**6):
        blocks = draw.integers(0, largest + 1, (5, size))
        windows = draw.integers(0, largest + 1, (5, 3 * size - 1))
        windows[2, 3 : 3 + size] = blocks[2]
        sums = mismatches(blocks, windows, largest)
        equal = np.array([[(w[t : t + size] == b).all() for t in range(2 * size)] for b, w in zip(blocks, windows, strict=True)])
        assert ((sums == 0) == equal).all() and (sums >= 0).all() and equal[2, 3]
        if largest <= 50:  # one digit: the sums themselves
            assert sums[0, 1] == np.square(blocks[0] - windows[0, 1 : 1 + size]).sum()


def mixed_text(draw):
    kinds = draw.choice([1, 2, 2, 3, 5, 60])
    words = [b"%d" % draw.randrange(kinds) for _ in range(draw.choice([0, 1, 11, 12, 13, 40, 150]))]
    for _ in range(draw.randrange(4)):
        if words:
            a, p = draw.randrange(len(words)), draw.randint(1, 50)
            unit = words[a : a + p]
            words[a:a] = unit * draw.randint(1, 5) + unit[: draw.randint(0, len(unit))]
    return words


@settings(max_examples=120, deadline=None)
@given(st.randoms(use_true_random=False), st.sampled_from([4, 2**17]))
def test_runs_against_all_periods(draw, part):
    before, periodic_runs.LONGEST_BLOCK = periodic_runs.LONGEST_BLOCK, part
    try:
        words = [mixed_text(draw) for _ in range(6)]
        runs = numbered(words).runs()
        for k, own in enumerate(words):
            assert sorted(tuple(r[1:]) for r in runs[runs[:, 0] == k].tolist()) == all_runs(own)
    finally:
        periodic_runs.LONGEST_BLOCK = before


def test_long_runs():
    assert numbered([[b"a"] * 300_000, [], [b"b"] * 11, [b"b"] * 12]).runs().tolist() == [[0, 0, 300_000, 1], [3, 0, 12, 1]]
    words = [b"%d" % (n % 40_001) for n in range(120_000)]
    assert numbered([[b"x", *words, b"y"]]).runs().tolist() == [[0, 1, 120_000, 40_001]]


def test_rows(documents, texts, nothing):
    found = periodic_runs.periodic_runs(documents)
    assert collections.Counter(map(tuple, found.collect())) == collections.Counter(plain(*row) for row in texts)
    assert periodic_runs.periodic_runs(nothing).collect() == []
    bare = {r.doc_id: r.n_runs for r in periodic_runs.periodic_runs(documents, plant=False).where("n_runs > 0").collect()}
    assert {16, 19} <= set(bare)


def test_planted_tails(spark, texts):
    base = texts[0][1]
    rows = [(key, base) for key in range(100, 160)] + [(None, base), (100, ""), (101, None), (102, "one")]
    found = periodic_runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert collections.Counter(map(tuple, found)) == collections.Counter(plain(*row) for row in rows)
    planted = [key for key in range(100, 160) if zlib.crc32(str(key).encode()) % 10 == 0]
    assert len(planted) > 3 and {r.doc_id for r in found if r.n_runs} <= set(planted)


def test_query_against_all_periods(spark, sf):
    import pyarrow.parquet

    rows = pyarrow.parquet.read_table(TESTDATA / "sf0.001" / "documents.parquet", columns=["doc_id", "text"]).to_pylist()
    short = {r["doc_id"]: r["text"] for r in rows if len(WORD.findall(r["text"] or "")) <= 1500}
    found = {r.doc_id: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, sf).collect()}
    assert len(found) == len(rows) and len(short) > 0.9 * len(rows)
    assert {i: found[i] for i in short} == {i: plain(i, t) for i, t in short.items()}
    draw = random.Random(1)
    for row in draw.sample([r for r in rows if r["doc_id"] not in short], min(2, len(rows) - len(short))):
        assert found[row["doc_id"]] == plain(row["doc_id"], row["text"])
