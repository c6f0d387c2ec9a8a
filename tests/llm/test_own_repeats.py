"""Strings that a document has in several surroundings, and a later one in one of these."""

import random
import tracemalloc

import numpy as np
import pytest

from sluiceway.llm import suffix_dedup
from sluiceway.llm.anchored import parts


@pytest.mark.parametrize("others, shard_bytes", [(False, suffix_dedup.SHARD_BYTES), (True, 100)])
def test_repeats_of_one_owner(spark, others, shard_bytes):
    draw = random.Random(3)
    line, *around = ("".join(draw.choice("abcdefgh ") for _ in range(60)) for _ in range(9))
    first = "|".join(a + line[:40] + b for a, b in zip(around[::2], around[1::2]))
    found = zip(*parts(suffix_dedup.CODES[np.frombuffer(first.encode(), np.uint8)], 50, 20)[::3], strict=True)
    starts, anchors = zip(*((int(a), int(b)) for a, b in found), strict=True)
    common = max(anchors, key=anchors.count)
    place, other = [n for n, anchor in enumerate(anchors) if anchor == common][:2]
    texts = [(1, first), (5, first[starts[place] : starts[place + 1] + 49])]  # a part and nothing beside it
    if others:
        texts.append((6, first[starts[other] + 1 : starts[other + 1] + 49]))
    rows = suffix_dedup.suffix_dedup(spark.createDataFrame(texts, "doc_id long, text string"), shard_bytes=shard_bytes).collect()
    found = {r.doc_id: (r.n_removed, r.n_spans, r.kept_bytes.decode()) for r in rows}
    assert found == {key: (0, 0, text) if key == 1 else (len(text), 1, "") for key, text in texts}


def test_memory_of_a_shard():
    """Two tasks of an executor sort a shard each beside its heap, with 1,200 MB for both."""
    draw = np.random.default_rng(3)
    parts = [draw.integers(99, 125, 90).astype(np.uint16) for _ in range(suffix_dedup.SHARD_BYTES // 364)]
    rows = [np.append(np.where(np.arange(90) == k * 20, 50 + k, part), 1) for part in parts for k in range(4)]
    text = np.concatenate([*rows, [0]]).astype(np.uint16)
    starts = np.arange(len(rows)) * 91
    tracemalloc.start()
    least = suffix_dedup.least_owners(text, starts, np.arange(len(rows)), 50, suffix_dedup.HELD_ENTRIES)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert least[91 + 40] == 0 and least[91 + 1] == 1  # windows after the sign that differs, and over it
    assert peak < 350_000_000


def test_parts_of_many_texts(monkeypatch):
    """Parts found together hold the same windows by the same anchors as those of each text, and are hashed by halves."""
    for seed in range(20):
        draw = np.random.default_rng(seed)
        length = int(draw.integers(20, 60))
        gram = int(draw.integers(5, length + 1))
        monkeypatch.setattr(suffix_dedup, "TOGETHER", int(draw.integers(60, 3000)))
        texts = [draw.integers(97, 99 + seed, int(draw.integers(0, 400))).astype(np.uint8) for _ in range(40)]
        found, expected = {}, {}
        for some in suffix_dedup.found_parts(texts, length, gram):
            assert {*suffix_dedup.halves(some, length, gram)[1].tolist()} == {*range(len(some.first))}
            for text, first, count, before, anchor in zip(some.text, some.first, some.count, some.before, some.anchor.view(np.int64)):
                found |= {(text, first + k): (first + before, anchor) for k in range(count)}
        for n, text in enumerate(texts):
            for first, count, before, anchor, _ in zip(*parts(suffix_dedup.CODES[text], length, gram)):
                expected |= {(n, first + k): (first + before, anchor) for k in range(count)}
        assert found == expected


def test_only_parts_with_shared_bytes_are_rows(spark):
    """A gram that texts share gives no row unless as many bytes beside it are shared as half of a window has."""
    draw = random.Random(5)
    alone = ["".join(draw.choice("abcdefgh ") for _ in range(3000)) for _ in range(40)]
    gram, passage = alone[0][:20], alone[1][500:580]
    texts = [(n, text + gram + text[::-1] if n < 30 else text + passage, n) for n, text in enumerate(alone)]
    frame = spark.createDataFrame(texts, "n long, text string, owner long").selectExpr("*", "n DIV 8 page")
    others = suffix_dedup.common_halves(frame, 50, 20, 7)
    rows = suffix_dedup.byte_parts(frame, others, 50, 20, 7).collect()
    assert {r.n for r in rows} == {1, *range(30, 40)}  # each text has some 375 parts
    assert all(bytes(r.bytes) in texts[r.n][1].encode() for r in rows) and len(rows) < 12 * 11
