"""One row per key, and a batch merged into a table, against plain Python."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from sluiceway.operators import latest_per_key, matched_keys, merge_rows, unmatched_rows

KEYS = st.integers(0, 4)
VALUES = st.one_of(st.none(), st.integers(-3, 3))
ROWS = st.lists(st.tuples(KEYS, VALUES, VALUES), max_size=12)
some = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def rank(value):
    return (value is not None, value or 0)


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=lambda row: [rank(v) for v in row])


@some
@given(batch=ROWS)
def test_largest_row_wins(spark, batch):
    frame = spark.createDataFrame(batch, "k int, a int, b int")
    expected = {}
    for k, a, b in batch:
        best = expected.get(k)
        if best is None or (rank(a), rank(b)) > (rank(best[0]), rank(best[1])):
            expected[k] = (a, b)
    assert rows(latest_per_key(frame, ["k"])) == sorted((k, *v) for k, v in expected.items())


@some
@given(batch=ROWS)
def test_last_by_order_wins(spark, batch):
    frame = spark.createDataFrame(batch, "k int, a int, b int")
    expected = {}
    for k, a, b in batch:
        best = expected.get(k)
        if best is None or (rank(b), rank(a)) > (rank(best[1]), rank(best[0])):
            expected[k] = (a, b)
    result = latest_per_key(frame, ["k"], ["b"])
    assert result.columns == ["k", "a", "b"]
    assert rows(result) == sorted((k, *v) for k, v in expected.items())


@some
@given(table=ROWS, batch=st.dictionaries(KEYS, st.tuples(VALUES, VALUES)))
def test_merge(spark, table, batch):
    old = spark.createDataFrame(table, "k int, a int, b int")
    new = spark.createDataFrame([(k, b, c) for k, (b, c) in batch.items()], "k int, b int, c int")
    expected = [(k, a, *batch[k]) if k in batch else (k, a, b, None) for k, a, b in table]
    assert rows(merge_rows(old, new, ["k"])) == sorted(expected, key=lambda r: [rank(v) for v in r])
    present = {k for k, _, _ in table}
    for unique in {len(present) == len(table), False}:
        hits = matched_keys(old, new, ["k"], unique)
        assert rows(hits) == sorted((k,) for k in present & batch.keys())
        left = rows(unmatched_rows(new, hits, ["k"]))
        assert [row[0] for row in left] == sorted(batch.keys() - present)


def test_only_keys(spark):
    frame = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "k int, j int")
    assert rows(latest_per_key(frame, ["k", "j"])) == [(1, 2), (1, 3)]
    assert rows(merge_rows(frame, frame, ["k", "j"])) == rows(frame)


def test_maps_need_an_order(spark):
    frame = spark.sql("SELECT id % 2 AS k, id AS n, map('n', id) AS m FROM range(6)")
    with pytest.raises(ValueError, match="order_by"):
        latest_per_key(frame, ["k"])
    result = latest_per_key(frame, ["k"], ["n"])
    assert sorted((r.k, r.n, r.m["n"]) for r in result.collect()) == [(0, 4, 4), (1, 5, 5)]


def test_awkward_column_names(spark):
    frame = spark.createDataFrame([(1, 5), (1, 7)], ["source.id", "a `b`.c"])
    kept = latest_per_key(frame, ["source.id"])
    assert rows(kept) == [(1, 7)] and kept.columns == frame.columns
    assert rows(merge_rows(frame, kept, ["source.id"])) == [(1, 7), (1, 7)]
    assert rows(matched_keys(frame, kept, ["source.id"])) == [(1,)]


def test_key_on_a_third_of_the_rows_is_combined_before_the_shuffle(spark, capsys):
    frame = spark.range(0, 9000, 1, 6).selectExpr("IF(id % 3 = 0, -1, id) AS k", "id AS v")
    kept = latest_per_key(frame, ["k"])
    kept.explain()
    text = capsys.readouterr().out
    assert text.index("Exchange") < text.index("partial_max")
    assert kept.where("k = -1").first()["v"] == 8997
    assert kept.count() == 6001


def test_large_sides_join_without_broadcast(spark, capsys):
    """A table with a hot key stays on the left, where it can be split."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = spark.range(0, 9000, 1, 6).selectExpr("IF(id % 3 = 0, -1, id) AS k", "id AS v")
        batch = spark.createDataFrame([(-1, "hot"), (1, "one"), (-7, "new")], "k long, w string")
        merged = merge_rows(table, batch, ["k"])
        merged.explain()
        assert "LeftOuter" in capsys.readouterr().out
        assert merged.count() == 9000
        assert merged.where("w = 'hot'").count() == 3000
        assert rows(matched_keys(table, batch, ["k"])) == [(-1,), (1,)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
