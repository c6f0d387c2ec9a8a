"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from showcase import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    from conftest import TESTDATA

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA}/sf0.001/{name}.parquet'"
        )
    return connection


def _sorted(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(name, spark, oracle, sf, capsys):
    frame = queries()[name](spark, sf)
    ours = _sorted(frame.toPandas())
    theirs = _sorted(oracle.execute(oracle_sql()[name]).df())
    assert len(theirs) > 0
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False, check_exact=True)
    frame.explain()
    plan = capsys.readouterr().out
    for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert step not in plan


def test_flagship(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())
