"""The registered queries on the smallest tables, against SQL where there is some."""

import duckdb
import pandas as pd
import pytest
from conftest import TESTDATA

from sluiceway.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op2_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op5_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op7_sampled_segmentations": "doc_id sample n_pieces log_prob perturbed log_inclusion ids_crc32 round_trip",
    "op9_nearest_neighbours": "query_id rank vec_id score",
    "op10_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op13_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}


def ordered(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(name, spark, sf):
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/sf0.001/{table}.parquet'")
    theirs = ordered(connection.execute(ORACLES[name]).df())
    ours = ordered(QUERIES[name](spark, sf).toPandas())
    assert len(theirs) > 0
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False, check_exact=True)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_columns_and_rows(name, spark, sf):
    frame = QUERIES[name](spark, sf)
    assert frame.columns == COLUMNS[name].split()
    assert frame.count() > 0


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
