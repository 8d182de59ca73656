"""Oracle queries and the pipeline."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from check_oracle import compare
from fieldmosaic.llm.queries import ORACLES
from workload.inputs import TABLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    assert compare(spark, db, name, SF_DIR)[0].startswith("ok")


def test_stages_keep_columns_and_take_edge_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame([(10_001, None, None, None, None), (None, "", "en", "s", 0), (10_002, " \n", "en", "s", 2), (10_002, " \n", "en", "s", 2)], docs.schema)
    for rows in (docs.union(odd), docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            before, rows = rows.count(), corpus_pipeline.stored(stage(spark, rows, SF_DIR), "stage")
            assert rows.columns == docs.columns and rows.count() <= before
        tokens = corpus_pipeline.STAGES[-1][1](spark, rows, SF_DIR)
        assert tokens.columns == ["doc_id", "n_tokens", "ids"] and tokens.count() == rows.count()
