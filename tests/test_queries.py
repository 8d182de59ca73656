"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as contract
from check_oracle import compare
from workload.inputs import TABLES

SF_DIR = "/root/testdata/sf0.001"
LLM = re.compile(r"op\d+_|pipeline$")  # tested with their subpackage
LARGER = {"effect_model", "random_effects"}  # nothing to fit on the smallest tables


@pytest.fixture(scope="module")
def databases():
    found = {}
    for folder in (SF_DIR, "/root/testdata/sf0.01"):
        found[folder] = duckdb.connect()
        for table in TABLES:
            found[folder].execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return found


def test_every_query_has_sql():
    assert not [q for q in set(contract.queries()) - set(contract.oracle_sql()) if not LLM.match(q)]


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(q for q in contract.queries() if not LLM.match(q)))
def test_query(spark, databases, name):
    folder = "/root/testdata/sf0.01" if name in LARGER else SF_DIR
    verdict, _ = compare(spark, databases[folder], name, folder)
    assert verdict.startswith("ok"), verdict
