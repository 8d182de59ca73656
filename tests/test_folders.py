"""Stored tables that are changed folder by folder."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fieldmosaic.operators import ledger
from fieldmosaic.schemas import LEDGER_FOLDERS
from fieldmosaic.sources import folders

STORE = "id long, area_id string, area_level string, classification string, shp_version string, stage string, file_path string, layer_updated boolean, recorded_at date"
RESULTS = "area_id string, area_level string, classification string, shp_version string, stage string, file_path string, recorded_at date, status string, pos long"


def files(path):
    return {str(p.relative_to(path)) for p in Path(path).rglob("*.parquet")}


def ledger_of(spark, path):
    rows = [(i, f"A{i}", "town", f"layer{i % 3}", str(2020 + i % 2), "raw", f"old/{i}", False, None) for i in range(60)]
    df = spark.createDataFrame(rows, STORE)
    folders.write_folders(df, path, LEDGER_FOLDERS)
    return df


def test_only_named_folders_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "ledger")
    schema, before = ledger_of(spark, path).schema, files(path)
    sent = spark.createDataFrame(
        [("A0", "town", "layer0", "2020", "raw", "new/0", None, "updated", 1), ("X", "town", "layer0", "2020", "raw", "new/x", None, "created", 2),
         ("X", "town", "layer9", "2020", "raw", "new/y", None, "created", 3), ("A1", "town", "layer1", "2021", "raw", "new/1", None, "error", 4)], RESULTS)
    for _ in range(2):  # logged again, as after a failure
        ledger.log_into_store(path, schema, sent, "pos")
        after = files(path)
        touched = ("shp_version=2020/classification=layer0", "shp_version=2020/classification=layer9")
        assert {f for f in before if not f.startswith(touched)} == {f for f in after if not f.startswith(touched)}
        assert not {f for f in before & after if f.startswith(touched)}
        stored = {r.id: (r.area_id, r.shp_version, r.file_path) for r in folders.read_folders(spark, path, schema).collect()}
        assert len(stored) == 62 and stored[0] == ("A0", "2020", "new/0") and stored[1] == ("A1", "2021", "old/1")
        assert sorted(stored[i][2] for i in (60, 61)) == ["new/x", "new/y"]


def test_odd_batches(spark, tmp_path):
    path = str(tmp_path / "ledger")
    schema, before = ledger_of(spark, path).schema, files(path)
    ledger.log_into_store(path, schema, spark.createDataFrame([], RESULTS), "pos")
    for version in (None, ""):
        with pytest.raises(ValueError):
            ledger.log_into_store(path, schema, spark.createDataFrame([("A0", "town", "layer0", version, "raw", "n", None, "updated", 1)], RESULTS), "pos")
    assert files(path) == before
    fresh = str(tmp_path / "none")
    ledger.log_into_store(fresh, schema, spark.createDataFrame([("A0", "town", "layer0", "2020", "raw", "n", None, "updated", 1)], RESULTS), "pos")
    assert [r.id for r in folders.read_folders(spark, fresh, schema).collect()] == [1]


def test_other_folders_are_not_read(spark, tmp_path):
    """A damaged file of another folder does no harm to the rewrite, since nothing but the named folders is opened."""
    path = str(tmp_path / "ledger")
    schema = ledger_of(spark, path).schema
    for file in Path(path, "shp_version=2021").rglob("*.parquet"):
        file.write_bytes(b"damaged")
    batch = spark.createDataFrame([("layer0", "2020")], "classification string, shp_version string")
    folders.update_folders(path, schema, batch, LEDGER_FOLDERS, lambda stored, _: stored.withColumn("file_path", F.lit("seen")))
    assert {r.file_path for r in spark.read.schema(schema).parquet(f"{path}/shp_version=2020/classification=layer0").collect()} == {"seen"}
