"""Published versions: only whole ones are seen."""

from __future__ import annotations

from pathlib import Path

import pytest

from fieldmosaic.sources import versions


def states(spark, path):
    return {r.version: (r.n_rows, r.n_lost, r.whole) for r in versions.version_states(spark, path).collect()}


def test_newest_whole_version_is_read(spark, tmp_path):
    path = f"{tmp_path}/areas"
    with pytest.raises(FileNotFoundError):
        versions.read_published(spark, path)
    assert versions.publish(spark.range(100).repartition(3), path) == 1
    assert versions.publish(spark.range(7), path) == 2
    assert states(spark, path) == {1: (100, 0, True), 2: (7, 0, True)}
    assert versions.read_published(spark, path).count() == 7 and versions.read_published(spark, path, 1).count() == 100
    with pytest.raises(FileNotFoundError):
        versions.read_published(spark, path, 3)


def test_unfinished_publications_stay_invisible(spark, tmp_path):
    path = f"{tmp_path}/areas"
    versions.publish(spark.range(10).repartition(2), path)
    spark.range(99).write.parquet(f"{path}/parts/unfinished")  # stopped before its manifest
    assert versions.read_published(spark, path).count() == 10
    rows = spark.createDataFrame([("gone/part-0.parquet", 5, 5, "gone")], "part string, bytes long, rows long, token string")
    rows.write.parquet(f"{path}/manifests/version=2")  # a manifest whose part is not there
    assert states(spark, path)[2] == (5, 1, False) and versions.read_published(spark, path).count() == 10
    rows.write.parquet(f"{path}/manifests/version=3/_temporary/0")  # a manifest still being written
    assert set(states(spark, path)) == {1, 2}
    with pytest.raises(FileNotFoundError):
        versions.read_published(spark, path, 2)


def test_damaged_part_falls_back(spark, tmp_path):
    path = f"{tmp_path}/areas"
    versions.publish(spark.range(10), path)
    versions.publish(spark.range(20).repartition(2), path)
    part = sorted(Path(path, "parts", versions.newest(spark, path)[1]).glob("*.parquet"))[0]
    part.write_bytes(part.read_bytes()[:-3])
    assert states(spark, path)[2][1:] == (1, False) and versions.read_published(spark, path).count() == 10


def test_empty_and_odd_columns(spark, tmp_path):
    path = f"{tmp_path}/areas"
    empty = spark.createDataFrame([], "version long, part string, token string")
    versions.publish(empty, path)
    got = versions.read_published(spark, path)
    assert got.columns == empty.columns and got.isEmpty()
