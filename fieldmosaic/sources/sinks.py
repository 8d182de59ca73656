"""Training sets, pixel stores and JSON documents as sinks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

FORMATS = ("csv", "parquet")


def export_path(folder: str, layer: str, fmt: str, day: date) -> str:
    return f"{folder}/GIS_processed_{layer}_{day:%Y%m%d}.{fmt}"


def export_training_set(df: DataFrame, folder: str, layer: str, fmt: str = "parquet", day: date | None = None) -> str:
    """Write the training set under its dated name and return the path; parts are written in parallel."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    path = export_path(folder, layer, fmt, day or date.today())
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.format(fmt).save(path)
    return path


def write_pixels(pixels: DataFrame, path: str) -> None:
    """Pixel store by version, stage and layer.

    The rebalance hint gathers each folder in few files and cuts a folder that is too big for
    one task.
    """
    folders = ["shp_version", "stage", "classification"]
    pixels.hint("rebalance", *folders).write.mode("overwrite").partitionBy(*folders).parquet(path)


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("encoding", "UTF-8").json(path)
    return path


def replace_table(df: DataFrame, path: str) -> None:
    """All-or-nothing write: checked rows go to a path nobody reads yet; it must not exist."""
    df.write.mode("errorifexists").parquet(path)
