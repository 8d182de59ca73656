"""Statistics tables, JSON documents and earlier outputs as sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldmosaic.operators.records import json_shape

OUTPUT_NAME = r"_processed_(.+)_(\d{8})(?:\.(?:csv|parquet))?/?$"


def load_statistics(spark: SparkSession, root: str, dataset: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A statistics dataset by name, from a folder of tables; with fmt jdbc, `root` is the connection URL."""
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(url=root, dbtable=dataset, **options).load()
    return spark.read.format(fmt).options(**options).load(f"{root}/{dataset}.{fmt}")


def load_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents of a path as (path, shape, document); only objects and lists of objects."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return text.withColumn("shape", json_shape(F.col("value"))).where("shape is not null").select(
        "path", "shape", F.parse_json("value").alias("document")
    )


def output_layer(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, OUTPUT_NAME, 1), F.lit(""))


def output_date(path: Column) -> Column:
    return F.to_date(F.nullif(F.regexp_extract(path, OUTPUT_NAME, 2), F.lit("")), "yyyyMMdd")


def latest_output(paths: DataFrame) -> DataFrame:
    """Newest output path per layer."""
    dated = paths.select("path", output_layer(F.col("path")).alias("layer"), output_date(F.col("path")).alias("day"))
    return dated.where("layer is not null").groupBy("layer").agg(F.max_by("path", F.struct("day", "path")).alias("path"))


def list_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Output folders and files under `folder`, named without reading their contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    return files.select(F.regexp_extract("path", r"^(.*?_processed_.+?_\d{8}(?:\.[a-z]+)?)(?:/|$)", 1).alias("path")).where("path != ''").distinct()
