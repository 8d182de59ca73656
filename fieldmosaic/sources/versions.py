"""Published versions of a table: parts first, then a manifest that names them.

Every publication writes its rows to a folder of its own, lists the files with their sizes, and
at last writes that list, the manifest, as one file under a new number. A reader takes the newest
manifest whose files are all there in full; what a failed or unfinished publication left behind
is named by no manifest and stays invisible.

    path/parts/<token>/...                data of one publication
    path/manifests/version=<n>/...        (part, bytes, rows, token), one row per file

Manifests are read and written by Spark, so path may lie on any file system it knows. Two
publishers at once: the second to claim a number gets an error and the table keeps the first.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

MANIFEST = "version long, part string, bytes long, rows long, token string"
NO_PART = ""  # the part of a publication without files


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """(version, part, bytes, rows, token) of every manifest; none if nothing was published.

    A manifest is one file that appears under its name when it is complete, so there is no half of one.
    """
    try:
        rows = spark.read.schema(MANIFEST).option("basePath", f"{path}/manifests").parquet(f"{path}/manifests")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)
    return rows.select("version", "part", "bytes", "rows", "token")


def version_states(spark: SparkSession, path: str) -> DataFrame:
    """(version, n_parts, n_rows, n_lost, whole) per manifest; a part is lost if its file is gone or has another size."""
    wanted = manifests(spark, path)
    there = _files(spark, f"{path}/parts").select(F.regexp_extract("file", r"/parts/([^/]+/[^/]+)$", 1).alias("part"), F.col("bytes").alias("_bytes"))
    real = F.col("part") != NO_PART
    lost = real & ~F.coalesce(F.col("_bytes") == F.col("bytes"), F.lit(False))
    states = wanted.join(there, "part", "left").groupBy("version").agg(
        F.count_if(real).alias("n_parts"), F.sum("rows").alias("n_rows"), F.count_if(lost).alias("n_lost")
    )
    return states.withColumn("whole", F.col("n_lost") == 0)


def publish(df: DataFrame, path: str) -> int:
    """Write the rows as the next version and return its number; readers see it once its manifest is there."""
    spark, token = df.sparkSession, uuid.uuid4().hex
    folder = f"{path}/parts/{token}"
    df.write.mode("errorifexists").parquet(folder)
    known = manifests(spark, path).agg(F.max("version")).first()[0]
    number = 1 + (known or 0)
    data = spark.read.schema(df.schema).parquet(folder)
    counts = data.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
    parts = _files(spark, folder, "*.parquet").withColumn("name", F.substring_index("file", "/", -1)).join(
        counts.select(F.substring_index("file", "/", -1).alias("name"), "rows"), "name", "left")
    listed = parts.select(F.concat(F.lit(f"{token}/"), "name").alias("part"), "bytes", F.coalesce("rows", F.lit(0)).alias("rows"), F.lit(token).alias("token"))
    none = spark.range(1).select(F.lit(NO_PART).alias("part"), F.lit(0).cast("long").alias("bytes"), F.lit(0).cast("long").alias("rows"), F.lit(token).alias("token"))
    listed.unionByName(none).coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifests/version={number}")
    return number


def newest(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """Number and token of the newest whole version, if there is one."""
    whole = version_states(spark, path).where("whole").select("version")
    row = manifests(spark, path).join(whole, "version").orderBy(F.col("version").desc()).select("version", "token").first()
    return (row.version, row.token) if row else None


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the newest whole version, or of the one named; a version that is not whole is refused."""
    if version is None:
        found = newest(spark, path)
    else:
        row = manifests(spark, path).where(F.col("version") == version).join(version_states(spark, path).where("whole"), "version", "left_semi").first()
        found = (row.version, row.token) if row else None
    if found is None:
        raise FileNotFoundError(f"{path}: no whole version" if version is None else f"{path}: version {version} is not whole")
    return spark.read.parquet(f"{path}/parts/{found[1]}")


def _files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(file, bytes) below a folder, contents unread; a folder that is not there has none."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    try:
        return reader.load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file string, bytes long")
