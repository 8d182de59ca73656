"""Tables stored in one folder per value of some columns, changed folder by folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from fieldmosaic.runtime import materialize

MOST_NAMES = 2000  # folder names that a plan spells out


def read_folders(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The stored rows, with the types given rather than those the folder names suggest; nothing stored gives no rows."""
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_folders(rows: DataFrame, path: str, folders: list[str]) -> None:
    """Write the rows as whole folders; folders without a row among them are left as they are.

    The rebalance hint gathers a folder in few files and cuts one that is too big for one task. New files
    appear when all tasks are done, and a failed job is simply run again.
    """
    (
        rows.hint("rebalance", *folders).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)
    )


def update_folders(
    path: str, schema: StructType, batch: DataFrame, folders: list[str], change: Callable[[DataFrame, DataFrame], DataFrame]
) -> None:
    """Put `change(stored rows, batch)` in place of the folders that the batch names, and leave all others untouched.

    `change` sees the stored rows of the named folders only and must keep its rows within them, as upserts by a
    key that includes `folders` do. An empty batch changes nothing. A null or empty folder value is refused
    (ValueError): storage knows no difference between the two. Other folders are not opened, as long as the batch names
    MOST_NAMES folders at most; a larger batch reads the whole table and still rewrites its own folders only. If
    `change` is an upsert, a job that failed half way may be run again.
    """
    spark = batch.sparkSession
    batch = materialize(batch)
    nameless = reduce(or_, [F.coalesce(F.col(c).cast("string") == "", F.lit(True)) for c in folders])
    state = batch.agg(F.count("*").alias("rows"), F.count_if(nameless).alias("nameless")).first()
    if state.nameless:
        raise ValueError(f"{state.nameless} rows without a value in {', '.join(folders)}")
    if not state.rows:
        return
    stored = read_folders(spark, path, schema)
    named = batch.select(*folders).distinct()
    names = named.limit(MOST_NAMES + 1).collect()
    if len(names) <= MOST_NAMES:
        stored = stored.where(F.struct(*folders).isin([F.struct(*[F.lit(r[c]).alias(c) for c in folders]) for r in names]))
    touched = stored.join(named, folders, "left_semi").select(*schema.names)
    write_folders(change(touched, batch).select(*schema.names), path, folders)
