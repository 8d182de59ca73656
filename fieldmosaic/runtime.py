"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fieldmosaic")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for checkpoints, taken from the session.

    A folder of this machine is made up only in local mode, where one JVM holds
    driver and executors; a cluster without the setting is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="fieldmosaic-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small in-code table as a local relation.

    Spark knows its exact size, so a join with it is broadcast without a hint.
    """
    names = [field.split()[0] for field in schema.split(",")]
    columns = {name: [row[i] for row in rows] for i, name in enumerate(names)}
    return spark.createDataFrame(pa.table(columns), schema=schema)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out evenly, for few rows that each take long (polygons come in one small file)."""
    spark = df.sparkSession
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows to reliable storage once, so later readers see one result.

    Needed where a plan is not repeatable: range partitioning samples its input,
    so a second evaluation may cut the partitions elsewhere.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows as Parquet to the shared folder and read them back.

    Cuts the lineage: a lost executor costs a read, not a second computation. A reader takes the columns
    it needs, and of a pixel table a file has a few bytes a row. The file lies
    below `spark.checkpoint.dir`, which the owner of the session clears when a job is over.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
