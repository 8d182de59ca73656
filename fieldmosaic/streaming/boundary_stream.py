"""New boundary files as a file stream: area tables, or .shp and .dbf files as they arrive."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldmosaic.operators.boundaries import accepted_batches, batch_gate, new_versions, without_split_town
from fieldmosaic.operators.records import one_per_key
from fieldmosaic.plans.ingest import areas_from_records
from fieldmosaic.schemas import AREA_KEY
from fieldmosaic.sources import shapefiles

FILES = "path string, modificationTime timestamp, length long, content binary"
FILES_PER_BATCH = 1000
UNIT = ("shp_version", "source_file")  # what is accepted or refused, and stored, as a whole


def stored_areas(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """What is stored so far; only a missing path counts as nothing."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.limit(0)


def store_files(batch: DataFrame, number: int, target: str, position: str, refused: str) -> None:
    """Write the areas of each version and file that are not stored yet, as a partition folder of its own.

    An area another file of its version brought before is left as it is. Files with a nameless row
    are refused and listed in `refused`. Whole folders are replaced, so a batch that is run
    again after a failure leaves the same tables behind.
    """
    spark = batch.sparkSession
    stored = stored_areas(spark, target, batch.drop(position))
    fresh = without_split_town(new_versions(batch, stored, UNIT))
    gate = batch_gate(fresh, UNIT).where("not accepted").drop("accepted")
    gate.write.mode("overwrite").parquet(f"{refused}/batch={number}")
    named = one_per_key(accepted_batches(fresh, UNIT), AREA_KEY, [F.col(position), F.col("source_file")]).drop(position)
    kept = named.join(stored.select(*AREA_KEY), AREA_KEY, "left_anti").select(*named.columns)
    (
        kept.hint("rebalance", *UNIT).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*UNIT).parquet(target)
    )


def ingest_stream(
    spark: SparkSession, folder: str, schema, target: str, checkpoint: str, position: str = "record", refused: str | None = None,
) -> StreamingQuery:
    """Ingest area files that appear in a folder; each file is read once.

    A version may arrive in several files, at any time. Runs until all present files are done;
    start it again to go on from the checkpoint. Refused files are listed in `refused` (default:
    the target with `_refused`).
    """
    stream = spark.readStream.schema(schema).parquet(folder).withColumn("source_file", F.col("_metadata.file_name"))
    away = refused or f"{target.rstrip('/')}_refused"
    return (
        stream.writeStream.foreachBatch(lambda batch, number: store_files(batch, number, target, position, away))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def layers_completed(spark: SparkSession, waiting: str, number: int) -> list[str]:
    """Paths of the .shp files whose last part came with batch `number`, while both parts are known by then.

    `waiting` lists the names of all parts by batch; a driver receives the paths of one batch at most.
    """
    parts = spark.read.schema("path string, batch long").option("basePath", waiting).parquet(waiting).where(F.col("batch") <= number)
    kind = F.lower(F.substring_index("path", ".", -1))
    layers = parts.groupBy(shapefiles.home(F.col("path")).alias("home")).agg(
        F.max("batch").alias("last"), F.count_if(kind == "dbf").alias("n_dbf"), F.max(F.when(kind == "shp", F.col("path"))).alias("shape")
    )
    return [r.shape for r in layers.where((F.col("last") == number) & (F.col("n_dbf") > 0) & F.col("shape").isNotNull()).select("shape").collect()]


def store_layers(batch: DataFrame, number: int, target: str, waiting: str, refused: str) -> None:
    """Note the parts of a batch, then store the areas of every layer that is complete with them.

    A layer whose parts come in different batches waits by name only; its files are read
    when it is complete, with the .cpg file if there is one by then. Parts that cannot be decoded are
    listed with the reason in `refused`. All that is written has the number of the batch or the
    name of the layer, so a batch that is run again after a failure leaves the same tables.
    """
    spark = batch.sparkSession
    batch.select("path").write.mode("overwrite").parquet(f"{waiting}/batch={number}")
    shapes = layers_completed(spark, waiting, number)
    if not shapes:
        return
    parts = shapefiles.layer_parts(spark, shapes)
    shapefiles.boundary_rejects(*parts).write.mode("overwrite").parquet(f"{refused}_parts/batch={number}")
    records = shapefiles.join_records(shapefiles.shape_records(parts[0]), shapefiles.attribute_records(parts[1]))
    areas = areas_from_records(records).withColumn("source_file", F.concat("shp_version", F.lit(".shp")))
    store_files(areas, number, target, "record", refused)


def ingest_shape_stream(
    spark: SparkSession, folder: str, target: str, checkpoint: str, waiting: str | None = None, refused: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Ingest .shp and .dbf files that appear in a folder, in any order and at any time.

    An area file counts from the batch in which its second part arrives; rivers and the like are
    passed over. Runs until all present files are done; start it again to go on from the checkpoint.
    `waiting` (default: the target with `_waiting`) holds the names of the parts seen so far.
    """
    files = (
        spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.{shp,dbf}")
        .option("maxFilesPerTrigger", files_per_batch).load(folder).select("path").where(shapefiles.wanted(F.col("path")))
    )
    base = target.rstrip("/")
    seen, away = waiting or f"{base}_waiting", refused or f"{base}_refused"
    return (
        files.writeStream.foreachBatch(lambda batch, number: store_layers(batch, number, target, seen, away))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
