"""Boundary ingest: files to stored areas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldmosaic.operators.boundaries import accepted_batches, insert_new, is_missing, new_versions, without_split_town
from fieldmosaic.operators.records import ensure_columns
from fieldmosaic.schemas import AREA_COLUMNS
from fieldmosaic.sources.shapefiles import read_boundary_files


def areas_from_records(records: DataFrame) -> DataFrame:
    """Decoded boundary records as areas; a file whose records lack TOWNID holds counties.

    Every attribute outside the fixed columns stays available in `attributes`.
    """
    fixed = [c for c in AREA_COLUMNS if c not in ("area_id", "area_level", "geometry", "shp_version", "created_at")]
    is_town = F.map_contains_key("attributes", F.lit("TOWNID"))
    columns = [F.try_element_at("attributes", F.lit(n)).alias(n) for n in fixed]
    level = F.when(is_town, "town").otherwise("county").alias("area_level")
    area = F.when(is_town, F.try_element_at("attributes", F.lit("TOWNID"))).otherwise(
        F.try_element_at("attributes", F.lit("COUNTYID"))
    )
    return records.select(area.alias("area_id"), level, *columns, "geometry", "shp_version", "record", "attributes")


def ingest(target: DataFrame, batch: DataFrame, position: str = "record") -> DataFrame:
    """Target plus the areas of versions it does not know yet; a version with a nameless row is refused.

    Columns only the batch has are added to the target, null for the rows already stored.
    """
    fresh = accepted_batches(without_split_town(new_versions(batch, target)))
    stamped = ensure_columns(fresh, [c for c in target.columns if c != "created_at"]).withColumn("created_at", F.current_timestamp())
    return insert_new(target, stamped, position)


def ingest_folder(spark: SparkSession, folder: str, target: DataFrame) -> DataFrame:
    return ingest(target, areas_from_records(read_boundary_files(spark, folder)))


def has_refused(batch: DataFrame) -> bool:
    return not batch.where(is_missing(F.col("area_id"))).isEmpty()
