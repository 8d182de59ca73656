"""Area boundaries: identity, versions, names, gates and versioned inserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldmosaic.functions.dates import roc_digits_to_date, version_digits
from fieldmosaic.functions.text import file_stem
from fieldmosaic.functions.wkt import parse_polygon
from fieldmosaic.operators.records import first_per_key
from fieldmosaic.schemas import AREA_KEY

# The one town that a separate boundary file delivers instead.
SPLIT_TOWN = "T28"
SPLIT_TOWN_SOURCE = "town_moi"


def boundary_files(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Boundary files among file names, with the version each stands for."""
    lower = F.lower(name)
    wanted = F.col(name).endswith(".shp") & (lower.contains("county") | lower.contains("town"))
    return files.where(wanted).withColumn("shp_version", file_stem(F.col(name)))


def list_boundary_files(spark: SparkSession, folder: str) -> DataFrame:
    """Boundary files of a folder; names only, no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.shp").load(folder)
    return boundary_files(files.select(F.col("_metadata.file_name").alias("file_name")))


def sort_column(columns: list[str], file_name: str) -> str | None:
    """Column to order a boundary file by: county files by COUNTYID, town files by TOWNID, others not."""
    lower = {c.lower() for c in columns}
    if "countyid" not in lower:
        return None
    if "county" in file_name.lower():
        chosen = "COUNTYID"
    elif "townid" in lower and "town" in file_name.lower():
        chosen = "TOWNID"
    else:
        return None
    return chosen if chosen in columns else None


def union_boundaries(tables: list[DataFrame]) -> DataFrame:
    """Stack boundary tables; columns only some of them have are null elsewhere."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def with_identity(df: DataFrame) -> DataFrame:
    """Add area_level and area_id: a table without TOWNID holds counties."""
    county = "TOWNID" not in df.columns
    level = "county" if county else "town"
    return df.withColumns({"area_level": F.lit(level), "area_id": F.col("COUNTYID" if county else "TOWNID")})


def is_missing(value: Column) -> Column:
    """Null, blank or the text an empty float turns into."""
    return value.isNull() | (F.trim(value) == "") | (F.lower(value) == "nan")


def without_split_town(df: DataFrame) -> DataFrame:
    """Leave out the town that another file delivers, in versions of the main town file."""
    dropped = (F.col("area_id") == SPLIT_TOWN) & F.lower("shp_version").contains(SPLIT_TOWN_SOURCE)
    return df.where(~F.coalesce(dropped, F.lit(False)))


def batch_gate(df: DataFrame, unit: tuple[str, ...] = ("shp_version",)) -> DataFrame:
    """One row per version (or other unit): row count, rows without area id, and whether the batch may be stored."""
    bad = F.count_if(is_missing(F.col("area_id")))
    return df.groupBy(*unit).agg(
        F.count("*").alias("n_rows"), bad.alias("n_missing"), (bad == 0).alias("accepted")
    )


def accepted_batches(df: DataFrame, unit: tuple[str, ...] = ("shp_version",)) -> DataFrame:
    """Rows of the versions (or other units) in which every row has an area id."""
    refused = df.where(is_missing(F.col("area_id"))).select(*unit).distinct()
    return df.join(refused, list(unit), "left_anti").select(*df.columns)


def insert_new(target: DataFrame, batch: DataFrame, position: str, keys: list[str] | None = None) -> DataFrame:
    """Stored rows plus the first batch row of every key not stored yet.

    A key with a null part never collides, so all such batch rows are kept.
    """
    keys = keys or AREA_KEY
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    fresh = first_per_key(batch.where(~has_null), keys, position).join(target.select(*keys), keys, "left_anti")
    added = fresh.unionByName(batch.where(has_null)).drop(position)
    return target.unionByName(added, allowMissingColumns=True)


def new_versions(batch: DataFrame, stored: DataFrame, unit: tuple[str, ...] = ("shp_version",)) -> DataFrame:
    """Batch rows of versions (or other units) nothing is stored of."""
    return batch.join(stored.select(*unit).distinct(), list(unit), "left_anti").select(*batch.columns)


def areas_by_level(areas: DataFrame, level: str | None = None) -> DataFrame:
    """Areas of one level (any other value: all), with the boundary as nested parts, by area id."""
    chosen = areas.where(F.col("area_level") == level) if level in ("county", "town") else areas
    return chosen.withColumn("parts", parse_polygon(F.col("geometry"))).orderBy("area_id")


def version_stamp(df: DataFrame) -> DataFrame:
    """Add the seven version digits and the day they stand for."""
    return df.withColumn("stamp", version_digits(F.col("shp_version"))).withColumn(
        "stamp_date", roc_digits_to_date(F.col("stamp"))
    )


def versions_desc(areas: DataFrame) -> DataFrame:
    """Known version digits, newest first."""
    stamps = areas.select(version_digits(F.col("shp_version")).alias("stamp"))
    return stamps.where("stamp is not null").distinct().orderBy(F.col("stamp").desc())


def areas_of_version(areas: DataFrame, version: str) -> DataFrame:
    """Areas whose version contains the text as it stands."""
    return areas.where(F.coalesce(F.contains(F.col("shp_version"), F.lit(version)), F.lit(False)))


def backfill_county_name(areas: DataFrame) -> DataFrame:
    """Towns without county name take the one of their county row; the last by area id and version names a county.

    Only a null is filled, an empty text stays. Names are reduced to one per county before the
    join, which therefore never multiplies rows; a small side is broadcast on its measured size
    and a county full of towns is split as a skewed join partition.
    """
    named = areas.where("area_level = 'county' and COUNTYENG is not null and COUNTYENG != ''")
    order = F.struct(*[c for c in ("area_id", "shp_version", "COUNTYENG") if c in areas.columns])
    names = named.groupBy("COUNTYID").agg(F.max_by("COUNTYENG", order).alias("_county_name"))
    fill = (F.col("area_level") == "town") & F.col("COUNTYENG").isNull()
    return (
        areas.join(names, "COUNTYID", "left")
        .withColumn("COUNTYENG", F.when(fill, F.col("_county_name")).otherwise(F.col("COUNTYENG")))
        .select(*areas.columns)
    )


def with_region_name(areas: DataFrame) -> DataFrame:
    """Add region_name and reject_reason; exactly one of them is null.

    Towns are called COUNTY_TOWN, counties COUNTY, blanks as underscores.
    """
    county, town = F.coalesce("COUNTYENG", F.lit("")), F.coalesce("TOWNENG", F.lit(""))
    level = F.col("area_level")
    reason = (
        F.when((level == "town") & ((county == "") | (town == "")), "name missing")
        .when((level == "county") & (county == ""), "name missing")
        .when(~F.coalesce(level.isin("town", "county"), F.lit(False)), "unknown level")
        .when(F.col("geometry").isNull(), "geometry missing")
    )
    name = F.when(level == "town", F.concat_ws("_", county, town)).otherwise(county)
    return areas.withColumn("reject_reason", reason).withColumn(
        "region_name", F.when(F.col("reject_reason").isNull(), F.replace(name, F.lit(" "), F.lit("_")))
    )
