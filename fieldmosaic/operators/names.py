"""Layer titles, their classification and the legend that colours them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldmosaic.functions.text import process_string, strip_blank
from fieldmosaic.operators.records import last_per_key
from fieldmosaic.runtime import local_table
from fieldmosaic.tables.layer_values import CROP_PREFIX, CROP_SUFFIX, SOIL_PREFIX, SOIL_WORD, layer_rows

VALID_NAME = "^[a-z0-9_]+$"


def static_layers(spark: SparkSession) -> DataFrame:
    """The known layers: name_zh, name_en, legend, in listed order."""
    rows = [(i, *row) for i, row in enumerate(layer_rows(), start=1)]
    return local_table(spark, rows, "layer_no int, name_zh string, name_en string, legend string")


def legend_of(classification: Column) -> Column:
    """Legend layer of a classification: crops share one, depth layers of a soil map share one."""
    pairs = {english: legend for _, english, legend in layer_rows() if not english.startswith(CROP_PREFIX)}
    table = F.create_map(*[F.lit(text) for pair in pairs.items() for text in pair])
    return F.when(classification.startswith(CROP_PREFIX), F.lit(CROP_PREFIX)).otherwise(
        F.coalesce(F.try_element_at(table, classification), classification)
    )


def layer_names(static: DataFrame, overrides: DataFrame, position: str) -> DataFrame:
    """(name_zh, name_en, origin): overrides replace listed names, the last override of a name wins."""
    own = last_per_key(overrides, ["name_zh"], position).select("name_zh", "name_en", F.lit("override").alias("origin"))
    listed = static.select("name_zh", "name_en", F.lit("static").alias("origin"))
    return listed.join(own.select("name_zh"), "name_zh", "left_anti").unionByName(own)


def add_override(overrides: DataFrame, name_zh: str, name_en: str, position: str) -> DataFrame:
    """Overrides with one more entry after all others."""
    top = overrides.agg((F.coalesce(F.max(position), F.lit(0)) + 1).cast(overrides.schema[position].dataType).alias(position))
    return overrides.unionByName(top.select(F.lit(name_zh).alias("name_zh"), F.lit(name_en).alias("name_en"), position))


def look_up(titles: DataFrame, names: DataFrame) -> DataFrame:
    """Titles with their English name, null where unknown."""
    return titles.join(names, titles.map_name == names.name_zh, "left").drop("name_zh")


def layer_kind(title: Column) -> Column:
    return F.when(F.contains(title, F.lit(CROP_SUFFIX)), "crop").when(F.contains(title, F.lit(SOIL_WORD)), "soil").otherwise("other")


def layer_core(title: Column) -> Column:
    """Title without the words that only tell the kind."""
    kind = layer_kind(title)
    cut = F.when(kind == "crop", F.replace(title, F.lit(CROP_SUFFIX), F.lit(""))).when(
        kind == "soil", F.replace(title, F.lit(SOIL_WORD), F.lit(""))
    ).otherwise(title)
    return strip_blank(cut)


def classification_of(kind: Column, english: Column) -> Column:
    """Full classification of a new layer; null where the English core name is not valid."""
    core = process_string(english)
    full = F.when(kind == "crop", F.concat(F.lit(f"{CROP_PREFIX}_"), core)).when(
        kind == "soil", F.concat(F.lit(f"{SOIL_PREFIX}_"), core)
    )
    return F.when(kind == "other", english).when(is_valid_name(core), full)


def is_valid_name(english: Column) -> Column:
    return english.rlike(VALID_NAME)
