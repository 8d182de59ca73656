"""Legend colours as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldmosaic.functions.text import process_string
from fieldmosaic.runtime import local_table
from fieldmosaic.schemas import COLOR_MAP
from fieldmosaic.tables.color_values import legend_rows


def color_map(spark: SparkSession) -> DataFrame:
    return local_table(spark, legend_rows(), COLOR_MAP)


def color_key(b: Column, g: Column, r: Column) -> Column:
    return F.concat_ws(",", *[c.cast("string") for c in (b, g, r)])


def parse_color_key(key: Column) -> Column:
    """struct<b,g,r> of a `B,G,R` text, null channels where it is not a number."""
    pieces = F.split(key, ",")
    return F.struct(*[F.try_element_at(pieces, F.lit(i + 1)).try_cast("int").alias(c) for i, c in enumerate("bgr")])


def read_color_map(spark: SparkSession, path: str) -> DataFrame:
    """Legend JSON file (`layer[illustrative_diagram]` -> data_type, color_to_value) as the colour table."""
    text = spark.read.text(path, wholetext=True)
    layers = text.select(F.explode(F.from_json("value", "map<string,struct<data_type:string,color_to_value:string>>")).alias("name", "entry"))
    return explode_color_entries(layers.select("name", "entry.data_type", F.col("entry.color_to_value").alias("colours")))


def explode_color_entries(entries: DataFrame) -> DataFrame:
    """(name, data_type, colours JSON text) to one row per colour; the value may be number, code or vector."""
    pairs = entries.select(
        F.regexp_replace("name", r"\[.*\]$", "").alias("layer"), "data_type",
        F.explode(F.from_json("colours", "map<string,string>")).alias("key", "pair"),
    )
    value = F.try_variant_get(F.try_parse_json("pair"), "$[1]", "string")
    number, vector = value.try_cast("double"), F.try_variant_get(F.try_parse_json("pair"), "$[1]", "array<double>")
    bgr = parse_color_key(F.col("key"))
    return pairs.select(
        "layer", "data_type", bgr.b.alias("b"), bgr.g.alias("g"), bgr.r.alias("r"),
        F.coalesce(F.try_variant_get(F.try_parse_json("pair"), "$[0]", "string"), F.col("pair")).alias("label"),
        number.alias("value_num"),
        F.when(number.isNull() & vector.isNull(), value).alias("value_code"),
        vector.alias("value_vec"),
    )


def add_legend(existing: DataFrame, layer: str, data_type: str, labelled: DataFrame) -> DataFrame:
    """Colour table with a new layer from (b, g, r, label); a layer that is there already is left as it is."""
    fresh = labelled.select(
        F.lit(layer).alias("layer"), process_string(F.lit(data_type)).alias("data_type"), "b", "g", "r",
        process_string(F.col("label")).alias("label"),
    )
    added = fresh.join(existing.select("layer").distinct(), "layer", "left_anti")
    return existing.unionByName(added, allowMissingColumns=True)
