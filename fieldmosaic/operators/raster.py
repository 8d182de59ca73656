"""Pixel tables: colours, classes, class areas and shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldmosaic.operators.geometry import mask_spans, with_inside
from fieldmosaic.operators.names import legend_of

WHITE = 254  # a pixel whose three channels all reach this counts as white background
UNMAPPED = "unmapped"


def is_white() -> Column:
    return (F.col("b") >= WHITE) & (F.col("g") >= WHITE) & (F.col("r") >= WHITE)


def distinct_colors(pixels: DataFrame) -> DataFrame:
    """Colours that are not white, sorted."""
    return pixels.where(~is_white()).select("b", "g", "r").distinct().orderBy("b", "g", "r")


def nearly_white(pixels: DataFrame, image: list[str]) -> DataFrame:
    """Per image whether the mean of all channels reaches the white limit."""
    mean = F.sum(F.col("b").cast("long") + F.col("g") + F.col("r")) / (3 * F.count("*"))
    return pixels.groupBy(*image).agg((mean >= WHITE).alias("nearly_white"))


def white_background(pixels: DataFrame, image: list[str]) -> DataFrame:
    """Per image whether it has any white pixel."""
    return pixels.groupBy(*image).agg(F.bool_or(is_white()).alias("has_white"))


def apply_mask(pixels: DataFrame, areas: DataFrame, keys: list[str], mask: DataFrame | None = None) -> DataFrame:
    """All pixels of the images; those outside their polygon become black (0, 0, 0).

    A stored result of `mask_spans` can be given as `mask`: it serves every layer of a
    boundary version, and as a file its size is known when the join is planned.
    """
    flagged = with_inside(pixels, mask_spans(areas, keys) if mask is None else mask, keys)
    zero = {c: F.when(F.col("inside"), F.col(c)).otherwise(F.lit(0).cast("smallint")) for c in "bgr"}
    return flagged.withColumns(zero)


def with_class(pixels: DataFrame, colors: DataFrame) -> DataFrame:
    """Pixels with legend layer, label and value of their colour; unknown colours keep a null label.

    The built-in legend is a local relation and legend files have a known size, so Spark
    broadcasts it while it is small and shuffles otherwise.
    """
    legend = colors.select(
        F.col("layer"), *[F.col(c).cast("smallint").alias(c) for c in "bgr"], "label", "value_num", "value_code", "value_vec"
    )
    return pixels.withColumn("layer", legend_of(F.col("classification"))).join(legend, ["layer", "b", "g", "r"], "left")


def quantify_classes(pixels: DataFrame, colors: DataFrame, resolution: float = 100, n: Column | None = None) -> DataFrame:
    """Pixels and area per area, version, layer and class label.

    Background (white, or black as left by the mask) is not counted; two colours of one label
    count together; colours the legend lacks are counted as one class of their own. `n` is the number
    of pixels a row stands for, one if not given.

    Pixels are first counted per colour, in every task before the shuffle, so one area holding
    most pixels is no heavier than the rest and the legend only meets one row per colour and
    image.
    """
    black = (F.col("b") == 0) & (F.col("g") == 0) & (F.col("r") == 0)
    image = ["area_id", "shp_version", "classification"]
    counted = pixels.where(~is_white() & ~black).groupBy(*image, "b", "g", "r").agg((F.count("*") if n is None else F.sum(n)).alias("n"))
    counts = with_class(counted, colors).groupBy(*image, F.coalesce("label", F.lit(UNMAPPED)).alias("label")).agg(
        F.sum("n").alias("n_pixels")
    )
    return counts.withColumn("area_m2", F.col("n_pixels") * float(resolution * resolution))


def class_share(classes: DataFrame) -> DataFrame:
    """Share of each class in its area, version and layer; a group has one row per legend label."""
    whole = Window.partitionBy("area_id", "shp_version", "classification")
    return classes.withColumn("share", F.col("n_pixels") / F.sum("n_pixels").over(whole))


def class_features(classes: DataFrame, colors: DataFrame) -> DataFrame:
    """Physical features per area, version and layer: mean class value and mean sand, silt, clay."""
    values = colors.select("layer", "label", "value_num", "value_vec").dropDuplicates(["layer", "label"])
    joined = classes.withColumn("layer", legend_of(F.col("classification"))).join(values, ["layer", "label"], "left")
    n = F.col("n_pixels")

    def mean(value: Column) -> Column:
        return F.try_divide(F.sum(n * value), F.sum(F.when(value.isNotNull(), n)))

    textures = [mean(F.get("value_vec", F.lit(i))).alias(name) for i, name in enumerate(("sand", "silt", "clay"))]
    return joined.groupBy("area_id", "shp_version", "classification").agg(
        F.sum(n).alias("n_pixels"), mean(F.col("value_num")).alias("mean_value"), *textures
    )


def features_by_area(features: DataFrame, layers: list[str], values: list[str]) -> DataFrame:
    """One row per area and version: every value of every named layer as `<layer>_<value>`.

    The layers are given, so nothing is looked up in the data first; a layer an area has no
    image of leaves nulls, one that is not named is left out. One aggregation on the area.
    """
    def cell(layer: str, value: str) -> Column:
        return F.max(F.when(F.col("classification") == layer, F.col(value))).alias(f"{layer}_{value}")

    return features.groupBy("area_id", "shp_version").agg(*[cell(la, v) for la in layers for v in values])


def code_shares(classes: DataFrame, colors: DataFrame, codes: list[str]) -> DataFrame:
    """Auxiliary features per area, version and layer: the pixel share of each named class code."""
    values = colors.select("layer", "label", "value_code").dropDuplicates(["layer", "label"])
    joined = classes.withColumn("layer", legend_of(F.col("classification"))).join(values, ["layer", "label"], "left")
    n = F.col("n_pixels")
    shares = [(F.sum(F.when(F.col("value_code") == c, n).otherwise(0)) / F.sum(n)).alias(f"share_{c}") for c in codes]
    return joined.groupBy("area_id", "shp_version", "classification").agg(*shares)
