"""Layer mapping: from areas and layers to requests, and from images to class areas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from fieldmosaic.operators.boundaries import areas_of_version, backfill_county_name, with_region_name
from fieldmosaic.operators.geometry import image_size_check, polygon_area, with_frame
from fieldmosaic.operators.ledger import change_status, image_path, log_results, mask_decision, resume_plan
from fieldmosaic.operators.raster import apply_mask
from fieldmosaic.operators.runs import quantify_mask
from fieldmosaic.operators.wms import request_plan
from fieldmosaic.runtime import materialize, stored

IMAGE = ["area_id", "classification", "shp_version"]


@dataclass
class MappingRun:
    """What a run leaves: its images with status and action, the store of masked pixels, the ledger."""

    work: DataFrame
    masked: DataFrame
    ledger: DataFrame


def requests(
    areas: DataFrame, layers: DataFrame, version: str, resolution: float = 100,
    done: tuple[int, str] | None = None,
) -> DataFrame:
    """Requests of one version: names filled and checked, frames computed, finished work left out.

    `layers` has layer_no, name_en and map_url.
    """
    named = backfill_county_name(areas)  # over all versions: a county may carry another stamp than its towns
    chosen = with_region_name(areas_of_version(named, version) if version else named)
    framed = with_frame(chosen.where("reject_reason is null"), resolution)
    plan = request_plan(layers, framed)
    return resume_plan(plan, *done) if done else plan


def classify(pixels: DataFrame, areas: DataFrame, colors: DataFrame, keys: list[str], resolution: float = 100, tolerance: int = 0) -> DataFrame:
    """Class counts and areas inside each polygon, for images whose size fits their area.

    The parsed polygons (one row per area) are written once; size check, mask and area read them.
    """
    framed = materialize(with_frame(areas, resolution).withColumn("polygon_m2", polygon_area(F.col("parts"))))
    image = [*keys, "classification"]
    fits = image_size_check(pixels, framed, image, keys, tolerance).where("accepted").select(*image)
    usable = pixels.join(fits, image, "left_semi")
    return quantify_mask(usable, colors, framed, keys)


def image_digest(pixels: DataFrame) -> DataFrame:
    """Pixel count and an order-free digest per image, combined in every task before the shuffle."""
    places = F.xxhash64("row", "col", "b", "g", "r")
    return pixels.groupBy(*IMAGE).agg(F.count("*").alias("n_pixels"), F.bit_xor(places).alias("digest"))


def run(
    images: DataFrame, known: DataFrame, pixels: DataFrame, areas: DataFrame, keys: list[str], ledger: DataFrame,
    masked: DataFrame, files: DataFrame | None = None, mask: DataFrame | None = None, rejects: DataFrame | None = None,
) -> MappingRun:
    """Mask what is new or changed in a snapshot of raw images, and log it.

    `images` has the image key, area_level, region_name, path, content and recorded_at, `known`
    path and content of the snapshot before. An image without content or polygon, or listed in
    `rejects` (path, reason), is an error and ends there; `reason` says why. An unchanged one is left alone if the ledger has its mask (and `files` the mask's
    path). All others are masked; the ledger gets their raw row, and their masked row unless
    the stored mask has the same pixels. A run on its own outcome changes nothing.

    The images' decisions and the new masks are written once; contents are never shuffled, and
    pixels only towards their mask.
    """
    shaped = areas.where("parts is not null").select(*keys).distinct().withColumn("_shaped", F.lit(True))
    found = images.join(change_status(known, images), "path").join(shaped, keys, "left")
    unreadable = F.lit(None).cast("string")
    if rejects is not None:
        why = rejects.groupBy("path").agg(F.min("reason").alias("_why"))
        found, unreadable = found.join(why, "path", "left"), F.col("_why")
    reason = F.when(F.col("content").isNull(), "content missing").when(F.col("_shaped").isNull(), "geometry missing").otherwise(unreadable)
    found = found.withColumn("reason", reason).drop("content", "_shaped", "_why")
    found = found.withColumn("status", F.when(F.col("reason").isNotNull(), "error").otherwise(F.col("status")))
    work = materialize(mask_decision(found, ledger, files))

    todo = work.where("action = 'mask'")
    fresh = apply_mask(pixels.join(todo.select(*IMAGE), IMAGE, "left_semi"), areas, keys, mask)
    fresh = stored(fresh.select(*masked.columns), "masked")
    before = image_digest(masked).select(*IMAGE, F.col("n_pixels").alias("_n"), F.col("digest").alias("_digest"))
    same = (F.col("n_pixels") == F.col("_n")) & (F.col("digest") == F.col("_digest"))
    status = F.when(F.col("_n").isNull(), "created").when(same, "unchanged").otherwise("updated")
    done = image_digest(fresh).join(before, IMAGE, "left").select(*IMAGE, status.alias("status"))

    logged = [*IMAGE, "stage", "area_level", "file_path", "recorded_at", F.col("logged_status").alias("status")]
    raw = todo.withColumns({"stage": F.lit("raw"), "file_path": F.col("path")}).select(*logged)
    place = image_path(F.col("shp_version"), F.lit("masked"), F.col("classification"), F.col("region_name"))
    after = mask_decision(todo.drop("status", "action", "logged_status").join(done, IMAGE), ledger, files)
    after = after.withColumns({"stage": F.lit("masked"), "file_path": place}).select(*logged)
    store = masked.join(todo.select(*IMAGE), IMAGE, "left_anti").select(*masked.columns).unionByName(fresh)
    return MappingRun(work, store, log_results(ledger, raw.unionByName(after), "file_path"))
