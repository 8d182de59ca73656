"""Pixels as runs: (image, row, first, last, colour), and the intersection of runs with the spans of a mask.

An image line of one colour is one row however wide it is, so what is shuffled, joined and counted
grows with the edges in a picture rather than with its pixels.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldmosaic.operators.geometry import BLOCK, mask_spans
from fieldmosaic.operators.raster import class_share, quantify_classes

COLOR = ["b", "g", "r"]


def _merged(image: list[str]):
    """Within a batch: sort by image and place, then join neighbours of one colour; borders of blocks are kept."""

    def run(batches):
        for batch in batches:
            names = [*image, "row", "first", "last", *COLOR]
            if not batch.num_rows:
                continue
            keys = [pc.dictionary_encode(batch.column(c), null_encoding="encode").indices.to_numpy(zero_copy_only=False) for c in image]
            row, col = (pc.fill_null(batch.column(c), -1).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("row", "col"))
            paint = np.stack([pc.fill_null(batch.column(c).cast(pa.int32()), -1).to_numpy(zero_copy_only=False) for c in COLOR])
            order = np.lexsort((col, row, *keys[::-1]))
            row, col, paint, keys = row[order], col[order], paint[:, order], [k[order] for k in keys]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (row[1:] != row[:-1]) | (col[1:] != col[:-1] + 1) | (paint[:, 1:] != paint[:, :-1]).any(axis=0) | (col[1:] % BLOCK == 0) | (col[:-1] < 0)
            for k in keys:
                fresh[1:] |= k[1:] != k[:-1]
            starts = np.flatnonzero(fresh)
            ends = np.append(starts[1:], len(order)) - 1
            head, tail = (pa.array(order[at]) for at in (starts, ends))
            take = {c: batch.column(c).take(head) for c in (*image, "row", *COLOR)}
            take |= {"first": batch.column("col").take(head), "last": batch.column("col").take(tail)}
            yield pa.RecordBatch.from_arrays([take[c] for c in names], names)

    return run


def pixel_runs(pixels: DataFrame, image: list[str]) -> DataFrame:
    """Runs of a pixel table: image, row, first, last, b, g, r.

    Every task joins the neighbours it holds, before anything is shuffled; a run may therefore be
    one of several in a row. Runs end at block borders. Repeated pixels stay repeated; a pixel without a
    place is a run without one.
    """
    kinds = dict(pixels.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in (*image, "row")), f"first {kinds['col']}", f"last {kinds['col']}", *(f"{c} {kinds[c]}" for c in COLOR)])
    return pixels.select(*image, "row", "col", *COLOR).mapInArrow(_merged(image), schema)


def tiles(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Spans of a mask (`mask_spans`) with a flag `inside`, and the gaps between them up to the borders of their blocks."""
    line = Window.partitionBy(*keys, "row", "block").orderBy("c0")
    begin, end = F.col("block") * BLOCK, (F.col("block") + 1) * BLOCK - 1
    part = lambda a, b, flag: F.struct(a.cast("int").alias("c0"), b.cast("int").alias("c1"), F.lit(flag).alias("inside"))
    around = spans.withColumn("_from", F.coalesce(F.lag("c1").over(line) + 1, begin)).withColumn("_last", F.lead("c0").over(line).isNull())
    parts = F.array(part(F.col("_from"), F.col("c0") - 1, False), part(F.col("c0"), F.col("c1"), True), part(F.col("c1") + 1, F.when(F.col("_last"), end).otherwise(F.col("c1")), False))
    return around.select(*keys, "row", "block", F.explode(parts).alias("_t")).select(*keys, "row", "block", "_t.*").where("c0 <= c1")


def clip(runs: DataFrame, spans: DataFrame, keys: list[str], outside: bool = True) -> DataFrame:
    """Runs cut where the mask begins and ends, with a flag `inside`; without `outside` only what the mask shows.

    An equi-join on area, row and column block, in which two sorted lists of intervals meet: a run becomes one row per
    span it overlaps, and per gap if the rest is asked for. Both sides grow with the data and are
    shuffled; a block of a line has at most BLOCK / 2 spans.
    """
    mine = tiles(spans, keys) if outside else spans.withColumn("inside", F.lit(True))
    mine = mine.withColumnsRenamed({c: f"_{c}" for c in [*keys, "row", "block", "c0", "c1", "inside"]})
    same = [runs[k] == F.col(f"_{k}") for k in [*keys, "row"]]
    on = reduce(and_, [*same, F.floor(runs["first"] / BLOCK).cast("int") == F.col("_block"), runs["first"] <= F.col("_c1"), runs["last"] >= F.col("_c0")])
    joined = runs.join(mine.hint("merge"), on, "left" if outside else "inner")
    kind, met = dict(runs.dtypes)["first"], F.col("_c0").isNotNull()
    return joined.select(
        *[runs[c] for c in runs.columns if c not in ("first", "last")],
        F.when(met, F.greatest(runs["first"], F.col("_c0"))).otherwise(runs["first"]).cast(kind).alias("first"),
        F.when(met, F.least(runs["last"], F.col("_c1"))).otherwise(runs["last"]).cast(kind).alias("last"),
        F.coalesce("_inside", F.lit(False)).alias("inside"),
    )


def length() -> Column:
    """Number of pixels of a run; one without a place is one pixel."""
    return F.coalesce(F.col("last") - F.col("first") + 1, F.lit(1)).cast("long")


def blackened(clipped: DataFrame) -> DataFrame:
    """Clipped runs as the masked image shows them: black (0, 0, 0) outside."""
    kinds = dict(clipped.dtypes)
    return clipped.withColumns({c: F.when(F.col("inside"), F.col(c)).otherwise(F.lit(0).cast(kinds[c])) for c in COLOR})


def quantify_mask(pixels: DataFrame, colors: DataFrame, areas: DataFrame, keys: list[str], spans: DataFrame | None = None) -> DataFrame:
    """Class counts inside the polygons, the polygon's own area shared out by pixel share.

    `areas` needs parts, box, width, height and polygon_m2; a stored result of `mask_spans` can be given.
    """
    runs = pixel_runs(pixels, ["area_id", "shp_version", "classification"])
    inside = clip(runs, mask_spans(areas, keys) if spans is None else spans, keys, outside=False)
    shares = class_share(quantify_classes(inside, colors, n=length()))
    return shares.join(areas.select(*keys, "polygon_m2"), keys, "left").withColumn("class_m2", F.col("share") * F.col("polygon_m2"))
