"""Processing ledger: upserts, change detection, pending work, reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from fieldmosaic.operators.ranking import global_rank
from fieldmosaic.operators.records import last_per_key
from fieldmosaic.runtime import materialize
from fieldmosaic.schemas import LEDGER_FOLDERS, LEDGER_KEY
from fieldmosaic.sources.folders import read_folders, update_folders


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Target after the batch is written row by row: keys it has are overwritten, others added.

    The last batch row of a key wins. Columns the batch lacks keep their stored value; a null in
    the batch overwrites. If the batch has only key columns nothing is overwritten. A null key
    never collides, so such rows go around the join. What is left is one full outer join with
    unique keys on both sides.
    """
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    rows = last_per_key(batch.where(~has_null), keys, position).drop(position)
    columns = target.columns + [c for c in rows.columns if c not in target.columns]
    old = target.where(~has_null).select(*[F.col(c).alias(f"_old_{c}") for c in target.columns])
    new = rows.withColumn("_sent", F.lit(True))
    on = reduce(lambda a, b: a & b, [F.col(f"_old_{k}") == F.col(k) for k in keys])

    def merged(name: str) -> Column:
        if name not in rows.columns:
            return F.col(f"_old_{name}").alias(name)
        if name not in target.columns:
            return F.col(name)
        return F.when(F.col("_sent"), F.col(name)).otherwise(F.col(f"_old_{name}")).alias(name)

    joined = old.join(new, on, "full_outer").select(*[merged(c) for c in columns])
    for aside in (target, batch.drop(position)):
        joined = joined.unionByName(aside.where(has_null), allowMissingColumns=True)
    return joined


def log_results(ledger: DataFrame, results: DataFrame, position: str, highest: int | None = None) -> DataFrame:
    """Ledger after logging results (ledger columns plus status); error and unchanged are skipped.

    Known keys get the new file_path and time; new keys are numbered after the highest id in
    the order of their key. `highest` gives that id where `ledger` is only a part of the whole. The
    results, reduced to one row per key, are written once because both halves read them.
    """
    logged = results.where(~F.col("status").isin("error", "unchanged"))
    batch = materialize(last_per_key(logged, LEDGER_KEY, position).select(*LEDGER_KEY, "area_level", "file_path", "recorded_at"))
    changes = batch.select(*LEDGER_KEY, F.col("file_path").alias("_path"), F.col("recorded_at").alias("_at"))
    known = (
        ledger.join(changes, LEDGER_KEY, "left")
        .withColumn("file_path", F.coalesce("_path", "file_path"))
        .withColumn("recorded_at", F.coalesce("_at", "recorded_at"))
        .select(*ledger.columns)
    )
    top = highest_id(ledger) if highest is None else highest
    fresh = batch.join(ledger.select(*LEDGER_KEY), LEDGER_KEY, "left_anti")
    added = global_rank(fresh, [F.col(c) for c in LEDGER_KEY], "_rn").withColumns(
        {"id": F.col("_rn") + F.lit(top), "layer_updated": F.lit(False)}
    )
    return known.unionByName(added.select(*ledger.columns))


def highest_id(ledger: DataFrame) -> int:
    return ledger.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]


def log_into_store(path: str, schema: StructType, results: DataFrame, position: str) -> None:
    """`log_results` on a ledger stored in LEDGER_FOLDERS: folders without a logged result keep their files.

    Only the ids of the other folders are read. Logging the same results again changes no row.
    """
    logged = results.where(~F.col("status").isin("error", "unchanged"))
    top = highest_id(read_folders(results.sparkSession, path, schema))
    update_folders(path, schema, logged, LEDGER_FOLDERS, lambda stored, batch: log_results(stored, batch, position, top))


def log_outcome(status: Column) -> Column:
    return F.when(status.isin("error", "unchanged"), "skipped").otherwise("logged")


def with_defaults(df: DataFrame) -> DataFrame:
    """Missing time stamps become now, a missing update flag becomes false."""
    defaults = {"created_at": F.current_timestamp(), "recorded_at": F.current_timestamp(), "layer_updated": F.lit(False)}
    return df.withColumns({c: F.coalesce(c, v) for c, v in defaults.items() if c in df.columns})


def ledger_scan(ledger: DataFrame, **wanted: str | None) -> DataFrame:
    """Ledger rows that match every given column; no value means any."""
    for name, value in wanted.items():
        if value is not None:
            ledger = ledger.where(F.col(name) == value)
    return ledger


def change_status(old: DataFrame, new: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """created / updated / unchanged per new file, by length and digest.

    Only the digests are shuffled, not the contents.
    """
    def digest(df: DataFrame, prefix: str) -> DataFrame:
        body = F.col(content).cast("binary")
        return df.select(key, F.octet_length(body).alias(f"{prefix}_len"), F.sha2(body, 256).alias(f"{prefix}_sha"))

    joined = digest(new, "new").join(digest(old, "old"), key, "left")
    same = (F.col("old_len") == F.col("new_len")) & (F.col("old_sha") == F.col("new_sha"))
    status = F.when(F.col("old_len").isNull(), "created").when(same, "unchanged").otherwise("updated")
    return joined.select(key, status.alias("status"))


def with_done(work: DataFrame, ledger: DataFrame, stage: str = "masked", files: DataFrame | None = None) -> DataFrame:
    """Work items with `done`: the ledger has their key at this stage and the file is there."""
    stored = ledger.where(F.col("stage") == stage)
    if files is not None:
        stored = stored.join(files.select(F.col("path").alias("file_path")).distinct(), "file_path", "left_semi")
    key = [c for c in LEDGER_KEY if c != "stage"]
    stored = stored.select(*key, F.lit(True).alias("done")).distinct()
    return work.join(stored, key, "left").withColumn("done", F.coalesce("done", F.lit(False)))


def pending(work: DataFrame, ledger: DataFrame, stage: str = "masked", files: DataFrame | None = None) -> DataFrame:
    """Work items still to do: changed ones, and unchanged ones without a stored result."""
    flagged = with_done(work, ledger, stage, files)
    return flagged.where((F.col("status") != "unchanged") | ~F.col("done")).drop("done")


def mask_decision(work: DataFrame, ledger: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Next step per image: error ends it, unchanged with a mask is skipped, unchanged without counts as created."""
    flagged = with_done(work, ledger, "masked", files)
    idle = F.col("status") == "unchanged"
    action = F.when(F.col("status") == "error", "stop").when(idle & F.col("done"), "skip").otherwise("mask")
    status = F.when(idle & ~F.col("done"), "created").otherwise(F.col("status"))
    return flagged.withColumn("action", action).withColumn("logged_status", status).drop("done")


def ledger_lookup(requests: DataFrame, ledger: DataFrame, shp_version: str) -> DataFrame:
    """Stored path per (area_id, classification, stage) of one version."""
    paths = ledger_scan(ledger, shp_version=shp_version).select("area_id", "classification", "stage", "file_path")
    return requests.join(paths, ["area_id", "classification", "stage"], "left")


def reconcile(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """Paths on one side only: missing_on_disk or not_in_ledger."""
    logged = ledger.select(F.col("file_path").alias("path")).distinct().withColumn("_l", F.lit(1))
    stored = files.select("path").distinct().withColumn("_f", F.lit(1))
    both = logged.join(stored, "path", "full_outer").where("_l is null or _f is null")
    return both.select("path", F.when(F.col("_f").isNull(), "missing_on_disk").otherwise("not_in_ledger").alias("problem"))


def resume_plan(plan: DataFrame, layer_no: int | None, area_id: str | None) -> DataFrame:
    """Plan rows (layer_no, area_id, …) after the last finished one; no position means all.

    Layers before it are left out, the layer itself continues behind the area.
    """
    if layer_no is None:
        return plan
    later = F.col("layer_no") > layer_no
    here = F.col("layer_no") == layer_no
    return plan.where(later | (here & (F.col("area_id") > area_id) if area_id else later | here))


def image_path(shp_version: Column, stage: Column, classification: Column, region: Column) -> Column:
    """Storage path of an image."""
    return F.concat_ws("/", F.lit("output/wms_images"), shp_version, stage, classification, F.concat(region, F.lit(".png")))
