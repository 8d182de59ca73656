"""Global positions, running sums and exact quantiles without a single-task window.

Rows are range partitioned on the full order, so a hot sort key is cut across partitions by
the tie-breaking columns; only one number per partition reaches the driver.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldmosaic.runtime import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its low bits


def _offsets(counts: dict[int, int]) -> tuple[Column, int]:
    """Array column with, per partition, the sum of all partitions before it; and the total."""
    starts, total = [], 0
    for pid in range(max(counts, default=0) + 1):
        starts.append(f"{total}L")
        total += counts.get(pid, 0)
    return F.expr(f"array({', '.join(starts)})"), total


def global_rank(df: DataFrame, order: list[Column], name: str = "rn", total: str | None = None) -> DataFrame:
    """Add the 1-based position of each row in ascending `order`, and optionally the row count.

    One range shuffle; the sorted rows are written once so positions are stable. The keys are
    computed once per row. The order should end in a unique column, else ties are numbered as
    they fall.
    """
    keys = [f"_k{i}" for i in range(len(order))]
    placed = (
        df.withColumns(dict(zip(keys, order)))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_slot", F.monotonically_increasing_id())
        .drop(*keys)
    )
    placed = materialize(placed)
    pid = F.shiftright("_slot", _ROW_BITS).cast("int")
    counts = {row.p: row.n for row in placed.groupBy(pid.alias("p")).agg(F.count("*").alias("n")).collect()}
    starts, rows = _offsets(counts)
    within = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = placed.withColumn(name, F.element_at(starts, pid + 1) + within + 1)
    if total:
        placed = placed.withColumn(total, F.lit(rows).cast("long"))
    return placed.drop("_slot")


def running_sum(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Add the sum of `value` over all rows up to and including this one under `order`."""
    placed = materialize(df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()))
    counts = {row._pid: row.n for row in placed.groupBy("_pid").agg(F.sum(value).alias("n")).collect()}
    starts, _ = _offsets(counts)
    window = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    start = F.element_at(starts, F.col("_pid") + 1)
    return placed.withColumn(name, start + F.sum(value).over(window)).drop("_pid")


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], keys: list[str] | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles per group as rows (keys…, column, prob, value).

    Equal values are counted before anything is sorted, so a value that fills a third of the
    table is one row; the counts are then summed along one range-partitioned order. A group
    may span any number of partitions.
    """
    keys = keys or []
    group = [*keys, "column"]
    long = df.unpivot(keys, columns, "column", "value") if len(columns) > 1 else df.select(
        *keys, F.lit(columns[0]).alias("column"), F.col(columns[0]).alias("value")
    )
    value = F.col("value").cast("double")
    tallies = (
        long.select(*group, value.alias("value"))
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*group, "value")
        .agg(F.count("*").alias("n"))
    )
    upto = running_sum(tallies, [*group, "value"], "n", "upto")
    bounds = upto.groupBy(*group).agg(F.min(F.col("upto") - F.col("n")).alias("base"), F.sum("n").alias("size"))
    wanted = bounds.select(
        *group, "base", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"), "size"
    ).withColumn("at", (F.col("size") - 1) * F.col("prob"))
    spots = wanted.select(
        *[F.col(k).alias(f"_{k}") for k in group], "prob", "base", "at", F.floor("at").alias("lo"), F.ceil("at").alias("hi")
    )
    if not keys:
        spots = F.broadcast(spots)  # one row per column and quantile
    first, last = F.col("upto") - F.col("n") - F.col("base"), F.col("upto") - F.col("base") - 1
    touched = (first <= F.col("hi")) & (last >= F.col("lo"))
    hits = upto.join(spots, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in group]) & touched).select(
        *group, "prob", "at",
        F.when((first <= F.col("lo")) & (F.col("lo") <= last), F.col("value")).alias("v_lo"),
        F.when((first <= F.col("hi")) & (F.col("hi") <= last), F.col("value")).alias("v_hi"),
    )
    ends = hits.groupBy(*group, "prob", "at").agg(F.max("v_lo").alias("v_lo"), F.max("v_hi").alias("v_hi"))
    share = F.col("at") - F.floor("at")
    return ends.select(*group, "prob", (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * share).alias("value"))


def ntile(df: DataFrame, order: list[Column], tiles: int, name: str) -> DataFrame:
    """Split the ordered rows into `tiles` runs whose sizes differ by one at most, longer ones first."""
    ranked = global_rank(df, order, "_rn", "_n")
    rn, n = F.col("_rn") - 1, F.col("_n")
    small, longer = F.floor(n / tiles), n % tiles
    head = longer * (small + 1)
    tile = F.when(rn < head, F.floor(rn / (small + 1))).otherwise(longer + F.floor(F.try_divide(rn - head, small)))
    return ranked.withColumn(name, (tile + 1).cast("int")).drop("_rn", "_n")
