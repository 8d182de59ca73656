"""Cleaning, imputation, outliers, encoding and scaling.

What has to be known about a whole column (mean, quantile, mode, categories) is fitted first
as a few numbers and then applied as plain expressions, without joins.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldmosaic.operators.joins import skew_join
from fieldmosaic.operators.ranking import exact_quantiles, global_rank


def known(df: DataFrame, column: str) -> Column:
    """The value of a column with NaN as null: both count as missing."""
    kind = df.schema[column].dataType.typeName()
    return F.when(~F.isnan(F.col(column)), F.col(column)) if kind in ("double", "float") else F.col(column)


def drop_all_null(df: DataFrame) -> DataFrame:
    """Leave out rows in which every column is null or NaN."""
    return df.na.drop("all")


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


CLEANING_RULES = {"drop_all_null": drop_all_null, "drop_duplicates": drop_duplicates}


def _left(df: DataFrame, rule: str, n: Column) -> Column:
    """How many of `n` equal rows a rule leaves."""
    if rule == "drop_duplicates":
        return F.least(n, F.lit(1))
    return F.when(reduce(or_, [known(df, c).isNotNull() for c in df.columns]), n).otherwise(0)


def clean(df: DataFrame, rules: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Cleaned rows and a report with one row per rule, in the order applied.

    The report reads the table once, whatever the number of rules: equal rows are counted, in every task
    before the shuffle, and every rule says how many of them it leaves.
    """
    rules = rules or ["drop_all_null"]
    current = df
    for rule in rules:
        current = CLEANING_RULES[rule](current)
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_n0")) if "drop_duplicates" in rules else df.withColumn("_n0", F.lit(1).cast("long"))
    for step, rule in enumerate(rules, start=1):
        counted = counted.withColumn(f"_n{step}", _left(df, rule, F.col(f"_n{step - 1}")).cast("long"))
    total = lambda step: F.coalesce(F.sum(f"_n{step}"), F.lit(0))
    rows = [F.struct(F.lit(step).alias("step"), F.lit(rule).alias("rule"), total(step - 1).alias("n_before"), total(step).alias("n_after")) for step, rule in enumerate(rules, start=1)]
    report = counted.agg(F.array(*rows).alias("_r")).select(F.inline("_r")).withColumn("rows_deleted", F.col("n_before") - F.col("n_after"))
    return current, report


def type_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Column types before and after cleaning."""
    old, new = dict(before.dtypes), dict(after.dtypes)
    rows = [(c, old.get(c), new.get(c)) for c in [*old, *[c for c in new if c not in old]]]
    return before.sparkSession.createDataFrame(rows, "column_name string, before string, after string")


def quantile_table(df: DataFrame, columns: list[str], probs: list[float]) -> dict[tuple[str, float], float]:
    """Exact quantiles of whole columns; one number per column and quantile comes back."""
    rows = exact_quantiles(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), columns, probs).collect()
    return {(row.column, row.prob): row.value for row in rows}


def column_modes(df: DataFrame, columns: list[str]) -> dict:
    """Most frequent value of each column, the smallest of equals; null for an empty column.

    One job for all columns: their values are counted as rows, in every task before the shuffle; one
    maximum per column meets the counts again.
    """
    values = df.select(*[known(df, c).cast("string").alias(c) for c in columns])
    long = values.unpivot([], columns, "column", "value") if len(columns) > 1 else values.select(F.lit(columns[0]).alias("column"), F.col(columns[0]).alias("value"))
    counts = long.where("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"))
    most = counts.groupBy("column").agg(F.max("n").alias("n"))
    best = counts.join(F.broadcast(most), ["column", "n"])  # one row per column
    row = best.agg(*[F.min(F.when(F.col("column") == c, F.col("value").cast(df.schema[c].dataType))).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return dict(zip(columns, row))


def handle_missing(df: DataFrame, strategies: dict[str, str]) -> DataFrame:
    """Fill or drop columns: `median`, `mode`, `zero` or `drop` per column."""
    unknown = set(strategies.values()) - {"median", "mode", "zero", "drop"}
    if unknown:
        raise ValueError(f"unknown strategies: {sorted(unknown)}")
    medians = [c for c, s in strategies.items() if s == "median"]
    fitted = quantile_table(df, medians, [0.5]) if medians else {}
    modes = [c for c, s in strategies.items() if s == "mode"]
    common = column_modes(df, modes) if modes else {}
    fills: dict[str, Column] = {}
    for column, strategy in strategies.items():
        current = F.col(column)
        if strategy != "drop" and df.schema[column].dataType.typeName() in ("double", "float"):
            current = F.nanvl(current, F.lit(None).cast("double"))
        if strategy == "median":
            fills[column] = F.coalesce(current, F.lit(fitted.get((column, 0.5))))
        elif strategy == "mode":
            fills[column] = F.coalesce(current, F.lit(common[column]))
        elif strategy == "zero":
            fills[column] = F.coalesce(current, F.lit(0).cast(df.schema[column].dataType))
    dropped = [c for c, s in strategies.items() if s == "drop"]
    return df.withColumns(fills).drop(*dropped)


def outlier_iqr(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Add `is_outlier` for values outside the quartiles by more than `factor` quartile ranges."""
    q = quantile_table(df, [column], [0.25, 0.75])
    low, high = q.get((column, 0.25)), q.get((column, 0.75))
    if low is None:
        return df.withColumn("is_outlier", F.lit(None).cast("boolean"))
    spread = high - low
    value = known(df, column)
    outside = (value < low - factor * spread) | (value > high + factor * spread)
    return df.withColumn("is_outlier", outside)


def moments(df: DataFrame, columns: list[str]) -> dict[str, tuple]:
    """(mean, population std, min, max) per column in one pass."""
    aggs = [f(known(df, c)).alias(f"{tag}_{i}") for i, c in enumerate(columns)
            for tag, f in (("a", F.avg), ("s", F.stddev_pop), ("l", F.min), ("h", F.max))]
    row = df.agg(*aggs).first()
    return {c: tuple(row[f"{tag}_{i}"] for tag in "aslh") for i, c in enumerate(columns)}


def outlier_zscore(df: DataFrame, column: str, limit: float = 3.0) -> DataFrame:
    """Add `is_outlier` for values more than `limit` population deviations off the mean."""
    mean, std, _, _ = moments(df, [column])[column]
    value = known(df, column)
    score = F.try_divide(F.abs(value - F.lit(mean)), F.lit(std))
    return df.withColumn("is_outlier", F.coalesce(score > limit, F.when(value.isNotNull(), F.lit(False))))


def scale(df: DataFrame, columns: list[str], method: str = "standard") -> DataFrame:
    """Standard (zero mean, unit population deviation) or min-max scaled; constant columns become 0, missing values null."""
    if method not in ("standard", "minmax"):
        raise ValueError(f"unknown method {method}")
    fitted = moments(df, columns)
    scaled = {}
    for c in columns:
        mean, std, low, high = fitted[c]
        if mean is None:
            continue
        base, width = (mean, std) if method == "standard" else (low, high - low)
        scaled[c] = (known(df, c) - F.lit(float(base))) / F.lit(float(width) or 1.0)
    return df.withColumns(scaled)


def encode_label(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Add the 0-based place of each value among the sorted distinct values; null stays null."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    codes = global_rank(counts, [F.col(column)], "_code")  # written once, counts included
    joined = skew_join(df, codes.select(column, "_code"), [column], codes.select(column, "_n"))
    return joined.withColumn(name or f"{column}_code", F.col("_code") - 1).drop("_code")


def encode_onehot(df: DataFrame, column: str, categories: list) -> DataFrame:
    """Replace a column by one 0/1 column per named category; other values and nulls are 0 in all of them.

    The categories become column names, so they are the caller's to give; where they are not known, or
    many, `encode_sparse` needs neither their list nor a column each.
    """
    flags = {f"{column}_{c}": F.coalesce((F.col(column) == c).cast("int"), F.lit(0)) for c in categories}
    return df.withColumns(flags).drop(column)


def encode_sparse(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One-hot encoding as rows (key, column, category) of the ones; zeros and nulls have no row."""
    return df.select(key, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot([key], columns, "column", "category").where(F.col("category").isNotNull())
