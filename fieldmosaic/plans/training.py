"""Training set: statistics and class features to one table per area, with its record and export."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, functions as F

from fieldmosaic.operators.clean import clean, encode_label, encode_onehot, handle_missing, known, scale
from fieldmosaic.operators.stats import correlation, histogram, join_features, recent_slope, summarize
from fieldmosaic.runtime import materialize
from fieldmosaic.sources.sinks import export_training_set

RULES = ["drop_all_null", "drop_duplicates"]
MODES = ("full", "preprocess", "features")


@dataclass
class TrainingPlan:
    """What to do with which column; every step without columns is left out."""

    level: str = "town"
    keys: list[str] = field(default_factory=lambda: ["town_id"])
    summary: dict[str, str | list[str]] = field(default_factory=dict)
    missing: dict[str, str] = field(default_factory=dict)
    onehot: dict[str, list] = field(default_factory=dict)  # categories by column
    labels: list[str] = field(default_factory=list)
    scaled: list[str] = field(default_factory=list)
    method: str = "standard"
    trend: tuple[str, str] | None = None  # year and value column of the detail table


def clean_statistics(stats: DataFrame) -> DataFrame:
    """Statistics without empty and repeated rows, written once for the summary and the trend."""
    return materialize(clean(stats, RULES)[0])


def preprocess(features: DataFrame, cleaned: DataFrame, plan: TrainingPlan) -> DataFrame:
    """Summarise the cleaned statistics, join them to the features, fill, encode, scale.

    The joined table (one row per area) is written once: every fitted step after it reads the
    table, not the detail rows.
    """
    return prepared(materialize(join_features(features, summarize(cleaned, plan.keys, plan.summary), plan.level)), plan)


def prepared(table: DataFrame, plan: TrainingPlan) -> DataFrame:
    """Fill, encode and scale the joined table."""
    if plan.missing:
        table = handle_missing(table, plan.missing)
    for column, categories in plan.onehot.items():
        table = encode_onehot(table, column, categories)
    for column in plan.labels:
        table = encode_label(table, column)
    return scale(table, plan.scaled, plan.method) if plan.scaled else table


def derive(table: DataFrame, stats: DataFrame, plan: TrainingPlan) -> DataFrame:
    """Add the recent trend of each area, from cleaned statistics."""
    if plan.trend is None:
        return table
    year, value = plan.trend
    slopes = recent_slope(stats, plan.keys, year, value).drop("n_years")
    return join_features(table, slopes, plan.level)


def explore(table: DataFrame, columns: list[str], bins: int = 10) -> tuple[DataFrame, dict[str, DataFrame]]:
    return correlation(table, columns), {c: histogram(table, c, bins) for c in columns}


def run(features: DataFrame, stats: DataFrame, plan: TrainingPlan, mode: str = "full") -> DataFrame:
    """full: both halves; preprocess: the first; features: the second on a preprocessed table."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    cleaned = clean_statistics(stats)
    table = features if mode == "features" else preprocess(features, cleaned, plan)
    return table if mode == "preprocess" else derive(table, cleaned, plan)


@dataclass
class TrainingRun:
    """The finished table, the record of how it came about, its exploration and where it was written."""

    table: DataFrame
    cleaning: DataFrame
    steps: DataFrame
    correlation: DataFrame
    histograms: dict[str, DataFrame]
    paths: list[str]


def record(before: DataFrame, after: DataFrame, plan: TrainingPlan) -> DataFrame:
    """Which step was applied to which column, with the column's mean and gaps before and after.

    A column a step replaces by others (one-hot, drop) has no figures after it. One pass over
    each table; the plan's few steps are the rows.
    """
    steps = [("missing", c, how) for c, how in plan.missing.items()] + [("one-hot", c, "") for c in plan.onehot]
    steps += [("label", c, "") for c in plan.labels] + [("scale", c, plan.method) for c in plan.scaled]
    named = before.sparkSession.createDataFrame(steps, "step string, column_name string, detail string")
    columns = list(dict.fromkeys(c for _, c, _ in steps))

    def figures(df: DataFrame, suffix: str) -> DataFrame:
        there = [c for c in columns if c in df.columns]
        parts = [F.struct(F.lit(c).alias("column_name"), F.count_if(known(df, c).isNull()).alias(f"n_null_{suffix}"),
                          F.avg(known(df, c).try_cast("double")).alias(f"mean_{suffix}")) for c in there]
        empty = "array<struct<column_name:string,n_null:bigint,mean:double>>"
        rows = df.agg(F.array(*parts).alias("f")) if parts else df.sparkSession.createDataFrame([([],)], f"f {empty}")
        return rows.select(F.explode("f").alias("f")).select("f.*").toDF("column_name", f"n_null_{suffix}", f"mean_{suffix}")

    return named.join(figures(before, "before"), "column_name", "left").join(figures(after, "after"), "column_name", "left")


def train(
    features: DataFrame, stats: DataFrame, plan: TrainingPlan, folder: str, layer: str, explored: list[str],
    formats: tuple[str, ...] = ("parquet",), day: date | None = None, bins: int = 10,
) -> TrainingRun:
    """The whole job: clean, summarise, join, fill, encode, scale, add trends, explore, write.

    The table is written first; record, exploration and further formats read it from there.
    """
    cleaning = materialize(clean(stats, RULES)[1])
    cleaned = clean_statistics(stats)
    joined = materialize(join_features(features, summarize(cleaned, plan.keys, plan.summary), plan.level))
    table = derive(prepared(joined, plan), cleaned, plan)
    paths = [export_training_set(table, folder, layer, "parquet", day)]
    table = table.sparkSession.read.parquet(paths[0])
    paths += [export_training_set(table, folder, layer, fmt, day) for fmt in formats if fmt != "parquet"]
    together, apart = explore(table, explored, bins)
    return TrainingRun(table, cleaning, record(joined, table, plan), together, apart, paths)
