"""Statistics per area: summaries, joins, trends, exploration."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldmosaic.functions.binding import let
from fieldmosaic.operators.clean import known, moments
from fieldmosaic.operators.joins import skew_join
from fieldmosaic.operators.ranking import exact_quantiles
from fieldmosaic.runtime import materialize

AGGREGATES = {"sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count, "std": F.stddev_samp}


def summarize(df: DataFrame, keys: list[str], strategy: dict[str, str | list[str]]) -> DataFrame:
    """One row per key with `column_statistic` columns; statistics as in AGGREGATES plus median.

    Sums and the like are combined before the shuffle. Medians are exact and taken on value
    counts along a range-partitioned order, so a key with most of the rows needs no big task.
    """
    wanted = [(c, s) for c, names in strategy.items() for s in ([names] if isinstance(names, str) else names)]
    plain = [AGGREGATES[s](c).alias(f"{c}_{s}") for c, s in wanted if s != "median"]
    out = df.groupBy(*keys).agg(*plain) if plain else df.select(*keys).distinct()
    for column in [c for c, s in wanted if s == "median"]:
        median = exact_quantiles(df, [column], [0.5], keys).select(
            *[F.col(k).alias(f"_{k}") for k in keys], F.col("value").alias(f"{column}_median")
        )
        on = [out[k].eqNullSafe(median[f"_{k}"]) for k in keys]
        out = out.join(median, on, "left").drop(*[f"_{k}" for k in keys])
    return out


def yearly_totals(df: DataFrame, keys: list[str], year: str, value: str) -> DataFrame:
    return df.groupBy(*keys, year).agg(F.sum(value).alias(value))


def yearly_mean(df: DataFrame, keys: list[str], year: str, value: str) -> DataFrame:
    """Mean over years of the yearly totals per key."""
    yearly = yearly_totals(df, keys, year, value)
    return yearly.groupBy(*keys).agg(F.avg(value).alias(f"{value}_yearly_mean"), F.count("*").alias("n_years"))


def recent_years(df: DataFrame, keys: list[str], year: str, value: str, last: int) -> DataFrame:
    """Yearly totals of the last `last` years of each key, newest first by `recency`.

    Years are counted after the totals are formed, so a window holds one row per year.
    """
    yearly = yearly_totals(df, keys, year, value)
    window = Window.partitionBy(*keys).orderBy(F.col(year).desc())
    return yearly.withColumn("recency", F.row_number().over(window)).where(F.col("recency") <= last)


def pivot_groups(df: DataFrame, keys: list[str], group: str, value: str, groups: list[str]) -> DataFrame:
    """One column per named group with its total; naming them keeps it to a single pass."""
    totals = df.groupBy(*keys).agg(
        *[F.sum(F.when(F.col(group) == g, F.col(value)).otherwise(0.0)).alias(f"{value}_{g}") for g in groups]
    )
    return totals


def join_features(features: DataFrame, stats: DataFrame, level: str, feature_key: dict[str, str] | None = None) -> DataFrame:
    """Area features with the statistics of their town or county; areas without statistics stay."""
    key = {"town": "town_id", "county": "county_id"}[level]
    own = (feature_key or {"town": "area_id", "county": "COUNTYID"})[level]
    return features.join(stats.withColumnRenamed(key, "_key"), F.col(own) == F.col("_key"), "left").drop("_key")


def moving_trend(df: DataFrame, key: str, year: str, value: str, half_width: int = 2) -> DataFrame:
    """Yearly totals with trend (centred moving average by position) and deviation ((value - trend) / trend).

    Totals come first, so the window of a key holds one row per year.
    """
    window = Window.partitionBy(key).orderBy(year).rowsBetween(-half_width, half_width)
    with_trend = yearly_totals(df, [key], year, value).withColumn("trend", F.avg(value).over(window))
    return with_trend.withColumn("deviation", deviation(F.col(value), F.col("trend")))


def deviation(value: Column, trend: Column) -> Column:
    return F.try_divide(value - trend, trend)


def hp_trend(df: DataFrame, key: str, year: str, value: str, smoothing: float = 100.0) -> DataFrame:
    """Hodrick-Prescott trend of each yearly series (key, year, value, trend).

    Rows are first totalled per key and year, so a series is one array with a number per year. Its
    five-band system is solved by one pass of elimination and one back, as column expressions.
    A missing total leaves the whole series without a trend.
    """
    series = yearly_totals(df, [key], year, value)
    points = F.array_sort(F.collect_list(F.struct(F.col(year).alias("year"), F.col(value).cast("double").alias("value"))))
    grouped = series.groupBy(key).agg(points.alias("_points"))
    row = "struct<d:double,e:double,f:double,z:double>"
    n = F.size("_points")

    def eliminate(state: Column, i: Column) -> Column:
        """Pivot d, factors e and f towards the next two rows, and the reduced value z of row i."""
        one, two = state.one, state.two
        first, middle, last = (F.when(c, smoothing).otherwise(0.0) for c in (i <= n - 3, (i >= 1) & (i <= n - 2), i >= 2))
        pivot = 1 + first + 4 * middle + last - one.d * one.e * one.e - two.d * two.f * two.f
        reduced = F.get("_points", i).value - one.e * one.z - two.f * two.z
        here = let(pivot, lambda d: F.struct(
            d.alias("d"), ((-2 * (first + middle) - one.d * one.e * one.f) / d).alias("e"), (first / d).alias("f"), reduced.alias("z")))
        return let(here, lambda r: F.struct(F.concat(state.rows, F.array(r)).alias("rows"), r.alias("one"), one.alias("two")))

    def substitute(state: Column, r: Column) -> Column:
        x = r.z / r.d - r.e * state.one - r.f * state.two
        return let(x, lambda v: F.struct(F.concat(F.array(v), state.rows).alias("rows"), v.alias("one"), state.one.alias("two")))

    zero = F.struct(*[F.lit(0.0).alias(c) for c in "defz"])
    start = F.struct(F.array().cast(f"array<{row}>").alias("rows"), zero.alias("one"), zero.alias("two"))
    rows = F.aggregate(F.sequence(F.lit(0), n - 1), start, eliminate, lambda s: s.rows)
    end = F.struct(F.array().cast("array<double>").alias("rows"), F.lit(0.0).alias("one"), F.lit(0.0).alias("two"))
    trend = F.aggregate(F.reverse(rows), end, substitute, lambda s: s.rows)
    pairs = F.zip_with("_points", trend, lambda p, t: F.struct(p.year.alias("year"), p.value.alias("value"), t.alias("trend")))
    return grouped.select(key, F.explode(pairs).alias("_p")).select(
        key, F.col("_p.year").alias(year), F.col("_p.value").alias(value), F.col("_p.trend").alias("trend"))


def yoy_difference(df: DataFrame, key: str, year: str, value: str) -> DataFrame:
    """Yearly totals with the difference to the year before in order; null for the first."""
    window = Window.partitionBy(key).orderBy(year)
    return yearly_totals(df, [key], year, value).withColumn("yoy", F.col(value) - F.lag(value).over(window))


def recent_slope(df: DataFrame, keys: list[str], year: str, value: str, last: int = 5) -> DataFrame:
    """Linear slope per key over its last years; null with one year only."""
    recent = recent_years(df, keys, year, value, last)
    slope = F.regr_slope(F.col(value), F.col(year).cast("double"))
    return recent.groupBy(*keys).agg(slope.alias("slope"), F.count("*").alias("n_years"))


def downscale(totals: DataFrame, towns: DataFrame, county: str, total: str, weight: str) -> DataFrame:
    """County totals split over their towns by weight; null where a county's weights sum to 0.

    The weight sum is an aggregate joined back rather than a window, so a county with a third
    of all towns is not one task, in the sum or in the join back.
    """
    counts = materialize(towns.where(F.col(county).isNotNull()).groupBy(county).agg(F.sum(weight).alias("_w"), F.count("*").alias("_n")))
    sums = counts.drop("_n").join(totals.select(county, total), county)
    share = F.try_divide(F.col(weight), F.col("_w"))
    return skew_join(towns, sums, [county], counts.select(county, "_n")).withColumn("allocated", F.col(total) * share).drop("_w")


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """(bin, n, low, high) of equal-width bins over the value range; empty bins are listed with 0."""
    _, _, low, high = moments(df, [column])[column]
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, n long, low double, high double")
    low, high = float(low), float(high)
    width = (high - low) / bins or 1.0
    value = known(df, column)
    place = F.least(F.floor((value - low) / width), F.lit(bins - 1)).cast("int")
    counts = df.where(value.isNotNull()).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(counts, "bin", "left").select(
        "bin", F.coalesce("n", F.lit(0).cast("long")).alias("n"),
        (low + F.col("bin") * width).alias("low"), (low + (F.col("bin") + 1) * width).alias("high"),
    )


def correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Correlation matrix as (x, y, corr) rows, all pairs from one pass."""
    pairs = list(combinations_with_replacement(columns, 2))
    row = df.agg(*[F.corr(known(df, x), known(df, y)).alias(f"c{i}") for i, (x, y) in enumerate(pairs)])
    entries = []
    for i, (x, y) in enumerate(pairs):
        for a, b in {(x, y), (y, x)}:
            entries.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"c{i}").alias("corr")))
    return row.select(F.inline(F.array(*entries)))
