"""From yield deviations to a stability class per town."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from fieldmosaic.operators.ranking import ntile
from fieldmosaic.runtime import materialize


def align_targets(targets: DataFrame, towns: DataFrame, signals: DataFrame, county: str = "county_id") -> DataFrame:
    """County targets per year spread to all towns of the county with their yearly signals.

    Targets are one row per county and year, signals one per town and year. A town without
    signals gets a row for every year of its county's targets.
    """
    wanted = towns.select("town_id", county).join(targets.select(county, "year"), county)
    years = wanted.unionByName(towns.select("town_id", county).join(signals.select("town_id", "year"), "town_id")).distinct()
    yearly = years.join(towns.drop(county), "town_id").join(signals, ["town_id", "year"], "left")
    return yearly.join(targets, [county, "year"], "left")


def interactions(df: DataFrame, left: list[str], right: list[str]) -> DataFrame:
    """Products of every left with every right column, as left_x_right."""
    return df.withColumns({f"{a}_x_{b}": F.col(a) * F.col(b) for a in left for b in right})


def center(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Add columns less their mean within the key, as column_c.

    The means are combined before the shuffle and joined back, not a window over the key.
    """
    means = df.groupBy(key).agg(*[F.avg(c).alias(f"_m_{c}") for c in columns])
    joined = df.join(means, key, "left")
    return joined.withColumns({f"{c}_c": F.col(c) - F.col(f"_m_{c}") for c in columns}).drop(*[f"_m_{c}" for c in columns])


def fit_effects(df: DataFrame, county: str, target: str, features: list[str]) -> LinearRegressionModel:
    """Effects of the features on the target with county level differences taken out.

    This is the within estimator: county means are removed from both sides before a plain
    regression. `fit_random_effects` estimates the spread of the county effect as well.
    """
    known = df.dropna(subset=[target, *features])
    centred = center(known, county, [target, *features])
    assembler = VectorAssembler(inputCols=[f"{f}_c" for f in features], outputCol="features")
    model = LinearRegression(featuresCol="features", labelCol=f"{target}_c", fitIntercept=False)
    return model.fit(assembler.transform(centred))


@dataclass
class RandomEffects:
    """Fixed effects by feature (the level under an empty name), both variances, and (county, n, effect, variance) rows."""

    fixed: dict[str, float]
    var_county: float
    var_residual: float
    counties: DataFrame
    rounds: int


def fit_random_effects(df: DataFrame, county: str, target: str, features: list[str], rounds: int = 200, tolerance: float = 1e-8) -> RandomEffects:
    """Mixed model: fixed effects of the features, a normal random effect per county, by expectation-maximisation.

    The rows are read once, for sums and products per county, combined in every task before the shuffle.
    A round is one aggregation over that table of one row per county, of which a handful of sums reaches the driver; the
    rounds end when no variance changes by more than the share `tolerance`. Rows that miss the target or a feature are left out;
    null counties are one county.
    """
    names = [f"_x{i}" for i in range(len(features) + 1)]
    shown = df.dropna(subset=[target, *features]).select(F.col(county).alias("_g"), F.lit(1.0).alias(names[0]), *[F.col(f).cast("double").alias(n) for f, n in zip(features, names[1:])], F.col(target).cast("double").alias("_y"))
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = [F.sum(n).alias(n) for n in [*names, "_y"]]
    products = [F.sum(F.col(names[i]) * F.col(names[j])).alias(f"_p{i}_{j}") for i, j in pairs]
    products += [F.sum(F.col(n) * F.col("_y")).alias(f"_q{i}") for i, n in enumerate(names)] + [F.sum(F.col("_y") * F.col("_y")).alias("_yy")]
    groups = materialize(shown.groupBy("_g").agg(*sums, *products))
    whole = groups.agg(F.count("*").alias("groups"), *[F.sum(c).alias(c) for c in groups.columns if c != "_g"]).first()
    if not whole.groups:
        raise ValueError("no row has the target and all features")
    a = np.zeros((len(names), len(names)))
    for i, j in pairs:
        a[i, j] = a[j, i] = whole[f"_p{i}_{j}"]
    b, n, yy = np.array([whole[f"_q{i}"] for i in range(len(names))]), whole[names[0]], whole["_yy"]
    beta = np.linalg.lstsq(a, b, rcond=None)[0]
    var_residual = var_county = max((yy - 2 * beta @ b + beta @ a @ beta) / n, 0.0)

    def effect() -> tuple[Column, Column]:
        spread = F.lit(float(var_residual)) + F.col(names[0]) * F.lit(float(var_county))
        rest = reduce(add, [F.col(x) * F.lit(float(-v)) for x, v in zip(names, beta)], F.col("_y"))
        return F.coalesce(F.try_divide(F.lit(float(var_county)) * rest, spread), F.lit(0.0)), F.coalesce(F.try_divide(F.lit(float(var_county * var_residual)), spread), F.lit(0.0))

    done = 0
    while done < rounds:
        u, v = effect()
        held = groups.select(*names, "_y", u.alias("u"), v.alias("v"))
        size = F.col(names[0])
        e = held.agg(*[F.sum(F.col(x) * F.col("u")).alias(x) for x in names], F.sum(F.col("_y") * F.col("u")).alias("yu"), F.sum(size * F.col("u") ** 2).alias("nuu"),
                     F.sum(F.col("u") ** 2 + F.col("v")).alias("uv"), F.sum(size * F.col("v")).alias("nv")).first()
        xu = np.array([e[x] for x in names])
        beta = np.linalg.lstsq(a, b - xu, rcond=None)[0]
        before = var_residual, var_county
        var_residual = max((yy - 2 * beta @ b + beta @ a @ beta - 2 * (e.yu - beta @ xu) + e.nuu + e.nv) / n, 0.0)
        var_county = e.uv / whole.groups
        done += 1
        if all(abs(new - old) <= tolerance * abs(old) for new, old in zip((var_residual, var_county), before)):
            break
    u, v = effect()
    counties = groups.select(F.col("_g").alias(county), F.col(names[0]).cast("long").alias("n"), u.alias("effect"), v.alias("variance"))
    return RandomEffects(dict(zip(["", *features], beta.tolist())), float(var_county), float(var_residual), counties, done)


def resilience(df: DataFrame, weights: dict[str, float], classes: int, position: str) -> DataFrame:
    """Sensitivity (weighted sum of features), resilience (its negative) and stability class 1..classes.

    Class 1 is the most resilient; a row without score has no class and is not ranked.
    """
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + F.col(name) * F.lit(float(weight))
    scored = df.withColumn("sensitivity", total).withColumn("resilience", -F.col("sensitivity"))
    unknown = F.col("sensitivity").isNull() | F.isnan("sensitivity")
    ranked = ntile(scored.where(~unknown), [F.col("sensitivity"), F.col(position)], classes, "stability_class")
    return ranked.unionByName(scored.where(unknown).withColumn("stability_class", F.lit(None).cast("int")))


def effect_weights(model: LinearRegressionModel, features: list[str]) -> dict[str, float]:
    return dict(zip(features, (float(c) for c in model.coefficients)))
