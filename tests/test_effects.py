"""Random county effects against the same model fitted row by row."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldmosaic.operators import resilience


def row_wise(groups, x, y, rounds):
    """Expectation-maximisation on whole matrices."""
    design = np.column_stack([np.ones(len(x)), x])
    member = (groups[:, None] == np.unique(groups)[None, :]).astype(float)
    beta = np.linalg.solve(design.T @ design, design.T @ y)
    s2 = u2 = np.mean((y - design @ beta) ** 2)
    for _ in range(rounds):
        cov = np.linalg.inv(member.T @ member / s2 + np.eye(member.shape[1]) / u2)
        u = cov @ member.T @ (y - design @ beta) / s2
        beta = np.linalg.solve(design.T @ design, design.T @ (y - member @ u))
        s2 = (np.sum((y - design @ beta - member @ u) ** 2) + np.trace(member @ cov @ member.T)) / len(y)
        u2 = np.mean(u**2 + np.diag(cov))
    cov = np.linalg.inv(member.T @ member / s2 + np.eye(member.shape[1]) / u2)
    return beta, s2, u2, cov @ member.T @ (y - design @ beta) / s2


def test_rounds_match_whole_matrices(spark):
    rng = np.random.default_rng(5)
    groups = rng.integers(0, 7, 150)
    groups[groups == 6] = np.where(rng.random((groups == 6).sum()) < 0.1, 6, 0)  # sizes differ
    x = rng.normal(size=(150, 2))
    y = 3 + x @ [1.5, -2.0] + rng.normal(scale=2, size=7)[groups] + rng.normal(size=150)
    rows = [(f"g{g}", float(a), float(b), float(t)) for g, (a, b), t in zip(groups, x, y)] + [("g1", None, 1.0, 1.0), ("g9", 1.0, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "county string, a double, b double, t double")
    found = resilience.fit_random_effects(df, "county", "t", ["a", "b"], rounds=7, tolerance=0.0)
    beta, s2, u2, u = row_wise(groups, x, y, 7)
    assert list(found.fixed) == ["", "a", "b"] and np.allclose(list(found.fixed.values()), beta)
    assert found.var_residual == pytest.approx(s2) and found.var_county == pytest.approx(u2)
    effects = {r.county: r.effect for r in found.counties.collect()}
    assert effects == pytest.approx({f"g{g}": e for g, e in zip(np.unique(groups), u)})


def test_it_ends_when_nothing_changes_and_finds_planted_spread(spark):
    rng = np.random.default_rng(6)
    level = rng.normal(scale=3, size=40)
    rows = [(int(g), float(a), float(1 + 2 * a + level[g] + rng.normal(scale=0.5))) for g in range(40) for a in rng.normal(size=8)]
    found = resilience.fit_random_effects(spark.createDataFrame(rows, "county long, a double, t double"), "county", "t", ["a"], tolerance=1e-4)
    assert found.rounds < 100 and found.fixed["a"] == pytest.approx(2, abs=0.2)
    assert found.var_residual == pytest.approx(0.25, rel=0.3) and found.var_county == pytest.approx(level.var(), rel=0.3)
    assert found.counties.where(F.col("n") == 8).count() == 40


def test_no_rows(spark):
    with pytest.raises(ValueError):
        resilience.fit_random_effects(spark.createDataFrame([], "county string, a double, t double"), "county", "t", ["a"])
