"""Positions, running sums and quantiles on skewed data."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from fieldmosaic.operators import ranking, records


def skewed(spark, n=3000):
    """A third of the rows share one key and one value."""
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        "id", F.when(hot, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("key"),
        F.when(hot, 7.0).otherwise((F.col("id") * 37 % 501).cast("double")).alias("value"),
    )


def test_global_rank_counts_through_ties(spark):
    rows = ranking.global_rank(skewed(spark), [F.col("key"), F.col("id")], "rn", "n").collect()
    ordered = sorted(rows, key=lambda r: r.rn)
    assert [r.rn for r in ordered] == list(range(1, 3001)) and {r.n for r in rows} == {3000}
    assert [(r.key, r.id) for r in ordered] == sorted((r.key, r.id) for r in rows)


def test_hot_key_is_cut_across_partitions(spark):
    spread = skewed(spark).repartitionByRange(8, "key", "id").withColumn("p", F.spark_partition_id())
    assert spread.where("key = 'hot'").select("p").distinct().count() > 1


def test_empty_input(spark):
    empty = skewed(spark).where("id < 0")
    assert ranking.global_rank(empty, [F.col("id")]).collect() == []
    assert ranking.exact_quantiles(empty, ["value"], [0.5]).collect() == []


def test_running_sum(spark):
    rows = ranking.running_sum(skewed(spark).withColumn("one", F.lit(2)), ["key", "id"], "one", "upto").collect()
    assert [r.upto for r in sorted(rows, key=lambda r: (r.key, r.id))] == list(range(2, 6001, 2))


def test_quantiles_equal_numpy(spark):
    df = skewed(spark).withColumn("other", F.when(F.col("id") % 5 == 0, None).otherwise(-F.col("value"))).cache()
    data = df.toPandas()
    probs = [0.0, 0.1, 0.5, 0.75, 1.0]
    whole = {(r.column, r.prob): r.value for r in ranking.exact_quantiles(df, ["value", "other"], probs).collect()}
    for column in ("value", "other"):
        for p in probs:
            assert np.isclose(whole[column, p], np.quantile(data[column].dropna(), p))
    grouped = {(r.key, r.prob): r.value for r in ranking.exact_quantiles(df, ["value"], probs, ["key"]).collect()}
    for key, part in data.groupby("key"):
        for p in probs:
            assert np.isclose(grouped[key, p], np.quantile(part["value"], p))


def test_ntile_sizes(spark):
    tiles = ranking.ntile(spark.range(23), [F.col("id")], 5, "t").groupBy("t").count().collect()
    assert {r.t: r["count"] for r in tiles} == {1: 5, 2: 5, 3: 5, 4: 4, 5: 4}
    few = ranking.ntile(spark.range(3), [F.col("id")], 5, "t").collect()
    assert sorted(r.t for r in few) == [1, 2, 3]


def test_one_per_key_prunes_before_the_shuffle(spark):
    plan = records.last_per_key(skewed(spark), ["key"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_pages(spark):
    for n, size, pages in ((20, 20, 1), (26, 20, 2), (101, 50, 3)):
        rows = records.paginate(spark.range(n), [F.col("id")]).collect()
        assert {r.page_size for r in rows} == {size} and max(r.page for r in rows) == pages


def test_pick_nth(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("v"))
    assert [r.v for r in records.pick_nth(df, ["v"], 3).collect()] == [2]
    assert records.pick_nth(df, ["v"], 0).collect() == [] and records.pick_nth(df, ["v"], 101).collect() == []


def test_pick_nth_far_in(spark):
    assert [r.id for r in records.pick_nth(spark.range(500), ["id"], 321).collect()] == [320]
