"""Look-ups in which one key holds a third of the rows."""

from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from fieldmosaic.operators import clean, stats
from fieldmosaic.operators.joins import hot_keys, skew_join


def facts_of(spark, n=24_000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (F.col("id") % 4001).cast("string")))
    return spark.range(n).repartition(8).select("id", key.alias("key"))


@pytest.fixture
def plain(spark):
    """Without adaptive plans, so every shuffle partition stays visible."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_hot_key_is_not_one_task(plain, broadcast_rows):
    facts = facts_of(plain)
    lookup = facts.where("key is not null and id % 6 <> 2").select("key").distinct().withColumn("code", F.length("key"))
    joined = skew_join(facts, lookup, ["key"], broadcast_rows=broadcast_rows)
    rows = [r.n for r in joined.where("key = 'hot'").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(rows) >= 8 and max(rows) <= 2 * statistics.median(rows)
    got = sorted(map(tuple, joined.collect()), key=repr)
    assert got == sorted(map(tuple, facts.join(lookup, "key", "left").select("id", "key", "code").collect()), key=repr) and len(got) == 24_000


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_repeated_lookup_rows_and_odd_tables(spark, broadcast_rows):
    facts = spark.createDataFrame([("a", 1)] * 5 + [("b", None), (None, 3)], "key string, value int")
    lookup = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z"), ("c", "q")], "key string, name string")
    for left, right in ((facts, lookup), (facts.limit(0), lookup), (facts, lookup.limit(0)), (facts.where("key is null"), lookup)):
        joined = skew_join(left, right, ["key"], broadcast_rows=broadcast_rows)
        want = left.join(right, "key", "left").select("key", "value", "name")
        assert joined.columns == want.columns and sorted(map(repr, joined.collect())) == sorted(map(repr, want.collect()))


def test_hot_keys_are_bounded(spark):
    counts = spark.range(1000).select(F.col("id").alias("key"), F.lit(10).alias("_n"))
    assert hot_keys(counts, ["key"], 0.01).isEmpty()
    assert hot_keys(counts.withColumn("_n", F.when(F.col("key") < 90, 1000).otherwise(1)), ["key"], 0.01).count() == 90


def test_codes_and_shares_of_a_hot_category(plain):
    facts = facts_of(plain)
    coded = clean.encode_label(facts, "key")
    values = sorted({r.key for r in facts.collect()} - {None})
    assert {(r.key, r.key_code) for r in coded.collect()} == {(v, i) for i, v in enumerate(values)} | {(None, None)}
    totals = facts.where("key is not null").groupBy("key").agg(F.lit(100.0).alias("total"))
    split = stats.downscale(totals, facts.withColumn("w", F.lit(1.0)), "key", "total", "w")
    for df in (coded, split):
        rows = [r.n for r in df.where("key = 'hot'").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert len(rows) >= 8 and max(rows) <= 2 * statistics.median(rows)
    assert split.where("key = 'hot'").agg(F.round(F.sum("allocated"), 6)).first()[0] == 100.0
