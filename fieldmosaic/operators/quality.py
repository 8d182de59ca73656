"""Table constraints as violation reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from fieldmosaic.schemas import AREA_KEY, AREA_LEVELS, LEDGER_KEY, STAGES

AREA_RULES = {
    "not_null": ["area_id", "area_level", "geometry", "shp_version"],
    "domain": {"area_level": AREA_LEVELS},
    "unique": AREA_KEY,
}
LEDGER_RULES = {
    "not_null": ["area_id", "area_level", "classification", "shp_version", "stage", "file_path"],
    "domain": {"stage": STAGES},
    "unique": LEDGER_KEY,
}


def constraint_violations(df: DataFrame, rules: dict) -> DataFrame:
    """(rule, column_name, n) for every rule, 0 where it holds.

    Null and domain rules are counted in one pass; duplicates count the rows beyond the first
    of each fully known key.
    """
    checks = [("not_null", c, F.col(c).isNull()) for c in rules["not_null"]]
    checks += [("domain", c, F.col(c).isNotNull() & ~F.col(c).isin(*allowed)) for c, allowed in rules["domain"].items()]
    names = [f"{rule}:{column}" for rule, column, _ in checks]
    counts = df.agg(*[F.count_if(bad).alias(n) for n, (_, _, bad) in zip(names, checks)])
    simple = counts.unpivot([], names, "_name", "n").select(
        F.substring_index("_name", ":", 1).alias("rule"), F.substring_index("_name", ":", -1).alias("column_name"), "n"
    )
    key = rules["unique"]
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    groups = df.where(known).groupBy(*key).agg((F.count("*") - 1).alias("extra"))
    unique = groups.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("n")).select(
        F.lit("unique").alias("rule"), F.lit(",".join(key)).alias("column_name"), "n"
    )
    return simple.unionByName(unique)
