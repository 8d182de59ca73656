"""Joins with a look-up table in which a few keys hold most of the rows."""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from fieldmosaic.runtime import materialize

HOT_SHARE = 1 / 256  # of the rows; so there are at most 256 hot keys
BROADCAST_ROWS = 100_000  # rows of the look-up table for all hot keys together


def hot_keys(counts: DataFrame, keys: list[str], share: float = HOT_SHARE) -> DataFrame:
    """(keys…, _n) of the keys that hold at least `share` of all rows, 1 / share of them at most; counts are (keys…, _n)."""
    total = counts.agg(F.sum("_n")).first()[0] or 0
    return counts.where(F.col("_n") >= max(2, math.ceil(total * share)))


def skew_join(
    facts: DataFrame, lookup: DataFrame, keys: list[str], counts: DataFrame | None = None,
    share: float = HOT_SHARE, broadcast_rows: int = BROADCAST_ROWS, salts: int = 64,
) -> DataFrame:
    """Left join of `facts` and `lookup` on `keys` (not null-safe), in which no key becomes one task.

    Keys are counted (combined in every task; pass stored `counts` (keys…, _n) if they are known). The look-up
    rows of the hot keys are counted too. While they are `broadcast_rows` at most, they go to the facts, so that rows
    with a hot key are not shuffled; beyond that, facts are dealt to `salts` tasks a key by a hash of the
    whole row and the look-up rows are copied to each, so only rows that agree in every column share a task. Null keys match nothing
    and stay where they are. All other rows meet in a plain join. Columns: those of `facts`, then the others of `lookup`.
    """
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    columns = [*facts.columns, *[c for c in lookup.columns if c not in keys]]
    if counts is None:
        counts = materialize(facts.where(known).groupBy(*keys).agg(F.count("*").alias("_n")))
    hot = materialize(hot_keys(counts, keys, share).select(*keys))
    near = F.broadcast(hot)  # 1 / share rows at most
    cold = facts.where(known).join(near, keys, "left_anti").join(lookup, keys, "left").select(*columns)
    missing = facts.where(~known).select(*facts.columns, *[F.lit(None).cast(lookup.schema[c].dataType).alias(c) for c in columns[len(facts.columns):]])
    warm, theirs = facts.join(near, keys, "left_semi"), lookup.join(near, keys, "left_semi")
    if theirs.limit(broadcast_rows + 1).count() <= broadcast_rows:
        warm = warm.join(F.broadcast(theirs), keys, "left")
    else:
        dealt = warm.withColumn("_salt", F.pmod(F.xxhash64(*warm.columns), F.lit(salts)).cast("int"))
        copies = theirs.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        warm = dealt.join(copies.hint("shuffle_merge"), [*keys, "_salt"], "left")
    return warm.select(*columns).unionByName(cold).unionByName(missing)
