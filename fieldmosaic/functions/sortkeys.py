"""Sort keys as columns: natural order, priority words, numbers, dates.

Every key is a plain column whose ascending order is the wanted one.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from fieldmosaic.functions.dates import parse_date

# Order of the position words.
PRIORITY_WORDS = {"上": 1, "前": 1, "一": 1, "中": 2, "二": 2, "下": 3, "後": 3, "三": 3}

COLLATION = "zh_Hant_TWN"


def natural_key(text: Column) -> Column:
    """Key under which digit runs compare as numbers of any length.

    A list of (text, digit count, digits without leading zeros) pieces; an empty text is an
    empty list and a missing one sorts like '0', just before it (see `natural_order`).
    """
    def piece(match: Column) -> Column:
        digits = F.regexp_extract(match, r"(\d*)$", 1)
        bare = F.regexp_replace(digits, "^0+", "")
        numeric = digits != ""
        return F.struct(
            F.regexp_replace(match, r"\d+$", "").alias("t"),
            F.when(numeric, F.length(bare)).alias("len"),
            F.when(numeric, bare).alias("digits"),
        )

    matches = F.filter(F.regexp_extract_all(text, F.lit(r"(\D*)(\d*)"), F.lit(0)), lambda m: m != "")
    missing = F.array(F.struct(F.lit("").alias("t"), F.lit(0).alias("len"), F.lit("").alias("digits")))
    return F.coalesce(F.transform(matches, piece), missing)


def natural_order(text: Column) -> list[Column]:
    return [natural_key(text), text.isNotNull()]


def priority_key(text: Column) -> list[Column]:
    """Position words first by their rank alone, then other text in Traditional Chinese order."""
    word = F.trim(text)
    other = len(PRIORITY_WORDS)
    rank = F.coalesce(*[F.when(word == w, F.lit(n)) for w, n in PRIORITY_WORDS.items()], F.lit(other))
    shown = F.when(rank == other, F.coalesce(text, F.lit(""))).otherwise(F.lit(""))
    return [rank, F.collate(shown, COLLATION)]


def number_key(value: Column) -> list[Column]:
    """Numbers in order, then what is not a number."""
    number = value.try_cast("double")
    return [number.isNull(), number]


def date_key(value: Column) -> list[Column]:
    """Dates in order; unparsable and missing ones count as the first day."""
    return [parse_date(F.trim(value))]


def sort_columns(keys: list, position: str) -> list[Column]:
    """Ascending keys for [(column, kind)] with kind date_asc, text_asc or number_asc, ties by position."""
    makers = {"date_asc": date_key, "text_asc": priority_key, "number_asc": number_key}
    order: list[Column] = []
    for name, kind in keys:
        order += makers[kind](F.col(name)) if kind in makers else [F.col(name)]
    return [*order, F.col(position)]


def sort_by_keys(df: DataFrame, keys: list[Column]) -> DataFrame:
    """Rows in ascending order of computed keys; each key is computed once per row, not per comparison."""
    names = [f"_k{i}" for i in range(len(keys))]
    return df.withColumns(dict(zip(names, keys))).orderBy(*names).drop(*names)


def natural_sort(df: DataFrame, column: str) -> DataFrame:
    return sort_by_keys(df, natural_order(F.col(column)))


def typed_sort(df: DataFrame, keys: list | str, position: str) -> DataFrame:
    """Rows sorted by typed keys; the keys may be JSON text.

    No keys leave the rows as they are; JSON that cannot be read gives no rows.
    """
    if isinstance(keys, str):
        try:
            keys = json.loads(keys)
        except ValueError:
            return df.where(F.lit(False))
    return sort_by_keys(df, sort_columns(keys, position)) if keys else df
