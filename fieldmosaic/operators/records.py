"""Generic records: keys, duplicates, paging, column profiles, registries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from fieldmosaic.functions.text import sanitize_column, truncate_text
from fieldmosaic.operators.ranking import global_rank
from fieldmosaic.schemas import label_of, type_of

def one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key under `order`; Spark prunes each task to one row per key before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def last_per_key(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    return one_per_key(df, keys, [F.col(position).desc()])


def first_per_key(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    return one_per_key(df, keys, [F.col(position).asc()])


def dedup_records(df: DataFrame, position: str) -> DataFrame:
    """Equal records reduced to the earliest; the result keeps that position as the order.

    A plain aggregation on all columns, combined before the shuffle: mass copies cost nothing.
    """
    columns = [c for c in df.columns if c != position]
    return df.groupBy(*columns).agg(F.min(position).alias(position)).select(*df.columns)


def ensure_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Missing columns are added as empty text."""
    return df.withColumns({n: F.lit(None).cast("string") for n in names if n not in df.columns})


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[sanitize_column(c) for c in df.columns])


def infer_labels(df: DataFrame, skip: tuple[str, ...] = ("foreign_key",)) -> DataFrame:
    """Narrowest storage label of each text column as rows (column_name, label), in one pass.

    A column without any value is text.
    """
    # A cheap look at the text saves most failing casts, which are slow.
    tests = {
        "integer": ("bigint", r"^\s*[+-]?\d+\s*$"), "float": ("double", r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?[df]?|nan|inf(inity)?)\s*$"),
        "boolean": ("boolean", r"(?i)^\s*(t|f|y|n|0|1)"), "datetime": ("timestamp", r"^\s*[+-]?\d{4,}(-|\s*$)"),
    }
    names = [c for c in df.columns if c not in skip]

    def label(name: str) -> Column:
        seen = F.count(name)
        choice: Column | None = None
        for tag, (dtype, looks) in tests.items():
            value = F.when(F.col(name).rlike(looks), F.col(name).try_cast(dtype))
            fits = (seen > 0) & (F.count(value) == seen)
            choice = F.when(fits, tag) if choice is None else choice.when(fits, tag)
        return choice.otherwise("text").alias(name)

    return df.agg(*[label(n) for n in names]).unpivot([], names, "column_name", "label")


def schema_labels(df: DataFrame, skip: tuple[str, ...] = ("foreign_key",)) -> dict[str, str]:
    """Storage label per column of a typed table."""
    return {f.name: label_of(f.dataType, f.name) for f in df.schema.fields if f.name not in skip}


def columns_ddl(labels: dict[str, str]) -> str:
    """Schema text for labelled columns, names made safe; an unknown label is text."""
    return ", ".join(
        f"`{sanitize_column(name)}` {type_of(label).simpleString()}" for name, label in labels.items() if name != "foreign_key"
    )


def pick_nth(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The n-th row (from 1) under an ascending order; no row when n is out of range.

    The order should end in a unique column, else any of the rows that tie at n may be taken.
    """
    if n < 1:
        return df.limit(0)
    return global_rank(df, [F.col(c) for c in order], "_nth").where(F.col("_nth") == n).drop("_nth")


def truncate_strings(df: DataFrame, limit: int = 15) -> DataFrame:
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: truncate_text(F.col(c), limit) for c in text})


def paginate(df: DataFrame, order: list[Column]) -> DataFrame:
    """Add row number, page number and page size; the size depends on the row count."""
    ranked = global_rank(df, order, "row_no", "_n")
    n = F.col("_n")
    size = F.when(n <= 25, n).when(n <= 100, F.lit(20)).otherwise(F.lit(50)).cast("long")
    page = (F.floor((F.col("row_no") - 1) / size) + 1).cast("long")
    return ranked.withColumn("page_size", size).withColumn("page", page).drop("_n")


def unpivot_record(df: DataFrame, keys: list[str]) -> DataFrame:
    """Each record as (field, value) rows, all values as text."""
    fields = [c for c in df.columns if c not in keys]
    return df.select(*keys, *[F.col(c).cast("string").alias(c) for c in fields]).unpivot(keys, fields, "field", "value")


def count_text(df: DataFrame) -> DataFrame:
    """Row count as text."""
    return df.agg(F.count("*").cast("string").alias("n"))


def table_counts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """(table_name, n) with the count as text; a table that does not exist counts "0"."""
    def one(name: str, df: DataFrame | None) -> DataFrame | None:
        return None if df is None else df.agg(F.count("*").cast("string").alias("n")).select(F.lit(name).alias("table_name"), "n")

    known = [one(name, df) for name, df in tables.items() if df is not None]
    if not known:
        return SparkSession.active().createDataFrame([(name, "0") for name in tables], "table_name string, n string")
    out = reduce(DataFrame.unionByName, known)
    absent = [name for name, df in tables.items() if df is None]
    if absent:
        rows = out.sparkSession.createDataFrame([(name, "0") for name in absent], "table_name string, n string")
        out = out.unionByName(rows)
    return out


def registry_counts(registry: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Registry with the row count of each table, 0 where the table is missing; last entry per id."""
    counts = table_counts(tables).select(
        F.col("table_name").alias("category_table_id"), F.col("n").cast("long").alias("n_rows")
    )
    joined = registry.join(counts, "category_table_id", "left")
    return joined.withColumn("n_rows", F.coalesce("n_rows", F.lit(0).cast("long")))


def registry_latest(registry: DataFrame, position: str) -> DataFrame:
    return last_per_key(registry, ["category_table_id"], position)


def layer_links(tables: dict[str, DataFrame], position: str, mark: str = "102") -> DataFrame:
    """(map_name, map_url) of all link tables whose id contains the mark; the last entry of a name wins.

    Tables rank in the order given, rows inside by their position.
    """
    chosen = [df.withColumn("_table", F.lit(i)) for i, (name, df) in enumerate(tables.items()) if mark in name]
    if not chosen:
        raise ValueError(f"no link table with {mark} in its id")
    rows = reduce(DataFrame.unionByName, chosen).select("map_name", "map_url", "_table", position)
    return one_per_key(rows, ["map_name"], [F.col("_table").desc(), F.col(position).desc()]).select("map_name", "map_url")


def json_shape(text: Column) -> Column:
    """`object` or `array` for a JSON object or a list of objects, null for anything else."""
    parsed = F.try_parse_json(text)
    shape = F.schema_of_variant(parsed)
    return (
        F.when(shape.startswith("OBJECT"), F.lit("object"))
        .when(shape.startswith("ARRAY<OBJECT") | (shape == "ARRAY<VOID>"), F.lit("array"))
    )


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)
