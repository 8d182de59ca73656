"""Training corpus in five stages: quality, repeated lines, similar texts, benchmark passages, tokens.

Each stage takes the documents its predecessor kept, with all their columns, and is written before
the next one starts. Null texts count as empty in every stage; rows that agree in id and text
are one document; columns beside `doc_id` and `text` pass through, and `n_chars` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldmosaic.llm import decontaminate, line_dedup, ngram_join, pieces, quality
from fieldmosaic.llm.common import documents, row_key, stored
from fieldmosaic.llm.registry import query


def _keyed(docs: DataFrame) -> DataFrame:
    """Every row as one struct, beside its key: names of other columns cannot clash."""
    return docs.select(F.struct("*").alias("row"), row_key(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_key"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts; those it rejects go."""
    scores = quality.quality_scores(docs, documents(spark, sf_dir, "labels"))
    rejected = scores.where("predicted = 0").select("_key").distinct()
    return _keyed(docs).join(rejected, "_key", "left_anti").select("row.*")


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of lines that stood in an earlier one; emptied ones stay as empty texts."""
    done = line_dedup.dedup_lines(docs)
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(F.col("deleted") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars")))
    return done.select(row.alias("row")).select("row.*")


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every class of similar texts; all texts without a word are one class.

    Of rows that agree in id and text the least by all columns stays.
    """
    classes = ngram_join.similar_classes(docs)
    first = classes.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_key")).alias("first")).select("first._key")
    return _keyed(docs).join(first, "_key", "left_semi").groupBy("_key").agg(F.min("row").alias("row")).select("row.*")


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no item of the benchmark."""
    leaks = decontaminate.contaminated(docs, documents(spark, sf_dir, "benchmark")).select("_key").distinct()
    return _keyed(docs).join(stored(leaks, "leaks"), "_key", "left_anti").select("row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document that is left."""
    return pieces.encode(docs).select(F.col("id").alias("doc_id"), F.size("ids").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("line dedup", cut_repeated_lines),
    ("n-gram jaccard join", keep_one_of_similar),
    ("benchmark decontamination", drop_benchmark_passages),
    ("sentencepiece encoding", tokenize),
]
ORACLE_SQL = None  # a fitted classifier is no SQL; the tests compare every stage with brute force


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return docs
