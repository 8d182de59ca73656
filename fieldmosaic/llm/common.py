"""Helpers the operators share: stored intermediate tables, row identity, word hashes, components."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldmosaic.runtime import stored  # noqa: F401

_ODD = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 20
_STRIDES = [pow(0xD1342543DE82EF95, k + 1, 1 << 64) for k in range(16)]


def identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only id and text, as `_id`, `_text` (null: empty) and `_key`, a digest of both.

    The key depends on content alone, so a rescan after a lost executor gives the same one.
    Rows that agree in id and text share it and are treated as one document.
    """
    raw = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(doc_id).alias("_id"), raw.alias("_text")).withColumn("_key", row_key(F.col("_id"), F.col("_text")))


def row_key(doc_id: Column, text: Column) -> Column:
    """Hashes of id and text, of 128 bits together, as text; the part after the colon belongs to the text alone."""
    tagged = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.concat_ws(":", F.hex(F.xxhash64(tagged, text)), F.hex(F.xxhash64(text, F.lit(1))))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether the crc32 of the id as text leaves the remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


@lru_cache(1)
def word_codes() -> np.ndarray:
    """Whether a code point is part of a word (letter, digit or mark that Python counts as such)."""
    table = np.zeros(0x110000, dtype=bool)
    for code in range(0x110000):
        table[code] = chr(code).isalnum()
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0xD1342543DE82EF95
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(size + 1, base, np.uint64), np.full(size + 1, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, `size` of them at least."""
    return _powers(max(1 << int(size).bit_length(), _PIECE))


def window_codes(values: np.ndarray, size: int) -> np.ndarray:
    """Rolling hash of every window of `size` values, equal for equal windows at any place."""
    if len(values) < size:
        return np.empty(0, np.uint64)
    up, down = powers(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values.astype(np.uint64)) * up[: len(values)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * down[: len(values) - size + 1])


def _hash_piece(codes: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = word_codes()[codes]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = powers(len(codes))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _ODD * up[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the lower-cased words (runs of letters and digits), in order.

    Equal words have equal hashes wherever they stand. Long texts are read in pieces that
    are cut at blanks, so memory beyond the text itself is bounded unless a text has no blank.
    """
    text = text.lower()
    found, at = [], 0
    while at < len(text):
        end = at + _PIECE
        if end < len(text):
            blank = text.rfind(" ", at, end)
            if blank <= at:
                blank = text.find(" ", end)
            end = blank if blank > 0 else len(text)
        found.append(_hash_piece(np.frombuffer(text[at:end].encode("utf-32-le", "surrogatepass"), np.uint32)))
        at = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def shingles(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words (16 at most); a shorter text is one shingle, an empty one none."""
    if not len(words):
        return np.empty(0, np.uint64)
    width = min(size, len(words), len(_STRIDES))
    count = len(words) - width + 1
    total = np.full(count, width, np.uint64)
    for k in range(width):
        total += words[k : k + count] * np.uint64(_STRIDES[k])
    total = mix(total)
    return np.unique(total)


def components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(node, component): the least node that is connected with each node of the edges.

    Every round points each node to its least neighbour, takes the pointer of the pointer, and
    renames the ends of the edges; edges inside a component vanish, so nodes at least halve.
    A round is two aggregations and joins on node ids; only one flag reaches the driver.
    """
    work = stored(edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v").distinct(), "edges")
    labels = stored(work.select(F.col("u").alias("node")).union(work.select("v")).distinct().withColumn("component", F.col("node")), "labels")
    while not work.isEmpty():
        both = work.union(work.select("v", "u"))
        parent = both.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("low")).select("at", F.least("at", "low").alias("up"))
        parent = stored(parent, "parents")
        upper = parent.select(F.col("at").alias("up"), F.col("up").alias("top"))
        parent = stored(parent.join(upper, "up", "left").select("at", F.coalesce("top", "up").alias("to")), "parents")
        first, second = parent.toDF("u", "u2"), parent.toDF("v", "v2")
        work = stored(work.join(first, "u").join(second, "v").where("u2 <> v2").select(F.col("u2").alias("u"), F.col("v2").alias("v")).distinct(), "edges")
        renamed = parent.toDF("component", "renamed")
        labels = stored(labels.join(renamed, "component", "left").select("node", F.coalesce("renamed", "component").alias("component")), "labels")
    return labels


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
