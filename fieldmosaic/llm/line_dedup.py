"""Line dedup by winnowing over line hashes.

From every line on stands a window, the shortest run of lines that has `min_words` words, and
another one ends at it. The least line hash of a window is its fingerprint. Only windows whose
fingerprint occurs more than once are looked at further; those whose 128-bit digest occurred
earlier (by document id, then position) are deleted. That extends a match both ways: of a longer
repeated run every line goes, the first ones by the window at its start, each later one by the
window that ends there. Every step reduces to one row per fingerprint or digest before the
shuffle, so a line that a third of the documents hold is one row with a count, and no pairs of
occurrences exist at any time.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from fieldmosaic.llm.common import documents, row_key, stored
from fieldmosaic.llm.registry import query

MIN_WORDS = 50
_WINDOWS = "_key string, _id {kind}, print long, digest binary, first int, past int"


def line_windows(text: str, min_words: int) -> list[tuple[int, bytes, int, int]]:
    """(fingerprint, digest, first line, line after the last) of every window of the text."""
    lines = [line.strip() for line in text.encode("utf-8", "surrogatepass").split(b"\n")]
    full = [k for k, line in enumerate(lines) if line]  # blank lines are counted beside a window, so many of them cost no more
    sums = np.cumsum([0] + [len(lines[k].split()) for k in full])
    if sums[-1] < min_words:
        return []
    codes = [xxhash.xxh3_64_intdigest(line) for line in lines]

    def window(first: int, end: int) -> tuple[int, bytes]:
        part = codes[first:end]
        low = min(part)
        digest = xxhash.xxh3_128_digest(struct.pack(f"<{len(part)}Q", *part)) if len(part) > 1 else xxhash.xxh3_128_digest(lines[first])
        return low - (1 << 64) if low >> 63 else low, digest

    def widened(digest: bytes, before: int, after: int) -> bytes:
        return xxhash.xxh3_128_digest(digest + struct.pack("<2Q", before, after)) if before or after else digest

    known: dict[tuple[int, int], tuple[int, bytes]] = {}
    found = []
    ends = np.searchsorted(sums, sums[:-1] + min_words).tolist()
    for k, end in enumerate(ends):
        if end > len(full):
            break
        first, past = full[k], full[end - 1] + 1
        low, digest = known[first, past] = window(first, past)
        blank = first - (full[k - 1] + 1 if k else 0)
        found += [(low, widened(digest, n, 0), first - n, past) for n in range(blank + 1)]
    starts = (np.searchsorted(sums, sums[1:] - min_words, "right") - 1).tolist()
    for k, start in enumerate(starts):
        if start < 0:
            continue
        first, past = full[start], full[k] + 1
        same = known.get((first, past))
        low, digest = same or window(first, past)
        blank = (full[k + 1] if k + 1 < len(full) else len(lines)) - past
        found += [(low, widened(digest, 0, n), first, past + n) for n in range(1 if same else 0, blank + 1)]
    return found


def _windows_of(min_words: int):
    def run(batches):
        for batch in batches:
            rows = [(key, doc, *w) for key, doc, text in zip(batch["_key"], batch["_id"], batch["_text"]) for w in line_windows(text, min_words)]
            for at in range(0, len(rows), 50_000):
                yield pd.DataFrame(rows[at : at + 50_000], columns=["_key", "_id", "print", "digest", "first", "past"])

    return run


def repeated_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(_key, first, past) of every window that occurred earlier."""
    known = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text")).where("_text is not null")
    known = known.withColumn("_key", row_key(F.col("_id"), F.col("_text")))
    kind = known.schema["_id"].dataType.simpleString()
    found = stored(known.select("_key", "_id", "_text").mapInPandas(_windows_of(min_words), _WINDOWS.format(kind=kind)), "windows")
    often = found.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print")
    near = stored(found.join(often, "print", "left_semi").select("_key", "_id", "digest", "first", "past"), "candidates")
    place = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_key").alias("key"), F.col("first").alias("first"))
    origin = stored(near.groupBy("digest").agg(F.min(place).alias("origin"), F.count("*").alias("n")).where("n > 1").drop("n"), "origins")
    return near.join(origin, "digest").where(place > F.col("origin")).select("_key", "first", "past")


def _rebuild(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
    out = []
    for whole, cuts in zip(text, spans):
        if cuts is None or not len(cuts):
            out.append((whole, 0))
            continue
        lines = whole.split("\n")
        gone = np.zeros(len(lines) + 1, np.int64)
        for first, past in cuts:
            gone[first] += 1
            gone[past] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        out.append(("\n".join(line for line, cut in zip(lines, gone) if not cut), int(gone.sum())))
    return pd.DataFrame(out, columns=["text", "deleted"])


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of `docs` with all their columns as struct `row`, the remaining `text`, and `deleted`, the number of lines cut.

    Lines are split at newlines and compared without blanks at their ends; words are separated by
    ASCII blanks. A null text stays null; a text whose lines all go becomes empty. Rows that
    agree in id and text are one document and are treated alike. Runs below `min_words` words
    stay. Null ids come last in the order.
    """
    cuts = repeated_windows(docs, doc_id, text, min_words)
    cuts = cuts.distinct().groupBy("_key").agg(F.collect_list(F.array("first", "past")).alias("spans"))
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    keyed = rows.withColumn("_key", row_key(F.col("_id"), F.col("_text"))).drop("_id")
    rebuild = F.pandas_udf(_rebuild, "text string, deleted int")
    joined = keyed.join(cuts, "_key", "left")
    built = joined.withColumn("built", F.when(F.col("spans").isNotNull(), rebuild("_text", "spans")))
    return built.select("row", F.coalesce("built.text", "_text").alias("text"), F.coalesce("built.deleted", F.lit(0)).alias("deleted"))


SQL = r"""
WITH l AS (
  SELECT doc_id, i - 1 AS i, lines[i] AS raw, regexp_replace(lines[i], '^[\x09-\x0D\x20]+|[\x09-\x0D\x20]+$', '', 'g') AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL), unnest(range(1, len(lines) + 1)) AS u(i)),
w AS (SELECT *, CASE WHEN line = '' THEN 0 ELSE len(regexp_split_to_array(line, '[\x09-\x0D\x20]+')) END AS words FROM l),
p AS (SELECT a.doc_id AS earlier, b.doc_id, b.i, b.i - a.i AS shift, b.words FROM w a JOIN w b ON a.line = b.line AND (a.doc_id < b.doc_id OR (a.doc_id = b.doc_id AND a.i < b.i))),
q AS (SELECT *, i - row_number() OVER (PARTITION BY earlier, doc_id, shift ORDER BY i) AS run FROM p),
r AS (SELECT doc_id, min(i) AS first, max(i) AS last FROM q GROUP BY earlier, doc_id, shift, run HAVING sum(words) >= 50),
c AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS i FROM r),
g AS (SELECT w.doc_id, w.i, raw, c.i IS NOT NULL AS cut FROM w LEFT JOIN c ON w.doc_id = c.doc_id AND w.i = c.i)
SELECT doc_id, CAST(sum(cut::int) AS INT) AS deleted, sha256(coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (NOT cut), '')) AS text_sha256
FROM g GROUP BY doc_id
UNION ALL SELECT doc_id, 0, NULL FROM documents WHERE text IS NULL"""


@query("op6_line_dedup", SQL)
def op6_line_dedup(spark, sf_dir):
    done = dedup_lines(documents(spark, sf_dir))
    return done.select("row.doc_id", "deleted", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
