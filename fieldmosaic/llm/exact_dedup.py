"""Exact duplicates by content-defined chunk recipes. Built-in functions only.

A text becomes its normalised form, the form a list of chunks whose borders depend on nearby
characters only, and the list a recipe of 64-bit chunk identifiers. Recipes, not texts, are
grouped. A long text crosses the network never, apart from chunks that occur more than once,
which are moved one time to verify that an identifier stands for one content.

Borders: the text is cut into units, each up to the next place where a border may be; the hash of a
unit decides whether its end is one, and one that follows another too closely is none. Neither
looks at where earlier cuts were made, so after an edit the borders are the old ones again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldmosaic.llm.common import documents, stored
from fieldmosaic.llm.registry import query

BLANKS = "[\\x20\\x09-\\x0D]+"
#: After what a border may be: some letters before a blank, and wide punctuation marks.
PLACES = ("d ", "l ", "m ", "y ", ". ", "、", "。", "，")
ONE_IN = 16  # so many of these places are borders
LEAST, MOST = 128, 4096  # characters between two borders, and of a chunk
SALTS = 16  # tasks over which the contents of one identifier are spread before they are combined


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def chunks(norm: Column, least: int = LEAST, most: int = MOST, one_in: int = ONE_IN) -> Column:
    """The chunks in order; joined they are the text, an empty text has none.

    A chunk begins at a border and runs to the next one; where that is more than `most` characters
    away, it is cut every `most` characters from its beginning. Borders are marked by line feeds,
    which a normalised text has none of.
    """
    for place in PLACES:
        norm = F.replace(norm, F.lit(place), F.lit(f"{place}\n"))
    units = F.transform(F.split(norm, "\n"), lambda u: F.when(F.pmod(F.xxhash64(u), F.lit(one_in)) == 0, F.concat(u, F.lit("\n"))).otherwise(u))
    marked = F.array_join(units, "")
    apart = F.regexp_replace(marked, f"\n(?<=\n[^\n]{{0,{least - 1}}}\n)", "") if least > 1 else marked
    return F.regexp_extract_all(apart, F.lit(f"[^\\n]{{1,{most}}}"), F.lit(0))


def identifier(chunk: Column, bits: int = 64) -> Column:
    """The identifier of a chunk before it is verified; fewer bits provoke collisions in tests."""
    code = F.xxhash64(chunk)
    return code if bits >= 64 else code.bitwiseAND(F.lit((1 << bits) - 1))


def recipes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(id, recipe, text_sha256) per row, and the identifiers that stand for more than one content.

    Chunks seen once need no proof. The others are reduced to the least and greatest content per
    identifier, within each task first; where the two differ the identifier is ambiguous. A content
    that many texts share is dealt to SALTS tasks by the id of the text, and combined there.
    """
    norm = docs.select(F.col(doc_id).alias("id"), normalized(F.col(text)).alias("norm"))
    parts = F.transform(chunks(F.col("norm")), lambda c: identifier(c, bits))
    rows = stored(norm.select("id", parts.alias("recipe"), F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")), "recipes")
    seen = rows.select(F.explode("recipe").alias("code")).groupBy("code").agg(F.count("*").alias("n")).where("n > 1").select("code")
    salted = seen.select("code", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt")
    contents = norm.select(salt, F.explode(chunks(F.col("norm"))).alias("chunk")).withColumn("code", identifier(F.col("chunk"), bits))
    spans = contents.join(salted, ["code", "salt"], "left_semi").groupBy("code").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
    return rows, stored(spans.where("low <> high").select("code"), "ambiguous")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Equal texts are identical after every run of blanks has become one space; null counts as
    empty, and empty texts are equal to each other. The least id of a group stays; rows that
    repeat this id are all kept, and null ids come last (keep_id is null only if all are). Columns
    beside id and text are not read; a very long text is as many chunks as it needs.
    Rows whose recipe has an ambiguous identifier are compared by their SHA-256 as well.
    """
    rows, ambiguous = recipes(docs, doc_id, text, bits)
    proof = F.lit("")
    if not ambiguous.isEmpty():
        unclear = rows.select("recipe", F.explode("recipe").alias("code")).join(ambiguous, "code", "left_semi").select("recipe").distinct()
        rows = stored(rows.join(unclear.withColumn("unclear", F.lit(True)), "recipe", "left"), "unclear")
        proof = F.when(F.col("unclear"), F.col("text_sha256")).otherwise("")
    rows = rows.select("id", "recipe", "text_sha256", proof.alias("proof"))
    groups = rows.groupBy("recipe", "proof").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1")
    groups = stored(groups, "groups")
    found = rows.join(groups, ["recipe", "proof"], "left")
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return found.select("id", keep.alias("keep_id"), size.alias("group_size"), F.col("id").eqNullSafe(keep).alias("kept"), "text_sha256")


SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)"""


@query("op8_exact_dedup", SQL)
def op8_exact_dedup(spark, sf_dir):
    return exact_groups(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")
