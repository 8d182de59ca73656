"""Ranked lexical search, term at a time with a limited set of accumulators.

Documents are reduced to postings of the terms that some item asks for, written once. Every task
turns its postings into lists by term and works off each item's terms from the rarest on. While the
summed bounds of the terms to come can still lift an unseen document to the k-th best partial score,
documents get new accumulators; from then on only those that have one are updated, exactly. A task
keeps the k best of an item over all its postings, whose last score starts the next lists' limit;
the k best of all tasks are the answer.

Items are worked off in blocks of `block_chars` characters: the driver and a worker hold the terms of
one block, and a block's postings and answers are written before the next one is collected.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fieldmosaic.llm.common import documents, stored
from fieldmosaic.llm.registry import query

TOP = 50
BLOCK_CHARS = 1 << 22
LIST_POSTINGS = 1 << 21  # a worker turns so many postings into lists at a time
LIST_DOCS = 1 << 16
_KEEP = set(b"0123456789abcdefghijklmnopqrstuvwxyz")
_TO_TERMS = bytes(b if b > 127 else (b + 32 if 65 <= b <= 90 else b if b in _KEEP else 32) for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, A to Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_TERMS).split()


def _postings(vocabulary: dict[bytes, int]):
    """Per document: its number of terms; the asked terms in it and how often each occurs, as 32-bit integers."""

    def run(batches):
        get = vocabulary.get
        for batch in batches:
            lengths, found = [], []
            for text in batch.column("_text"):
                words = terms_of(text.as_py())
                codes = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
                terms, often = np.unique(codes[codes >= 0], return_counts=True)
                lengths.append(len(words))
                found.append((terms.tobytes(), often.astype(np.int32).tobytes()))
            terms, often = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(lengths, pa.int64()), pa.array(terms, pa.binary()), pa.array(often, pa.binary())], ["_id", "n", "terms", "tf"])

    return run


def _frequencies(size: int):
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for terms in batch["terms"]:
                total[np.frombuffer(terms, np.int32)] += 1
        held = np.flatnonzero(total)
        yield pd.DataFrame({"term": held, "df": total[held]})

    return run


class Lists:
    """Postings by term of a number of documents, with the score part of every posting."""

    def __init__(self, ids: list, lengths: list[int], terms: list[bytes], often: list[bytes], weights: np.ndarray, size: int, total: int):
        self.ids = np.array(ids, dtype=object)
        sizes = np.array([len(t) // 4 for t in terms], np.int64)
        term = np.frombuffer(b"".join(terms), np.int32)
        tf = np.frombuffer(b"".join(often), np.int32).astype(np.int64)
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        m = 100 - 50 + (50 * np.array(lengths, np.int64) * size) // total
        part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        order = np.argsort(term, kind="stable")
        term, self.doc, self.part = term[order], doc[order], part[order]
        self.ends = np.searchsorted(term, np.arange(len(weights) + 1))

    def best(self, terms: list[int], top: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores), all that may be among the `top` best and score at least `floor`; rarest term first in `terms`."""
        lists = [(self.doc[a:b], self.part[a:b]) for a, b in ((self.ends[t], self.ends[t + 1]) for t in terms) if b > a]
        lists = [(d, p, int(p.max())) for d, p in lists]
        ahead = sum(bound for _, _, bound in lists)
        done, limit, at = 0, floor, 0
        scores = np.zeros(len(self.ids), np.int64)
        for docs, parts, bound in lists:
            if ahead <= done:  # the k-th partial score cannot exceed what is done
                limit = max(limit, _kth(scores[scores > 0], top))
            if ahead < limit:
                break
            scores[docs] += parts
            ahead, done, at = ahead - bound, done + bound, at + 1
        kept = np.flatnonzero(scores)
        scores = scores[kept]
        for docs, parts, bound in lists[at:]:
            limit = max(limit, _kth(scores, top))
            alive = scores + ahead >= limit
            kept, scores = kept[alive], scores[alive]
            spot = np.minimum(np.searchsorted(docs, kept), len(docs) - 1)
            hit = docs[spot] == kept
            scores[hit] += parts[spot[hit]]
            ahead -= bound
        limit = max(limit, _kth(scores, top), 1)
        alive = scores >= limit
        return kept[alive], scores[alive]


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def _search(items: list[tuple[int, list[int]]], weights: np.ndarray, size: int, total: int, top: int):
    def run(batches):
        best: dict[int, list[tuple]] = {no: [] for no, _ in items}

        def work(held: list[tuple]) -> None:
            ids, lengths, terms, often = zip(*held)
            lists = Lists(ids, lengths, terms, often, weights, size, total)
            for no, asked in items:
                mine = best[no]
                found, scores = lists.best(asked, top, -mine[-1][0] if len(mine) == top else 0)
                if len(found):
                    mine += [(-s, i is None, i) for s, i in zip(scores.tolist(), lists.ids[found])]
                    mine.sort()
                    del mine[top:]

        held, postings = [], 0
        kind = None
        for batch in batches:
            kind = batch.schema.field("_id").type
            for row in zip(*(batch.column(c).to_pylist() for c in ("_id", "n", "terms", "tf"))):
                held.append(row)
                postings += len(row[2]) // 4
                if postings >= LIST_POSTINGS or len(held) >= LIST_DOCS:
                    work(held)
                    held, postings = [], 0
        if held:
            work(held)
        rows = [(no, doc, -score) for no, mine in best.items() for score, _, doc in mine]
        for at in range(0, len(rows), 50_000):
            columns = zip(*rows[at : at + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), kind, pa.int64()))], ["no", "doc", "score"])

    return run


def _block(docs: DataFrame, block: list[tuple[str, object]], kinds: tuple[str, str], top: int) -> DataFrame:
    """(item, rank, doc, score) of the items of a block."""
    spark = docs.sparkSession
    asked = [sorted(set(terms_of(text))) for _, text in block]
    vocabulary = {term: k for k, term in enumerate(sorted({t for terms in asked for t in terms}))}
    lists = stored(docs.mapInArrow(_postings(vocabulary), f"_id {kinds[1]}, n long, terms binary, tf binary").where("n > 0"), "postings")
    size, total = lists.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    often = lists.select("terms").mapInPandas(_frequencies(len(vocabulary)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(len(vocabulary), np.int64)
    for row in often.collect():  # at most one row per term of the block
        df[row.term] = row.df
    weights = np.array([math.floor(1000 * math.log((2 * size + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    items = [(no, sorted((vocabulary[t] for t in terms if df[vocabulary[t]] and weights[vocabulary[t]]), key=lambda t: (df[t], t))) for no, terms in enumerate(asked)]
    found = lists.mapInArrow(_search(items, weights, size, total, top), f"no int, doc {kinds[1]}, score long")
    order = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(no, name) for no, (name, _) in enumerate(block)], f"no int, item {kinds[0]}")
    return ranked.join(names, "no").select("item", "rank", "doc", "score")


def search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    top: int = TOP, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(item, rank, doc, score): the `top` best documents with a score above 0 of every item, the best first.

    Every row of `docs` is a document of its own, so repeated rows take a rank each; equal scores go by
    ascending id, null ids last. Rows of `items` that agree in id and text are one item; two texts under one
    id are ranked each on its own. Null and empty texts have no terms: such documents do not count, such items
    find nothing, and an empty table gives no rows. A very long text is read whole by one task; only its
    distinct asked terms go on. Other columns are not looked at, whatever their names.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text")).where("_text <> ''")
    asked = items.select(F.col(item_id).alias("item"), F.col(item_text).cast("string").alias("body")).where("body <> ''").distinct()
    kinds = asked.schema["item"].dataType.simpleString(), rows.schema["_id"].dataType.simpleString()
    blocks = max(1, -(-(asked.agg(F.sum(F.length("body"))).first()[0] or 0) // block_chars))
    parts = []
    for k in range(blocks):
        block = [tuple(r) for r in asked.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == k).collect()]  # about block_chars characters
        parts.append(stored(_block(rows, block, kinds, top), "ranked"))
    return reduce(DataFrame.union, parts)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
i AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
  FROM benchmark),
a AS (SELECT CAST(count(*) FILTER (len(terms) > 0) AS BIGINT) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM d),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, a GROUP BY term),
s AS (SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // total))))) AS score
  FROM i JOIN p USING (term) JOIN w USING (term), a GROUP BY ALL),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM o WHERE rank <= 50"""


@query("op11_ranked_search", SQL)
def op11_ranked_search(spark, sf_dir):
    found = search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")
