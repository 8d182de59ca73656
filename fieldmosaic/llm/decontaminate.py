"""Benchmark decontamination by greedy string tiling.

A document is compared with every test item it shares a seed with, five equal words in a
row. The longest runs of equal words that are not marked yet are found with running Karp-Rabin
hashes and marked in both texts, then the next longest, until no run has five words; the share of
the item's words that are marked is its coverage. Since tiles are placed freely, passages count
in whatever order they stand.

The test items are the query set. They go to the tasks in blocks of bounded size, one scan of the
documents per block; documents are not shuffled, and all work on one of them is local to a row. What a
block finds is written before the next block is read, so the driver holds one block at a time.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from fieldmosaic.llm.common import documents, identified, stored, window_codes, word_hashes
from fieldmosaic.llm.registry import query

MIN_TILE = 5
COVERAGE = 0.6
BLOCK_CHARS = 16 << 20  # characters of test items that tasks hold at a time
WORD = re.compile(r"[^\W_]+")
TILES = "array<struct<item_start:int,doc_start:long,words:int>>"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def tile(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in item, start in doc, length); word ids are from 0 on, -1 matches nothing."""
    item, doc = item.copy(), doc.copy()
    tiles, most = [], min(len(item), len(doc))

    def windows(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        free = np.concatenate([[0], np.cumsum(ids < 0)])
        at = np.flatnonzero(free[size:] == free[:-size]) if len(ids) >= size else np.empty(0, int)
        return at, window_codes(ids, size)[at]

    while most >= least:
        low, high = least - 1, most
        while low < high:
            size = (low + high + 1) // 2
            if np.isin(windows(item, size)[1], windows(doc, size)[1]).any():
                low = size
            else:
                high = size - 1
        if low < least:
            break
        most = low
        at_i, codes_i = windows(item, most)
        at_d, codes_d = windows(doc, most)
        order = np.argsort(codes_d, kind="stable")
        codes_d, at_d = codes_d[order], at_d[order]
        placed = False
        for i, code in zip(at_i.tolist(), codes_i):
            if (item[i : i + most] < 0).any():
                continue
            for k in range(np.searchsorted(codes_d, code), np.searchsorted(codes_d, code, "right")):
                d = int(at_d[k])
                if (item[i : i + most] == doc[d : d + most]).all():
                    item[i : i + most] = -1
                    doc[d : d + most] = -1
                    tiles.append((i, d, most))
                    placed = True
                    break
        if not placed:
            most -= 1
    return sorted(tiles)


class Items:
    """A block of test items with its seeds, as arrays."""

    def __init__(self, rows: list[tuple], least: int):
        self.names, self.least = [r[0] for r in rows], least
        texts = [words_of(r[1] or "") for r in rows]
        self.vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
        self.ids = [np.array([self.vocabulary[w] for w in t], np.int64) for t in texts]
        seeds: dict[int, list[np.ndarray]] = {}
        for n, ids in enumerate(self.ids):
            if len(ids):
                size = min(least, len(ids))
                codes = window_codes(ids, size)
                seeds.setdefault(size, []).append(np.stack([codes, np.full(len(codes), n, np.uint64), np.arange(len(codes), dtype=np.uint64)]))
        self.seeds = {}
        for size, parts in seeds.items():
            table = np.concatenate(parts, axis=1)
            self.seeds[size] = table[:, np.argsort(table[0], kind="stable")]

        self.filters = {}
        for ids, text in zip(self.ids, (r[1] or "" for r in rows)):
            if len(ids):
                size = min(least, len(ids))
                self.filters.setdefault(size, []).append(window_codes(word_hashes(text), size))
        self.filters = {size: np.unique(np.concatenate(codes)) for size, codes in self.filters.items()}

    def may_match(self, text: str) -> bool:
        """Whether the text has a seed, by hashes of words alone; most documents end here."""
        words = word_hashes(text)
        for size, codes in self.filters.items():
            mine = window_codes(words, size)
            if (codes[np.minimum(np.searchsorted(codes, mine), len(codes) - 1)] == mine).any():
                return True
        return False

    def hits(self, ids: np.ndarray) -> dict[int, list[tuple[np.ndarray, np.ndarray, int]]]:
        """Per item: (positions in the document, positions in the item, window size) of shared seeds."""
        out: dict[int, list] = {}
        unknown = np.concatenate([[0], np.cumsum(ids < 0)])
        for size, (codes, item, place) in self.seeds.items():
            if len(ids) < size:
                continue
            at = np.flatnonzero(unknown[size:] == unknown[:-size])
            mine = window_codes(ids, size)[at]
            lo, hi = np.searchsorted(codes, mine), np.searchsorted(codes, mine, "right")
            found = hi > lo
            if not found.any():
                continue
            at, lo, n = at[found], lo[found], (hi - lo)[found]
            rows = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            owner, where, at = item[rows], place[rows], np.repeat(at, n)
            order = np.argsort(owner, kind="stable")
            owner, where, at = owner[order], where[order], at[order]
            cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]]))
            for a, b in zip(cuts, cuts[1:]):
                out.setdefault(int(owner[a]), []).append((at[a:b], where[a:b].astype(np.int64), size))
        return out

    def matches(self, text: str, coverage: float):
        if not self.may_match(text):
            return
        get = self.vocabulary.get
        ids = np.array([get(w, -1) for w in words_of(text)], np.int64)
        for n, seeds in self.hits(ids).items():
            item = self.ids[n]
            reach = np.zeros(len(item), bool)
            near = np.zeros(len(ids) + 1, np.int64)
            for at, where, size in seeds:
                for k in range(size):
                    reach[where + k] = True
                near[: len(ids)] += np.bincount(at, minlength=len(ids)) - np.bincount(np.minimum(at + size, len(ids)), minlength=len(ids) + 1)[: len(ids)]
            if reach.mean() < coverage:
                continue
            kept = np.flatnonzero(np.cumsum(near)[: len(ids)] > 0)
            gaps = np.flatnonzero(np.diff(kept) > 1) + 1
            places = np.insert(kept, gaps, -1)
            tiles = tile(item, np.where(places < 0, -1, ids[places]), min(self.least, len(item)))
            marked = sum(t[2] for t in tiles)
            if marked >= coverage * len(item):
                yield self.names[n], len(item), marked, [(i, int(places[d]), size) for i, d, size in tiles]


def _scan(rows: list[tuple], coverage: float, least: int):
    def run(batches):
        items = Items(rows, least)
        for batch in batches:
            out = [
                (key, doc, name, words, marked, tiles)
                for key, doc, text in zip(batch["_key"], batch["_id"], batch["_text"])
                for name, words, marked, tiles in items.matches(text, coverage)
            ]
            yield pd.DataFrame(out, columns=["_key", "_id", "item", "item_words", "matched", "tiles"])

    return run


def contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    coverage: float = COVERAGE, least: int = MIN_TILE, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document and test item with enough coverage: _key, id, item, item_words, matched, coverage, tiles.

    Words are lower-cased runs of letters and digits. An item below five words must stand in the
    document as a whole; items and documents without words match nothing. Null texts count as
    empty, repeated rows are judged one by one. Among equally long tiles the first in the item, then in the
    document, is marked. Other columns are not read, so their names cannot clash. An empty benchmark finds
    nothing. A very long text is tiled within one task, on the places near its seeds only. `_key` is `row_key` of id and text.
    """
    rows = identified(docs, doc_id, text)
    items = benchmark.select(F.col(item_id).alias("name"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("body")).where("body <> ''")
    chars = items.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    kinds = [d.schema[c].dataType.simpleString() for d, c in ((rows, "_id"), (items, "name"))]
    schema = f"_key string, _id {kinds[0]}, item {kinds[1]}, item_words int, matched int, tiles {TILES}"
    parts = []
    for k in range(blocks):
        block = [tuple(r) for r in items.where(F.pmod(F.xxhash64("name", "body"), F.lit(blocks)) == k).collect()]  # about block_chars characters
        parts.append(stored(rows.mapInPandas(_scan(block, coverage, least), schema), "tiles"))
    found = reduce(DataFrame.union, parts)
    return found.select("_key", F.col("_id").alias("id"), "item", "item_words", "matched", (F.col("matched") / F.col("item_words")).alias("coverage"), "tiles")


@query("op7_decontamination")
def op7_decontamination(spark, sf_dir):
    found = contaminated(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "item_words", "matched", F.round("coverage", 6).alias("coverage"), F.size("tiles").alias("tiles"))
