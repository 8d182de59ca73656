"""Best-fit packing by exact complements.

Only the lengths matter, and there are at most `capacity` of them, so the plan is made on counts per
length. From the longest on, the gap a piece leaves is looked up among the single lengths, the sums
of two and the sums of three; a combination that fills it exactly is consumed as often as the counts
allow, all in one step. What has no complement is packed best fit, longest first, again in steps over equal
sequences. The plan is a list of ranges: the pieces of a length from rank r on go to sequences from s
on, at an offset. Pieces are ranked within their length along one range-partitioned order and look
up their range, so a length that a third of the pieces share is cut over partitions.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fieldmosaic.llm.byte_bpe import byte_bpe
from fieldmosaic.llm.common import documents, stored
from fieldmosaic.llm.registry import query
from fieldmosaic.operators.ranking import global_rank

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
CAPACITY = 2048
END = 0  # the id behind every document
ROWS_CHARS = 1 << 22  # characters whose pieces are handed over at a time


class Sums:
    """Which sums of two and of three lengths the counts allow; an index over all gaps, renewed when a length runs out."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.renew()

    def renew(self) -> None:
        self.one = self.counts > 0
        size = 1 << int(3 * len(self.counts)).bit_length()
        waves = np.fft.rfft(self.one, size)
        self.two = np.fft.irfft(waves**2, size)[: len(self.counts)] > 0.5
        self.three = np.fft.irfft(np.fft.rfft(self.two, size) * waves, size)[: len(self.counts)] > 0.5

    def pair(self, total: int, taken: Counter) -> tuple[int, ...] | None:
        """Two lengths with this sum, the longer one as long as possible, beside those taken."""
        if total < 2 or not self.two[total]:
            return None
        longer = np.arange(total - 1, (total - 1) // 2, -1)
        for a in longer[self.one[longer] & self.one[total - longer]].tolist():
            if self.allowed(taken + Counter((a, total - a))):
                return a, total - a
        return None

    def allowed(self, wanted: Counter) -> int:
        """How often this combination can be taken."""
        return min(int(self.counts[x]) // n for x, n in wanted.items())

    def filling(self, length: int) -> Counter | None:
        """The length and at most three others that make up the capacity."""
        gap, taken = len(self.counts) - 1 - length, Counter((length,))
        if gap == 0:
            return taken
        if self.one[gap] and self.allowed(taken + Counter((gap,))):
            return taken + Counter((gap,))
        found = self.pair(gap, taken)
        if found is None and gap > 2 and self.three[gap]:
            longest = np.arange(gap - 2, (gap - 1) // 3, -1)
            for a in longest[self.one[longest] & self.two[gap - longest]].tolist():
                rest = self.pair(gap - a, taken + Counter((a,)))
                if rest is not None:
                    found = a, *rest
                    break
        return None if found is None else taken + Counter(found)


class Plan:
    """Groups of equal sequences: (number of them, gap, parts (length, pieces a sequence, first rank))."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.next = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[tuple[int, list]]] = {}
        self._exact()
        self._best_fit()

    def _take(self, length: int, pieces: int) -> int:
        rank = int(self.next[length])
        self.next[length] += pieces
        self.left[length] -= pieces
        return rank

    def _put(self, number: int, gap: int, parts: list) -> None:
        if number:
            self.open.setdefault(gap, []).append((number, parts))

    def _exact(self) -> None:
        sums = Sums(self.left)
        for length in range(self.capacity, 0, -1):
            while self.left[length]:
                wanted = sums.filling(length)
                if wanted is None:
                    break
                number = sums.allowed(wanted)
                self._put(number, 0, [(x, n, self._take(x, number * n)) for x, n in sorted(wanted.items(), reverse=True)])
                if any(not self.left[x] for x in wanted):
                    sums.renew()

    def _best_fit(self) -> None:
        for length in range(self.capacity, 0, -1):
            while self.left[length]:
                gap = min((g for g, groups in self.open.items() if g >= length and groups), default=None)
                number, parts = self.open[gap].pop() if gap is not None else (int(self.left[length]), [])
                gap = self.capacity if gap is None else gap
                each = min(gap // length, int(self.left[length]))
                some = min(number, int(self.left[length]) // each)
                if parts:
                    self._put(number - some, gap, [(x, n, rank + some * n) for x, n, rank in parts])
                self._put(some, gap - each * length, [*parts, (length, each, self._take(length, some * each))])

    def ranges(self) -> list[tuple[int, int, int, int, int]]:
        """(length, first rank, pieces a sequence, first sequence, offset), by length and rank."""
        out, sequence = [], 0
        for groups in self.open.values():
            for number, parts in groups:
                offset = 0
                for length, each, rank in parts:
                    out.append((length, rank, each, sequence, offset))
                    offset += length * each
                sequence += number
        return sorted(out)


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Add `sequence_id` and `offset` to every row, in as few sequences as the method finds.

    Lengths must be 1 to `capacity`; a null or other length ends with an error. Rows of equal length are interchangeable, so
    ties and repeated rows need no order. An empty table stays empty. Columns named like the two new ones are replaced.
    """
    fixed = pieces.drop("sequence_id", "offset").withColumn("_at", F.monotonically_increasing_id())
    sizes = {row[0]: row[1] for row in pieces.groupBy(length).agg(F.count("*")).collect()}  # one row per length
    if any(size is None or not 1 <= size <= capacity for size in sizes):
        raise ValueError(f"lengths must be 1 to {capacity}")
    ranges = Plan(sizes, capacity).ranges()
    before, total = {}, 0
    for size in sorted(sizes):
        before[size], total = total, total + sizes[size]
    begins = np.array([before[size] + rank for size, rank, *_ in ranges], np.int64)
    table = np.array(ranges, np.int64).reshape(-1, 5)

    @F.pandas_udf("sequence_id long, offset long")
    def place(at: pd.Series) -> pd.DataFrame:
        spot = np.searchsorted(begins, at.to_numpy(), "right") - 1
        size, _, each, sequence, offset = table[spot].T
        inside = at.to_numpy() - begins[spot]
        return pd.DataFrame({"sequence_id": sequence + inside // each, "offset": offset + inside % each * size})

    ranked = global_rank(fixed, [F.col(length), F.col("_at")], "_rank").withColumn("_place", place(F.col("_rank") - 1))
    return ranked.select("*", "_place.sequence_id", "_place.offset").drop("_place", "_rank", "_at")


def _cut(definition: str, capacity: int):
    def run(batches):
        model = byte_bpe(definition)
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            rows, owners, chars = [], [], 0

            def handed():
                columns = list(zip(*rows))
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
                return pa.RecordBatch.from_arrays([batch.column("_id").take(pa.array(owners, pa.int32())), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["id", "piece", "start", "length", "ids"])

            for k, ids in enumerate(model.encode(texts)):
                ids = np.append(ids, END).astype("<u4")
                first = len(ids) - capacity * ((len(ids) - 1) // capacity)
                for piece, past in enumerate(range(first, len(ids) + 1, capacity)):
                    start = 0 if piece == 0 else past - capacity
                    rows.append((piece, start, past - start, ids[start:past].tobytes()))
                    owners.append(k)
                chars += len(texts[k])
                if chars >= ROWS_CHARS:
                    yield handed()
                    rows, owners, chars = [], [], 0
            if rows:
                yield handed()

    return run


def token_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """id, piece, start, length, ids (little-endian 32-bit) of the pieces of every row of `docs`.

    A document is its token ids and one id 0. What is longer than `capacity` is cut from the end, so
    that only the first piece may be shorter. Null and empty texts are the id 0 alone; repeated rows give
    repeated pieces; long texts are encoded in slices by one task. Other columns are not looked at.
    """
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()  # sent along with the tasks, so workers need no file
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(_cut(definition, capacity), f"id {kind}, piece int, start long, length long, ids binary")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the whole sequences out of packed pieces with their ids; a group is one sequence, so it is never larger than the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda done, part: F.concat(done, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


@query("op13_packing")
def op13_packing(spark, sf_dir):
    pieces = token_pieces(documents(spark, sf_dir)).select(F.col("id").alias("doc_id"), "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(stored(pieces, "pieces"))
