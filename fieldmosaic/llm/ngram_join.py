"""N-gram Jaccard join with Bayesian pruning of candidates.

Texts become sets of word 5-grams; two texts are linked if their Jaccard similarity reaches
0.8. Equal sets collapse to one representative first. MinHash bands nominate candidates: with
3 hashes in each of 24 bands a pair at the threshold escapes all of them once in 3e7. In a
bucket, MinHash values are compared a few at a time, and a pair is dropped as soon as the
posterior probability that its similarity reaches the threshold falls below TOLERANCE. Buckets
report only the edges that span what is left, never its pairs; inside the components of
these edges the surviving pairs are verified on whole sets, block by block, and each task reports
a count of links per text and spanning edges of the verified graph.

A bucket or component of any size is dealt out as pairs of blocks of bounded size, so no task
holds a whole group. Groups of one are dropped before signatures are moved.
"""

from __future__ import annotations

from functools import lru_cache
from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from fieldmosaic.llm.common import components, documents, identified, mix, shingles, stored, word_hashes
from fieldmosaic.llm.registry import query

SIZE, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 3
TOLERANCE = 1e-9
STEP = 12  # MinHash values compared between two looks at the posterior
BLOCK = 1024  # texts in a block of a bucket
SMALL = 64  # groups up to this size are compared together with others of their size
VERIFY_BLOCK, VERIFY_BYTES = 512, 4 << 20  # texts and bytes of sets in a block of a component


def _seeds(count: int) -> tuple[np.ndarray, np.ndarray]:
    base = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return base[:count] | np.uint64(1), base[count:]


def signature(grams: np.ndarray, count: int = BANDS * ROWS) -> np.ndarray:
    """The high halves of `count` MinHash values; all ones for an empty set."""
    factor, shift = _seeds(count)
    low = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 4096):
        np.minimum(low, (grams[at : at + 4096, None] * factor + shift).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


@lru_cache(64)
def least_agreement(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, count: int = BANDS * ROWS, step: int = STEP) -> tuple[tuple[int, int], ...]:
    """(values compared, least number of equal ones that keeps a pair) at each look.

    With an even prior, m equal values of n give a Beta(m + 1, n - m + 1) posterior; the pair is
    kept while P(similarity >= threshold) reaches the tolerance.
    """
    grid = (np.arange(20_000) + 0.5) / 20_000
    looks = []
    for n in range(step, count + 1, step):
        for m in range(n + 1):
            log = lgamma(n + 2) - lgamma(m + 1) - lgamma(n - m + 1) + m * np.log(grid) + (n - m) * np.log1p(-grid)
            if np.exp(log)[grid >= threshold].sum() / 20_000 >= tolerance:
                looks.append((n, m))
                break
    return tuple(looks)


def surviving(left: np.ndarray, right: np.ndarray, looks) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two stacks of signatures that no look drops."""
    found_i, found_j = [], []
    for at in range(0, len(left), 256):
        part = left[at : at + 256]
        n, need = looks[0]
        equal = np.zeros((len(part), len(right)), np.int16)
        for k in range(n):
            equal += part[:, k, None] == right[None, :, k]
        i, j = np.nonzero(equal >= need)
        hits, done = equal[i, j].astype(np.int32), n
        for n, need in looks[1:]:
            for lo in range(0, len(i), 100_000):
                cut = slice(lo, lo + 100_000)
                hits[cut] += (part[i[cut], done:n] == right[j[cut], done:n]).sum(axis=1)
            keep = hits >= need
            i, j, hits, done = i[keep], j[keep], hits[keep], n
        found_i.append(i + at)
        found_j.append(j)
    return np.concatenate(found_i), np.concatenate(found_j)


def spanning(count: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Edges (least member, member) that connect what the pairs connect."""
    label = np.arange(count)
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            break
        label = low
    other = np.flatnonzero(label != np.arange(count))
    return list(zip(label[other].tolist(), other.tolist()))


def _sketches(batches):
    for batch in batches:
        out = []
        for key, doc, text in zip(batch["_key"], batch["_id"], batch["_text"]):
            grams = shingles(word_hashes(text), SIZE)
            first, second = (np.bitwise_xor.reduce(mix(grams + np.uint64(s))) if len(grams) else np.uint64(s) for s in (11, 23))
            out.append((key, doc, f"{int(first):016x}{int(second):016x}{len(grams):x}", len(grams), signature(grams).tobytes()))
        yield pd.DataFrame(out, columns=["_key", "_id", "rep", "grams", "sig"])


def _bands(batches):
    for batch in batches:
        rows = []
        for rep, sig in zip(batch["rep"], batch["sig"]):
            values = np.frombuffer(sig, np.uint32).reshape(BANDS, ROWS).astype(np.uint64)
            codes = np.full(BANDS, 0, np.uint64)
            for k in range(ROWS):
                codes = mix(codes + values[:, k] + np.uint64(1))
            codes = mix(codes ^ np.arange(BANDS, dtype=np.uint64) << np.uint64(58)).view(np.int64)
            rows.extend((code, rep) for code in codes.tolist())
        yield pd.DataFrame(rows, columns=["bucket", "rep"])


def _block_pairs(groups: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Members once per pair of blocks they take part in; columns `lo`, `hi` name the pair, `mine` the own block."""
    placed = members.join(groups, key).withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    return paired.withColumns({"lo": F.least("mine", "other"), "hi": F.greatest("mine", "other")}).drop("other", "blocks")


def _halves(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, bool]:
    """Positions of the two blocks in the group, and whether they are one block."""
    own = group["mine"].to_numpy()
    lo, hi = int(group["lo"].iloc[0]), int(group["hi"].iloc[0])
    left = np.flatnonzero(own == lo)
    return left, left if lo == hi else np.flatnonzero(own == hi), lo == hi


def _agreeing(sigs: np.ndarray, i: np.ndarray, j: np.ndarray, looks) -> tuple[np.ndarray, np.ndarray]:
    """Those of the given index pairs that no look drops."""
    kept, done, hits = np.arange(len(i)), 0, np.zeros(len(i), np.int32)
    for n, need in looks:
        for at in range(0, len(kept), 100_000):
            cut = kept[at : at + 100_000]
            hits[cut] += (sigs[i[cut], done:n] == sigs[j[cut], done:n]).sum(axis=1)
        kept, done = kept[hits[kept] >= need], n
    return i[kept], j[kept]


def _prune_groups(frame: pd.DataFrame) -> pd.DataFrame:
    """Spanning edges of many whole groups that lie one after the other; small groups of a size go together."""
    looks = least_agreement()
    sigs = np.frombuffer(b"".join(frame["sig"]), np.uint32).reshape(len(frame), -1)
    mine = frame["mine"].to_numpy()
    starts, sizes = _runs(frame)
    found = []
    for size in np.unique(sizes):
        at = starts[sizes == size]
        if size <= SMALL:
            i, j = np.triu_indices(size, 1)
            i, j = (at[:, None] + i).ravel(), (at[:, None] + j).ravel()
            across = (frame["lo"].to_numpy()[i] == frame["hi"].to_numpy()[i]) | (mine[i] != mine[j])
            found.append(_agreeing(sigs, i[across], j[across], looks))
            continue
        for start in at.tolist():
            left, right, same = _halves(frame.iloc[start : start + size])
            if len(left) and len(right):
                i, j = surviving(sigs[start + left], sigs[start + right], looks)
                i, j = start + left[i], start + right[j]
                keep = i < j if same else np.ones(len(i), bool)
                edges = spanning(size, i[keep] - start, j[keep] - start)
                found.append((np.array([u + start for u, _ in edges], int), np.array([v + start for _, v in edges], int)))
    i, j = (np.concatenate([f[k] for f in found]) if found else np.empty(0, int) for k in (0, 1))
    reps = frame["rep"].to_numpy()
    edges = np.array(spanning(len(frame), i, j), int).reshape(-1, 2)
    return pd.DataFrame({"u": reps[edges[:, 0]], "v": reps[edges[:, 1]]})


def _runs(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of rows with one bucket and pair of blocks."""
    keys = frame[["bucket", "lo", "hi"]].to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
    return starts, np.diff(np.append(starts, len(frame)))


def _prune(batches):
    """Groups come sorted; the last one of a batch may go on in the next."""
    rest = None
    for batch in batches:
        frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(frame):
            continue
        last = int(_runs(frame)[0][-1])
        rest = frame.iloc[last:].reset_index(drop=True)
        if last:
            yield _prune_groups(frame.iloc[:last].reset_index(drop=True))
    if rest is not None:
        yield _prune_groups(rest)


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between two lists of sets, by products of incidence slices."""
    cols = np.concatenate([*left, *right])
    rows = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in [*left, *right]])
    order = np.argsort(cols, kind="stable")
    cols, rows = cols[order], rows[order]
    ids = np.cumsum(np.concatenate([[0], cols[1:] != cols[:-1]])) if len(cols) else cols
    total = np.zeros((len(left), len(right)), np.float32)
    width = 2048
    for at in range(0, int(ids[-1]) + 1 if len(cols) else 0, width):
        lo, hi = np.searchsorted(ids, [at, at + width])
        dense = np.zeros((len(left) + len(right), width), np.float32)
        dense[rows[lo:hi], ids[lo:hi] - at] = 1
        total += dense[: len(left)] @ dense[len(left) :].T
    return total


def _verify(group: pd.DataFrame) -> pd.DataFrame:
    looks = least_agreement()
    group = group.sort_values("rep", ignore_index=True)
    sigs = np.stack([np.frombuffer(s, np.uint32) for s in group["sig"]])
    sets = [np.frombuffer(g, np.uint64) for g in group["set"]]
    sizes, weights = np.array([len(x) for x in sets]), group["copies"].to_numpy()
    left, right, same = _halves(group)
    links, pairs_i, pairs_j = np.zeros(len(group), np.int64), [], []
    if len(left) and len(right):
        i, j = surviving(sigs[left], sigs[right], looks)
        keep = i < j if same else np.ones(len(i), bool)
        alive = np.zeros((len(left), len(right)), bool)
        alive[i[keep], j[keep]] = True
        busy_l, busy_r = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if len(busy_l):
            shared = _overlaps([sets[left[k]] for k in busy_l], [sets[right[k]] for k in busy_r])
            union = sizes[left[busy_l], None] + sizes[right[busy_r]][None, :] - shared
            i, j = np.nonzero((shared >= THRESHOLD * union - 1e-6) & alive[np.ix_(busy_l, busy_r)])
            i, j = left[busy_l[i]], right[busy_r[j]]
            np.add.at(links, i, weights[j])
            np.add.at(links, j, weights[i])
            pairs_i, pairs_j = i, j
    low = np.arange(len(group))
    for u, v in spanning(len(group), np.asarray(pairs_i, int), np.asarray(pairs_j, int)):
        low[v] = u
    reps = group["rep"].to_numpy()
    out = pd.DataFrame({"rep": reps, "low": reps[low], "links": links})
    return out[(links > 0)]


def _sets(batches):
    for batch in batches:
        yield pd.DataFrame({"rep": batch["rep"], "set": [shingles(word_hashes(t), SIZE).tobytes() for t in batch["_text"]]})


def similar_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`similar_classes` without keys: id, class_id, class_size, n_links."""
    return similar_classes(docs, doc_id, text).drop("_key", "class")


def similar_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: _key, id, class (its name), class_id, class_size, n_links.

    The class is the connected component of the links, named by its least id; its size counts
    rows; n_links is the number of other rows at similarity 0.8 or more, copies included. A text
    below five words is one n-gram, so it is linked to equal word lists only; texts without a
    word (null, empty, blank) form one class of equal texts. Rows with equal id and text each
    get a row; null ids are allowed, and name a class only if no id is known.
    """
    rows = identified(docs, doc_id, text)
    sketch = stored(rows.mapInPandas(_sketches, f"_key string, _id {rows.schema['_id'].dataType.simpleString()}, rep string, grams int, sig binary"), "sketches")
    reps = stored(
        sketch.groupBy("rep").agg(F.count("*").alias("copies"), F.min("_key").alias("home"), F.min("_id").alias("least"), F.max("grams").alias("grams"), F.max("sig").alias("sig")), "reps"
    )
    worded = reps.where("grams > 0")
    banded = stored(worded.select("rep", "sig").mapInPandas(_bands, "bucket long, rep string"), "bands")
    crowded = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    crowded = stored(crowded, "buckets")
    members = banded.join(crowded, "bucket", "left_semi")
    members = stored(_block_pairs(crowded, members, "bucket"), "members").join(worded.select("rep", "sig"), "rep")
    dealt = members.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
    hopeful = stored(dealt.mapInPandas(_prune, "u string, v string").distinct(), "hopeful")
    near = components(hopeful).toDF("rep", "pool")

    pooled = stored(near.join(worded.select("rep", "sig", "home", "copies"), "rep"), "pooled")
    texts = rows.join(pooled.select(F.col("home").alias("_key"), "rep"), "_key").select("rep", "_text").dropDuplicates(["rep"])
    sets = stored(texts.mapInPandas(_sets, "rep string, set binary"), "sets")
    full = pooled.select("rep", "pool", "sig", "copies").join(sets, "rep")
    pools = full.groupBy("pool").agg(F.greatest(F.ceil(F.count("*") / VERIFY_BLOCK), F.ceil(F.sum(F.length("set")) / VERIFY_BYTES)).cast("int").alias("blocks"))
    checked = _block_pairs(stored(pools, "pools"), full, "pool").groupBy("pool", "lo", "hi").applyInPandas(_verify, "rep string, low string, links long")
    checked = stored(checked, "links")
    classes = components(checked.select("rep", "low"), "rep", "low").toDF("rep", "class")
    counts = checked.groupBy("rep").agg(F.sum("links").alias("links"))
    named = reps.select("rep", "copies", "least").join(classes, "rep", "left").join(counts, "rep", "left").withColumn("class", F.coalesce("class", "rep"))
    named = stored(named, "named")
    heads = named.groupBy("class").agg(F.min("least").alias("class_id"), F.sum("copies").alias("class_size"))
    wide = stored(named.join(heads, "class").select("rep", "class", "class_id", "class_size", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")
    return sketch.select("_key", F.col("_id").alias("id"), "rep").join(wide, "rep").drop("rep")


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS words FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN ['']
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS grams FROM w),
g AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
p AS (SELECT a.doc_id AS u, b.doc_id AS v FROM g a JOIN g b USING (gram) WHERE a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-6),
r AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, p.v FROM r JOIN p ON r.v = p.u),
c AS (SELECT u AS doc_id, min(v) AS class_id, count(*) AS class_size FROM r GROUP BY u)
SELECT doc_id, class_id, CAST(class_size AS BIGINT) AS class_size, (SELECT count(*) FROM p WHERE p.u = c.doc_id) AS n_links FROM c"""


@query("op10_ngram_jaccard_join", SQL)
def op10_ngram_jaccard_join(spark, sf_dir):
    return similar_texts(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")
