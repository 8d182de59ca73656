"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

Each text becomes a row of statistics in one pass; texts are not moved. Random Fourier features
of the standardised statistics approximate a Gaussian kernel. Each task sums its part of the
normal equations, the parts are added by Spark, and the driver solves one system of fixed size.
The ridge scores are calibrated by isotonic regression on labelled rows that the fit has not seen,
binned to a fixed number of bins.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from fieldmosaic.llm.common import documents, held_out, identified, stored
from fieldmosaic.llm.registry import query

FEATURES = 256  # random Fourier features
RIDGE = 1e-3  # per labelled row
BINS = 1000
CUT = 0.3
STATISTICS = 22
_CLASSES = {name: re.compile(rx) for name, rx in {"upper": r"[A-Z]", "digit": r"[0-9]", "mark": r"[!&%$#*|<>{}\[\]=_~^@\\]", "stop": r"[.?;:,]", "wide": r"[^\x00-\x7f]"}.items()}


def statistics(text: str) -> list[float]:
    """Numbers that do not depend on the language of a text or on what it is about."""
    words, lines = text.split(), text.split("\n")
    if not words:
        return [0.0] * STATISTICS
    n, chars = len(words), len(text)
    counts, line_counts = Counter(words), Counter(lines)
    ends = [w[-1] for w in words]
    counted = [len(rx.findall(text)) / chars for rx in _CLASSES.values()]
    lengths = np.fromiter(map(len, words), np.float64, n)
    top = counts.most_common(3)
    pairs = Counter(zip(words, words[1:]))
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    letters = [w for w in words if w[0].isalpha()]
    return [
        np.log1p(n), np.log1p(len(lines)), np.log1p(chars / len(lines)), lengths.mean(), lengths.std(), np.log1p(lengths.max()), *counted,
        len(counts) / n, top[0][1] / n, sum(c for _, c in top) / n, 1 - len(line_counts) / len(lines), max(line_counts.values()) / len(lines),
        len(pairs) / max(1, n - 1), repeats / n, sum(w.isupper() and len(w) > 1 for w in words) / n,
        sum(not (c.isalnum() or c in ".,;:?'\"") for c in ends) / n, sum(c in ".?!" for c in ends) / n, len(letters) / n,
    ]


def _statistics_of(batches):
    for batch in batches:
        yield pd.DataFrame({"_key": batch["_key"], "_id": batch["_id"], "x": [statistics(t) for t in batch["_text"]]})


class Fourier:
    """cos(xW + b) of standardised rows; the frequencies follow from the seed."""

    def __init__(self, mean, scale, features: int = FEATURES, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.asarray(mean), np.asarray(scale)
        self.w = rng.normal(size=(len(self.mean), features)) / np.sqrt(len(self.mean))
        self.b = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.cos(z @ self.w + self.b) * np.sqrt(2 / len(self.b)), np.ones((len(x), 1))])


def _sums(fourier: Fourier):
    """Per task: the rows of Z'Z with Z'y as last entry."""

    def run(batches):
        size = len(fourier.b) + 1
        total = np.zeros((size, size + 1))
        for batch in batches:
            if len(batch):
                z = fourier(np.stack(batch["x"]))
                total += z.T @ np.hstack([z, batch["y"].to_numpy(float)[:, None]])
        yield pd.DataFrame({"i": np.repeat(np.arange(size), size + 1), "j": np.tile(np.arange(size + 1), size), "v": total.ravel()})

    return run


def isotonic(scores: np.ndarray, hits: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing step values of a least-squares fit, as (score, value) knots (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for score, hit, weight in zip(scores, hits, weights):
        blocks.append([score * weight, hit, weight])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    table = np.array(blocks).reshape(-1, 3)
    return table[:, 0] / table[:, 2], (table[:, 1] + 0.5 * table[:, 1] / table[:, 2]) / (table[:, 2] + 0.5)


def fit(rows: DataFrame, features: int = FEATURES, ridge: float = RIDGE):
    """A function from statistics to scores, learned from (x, y, fold); constant if a class is missing."""
    learn = rows.where("fold > 0")
    moments = learn.select("y", F.posexplode("x")).groupBy("pos").agg(F.avg("col").alias("m"), F.stddev_pop("col").alias("s"), F.avg("y").alias("p")).orderBy("pos").collect()
    prior = moments[0].p if moments else 0.5
    if prior in (0, 1) or not moments:
        return lambda x: np.full(len(x), float(prior))
    fourier = Fourier([r.m for r in moments], [r.s if r.s > 1e-9 else 1.0 for r in moments], features)
    summed = learn.select("x", "y").mapInPandas(_sums(fourier), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    size = features + 1
    total = np.zeros((size, size + 1))
    total[summed["i"], summed["j"]] = summed["v"]
    count = total[-1, -2]
    weights = np.linalg.solve(total[:, :-1] + ridge * count * np.eye(size), total[:, -1])

    def raw(x: np.ndarray) -> np.ndarray:
        return fourier(x) @ weights

    def binned(batches):
        for batch in batches:
            if len(batch):
                at = np.clip(np.round(raw(np.stack(batch["x"])) * BINS / 2), -BINS // 2, BINS)
                yield pd.DataFrame({"at": at.astype(int), "y": batch["y"].astype(float)})

    bins = rows.where("fold = 0").select("x", "y").mapInPandas(binned, "at int, y double").groupBy("at").agg(F.sum("y").alias("hits"), F.count("*").alias("n")).orderBy("at").toPandas()
    if not len(bins):
        return lambda x: np.clip(raw(x), 0, 1)
    knots, values = isotonic(bins["at"].to_numpy() * 2 / BINS, bins["hits"].to_numpy(), bins["n"].to_numpy().astype(float))
    return lambda x: np.clip(np.interp(raw(x), knots, values), 0, 1)


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """One row per row of `docs`: _key, id, held_out, score (0 to 1, higher: label 1 likelier), predicted.

    Rows whose crc32 of the id leaves 0 modulo 5 are held out: their labels are never read. Of the
    others, those that leave 4 calibrate, the rest fit. Several labels of one id count as their
    mean, rounded; null labels and ids are not learned from. A text without words has zero
    statistics and is scored by them. Without labels of both kinds every score is the share of
    label 1, or one half. Equal rows get equal scores.
    """
    known = identified(docs, doc_id, text)
    kind = known.schema["_id"].dataType.simpleString()
    stats = stored(known.mapInPandas(_statistics_of, f"_key string, _id {kind}, x array<double>"), "statistics")
    out = held_out(F.col("_id"), 5, 0)
    marks = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.round(F.avg(label)).cast("double").alias("y"))
    fold = F.when(held_out(F.col("_id"), 5, 4), 0).otherwise(1).alias("fold")
    score = fit(stored(stats.where(~out).join(marks, "_id").select("x", "y", fold), "labelled"))

    def scored(batches):
        for batch in batches:
            values = score(np.stack(batch["x"])) if len(batch) else []
            yield batch[["_key", "_id"]].assign(score=values)

    done = stats.mapInPandas(scored, f"_key string, _id {kind}, score double")
    return done.select("_key", F.col("_id").alias("id"), held_out(F.col("_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


@query("op2_quality_classifier")
def op2_quality_classifier(spark, sf_dir):
    return quality_scores(documents(spark, sf_dir), documents(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id").drop("_key")
