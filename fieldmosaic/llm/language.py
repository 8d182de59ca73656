"""Language identification with a string kernel.

The kernel of two texts is the number of distinct letter n-grams (one to three, blended) that
both have, divided by the geometric mean of their numbers of n-grams. A Nyström map on landmark
texts turns it into vectors, one-versus-rest kernel ridge regression on them gives one score per
language. Kernel rows are computed as products of presence matrices, batch by batch; a text
is read once, whole, and never moved.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from fieldmosaic.llm.common import documents, held_out, stored
from fieldmosaic.llm.registry import query

SAMPLE = 1500  # learned texts per language at most, on average: a documented bound of the fit
LANDMARKS = 24  # of them per language, on average
RIDGE = 1e-3
SYMBOLS = 128
GRAMS = SYMBOLS + SYMBOLS**2 + SYMBOLS**3


@lru_cache(1)
def letter_classes() -> np.ndarray:
    """0 for what is no letter, 1 to 26 for a to z, one of the other symbols for every other letter."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        if chr(code).isalpha():
            table[code] = code - 96 if 97 <= code <= 122 else 27 + code * 2654435761 % (1 << 32) % (SYMBOLS - 27)
    return table


@lru_cache(1)
def _flags() -> np.ndarray:
    return np.zeros(GRAMS, bool)


def grams(text: str) -> np.ndarray:
    """Sorted numbers of the distinct n-grams; runs of other characters count as one border. Read in pieces."""
    text, seen = text.lower(), _flags()
    touched = []
    for at in range(0, len(text), 1 << 20):
        codes = letter_classes()[np.frombuffer(text[at : at + (1 << 20) + 2].encode("utf-32-le", "surrogatepass"), np.uint32)]
        codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])].astype(np.int64)
        pairs = codes[:-1] * SYMBOLS + codes[1:]
        for ids in (codes, SYMBOLS + pairs, SYMBOLS + SYMBOLS**2 + pairs[:-1] * SYMBOLS + codes[2:]):
            seen[ids] = True
            fresh = np.unique(ids) if len(ids) < 20_000 else np.flatnonzero(seen)
            touched.append(fresh)
    if not touched:
        return np.empty(0, np.int64)
    found = np.unique(np.concatenate(touched))
    seen[found] = False
    return found[found != 0]  # the border alone says nothing


def has_letter(found: np.ndarray) -> bool:
    return bool(len(found)) and bool(found[0] < SYMBOLS)


class Landmarks:
    """Presence matrix of the landmark texts and the Nyström map."""

    def __init__(self, sets: list[np.ndarray]):
        self.vocabulary = np.unique(np.concatenate(sets))
        self.matrix = np.zeros((len(self.vocabulary), len(sets)), np.float32)
        for k, found in enumerate(sets):
            self.matrix[np.searchsorted(self.vocabulary, found), k] = 1
        self.sizes = np.array([len(s) for s in sets], np.float64)
        own = (self.matrix.T @ self.matrix) / np.sqrt(self.sizes[:, None] * self.sizes[None, :])
        values, vectors = np.linalg.eigh(own.astype(np.float64))
        kept = values > 1e-6 * values.max()
        self.root = vectors[:, kept] / np.sqrt(values[kept])

    def __call__(self, sets: list[np.ndarray]) -> np.ndarray:
        """Vectors of texts, a row each with a constant as last entry."""
        rows = []
        for at in range(0, len(sets), 256):
            part = sets[at : at + 256]
            present = np.zeros((len(part), len(self.vocabulary)), np.float32)
            for k, found in enumerate(part):
                place = np.searchsorted(self.vocabulary, found)
                place[place == len(self.vocabulary)] = 0
                present[k, place[self.vocabulary[place] == found]] = 1
            sizes = np.maximum([len(s) for s in part], 1)
            kernel = (present @ self.matrix) / np.sqrt(sizes[:, None] * self.sizes[None, :])
            rows.append(np.hstack([kernel @ self.root, np.ones((len(part), 1))]))
        return np.concatenate(rows) if rows else np.empty((0, self.root.shape[1] + 1))


def _gram_rows(batches):
    for batch in batches:
        yield pd.DataFrame({"lang": batch["lang"], "draw": batch["draw"], "grams": [grams(t).tolist() for t in batch["_text"]]})


class Model:
    def __init__(self, langs: list[str], landmarks: Landmarks | None, weights: np.ndarray | None):
        self.langs, self.landmarks, self.weights = langs, landmarks, weights

    def __call__(self, texts) -> tuple[list[str], list[float]]:
        sets = [grams(t) for t in texts]
        if self.landmarks is None:
            return ["und"] * len(sets), [0.0] * len(sets)
        scores = self.landmarks(sets) @ self.weights
        best = scores.argmax(axis=1) if len(scores) else []
        return (
            [self.langs[b] if has_letter(s) else "und" for b, s in zip(best, sets)],
            [float(np.clip(row[b], 0, 1)) if has_letter(s) else 0.0 for row, b, s in zip(scores, best, sets)],
        )


def fit(known: DataFrame, lang: str, sample: int = SAMPLE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Learn from columns `_id`, `_text` and the language.

    A text is drawn if a hash of its id falls below sample / count of its language, so about
    `sample` texts per language are read however many there are, and the draw needs no sort.
    """
    rows = known.where(F.col(lang).isNotNull() & (F.col("_text") != ""))
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}  # one row per language
    if not counts:
        return Model([], None, None)
    draw = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, sample / n))])
    drawn = rows.select(F.col(lang).cast("string").alias("lang"), draw.alias("draw"), "_text", F.element_at(share, F.col(lang)).alias("share")).where("draw < share")
    few = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, landmarks / n))])
    sets = stored(drawn.mapInPandas(_gram_rows, "lang string, draw double, grams array<int>"), "grams").where("size(grams) > 0")
    chosen = sets.where(F.col("draw") < F.element_at(few, F.col("lang"))).orderBy("lang", "draw").collect()  # sets of n-grams, not texts
    if not chosen:
        chosen = sets.orderBy("draw").limit(landmarks).collect()
    if not chosen:
        return Model([], None, None)
    langs = sorted(map(str, counts))
    place = Landmarks([np.array(r.grams) for r in chosen])

    def sums(batches):
        size = place.root.shape[1] + 1
        total = np.zeros((size, size + len(langs)))
        for batch in batches:
            if len(batch):
                z = place([np.asarray(g) for g in batch["grams"]])
                total += z.T @ np.hstack([z, (batch["lang"].to_numpy()[:, None] == np.array(langs, object)[None, :]).astype(float)])
        yield pd.DataFrame({"i": np.repeat(np.arange(size), total.shape[1]), "j": np.tile(np.arange(total.shape[1]), size), "v": total.ravel()})

    summed = sets.select("lang", "grams").mapInPandas(sums, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    total = np.zeros((summed["i"].max() + 1, summed["j"].max() + 1))
    total[summed["i"], summed["j"]] = summed["v"]
    size = total.shape[0]
    weights = np.linalg.solve(total[:, :size] + ridge * max(total[size - 1, size - 1], 1) * np.eye(size), total[:, size:])
    return Model(langs, place, weights)


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of `docs`: id, held_out, lang_pred, score (0 to 1).

    Rows whose crc32 of the id leaves 1 modulo 3 are held out of the fit. A text without a letter
    (null and empty too) is `und` with score 0; so is every text if nothing can be learned.
    Null languages and ids are not learned from.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"), F.col(lang).cast("string").alias("_lang"))
    model = fit(rows.where(F.col("_id").isNotNull() & ~held_out(F.col("_id"), 3, 1)), "_lang")
    kind = rows.schema["_id"].dataType.simpleString()

    def predict(batches):
        for batch in batches:
            names, scores = model(batch["_text"])
            yield pd.DataFrame({"_id": batch["_id"], "lang_pred": names, "score": scores})

    done = rows.select("_id", "_text").mapInPandas(predict, f"_id {kind}, lang_pred string, score double")
    return done.select(F.col("_id").alias("id"), held_out(F.col("_id"), 3, 1).alias("held_out"), "lang_pred", "score")


@query("op3_language_id")
def op3_language_id(spark, sf_dir):
    return identify(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")
