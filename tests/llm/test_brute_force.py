"""Quality, language, quotations and the pipeline against plain Python on whole small tables."""

from __future__ import annotations

import random

import corpus_pipeline
from fieldmosaic.llm import language, pieces, quality, quotations
from pyspark.sql import functions as F
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"


def tables(spark, folder=SF_DIR):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    return docs, {r.doc_id: float(r.quality) for r in labels.collect() if r.quality is not None}


def test_quality_scores_match_brute_force(spark):
    docs, labels = tables(spark, "/root/testdata/sf0.01")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute.quality_scores(rows, labels)
    got = {r.id: r.score for r in quality.quality_scores(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet")).collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-6
    assert len(set(want.values())) > 10


def test_languages_match_brute_force(spark):
    docs, _ = tables(spark)
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    rows = docs.select("doc_id", "text", "lang", draw.alias("draw")).collect()
    want = brute.languages([(r.doc_id, r.text, r.lang) for r in rows], {r.doc_id: r.draw for r in rows})
    got = {r.id: (r.lang_pred, r.score) for r in language.identify(docs).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-3 for k in want)


def test_quotations_match_brute_force(spark):
    """Random threads whose messages quote lines, paragraphs and whole earlier messages, in other spacing and case, up to three levels deep."""
    rng = random.Random(31)
    rows = []
    for conv in range(12):
        texts = []
        for turn in range(rng.randint(1, 9)):
            blocks = []
            for _ in range(rng.randint(1, 3)):
                if texts and rng.random() < 0.6:
                    source = rng.choice(texts)
                    kind = rng.randrange(3)
                    chosen = source if kind == 0 else rng.choice(source.split("\n\n")) if kind == 1 else rng.choice(source.split("\n"))
                    chosen = chosen.upper() if rng.random() < 0.2 else chosen.replace(" ", "  ") if rng.random() < 0.2 else chosen
                    blocks.append("\n".join("> " + line for line in chosen.split("\n")))
                else:
                    blocks.append("\n".join(" ".join(rng.choice("abcdef") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 3))))
            texts.append(rng.choice(["\n", "\n\n"]).join(blocks))
            rows.append((f"c{conv}", turn, texts[-1]))
    got = {(r.row.conv_id, r.row.turn): (r.quotes, r.reply_to, r.thread, r.position) for r in
           quotations.linked(spark.createDataFrame(rows, "conv_id string, turn int, text string")).collect()}
    want = brute.links(rows)
    assert got == want and sum(v[1] is not None for v in want.values()) > 15 and any(v[2] not in (0, k[1]) for k, v in want.items())


def test_pipeline_matches_brute_force(spark):
    """Every stage on what its predecessor kept: rejected rows, cut lines, copies, passages and ids."""
    docs, labels = tables(spark)
    items = [brute.words(r.text or "") for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    state = {r.doc_id: r.text or "" for r in docs.collect()}
    scores = brute.quality_scores(list(state.items()), labels)

    def tokens(found):
        library = pieces.pieces(pieces.MODEL).library
        return {k: list(library.encode(t)) for k, t in found.items()}

    steps = [
        lambda found: {k: t for k, t in found.items() if scores[k] >= 0.3},
        lambda found: brute.without_repeated_lines(list(found.items())),
        lambda found: {k: found[k] for k in brute.least_of_similar(found)},
        lambda found: {k: t for k, t in found.items() if not any(brute.coverage(item, brute.words(t)) >= 0.6 for item in items)},
        tokens,
    ]
    rows, acted = docs, []
    for (name, stage), step in zip(corpus_pipeline.STAGES, steps):
        rows = corpus_pipeline.stored(stage(spark, rows, SF_DIR), "stage")
        before, state = state, step(state)
        got = {r.doc_id: list(r.ids) if "ids" in rows.columns else r.text or "" for r in rows.collect()}
        assert got == state, name
        acted.append(before != state)
    assert all(acted)
    assert {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF_DIR).collect()} == state
