"""Ranked search, conversation repair and packing against brute force, with ties, nulls, repeated rows and empty tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fieldmosaic.llm import conversation_repair as repairs, packing, ranked_search
from fieldmosaic.llm.byte_bpe import byte_bpe
from tests.llm.test_operators import EDGES, table

ITEMS = "item_id long, text string, rank int, doc int"


def brute_search(docs, items, top):
    """{(item, text): [(doc, score), …]} straight from the definition."""
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    terms = lambda t: pattern.findall("".join(c.lower() if c.isascii() else c for c in t or ""))
    held = [(i, terms(t)) for i, t in docs if terms(t)]
    size, total = len(held), sum(len(t) for _, t in held)
    df = Counter(t for _, ts in held for t in set(ts))
    out = {}
    for name, text in dict.fromkeys(items):
        found = []
        for i, ts in held:
            tf, m = Counter(ts), 50 + (50 * len(ts) * size) // total
            score = sum(math.floor(1000 * math.log((2 * size + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m)) for t in set(terms(text)) if tf[t])
            if score > 0:
                found.append((i, score))
        out[name, text] = sorted(found, key=lambda f: (-f[1], f[0] is None, f[0] or 0))[:top]
    return out


def test_search_matches_brute_force(spark):
    rng = random.Random(11)
    words = [f"W{i}" for i in range(40)] + ["é", "Ünder", "日本", "a_b", "x-y"]
    weights = [1 / (k + 1) for k in range(len(words))]
    docs = EDGES + [(k // 2 + 10, " ".join(rng.choices(words, weights, k=rng.randint(0, 30)))) for k in range(300)]
    items = [(1, "w3 w39 W7 é"), (1, "w3 w39 W7 é"), (2, " ".join(words)), (2, "other w0"), (3, None), (None, "w5; w6"), (4, "nowhere"), (5, "one a")]
    want = brute_search(docs, items, 7)
    for block in (1 << 20, 12):  # one block, a block for about every item
        got = ranked_search.search(table(spark, docs), spark.createDataFrame([(*i, 1, 1) for i in items], ITEMS), top=7, block_chars=block).collect()
        for item in (1, 2, 3, None, 4, 5):
            mine = sorted([r.rank, r.score, r.doc is None, r.doc or 0] for r in got if r.item == item)
            assert mine == sorted([k + 1, s, i is None, i or 0] for (name, _), found in want.items() if name == item for k, (i, s) in enumerate(found))


def test_search_of_empty_tables(spark):
    one = spark.createDataFrame([(1, "w1", 1, 1)], ITEMS)
    assert ranked_search.search(table(spark, []), one).collect() == []
    assert ranked_search.search(table(spark, EDGES), one.limit(0)).collect() == []


def test_limited_accumulators_lose_nothing(monkeypatch):
    """Many short lists in one task, so limits carry over; accumulators do stop."""
    rng = random.Random(12)
    weights = np.array([rng.randint(1, 9000) for _ in range(25)], np.int64)
    docs = [(k, rng.randint(1, 60), sorted(rng.sample(range(25), rng.randint(1, 12)))) for k in range(900)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([d[0] for d in docs], pa.int64()), pa.array([d[1] for d in docs]), pa.array([np.array(d[2], np.int32).tobytes() for d in docs]), pa.array([np.array([1 + t % 3 for t in d[2]], np.int32).tobytes() for d in docs])],
        ["_id", "n", "terms", "tf"],
    )
    size, total = len(docs), sum(d[1] for d in docs)
    df = Counter(t for d in docs for t in d[2])
    asked = [(no, sorted(rng.sample(range(25), 9), key=lambda t: (df[t], t))) for no in range(12)]
    monkeypatch.setattr(ranked_search, "LIST_DOCS", 70)
    got = [tuple(r.values()) for b in ranked_search._search(asked, weights, size, total, 5)(iter([batch])) for r in b.to_pylist()]
    for no, terms in asked:
        scores = []
        for k, n, held in docs:
            s = sum(int(weights[t]) * ((10**9 * (1 + t % 3)) // (1000 * (1 + t % 3) + 20 * (50 + 50 * n * size // total))) for t in held if t in terms)
            scores.append((-s, k))
        assert [(no, k, -s) for s, k in sorted(scores)[:5]] == [r for r in got if r[0] == no]
    lists = ranked_search.Lists(*zip(*((d[0], d[1], np.array(d[2], np.int32).tobytes(), np.ones(len(d[2]), np.int32).tobytes()) for d in docs)), weights, size, total)
    assert len(lists.best(asked[0][1], 5, 0)[0]) < 50 < sum(bool(set(d[2]) & set(asked[0][1])) for d in docs)


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\f\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "none")
        seen.add((role, text))
    return out


def brute_repair(rows):
    """Least (cost, audit) and the turns left, over all edits, grown row by row per string of initials' state."""
    best = {"": (0, "", ())}

    def better(known, state, option):
        if state not in known or option[:2] < known[state][:2]:
            known[state] = option

    def fits(state, c):
        joined = {"": "", "s": "s", "u": "u", "a": "ua"}[state] + c
        return c if re.fullmatch(r"s?(ua)*u?", joined) and joined else None

    def inserted(known):
        for _ in range(3):
            for state, (cost, audit, left) in list(known.items()):
                for c, name in (("u", "user"), ("a", "assistant")):
                    if fits(state, c):
                        better(known, c, (cost + 3, audit + "I", (*left, (name, ""))))
        return known

    best = inserted(best)
    for (role, text), fault in zip(rows, faults(rows)):
        after: dict = {}
        more = 3 * (fault == "truncated")
        for state, (cost, audit, left) in best.items():
            better(after, state, (cost + 4, audit + "D", left))
            if fault in ("none", "truncated"):
                if role[:1] in ("s", "u", "a") and fits(state, role[:1]):
                    better(after, role[:1], (cost + more, audit + "K", (*left, (role, text))))
                for c, name in (("u", "user"), ("a", "assistant")):
                    if fits(state, c):
                        better(after, c, (cost + 3 + more, audit + "R", (*left, (name, text))))
        best = inserted(after)
    return min(best[s] for s in ("", "a") if s in best)


@pytest.mark.parametrize("partitions", [1, 13])
def test_repair_matches_brute_force(spark, partitions):
    rng = random.Random(13)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "ux"], ["Yes.", "No!", "cut", " ", "", "a.\n", "Why? ", None, "é", "more of it."]
    rows = [(k, t, rng.choice(roles[:3] if rng.random() < 0.8 else roles), rng.choice(texts) if rng.random() < 0.5 else f"Turn {t}.", 1, "x") for k in range(60) for t in range(rng.randint(1, 9))]
    rows += [(7_000, t, rng.choice(roles[:3]), rng.choice([*texts, f"Turn {t}.", f"Cut {t}"]), 1, "x") for t in range(400)]  # spans partitions
    rows += [(None, None, "user", "Same.", 1, "x")] * 5 + [(8_000, 3, "user", "Dropped.", 0, "x"), (8_001, None, "user", "Late.", 1, "x"), (8_001, 5, "assistant", "Yes.", 2, "x")]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n int, conv string")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = repairs.repair(docs, copies=F.col("n"))
        cut = pieces.where("not whole").count()
        got = {r.conv: r for r in repairs.digests(pieces).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert (cut > 1) == (partitions > 1)
    known: dict = {}
    for conv, turn, role, text, n, _ in rows:
        known.setdefault(conv, []).extend([(turn, " " if role is None else role, " " if text is None else text)] * n)
    assert set(got) == set(known) and len(got) == repairs.digests(pieces).count()
    for conv, mine in known.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        plain = [r[1:] for r in mine]
        cost, audit, left = brute_repair(plain)
        r, turns, count = got[conv], [m[0] for m in mine if m[0] is not None], Counter(faults(plain))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(plain))
        assert (r.edits, r.cost, r.blank, r.duplicate, r.truncated, r.illegal) == (audit, cost, count["blank"], count["duplicate"], count["truncated"], illegal)
        assert r.sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in left).encode()).hexdigest()
        assert (r.low, r.high, r.turns) == (min(turns, default=None), max(turns, default=None), len(set(turns)))


def test_repair_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repairs.digests(repairs.repair(empty)).collect() == []


def test_blocks_of_the_walk_agree_with_one_block(monkeypatch):
    rng = random.Random(14)
    rows = [(rng.randint(0, 3), rng.randint(0, 2), rng.randint(0, 2)) for _ in range(500)]
    checkpointed = list(repairs.walk(rows, repairs.NONE, repairs.END, True))
    monkeypatch.setattr(repairs.math, "isqrt", lambda n: n)
    assert checkpointed == list(repairs.walk(rows, repairs.NONE, repairs.END, True))


def test_ids_equal_the_library():
    with open(packing.TOKENIZER, encoding="utf-8") as file:
        definition = file.read()
    library, model = Tokenizer.from_str(definition), byte_bpe(definition)
    rng = random.Random(15)
    pool = [*"abz sT'’.,!?19²½Ⅷ\n\t\r\x0b\x00    éßñ中文日本한Ａ😀́‍\u0085_-<|>", "'s", "'ll", "'ve", " '", "'S", "<|endoftext|>", "token" * 20]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(1500)] + ["word  two'll " * 150_000, "x" * 1_100_000]
    for text, ids in zip(texts, model.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 40, 256])
    counts = {k: rng.randint(1, rng.choice([2, 50, 3000])) for k in rng.sample(range(1, capacity + 1), rng.randint(1, capacity))}
    plan = packing.Plan(counts, capacity)
    assert not plan.left.any()
    number = sum(n for groups in plan.open.values() for n, _ in groups)
    room: dict = {}
    ranges = plan.ranges()
    for k, (length, rank, each, sequence, offset) in enumerate(ranges):
        past = ranges[k + 1][1] if k + 1 < len(ranges) and ranges[k + 1][0] == length else counts[length]
        assert past > rank
        for inside in range(past - rank):
            room.setdefault(sequence + inside // each, []).append((offset + inside % each * length, length))
    assert len(room) == number
    for parts in room.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    bins: list[int] = []  # piece by piece, best fit, longest first
    for length in sorted(Counter(counts).elements(), reverse=True):
        fit = min((b for b in range(len(bins)) if bins[b] >= length), key=lambda b: bins[b], default=None) if len(bins) < 400 else None
        if fit is None:
            bins.append(capacity - length)
        else:
            bins[fit] -= length
    assert number <= max(len(bins), -(-sum(k * n for k, n in counts.items()) // capacity)) + 2


def test_exact_combinations_come_first():
    plan = packing.Plan({10: 3, 6: 5, 4: 5, 3: 2, 2: 1, 1: 1}, 10)
    full = [sorted(x for x, n, _ in parts for _ in range(n)) for number, parts in plan.open.get(0, []) for _ in range(number)]
    assert full.count([10]) == 3 and full.count([4, 6]) == 5 and sum(n for groups in plan.open.values() for n, _ in groups) == 9


def test_packing_of_odd_rows(spark):
    docs = table(spark, [*EDGES, (9, "word " * 5000)])
    pieces = packing.token_pieces(docs)
    packed = packing.pack(pieces.withColumn("offset", F.lit("old"))).collect()
    assert len(packed) == pieces.count() and sum(r.id is None for r in packed) == 1
    parts = sorted((r for r in packed if r.id == 9), key=lambda r: r.piece)
    assert [r.length for r in parts[1:]] == [2048] * (len(parts) - 1) and [r.start for r in parts] == [0, *itertools.accumulate(r.length for r in parts[:-1])]
    whole = packing.sequences(packing.pack(pieces)).collect()
    assert sorted(len(r.ids) // 4 for r in whole) == sorted(sum(r.length for r in packed if r.sequence_id == s) for s in {r.sequence_id for r in packed})
    assert packing.pack(pieces.limit(0)).collect() == []
    with pytest.raises(ValueError):
        packing.pack(pieces.withColumn("length", F.lit(0)))
