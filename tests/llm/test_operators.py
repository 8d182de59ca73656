"""The operators on small tables: brute force, ties, nulls, empty tables, clashing columns."""

from __future__ import annotations

import itertools
import math
import random
import re
import time
import zlib

import pytest
from pyspark.sql import functions as F

from fieldmosaic.llm import decontaminate, exact_dedup, language, line_dedup, ngram_join, pieces, quality, quotations, sanitize, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _key string, row string, id long"
LABELS = "doc_id long, quality int"
WORDS = [f"w{i}" for i in range(300)]


def table(spark, rows):
    """Documents with extra columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, "xx" if i is None else f"l{i % 2}", "s", None if t is None else len(t), "k", "r", 7) for i, t in rows], DOCS)


def long_text(rng, words=80):
    return " ".join(rng.choice(WORDS) for _ in range(words))


EDGES = [(1, None), (2, ""), (3, "   \n\n"), (3, "   \n\n"), (None, "plain text here"), (4, "one"), (4, "one"), (5, "a" * 50_000), (6, "b 1.2.3.4 " * 3000)]


@pytest.mark.parametrize("rows", [[], EDGES])
def test_every_operator_takes_edge_rows(spark, rows):
    docs = table(spark, rows)
    labels = spark.createDataFrame([(3, 1), (3, None), (None, 0), (4, 0), (6, 1)], LABELS)
    items = spark.createDataFrame([(1, None), (2, ""), (3, "never in any of these texts")], "item_id long, text string")
    for count, done in [
        (len(rows), exact_dedup.exact_groups(docs)), (len(rows), line_dedup.dedup_lines(docs)), (len(rows), ngram_join.similar_texts(docs)),
        (0, decontaminate.contaminated(docs, items)), (len(rows), quality.quality_scores(docs, labels)), (len(rows), language.identify(docs)),
        (len(rows), sanitize.find_spans(docs)), (len(rows), sanitize.sanitize(docs)), (len(rows), pieces.decode(pieces.encode(docs))),
    ]:
        assert len(done.collect()) == count


def test_exact_groups_with_colliding_identifiers(spark):
    rng = random.Random(1)
    texts = [long_text(rng, n) for n in (0, 3, 200, 900, 900, 2000)]
    rows = [(k, rng.choice(texts).replace(" ", rng.choice([" ", "  ", "\t"]))) for k in range(60)]
    want = {}
    for k, t in rows:
        want.setdefault(re.sub(r"[ \t-\r]+", " ", t), []).append(k)
    for bits in (64, 1):
        for r in exact_dedup.exact_groups(table(spark, rows), bits=bits).collect():
            group = next(g for g in want.values() if r.id in g)
            assert (r.keep_id, r.group_size, r.kept) == (min(group), len(group), r.id == min(group))


def test_chunks_meet_again_after_an_insertion(spark):
    rng = random.Random(2)
    text = " ".join(w + rng.choice("adrstz") for w in long_text(rng, 14_000).split())
    rows = [("", text)]
    for size in (1, 16, 128, 250, 400, 700):
        for _ in range(5):
            at = rng.randrange(2000)
            rows.append((str(size), text[:at] + long_text(rng, 300)[:size] + text[at:]))
    first, *others = spark.createDataFrame(rows, "size string, t string").select("t", exact_dedup.chunks(F.col("t")).alias("c")).collect()
    assert len(first.c) > 50 and max(map(len, first.c)) <= exact_dedup.MOST
    for r in others:
        assert "".join(r.c) == r.t and len(set(r.c) - set(first.c)) <= 4


def test_chunks_without_borders_and_with_borders_only(spark):
    rows = [("",), ("a" * 10_000,), ("ad " * 5000,), ("\u4e2d\u6587\uff0c" * 4000,), ("x\x00y. \U0001f600. " * 900,)]
    for r in spark.createDataFrame(rows, "t string").select("t", exact_dedup.chunks(F.col("t")).alias("c")).collect():
        assert "".join(r.c) == r.t and all(0 < len(c) <= exact_dedup.MOST for c in r.c)
        assert len(r.c) <= len(r.t) / exact_dedup.LEAST + 2


def test_line_dedup_matches_brute_force(spark):
    """Every pair of equal lines is extended line by line to a longest common run; the later one goes if it has 50 words."""
    rng = random.Random(3)
    lines = [long_text(rng, n) for n in (2, 8, 20, 20, 30, 49, 50, 70)] + ["", "  "]
    rows = [(k, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 9)))) for k in range(40)]
    parts = [[line.strip() for line in text.split("\n")] for _, text in rows]
    places = [(k, i) for k, text in enumerate(parts) for i in range(len(text))]
    cut = set()
    for (a, i), (b, j) in itertools.combinations(places, 2):
        if i and j and parts[a][i - 1] == parts[b][j - 1]:
            continue
        n = 0
        while i + n < len(parts[a]) and j + n < len(parts[b]) and parts[a][i + n] == parts[b][j + n]:
            n += 1
        if sum(len(line.split()) for line in parts[b][j : j + n]) >= 50:
            cut |= {(b, j + k) for k in range(n)}
    want = {k: "\n".join(line for i, line in enumerate(text.split("\n")) if (k, i) not in cut) for k, text in rows}
    got = {r.row.doc_id: r.text for r in line_dedup.dedup_lines(table(spark, rows)).collect()}
    assert got == want


def test_repeated_runs_go_as_a_whole(spark):
    rng = random.Random(9)
    lines = [long_text(rng, n) for n in (2, 8, 20, 20, 30, 49, 50, 70)] + ["", "  "]
    rows = [(k, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 9)))) for k in range(40)]
    copy = "\n".join([long_text(rng, 60), "", "", long_text(rng, 40), long_text(rng, 5), ""])
    rows += [(40, copy), (41, copy), (42, "before\n" + copy + "after " + long_text(rng, 60))]
    seen, want = set(), {}
    for k, text in rows:
        parts, cut = [p.strip() for p in text.split("\n")], set()
        for i, j in itertools.combinations(range(len(parts) + 1), 2):  # by start: a run may repeat one of its own text
            run = tuple(parts[i:j])
            if sum(len(p.split()) for p in run) >= 50:
                if run in seen:
                    cut |= set(range(i, j))
                seen.add(run)
        want[k] = "\n".join(p for i, p in enumerate(text.split("\n")) if i not in cut)
    got = {r.row.doc_id: r.text for r in line_dedup.dedup_lines(table(spark, rows)).collect()}
    assert got == want and got[41] == "" and got[42].startswith("before\nafter")


def test_many_blank_lines_cost_no_more_than_others():
    text = "\n".join(["a " * 40] + [""] * 200_000 + ["b " * 40, ""])
    assert len(line_dedup.line_windows(text, 50)) == 2


def jaccard(a, b):
    def grams(t):
        w = re.findall(r"[^\W_]+", t.lower())
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else {()}

    return len(grams(a) & grams(b)) / len(grams(a) | grams(b))


def test_similar_texts_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "VERIFY_BLOCK", 8)
    rng = random.Random(4)
    rows = []
    for base in range(4):
        words = long_text(rng, 120).split()
        for _ in range(25 if base == 0 else 6):
            copy = list(words)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + k, t) for k, t in enumerate(["", "A b.", "a, B", "c"])]
    links = {k: [j for j, u in rows if j != k and jaccard(t, u) >= 0.8] for k, t in rows}
    classes = {k: {k} for k, _ in rows}
    for k, near in links.items():
        for j in near:
            both = classes[k] | classes[j]
            for m in both:
                classes[m] = both
    for r in ngram_join.similar_texts(table(spark, rows)).collect():
        assert (r.n_links, r.class_id, r.class_size) == (len(links[r.id]), min(classes[r.id]), len(classes[r.id]))


def test_pruning_keeps_pairs_at_the_threshold():
    count = ngram_join.BANDS * ngram_join.ROWS
    n, need = ngram_join.least_agreement()[-1]
    lost = sum(math.comb(count, m) * 0.8**m * 0.2 ** (count - m) for m in range(need))
    assert n == count and lost < 1e-6 and need > 0.3 * count


def test_tiles_match_naive_greedy():
    rng = random.Random(5)
    for _ in range(60):
        item = [rng.randrange(6) for _ in range(rng.randint(1, 25))]
        doc = [rng.randrange(-1, 6) for _ in range(rng.randint(1, 60))]
        tiles = decontaminate.tile(decontaminate.np.array(item), decontaminate.np.array(doc), 3)
        left, right = [False] * len(item), [False] * len(doc)
        longest = 0
        for i, d in itertools.product(range(len(item)), range(len(doc))):
            n = 0
            while i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n]:
                n += 1
            longest = max(longest, n)
        assert max((t[2] for t in tiles), default=0) == (longest if longest >= 3 else 0)
        for i, d, n in tiles:
            assert item[i : i + n] == doc[d : d + n] and not any(left[i : i + n]) and not any(right[d : d + n])
            left[i : i + n], right[d : d + n] = [True] * n, [True] * n


def test_reordered_passages_are_caught(spark):
    rng = random.Random(6)
    item = long_text(rng, 40).split()
    moved = " ".join(item[20:] + WORDS[:7] + item[:20])
    rows = [(1, long_text(rng, 50) + " " + moved), (2, long_text(rng, 300)), (3, " ".join(item[:15])), (4, " ".join(item).upper())]
    items = spark.createDataFrame([(9, " ".join(item)), (8, "w1 w2")], "item_id long, text string")
    for chars in (1 << 24, 20):
        found = decontaminate.contaminated(table(spark, rows), items, block_chars=chars).where("item = 9").collect()
        assert sorted((r.id, r.matched) for r in found) == [(1, 40), (4, 40)]


def test_empty_benchmark_and_equal_tiles(spark):
    docs = table(spark, [(1, "a b c d e x a b c d e"), (2, None)])
    assert decontaminate.contaminated(docs, spark.createDataFrame([], "item_id long, text string")).isEmpty()
    items = spark.createDataFrame([(9, "a b c d e f a b c d e")], "item_id long, text string")
    (found,) = decontaminate.contaminated(docs, items).collect()
    assert [tuple(t) for t in found.tiles] == [(0, 0, 5), (6, 6, 5)] and (found.item_words, found.matched) == (11, 10)


def test_base_spans_match_plain_patterns():
    rng = random.Random(7)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    for _ in range(3000):
        text = "".join(rng.choice("ab1234567890.@-+ ()%") for _ in range(rng.randint(0, 40)))
        spans = sanitize.base_spans(text)
        assert [s[:2] for s in spans if s[2] == "email"] == [m.span() for m in email.finditer(text)]
        plain = [m for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
        assert [s[:2] for s in spans if s[2] == "ip"] == [m.span() for m in plain]
    assert [s[2] for s in sanitize.base_spans("4111 1111 1111 1111 +1 (624) 555-2408")] == ["card", "phone"]


def test_terms_that_give_an_entity_away(spark):
    rows = [(k, f"note {WORDS[k]}{k} the codename Zanzibar of bob@x.example.org is fine") for k in range(5)]
    rows += [(10 + k, f"the note is fine, codename unknown {k}") for k in range(30)] + [(50 + k, "Quetzal mail eve@y.example.org") for k in range(9)]
    found = {r.id: r.text for r in sanitize.sanitize(table(spark, rows)).collect()}
    assert "Zanzibar" not in found[0] and "[EMAIL]" in found[0] and "codename" in found[0]
    assert "Quetzal" in found[50]  # nine copies of one text are one piece of evidence


def brute_disclosures(texts, support=3, least=0.9):
    """Entity and term of whole texts, by plain loops."""
    held = []
    for text in texts:
        spans = sanitize.base_spans(text)
        words = {m[0].lower() for m in sanitize.TERM.finditer(text) if not any(s <= m.start() and m.end() <= e for s, e, _ in spans)}
        held.append(({sanitize.entity_of(text, s) for s in spans}, words))
    found = {}
    for e, t in {(e, t) for es, ts in held for e in es for t in ts}:
        ne, nt = sum(e in es for es, _ in held), sum(t in ts for _, ts in held)
        both = [x for x, (es, ts) in zip(texts, held) if e in es and t in ts]
        if len(set(both)) >= support and ne < len(texts):
            rate = round(math.log(len(both) * len(texts) / (nt * ne)) / math.log(len(texts) / ne), 6)
            if rate >= least:
                found[e, t] = rate
    return found


def test_disclosing_terms_are_counted_in_whole_texts_and_marked_everywhere(spark):
    rng = random.Random(10)
    far = "Signed far below\n" + "\n".join(["the note is fine and long enough to part them"] * 3)
    rows = [(k, f"mail bob@x.example.org {WORDS[k]}\n{far}\nZanzibar") for k in range(40)] + [(40, "only Zanzibar here, zanzibar there"), (41, "zanzibars")]
    rows += [(50 + k, " ".join(rng.choice(["alpha", "beta1", "gamma", "delta", "1.2.3.4", "eve@y.example.org", "+1 624 555 2408", "\n"]) for _ in range(rng.randint(1, 6)))) for k in range(60)]
    rows += [(200 + k, far) for k in range(300)]
    frame = table(spark, rows)
    ids = sanitize.identified(frame)
    found = ids.mapInPandas(sanitize._found, f"_key string, _id long, base {sanitize.SPAN}, entities array<string>, words array<string>").withColumn("_text_key", F.substring_index("_key", ":", -1))
    for least in (0.9, 0.3):
        got = {(r.entity, r.term): r.disclosure for r in sanitize.disclosures(ids, found, least=least).collect()}
        want = brute_disclosures([t for _, t in rows], least=least)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-6 for k in got)
    assert ("email:bob@x.example.org", "zanzibar") in want
    texts = {r.id: r.text for r in sanitize.sanitize(frame).collect()}
    assert "Zanzibar" not in texts[0] and texts[40].lower().count("zanzibar") == 0 and texts[41] == "zanzibars" and "note" in texts[0]


def test_short_names_and_identifiers_are_terms(spark):
    rows = [(k, f"{WORDS[k]} bob@x.example.org the note, Ana, 王芳, A1234") for k in range(5)] + [(10 + k, f"the note {k}") for k in range(60)] + [(90, "王芳 a1234 ana bana")]
    texts = {r.id: r.text for r in sanitize.sanitize(table(spark, rows)).collect()}
    assert texts[0] == "w0 [EMAIL] the note, [TERM], [TERM], [TERM]" and texts[90] == "[TERM] [TERM] [TERM] bana"


def test_quotes_lead_to_their_messages(spark):
    m = [("c", 0, "First point here.\n\nSecond point there."), ("c", 1, "I agree"), ("c", 2, "> Second point there.\nNo."), ("c", 3, "> > second  POINT there.\n> No.\nYes."), ("d", 0, "> I agree\nalone"), (None, 1, "> x"), ("c", None, "> I agree"), ("e", 0, None)]
    df = spark.createDataFrame([(*x, "r", "k") for x in m], "conv_id string, turn int, text string, row string, _key string")
    got = {(r.row.conv_id, r.row.turn): (r.text, r.reply_to, r.thread, r.quotes) for r in quotations.linked(df).collect()}
    assert got["c", 2] == ("No.", 0, 0, 1) and got["c", 3] == ("Yes.", 2, 0, 2)
    assert got["d", 0] == ("alone", None, 0, 0) and got["c", 1][1:] == (None, 1, 0) and len(got) == len(m)
    place = {(r.row.conv_id, r.row.turn): r.position for r in quotations.linked(df).collect()}
    assert place["c", 0] < place["c", 2] < place["c", 3] < place["c", 1]


def test_pieces_equal_the_library(spark):
    rng, library = random.Random(8), pieces.pieces(pieces.MODEL).library
    texts = ["".join(rng.choice("abcde  ABC\n\tй日本😀") for _ in range(rng.choice([0, 5, 300, 20_000]))) for _ in range(12)] + ["ab" * 3000, "x" * 700 + " " * 300]
    got = pieces.decode(pieces.encode(table(spark, list(enumerate(texts))), chunk=64)).collect()
    for r in got:
        assert r.ids == library.encode(texts[r.id]) and r.text == texts[r.id]
    assert sum(len(t) >= 127 for t in texts) > len(texts) / 2  # the scan has encoded most of them


def test_decoding_equals_the_library():
    rng, p = random.Random(18), pieces.pieces(pieces.MODEL)
    for ids in [[rng.randrange(32_000 if rng.random() < 0.5 else 260) for _ in range(rng.randint(0, 9))] for _ in range(3000)] + [p.library.encode(" \n two  日本😀\x01")]:
        assert p.text(ids) == p.library.decode(ids)


def test_isotonic_is_monotone():
    _, values = quality.isotonic(quality.np.arange(6.0), quality.np.array([0, 3, 1, 2, 5, 4.0]), quality.np.full(6, 6.0))
    assert (quality.np.diff(values) >= 0).all()


def test_quality_and_language_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    q = quality.quality_scores(docs, labels).where("held_out").join(labels.withColumnRenamed("doc_id", "id"), "id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    lang = language.identify(docs).where("held_out").join(docs.select(F.col("doc_id").alias("id"), "lang"), "id").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert q > 0.9 and lang > 0.97


def test_urls(spark):
    urls = [None, "", "no scheme", "HTTP://A.Net/x?y#z", "http://www.example.net/en/1", "http://example.net", "http://b.example.com/de/", "http://x.org/fr/a", "http://notnet/", "http://q.info/fr/a", "http://q.info/fr/a"]
    pages = spark.createDataFrame([(k, u, "s") for k, u in enumerate(urls)], "page_id long, url string, score string")
    got = {r.id: r for r in url_filter.judge_urls(pages).collect()}
    assert [(got[k].host, got[k].path, got[k].rule) for k in (0, 2, 3, 4, 5, 6, 7, 8)] == [
        ("", "", None), ("", "", None), ("a.net", "/x", "net/"), ("www.example.net", "/en/1", "example.net/en/"), ("example.net", "", None),
        ("b.example.com", "/de/", "example.com/de/"), ("x.org", "/fr/a", "org/fr/"), ("notnet", "/", None),
    ]
    assert all(r.verdict in ("allow", "block") for r in got.values()) and len(got) == len(urls)
    assert url_filter.judge_urls(pages.limit(0)).count() == 0
    assert url_filter.calibrated([(-3, 0, 5), (2, 5, 0)]) == 0 and url_filter.calibrated([]) == 0


def test_url_scores_match_brute_force(spark):
    """Every Witten-Bell probability in plain Python; the models learn from labelled urls outside fold 0."""
    rng = random.Random(12)
    urls = ["http://" + "".join(rng.choice("abcx/.-\u00e9Q") for _ in range(rng.randint(0, 30))) for _ in range(120)] + ["", "a"]
    rows = [(u, rng.choice([0, 1, None])) for u in dict.fromkeys(urls)]
    order = url_filter.ORDER

    def windows(url):
        clean = "\x02" * order + "".join(c if " " <= c <= "~" else "\x01" for c in url.translate(str.maketrans(url_filter.UPPER, url_filter.LOWER)))
        return [clean[i : i + order + 1] for i in range(len(clean) - order)]

    counts = ({}, {})
    for url, side in rows:
        if side is not None and zlib.crc32(url.encode()) % url_filter.FOLDS:
            for w in windows(url):
                for k in range(order + 1):
                    after = counts[side].setdefault(w[order - k : order], {})
                    after[w[order]] = after.get(w[order], 0) + 1

    def chance(side, w):
        p = 1 / 97
        for k in range(order + 1):
            after = counts[side].get(w[order - k : order])
            if after:
                p = (after.get(w[order], 0) + len(after) * p) / (sum(after.values()) + len(after))
        return p

    def score(url):
        ratios = [math.log(chance(1, w)) - math.log(chance(0, w)) for w in windows(url)]
        return sum(ratios) / max(1, len(ratios)) * url_filter.MICRO

    scored, threshold = url_filter.url_scores(spark.createDataFrame(rows, "_url string, _side int"))
    got = {r._url: r._score for r in scored.collect()}
    assert len(got) == len(rows) and len({round(v, -4) for v in got.values()}) > 20
    assert all(abs(got[u] - score(u)) < 2 for u, _ in rows)
    fold = [(got[u], side) for u, side in rows if side is not None and zlib.crc32(u.encode()) % url_filter.FOLDS == 0]

    def error(cut):
        slots = [(max(-url_filter.GRID_HALF, min(url_filter.GRID_HALF, v // url_filter.GRID)) * url_filter.GRID, side) for v, side in fold]
        good, bad = ([v for v, side in slots if side == s] for s in (1, 0))
        return sum(v < cut for v in good) / len(good) + sum(v >= cut for v in bad) / len(bad)

    assert error(threshold) <= min(error(cut * url_filter.GRID) for cut in range(-url_filter.GRID_HALF, url_filter.GRID_HALF + 2)) + 1e-12


def test_very_long_urls(spark):
    urls = ["http://a.net/" + "abc/" * 75_000, "http://b.org/fr/" + "xyz-" * 75_000, "http://c.com/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    start = time.monotonic()
    assert {r.id: len(r.path) for r in url_filter.judge_urls(pages).collect()} == {0: 300_001, 1: 300_004, 2: 1}
    assert time.monotonic() - start < 60
