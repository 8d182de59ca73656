"""The learned and the linking operators again, in plain Python and numpy on whole tables."""

from __future__ import annotations

import itertools
import re
import zlib

import numpy as np

from fieldmosaic.llm import language, quality


def rest(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def isotonic_value(points, score):
    """Least-squares non-decreasing fit by the max-min formula over (score, hits, n), smoothed, between the middles of its steps."""
    rate = []
    for i in range(len(points)):
        rate.append(max(min(sum(h for _, h, _ in points[a : b + 1]) / sum(n for _, _, n in points[a : b + 1]) for b in range(i, len(points))) for a in range(i + 1)))
    knots = []
    for _, group in itertools.groupby(range(len(points)), lambda i: round(rate[i], 12)):
        step = [points[i] for i in group]
        n, hits = sum(p[2] for p in step), sum(p[1] for p in step)
        knots.append((sum(p[0] * p[2] for p in step) / n, (hits + 0.5 * hits / n) / (n + 0.5)))
    return np.clip(np.interp(score, [k for k, _ in knots], [v for _, v in knots]), 0, 1)


def quality_scores(docs, labels):
    """{doc_id: score} from (doc_id, text) and {doc_id: label}: least squares on all rows at once."""
    x = {k: np.array(quality.statistics(t or "")) for k, t in docs}
    learn = [k for k in x if k in labels and rest(k, 5) in (1, 2, 3)]
    rows = np.stack([x[k] for k in learn])
    spread = rows.std(axis=0)
    fourier = quality.Fourier(rows.mean(axis=0), np.where(spread > 1e-9, spread, 1.0))
    z = fourier(rows)
    root = np.sqrt(quality.RIDGE * len(learn)) * np.eye(z.shape[1])
    weights = np.linalg.lstsq(np.vstack([z, root]), np.concatenate([[labels[k] for k in learn], np.zeros(len(root))]), rcond=None)[0]
    raw = {k: float((fourier(v[None]) @ weights)[0]) for k, v in x.items()}
    bins: dict[int, list] = {}
    for k in x:
        if k in labels and rest(k, 5) == 4:
            bins.setdefault(int(np.clip(round(raw[k] * 500), -500, 1000)), []).append(labels[k])
    points = [(at / 500, sum(v), len(v)) for at, v in sorted(bins.items())]
    return {k: float(isotonic_value(points, v)) for k, v in raw.items()}


def gram_set(text):
    classes = language.letter_classes()
    codes: list[int] = []
    for c in text.lower():
        code = int(classes[ord(c)])
        if code or not codes or codes[-1]:
            codes.append(code)
    found = {tuple(codes[i : i + n]) for n in (1, 2, 3) for i in range(len(codes) - n + 1)}
    return found - {(0,)}


def languages(docs, draws):
    """{doc_id: (language, score)} from (doc_id, text, lang) and {doc_id: draw}; every kernel value is one set intersection."""
    sets = {k: gram_set(t or "") for k, t, _ in docs}
    learn = [(k, lang) for k, t, lang in docs if lang is not None and t and rest(k, 3) != 1]
    names = sorted({lang for _, lang in learn})
    counts = {n: sum(lang == n for _, lang in learn) for n in names}
    assert max(counts.values()) <= language.SAMPLE  # every learned text is drawn
    learn = [(k, lang) for k, lang in learn if sets[k]]
    marks = [k for k, lang in learn if draws[k] < min(1.0, language.LANDMARKS / counts[lang])]

    def kernel(a, b):
        return len(a & b) / (len(a) * len(b)) ** 0.5 if a and b else 0.0

    own = np.array([[kernel(sets[a], sets[b]) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(own)
    kept = values > 1e-6 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])
    vector = {k: np.append(np.array([kernel(sets[k], sets[m]) for m in marks]) @ root, 1.0) for k in sets}
    z = np.stack([vector[k] for k, _ in learn])
    y = np.array([[float(lang == n) for n in names] for _, lang in learn])
    ridge = np.sqrt(language.RIDGE * len(learn)) * np.eye(z.shape[1])
    weights = np.linalg.lstsq(np.vstack([z, ridge]), np.vstack([y, np.zeros((len(ridge), len(names)))]), rcond=None)[0]
    out = {}
    for k in sets:
        scores = vector[k] @ weights
        best = int(scores.argmax())
        out[k] = (names[best], float(np.clip(scores[best], 0, 1))) if any(len(g) == 1 for g in sets[k]) else ("und", 0.0)
    return out


def without_repeated_lines(docs, least=50):
    """{doc_id: text}: of every longest common run of lines of `least` words or more the later one goes."""
    lines = {k: (t or "").split("\n") for k, t in sorted(docs)}
    parts = {k: [line.strip() for line in v] for k, v in lines.items()}
    places: dict[str, list] = {}
    for k, v in parts.items():
        for i, line in enumerate(v):
            places.setdefault(line, []).append((k, i))
    cut = set()
    for line, spots in places.items():
        if not line:
            continue  # a run that matters has words; its blank lines are reached from those
        for (a, i), (b, j) in itertools.combinations(spots, 2):
            low = 0
            while i - low and j - low and parts[a][i - low - 1] == parts[b][j - low - 1]:
                low += 1
            n = -low
            while i + n < len(parts[a]) and j + n < len(parts[b]) and parts[a][i + n] == parts[b][j + n]:
                n += 1
            if sum(len(x.split()) for x in parts[b][j - low : j + n]) >= least:
                cut |= {(b, k) for k in range(j - low, j + n)}
    return {k: "\n".join(x for i, x in enumerate(v) if (k, i) not in cut) for k, v in lines.items()}


def words(text):
    return re.findall(r"[^\W_]+", text.lower())


def least_of_similar(docs):
    """Ids of the least document of every class of texts with 5-word similarity 0.8 or more."""
    sets = {}
    for k, t in sorted(docs.items()):
        w = words(t)
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    home = {k: k for k in sets}
    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if (not x and not y) or (x and y and min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and len(x & y) >= 0.8 * len(x | y)):
            keep, gone = sorted((home[a], home[b]))
            home = {k: keep if h == gone else h for k, h in home.items()}
    return {k for k, h in home.items() if k == h}


def coverage(item, doc, least=5):
    """Share of the item's words that greedy tiles of `least` words cover, the longest ones first."""
    least = min(least, len(item))
    seeds = {tuple(item[i : i + least]) for i in range(len(item) - least + 1)}
    if not item or not any(tuple(doc[i : i + least]) in seeds for i in range(len(doc) - least + 1)):
        return 0.0
    number = {w: i for i, w in enumerate(dict.fromkeys(item))}
    a, b = np.array([number[w] for w in item]), np.array([number.get(w, -1) for w in doc])
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    marked = 0
    while True:
        run = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a) - 1, -1, -1):
            same = (b == a[i]) & free_b & free_a[i]
            run[i, :-1] = np.where(same, run[i + 1, 1:] + 1, 0)
        longest = run.max()
        if longest < least:
            return marked / len(item)
        for i, d in zip(*np.nonzero(run == longest)):  # by place in the item, then in the document
            if free_a[i : i + longest].all() and free_b[d : d + longest].all():
                free_a[i : i + longest] = free_b[d : d + longest] = False
                marked += int(longest)


def links(messages):
    """{(conv, turn): (quotes, reply_to, thread, position)} for (conv, turn, text) with one row per turn, by comparing texts."""

    def levels(text):
        runs = []
        for line in text.split("\n"):
            marks = re.match(r"(?:[ \t]*>)*", line)[0]
            level, body = marks.count(">"), line[len(marks):]
            if not runs or runs[-1][0] != level:
                runs.append((level, []))
            runs[-1][1].append(body)
        return [(level, "\n".join(lines)) for level, lines in runs]

    def parts(passage):
        split = [passage, *re.split(r"\n[ \t]*\n", passage), *passage.split("\n")]
        return {" ".join(p.lower().split()) for p in split} - {""}

    out = {}
    for conv in {m[0] for m in messages}:
        mine = sorted((turn, levels(text or "")) for c, turn, text in messages if c == conv)
        said = {}
        for turn, runs in mine:
            whole = "\n\n".join(body.strip() for level, body in runs if level == 0 and body.strip())
            said[turn] = set().union(parts(whole), *[parts(body) for level, body in runs if level == 0])
        reply, quotes = {}, {}
        for turn, runs in mine:
            found = []
            for level, body in runs:
                best = [(len(p), min(o for o in said if p in said[o])) for p in parts(body) if level and any(p in s for s in said.values())]
                best = [b for b in best if b[1] < turn]
                if best:
                    found.append((level, *max(best)))
            quotes[turn] = len(found)
            reply[turn] = min(found, key=lambda f: (f[0], -f[1], -f[2]))[2] if found else None
        start = {}
        for turn, _ in mine:
            at = turn
            while reply[at] is not None:
                at = reply[at]
            start[turn] = at
        for place, turn in enumerate(sorted(start, key=lambda t: (start[t], t)), 1):
            out[conv, turn] = (quotes[turn], reply[turn], start[turn], place)
    return out
