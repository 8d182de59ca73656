"""Personal data: patterns, and terms that give protected entities away.

Patterns find e-mail addresses, IP addresses, card and telephone numbers. Their values are the
protected entities. Corpus counts then say how much a term discloses of an entity: the pointwise
mutual information of term and entity over the information of the entity itself,
log(n(t,e) N / n(t) n(e)) / log(N / n(e)), is 1 for a term that stands only where the entity does.
Terms are counted with the entities of their whole text. A term whose disclosure of any entity reaches a
threshold is generalised wherever it occurs, in texts without the entity too; one above a second
threshold is removed.

Counts are over the whole corpus. A term or entity that a third of the texts
hold is summed within tasks before it is shuffled, and met by joins in which one side has one row per key.
Pairs are formed only of entities and terms whose own counts allow the support and the threshold. Terms
to mark are looked for with a filter of fixed size and confirmed by a join.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from fieldmosaic.llm.common import documents, identified, stored
from fieldmosaic.llm.registry import query

KINDS = ("email", "ip", "card", "phone", "term")
FILTER_BITS = 1 << 23
SUPPORT = 3  # texts that hold term and entity together, at least
GENERALIZE, REMOVE = 0.9, 0.99
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A run of digits is tried from its start only: what fails there fails inside as well.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Every word of letters and digits, of any length.
TERM = re.compile(r"[^\W_]+")
SPAN = "array<struct<start:int,stop:int,kind:string>>"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches: from each @ back over the local part, so a long run without one is read once."""
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            yield start, match.end()
            end = match.end()
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start, then kind."""
    found = [(s, e, "email") for s, e in _emails(text)]
    if any(c in text for c in "0123456789"):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((m.start(), m.end(), "ip"))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
        for m in PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def entity_of(text: str, span: tuple[int, int, str]) -> str:
    """Kind and value, spelling variants taken together."""
    value = text[span[0] : span[1]].lower()
    return f"{span[2]}:{value if span[2] in ('email', 'ip') else re.sub('[^0-9]', '', value)}"


def term_places(text: str, spans: list[tuple[int, int, str]]):
    """(start, end) of every term that does not lie inside a span."""
    starts, reach = [s for s, _, _ in spans], []
    for _, e, _ in spans:
        reach.append(max(e, reach[-1]) if reach else e)
    for m in TERM.finditer(text):
        k = bisect_right(starts, m.start())
        if not k or reach[k - 1] < m.end():
            yield m.span()


def terms_of(text: str, spans: list[tuple[int, int, str]]) -> set[str]:
    words = {text[s:e] for s, e in term_places(text, spans)} if spans else set(TERM.findall(text))
    return {word.lower() for word in words}


def _found(batches):
    """Per row: its spans and entities, and the terms of a text that holds any entity."""
    for batch in batches:
        out = []
        for key, doc, text in zip(batch["_key"], batch["_id"], batch["_text"]):
            spans = base_spans(text)
            entities = sorted({entity_of(text, s) for s in spans})
            out.append((key, doc, spans, entities, sorted(terms_of(text, spans)) if entities else []))
        yield pd.DataFrame(out, columns=["_key", "_id", "base", "entities", "words"])


def _term_counts(batches):
    """(term, rows that hold it), summed over a batch."""
    for batch in batches:
        total: Counter = Counter()
        for text in batch["_text"]:
            total.update(terms_of(text, base_spans(text)))
        yield pd.DataFrame({"term": list(total.keys()), "with_term": list(total.values())})


def disclosures(rows: DataFrame, found: DataFrame, support: int = SUPPORT, least: float = GENERALIZE) -> DataFrame:
    """(entity, term, disclosure) for the pairs whose disclosure reaches `least`, from identified rows and what `_found` says of them.

    A pair needs `support` different texts, so copies of one text give nothing away; the other
    counts are over rows. An entity of every row carries no information and discloses nothing.
    """
    total = found.count()
    held = found.where(F.size("entities") > 0)
    entities = held.select("_text_key", F.explode("entities").alias("entity")).groupBy("entity", "_text_key").agg(F.count("*").alias("n"))
    entities = stored(entities, "entities")
    often = entities.groupBy("entity").agg(F.sum("n").alias("with_entity"), F.count("*").alias("texts"))
    often = stored(often.where((F.col("texts") >= support) & (F.col("with_entity") < total)).drop("texts"), "often")
    shape = "entity string, term string, disclosure double"
    if often.isEmpty():
        return rows.sparkSession.createDataFrame([], shape)
    bearing = stored(entities.join(often, "entity"), "bearing")
    words = held.join(bearing.select("_text_key").distinct(), "_text_key", "left_semi").select("_text_key", "words").dropDuplicates(["_text_key"])
    words = stored(words.select("_text_key", F.explode("words").alias("term")), "words")
    shared = words.groupBy("term").agg(F.count("*").alias("texts")).where(F.col("texts") >= support).select("term")
    terms = rows.mapInPandas(_term_counts, "term string, with_term long").groupBy("term").agg(F.sum("with_term").alias("with_term"))
    terms = stored(terms.join(shared, "term", "left_semi"), "terms")
    whole = F.lit(float(total))
    # With both = min(with_term, with_entity) the disclosure is at its greatest: 1 for the rarer term, else log(N / n(t)) / log(N / n(e)).
    able = (F.col("with_term") <= F.col("with_entity")) | (F.log(whole / F.col("with_term")) >= (least - 1e-6) * F.log(whole / F.col("with_entity")))
    pairs = words.join(terms, "term").join(bearing, "_text_key").where(able)
    pairs = pairs.groupBy("entity", "term", "with_entity", "with_term").agg(F.sum("n").alias("both"), F.count("*").alias("texts")).where(F.col("texts") >= support)
    gain = F.log(F.col("both") * whole / (F.col("with_term") * F.col("with_entity")))
    rate = F.try_divide(gain, F.log(whole / F.col("with_entity")))
    return pairs.select("entity", "term", F.round(rate, 6).alias("disclosure")).where(F.col("disclosure") >= least)


def _filter_of(terms: DataFrame) -> bytes:
    """A bit for every checksum of a term, FILTER_BITS in all."""
    bit = F.crc32(F.col("term").cast("binary")) % FILTER_BITS
    blocks = terms.select(bit.alias("bit")).groupBy(F.expr("bit div 32768").alias("block")).agg(F.bitmap_construct_agg(F.col("bit") % 32768).alias("bits"))
    whole = bytearray(FILTER_BITS // 8)
    for row in blocks.collect():
        whole[row["block"] * 4096 : (row["block"] + 1) * 4096] = row["bits"]
    return bytes(whole)


def _occurrences(bits: bytes):
    """(_key, term, start, stop) for every term that passes the filter."""

    def run(batches):
        passes = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
        for batch in batches:
            out = []
            for key, text in zip(batch["_key"], batch["_text"]):
                if not any(passes[zlib.crc32(w.lower().encode("utf-8", "surrogatepass")) % FILTER_BITS] for w in set(TERM.findall(text))):
                    continue
                for s, e in term_places(text, base_spans(text)):
                    term = text[s:e].lower()
                    if passes[zlib.crc32(term.encode("utf-8", "surrogatepass")) % FILTER_BITS]:
                        out.append((key, term, s, e))
                if len(out) >= 50_000:
                    yield pd.DataFrame(out, columns=["_key", "term", "start", "stop"])
                    out = []
            yield pd.DataFrame(out, columns=["_key", "term", "start", "stop"])

    return run


def marks_of(rows: DataFrame, known: DataFrame, remove: float = REMOVE) -> DataFrame:
    """(_key, terms): every occurrence of a term that discloses an entity, in any text."""
    shape = "_key string, term string, start int, stop int"
    terms = known.groupBy("term").agg((F.max("disclosure") >= remove).alias("remove"))
    if known.isEmpty():
        occurs = rows.sparkSession.createDataFrame([], shape)
    else:
        occurs = rows.mapInPandas(_occurrences(_filter_of(terms)), shape)
    marks = occurs.join(terms, "term").groupBy("_key").agg(F.array_sort(F.array_distinct(F.collect_list(F.struct("start", "stop", "remove")))).alias("terms"))
    return stored(marks, "marks")


def find_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", support: int = SUPPORT, generalize: float = GENERALIZE, remove: float = REMOVE) -> DataFrame:
    """One row per row of `docs`: _key, id, base, terms (spans of terms that give any entity away, with `remove`).

    Spans are code points, end exclusive. A null text counts as empty and has none; rows with
    equal id and text have equal spans; null ids are allowed.
    """
    rows = identified(docs, doc_id, text)
    kind = rows.schema["_id"].dataType.simpleString()
    found = rows.mapInPandas(_found, f"_key string, _id {kind}, base {SPAN}, entities array<string>, words array<string>")
    found = stored(found.withColumn("_text_key", F.substring_index("_key", ":", -1)), "found")
    known = stored(disclosures(rows, found, support, generalize), "disclosures")
    marks = marks_of(rows, known, remove)
    joined = found.select("_key", F.col("_id").alias("id"), "base").join(marks, "_key", "left")
    return joined.withColumn("terms", F.coalesce("terms", F.array().cast("array<struct<start:int,stop:int,remove:boolean>>")))


def _masked(text: pd.Series, base: pd.Series, terms: pd.Series) -> pd.Series:
    out = []
    for whole, spans, words in zip(text, base, terms):
        cuts = sorted([(s["start"], s["stop"], f"[{s['kind'].upper()}]") for s in spans] + [(w["start"], w["stop"], "" if w["remove"] else "[TERM]") for w in words])
        parts, at = [], 0
        for start, stop, mask in cuts:
            if start >= at:
                parts += [whole[at:start], mask]
            at = max(at, stop)
        out.append("".join(parts) + whole[at:])
    return pd.Series(out)


def sanitize(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **thresholds) -> DataFrame:
    """(id, text) with entities and generalised terms replaced by their kind and disclosing terms removed; null texts become empty."""
    spans = find_spans(docs, doc_id, text, **thresholds).select("_key", "base", "terms").dropDuplicates(["_key"])
    mask = F.pandas_udf(_masked, "string")
    return identified(docs, doc_id, text).join(spans, "_key").select(F.col("_id").alias("id"), mask("_text", "base", "terms").alias("text"))


def _listing(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))


@query("op4_pii")
def op4_pii(spark, sf_dir):
    found = find_spans(documents(spark, sf_dir))
    rank = F.create_map(*[F.lit(x) for k, kind in enumerate(KINDS) for x in (kind, k)])
    terms = F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["stop"].alias("stop"), F.lit("term").alias("kind")))
    keyed = F.transform(F.concat("base", terms), lambda s: F.struct(s["start"].alias("start"), F.element_at(rank, s["kind"]).alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    counts = [F.size(F.expr(f"filter(base, s -> s.kind = '{kind}')")).cast("long").alias(f"n_{kind}") for kind in KINDS[:4]]
    digest = F.sha2(_listing(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return found.select(F.col("id").alias("doc_id"), *counts, digest, _listing(F.array_sort(keyed)).alias("spans"), F.size("terms").alias("n_term"))
