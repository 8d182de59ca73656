"""URL filter: rules first, a ratio of two character language models for the rest. Built-in functions only.

Two smoothed variable-order Markov models, one of accepted and one of rejected urls, give each
character a probability after the longest context that was seen, backed off to shorter ones
(Witten-Bell). The sum of log ratios over a url, divided by its length, is compared with a
threshold that is calibrated on labelled urls the models have not seen.

Scores are computed once per distinct window (context and character) of the table, not per
position, and are whole micro-nats: sums do not depend on the order of the rows.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

from fieldmosaic.llm.common import documents, stored
from fieldmosaic.llm.registry import query
from fieldmosaic.runtime import spread

#: Rule and verdict; the longest rule that fits wins, at equal length the first in order of text.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
ORDER = 4  # characters of context at most
FOLDS = 5  # one in so many labelled urls calibrates the threshold
MICRO = 1_000_000
GRID = 20_000  # micro-nats between two thresholds
GRID_HALF = 250
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The rule that fits host and path, and its verdict; both null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _windows(urls: DataFrame, order: int) -> DataFrame:
    """One row per position: the character and up to `order` characters before it.

    Urls are lower-cased; characters outside ASCII count as one symbol, so the number of
    different windows is bounded by the alphabet, not by the table.
    """
    clean = F.concat(F.lit("\x02" * order), F.regexp_replace(F.translate(F.coalesce("_url", F.lit("")), UPPER, LOWER), r"[^\x20-\x7e]", "\x01"))
    cut = F.regexp_extract_all("_clean", F.lit(f"(?s)(?=(.{{{order + 1}}}))."), F.lit(1))  # one pass, however long
    return urls.withColumn("_clean", clean).select("*", F.explode(cut).alias("_window")).drop("_clean", "_url")


def _models(windows: DataFrame, order: int) -> DataFrame:
    """(context, side): total, number of different next characters, and counts by character, for every context length."""
    counted = windows.groupBy("_side", "_window").agg(F.count("*").alias("_n"))
    cuts = F.explode(F.sequence(F.lit(0), F.lit(order))).alias("_k")
    tails = counted.select("_side", "_window", "_n", cuts).select(
        "_side", "_n", F.expr(f"substring(_window, {order + 1} - _k, _k)").alias("context"), F.substring("_window", order + 1, 1).alias("next")
    )
    pairs = tails.groupBy("_side", "context", "next").agg(F.sum("_n").alias("_n"))
    after = F.map_from_entries(F.array_sort(F.collect_list(F.struct("next", "_n"))))
    return pairs.groupBy("_side", "context").agg(F.sum("_n").alias("total"), F.count("*").alias("kinds"), after.alias("after"))


def _ratios(windows: DataFrame, models: DataFrame, order: int) -> DataFrame:
    """Log ratio, accepted over rejected, of each distinct window, in micro-nats.

    P_k(c) = (n(c) + kinds * P_(k-1)(c)) / (total + kinds), an unseen context leaves P_(k-1), and
    P_(-1) is even over 97 symbols.
    """
    distinct = windows.select("_window").distinct()
    cuts = F.explode(F.sequence(F.lit(0), F.lit(order))).alias("_k")
    asked = distinct.select("_window", cuts).select("_window", "_k", F.expr(f"substring(_window, {order + 1} - _k, _k)").alias("context"), F.substring("_window", order + 1, 1).alias("next"))
    hits = asked.join(models, "context", "left").select(
        "_window", F.struct("_k", "_side", F.coalesce(F.try_element_at("after", F.col("next")), F.lit(0)).cast("double").alias("n"), F.col("total").cast("double").alias("total"), F.col("kinds").cast("double").alias("kinds")).alias("hit")
    )
    steps = hits.groupBy("_window").agg(F.array_sort(F.collect_list("hit")).alias("hits"))

    def chance(side: int) -> Column:
        return F.aggregate(F.filter("hits", lambda h: h["_side"].eqNullSafe(F.lit(side))), F.lit(1 / 97), lambda p, h: (h["n"] + h["kinds"] * p) / (h["total"] + h["kinds"]))

    return steps.select("_window", F.round((F.log(chance(1)) - F.log(chance(0))) * MICRO).cast("long").alias("_ratio"))


def url_scores(urls: DataFrame, order: int = ORDER) -> tuple[DataFrame, int]:
    """Score of every distinct `_url` (columns `_url`, `_side`: 1 accepted, 0 rejected, null unknown), and the threshold.

    The models learn from labelled urls outside fold 0; the threshold is the grid value with the
    least sum of both error rates on fold 0, the one nearest to zero among equals, zero without
    labels. Equal urls count once. Without labels of a side, its model is even over all symbols.
    """
    named = urls.groupBy("_url").agg(F.max("_side").alias("_side")).withColumn("_fold", F.pmod(F.crc32(F.coalesce("_url", F.lit("")).cast("binary")), F.lit(FOLDS)))
    named = named.withColumns({"_at": F.xxhash64("_url"), "_by": F.xxhash64("_url", F.lit(1))})  # stands for the url beside its windows
    named = stored(spread(named), "urls")  # dealt out: a url becomes many windows
    windows = _windows(named, order)
    models = stored(_models(windows.where("_side is not null and _fold <> 0"), order), "models")
    ratios = stored(_ratios(windows, models, order), "ratios")
    sums = windows.join(ratios, "_window").groupBy("_at", "_by").agg(F.sum("_ratio").alias("_sum"), F.count("*").alias("_len"))
    scored = named.join(sums, ["_at", "_by"], "left").select("_url", "_side", "_fold", F.expr("floor(coalesce(_sum, 0) / coalesce(_len, 1))").alias("_score"))
    scored = stored(scored, "scores")
    slot = F.greatest(F.lit(-GRID_HALF), F.least(F.lit(GRID_HALF), F.floor(F.col("_score") / GRID))).cast("int")
    tally = scored.where("_side is not null and _fold = 0").groupBy(slot.alias("slot")).agg(F.sum("_side").alias("good"), F.sum(1 - F.col("_side")).alias("bad"))
    return scored, calibrated([tuple(row) for row in tally.collect()])  # 501 rows at most


def calibrated(tally: list[tuple[int, int, int]]) -> int:
    """The threshold in micro-nats, from (slot, accepted, rejected) counts of the calibration urls."""
    goods, bads = sum(t[1] for t in tally) or 1, sum(t[2] for t in tally) or 1

    def error(cut: int) -> Fraction:
        return Fraction(sum(t[1] for t in tally if t[0] < cut), goods) + Fraction(sum(t[2] for t in tally if t[0] >= cut), bads)

    return min(range(-GRID_HALF, GRID_HALF + 2), key=lambda cut: (error(cut), abs(cut), cut)) * GRID


def judge_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES, order: int = ORDER) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, score (micro-nats per character, also where a rule decides).

    A url is accepted if its score reaches the threshold. A null or empty url has no host, no path and
    score 0. Repeated rows stay, equal urls have equal rows; a url may be of any length, in time
    proportional to it. Other columns of `pages` are not read, whatever their names.
    """
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).cast("string").alias("_url"))
    host, path = url_host(F.col("_url")), url_path(F.col("_url"))
    rule, says = matched_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"host": host, "path": path}).withColumns({"rule": rule, "_says": says})
    labelled = rows.select("_url", F.when(F.col("_says") == "allow", 1).when(F.col("_says") == "block", 0).alias("_side"))
    scored, threshold = url_scores(labelled, order)
    scored = scored.select(F.coalesce("_url", F.lit("")).alias("_name"), F.col("_url").isNull().alias("_none"), "_score", F.when(F.col("_score") >= threshold, "allow").otherwise("block").alias("_model"))
    keyed = rows.withColumns({"_name": F.coalesce("_url", F.lit("")), "_none": F.col("_url").isNull()})
    found = keyed.join(scored, ["_name", "_none"], "left")
    return found.select("id", "host", "path", "rule", F.coalesce("_says", "_model").alias("verdict"), F.col("_score").alias("score"))


@query("op1_url_filter")
def op1_url_filter(spark, sf_dir):
    return judge_urls(documents(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")
