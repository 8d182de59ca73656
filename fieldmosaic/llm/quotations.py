"""Quotation linking for chats and mail: quoted passages lead back to the messages they come from.

A message is split into passages of one quote level each. The text of level 0 is the message
itself; deeper passages are hashed in normalised form, whole, by paragraph and by line, and met
with the same hashes of the messages of the conversation. The original of a passage is the
earliest message that holds it, one row per hash after an aggregation, so a phrase that every
message of a huge conversation repeats joins with one row.
"""

from __future__ import annotations

import re

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from fieldmosaic.llm.common import documents, row_key, stored
from fieldmosaic.llm.registry import query
from fieldmosaic.operators.ranking import global_rank

MARK = re.compile(r"[ \t]*>")


def passages(text: str) -> list[tuple[int, str]]:
    """(level, text without marks) of the runs of lines with one quote level, in order."""
    runs: list[tuple[int, list[str]]] = []
    for line in text.split("\n"):
        level, at = 0, 0
        while match := MARK.match(line, at):
            level, at = level + 1, match.end()
        body = line[at:] if level == 0 else line[at:].removeprefix(" ")
        if runs and runs[-1][0] == level:
            runs[-1][1].append(body)
        else:
            runs.append((level, [body]))
    return [(level, "\n".join(lines)) for level, lines in runs]


def units(passage: str) -> dict[int, int]:
    """Hash and length of the passage, its paragraphs and its lines, in lower case with single blanks; empty ones are none."""
    found = {}
    for part in [passage, *re.split(r"\n[ \t]*\n", passage), *passage.split("\n")]:
        norm = " ".join(part.lower().split())
        if norm:
            code = xxhash.xxh3_64_intdigest(norm.encode("utf-8", "surrogatepass"))
            found[code - (1 << 64) if code >> 63 else code] = len(norm)
    return found


def body_of(text: str) -> str:
    """The text of level 0, without blank lines where quotes were cut."""
    return "\n\n".join(p.strip() for level, p in passages(text) if level == 0 and p.strip()) if ">" in text else text


def _units_of(batches):
    for batch in batches:
        rows = []
        for key, conv, turn, text in zip(batch["_key"], batch["_conv"], batch["_turn"], batch["_text"]):
            parts = passages(text)
            own = units(body_of(text))
            for level, part in parts:
                if level == 0:
                    own |= units(part)
            rows.extend((key, conv, turn, 0, 0, code, size) for code, size in own.items())
            for n, (level, part) in enumerate(parts):
                if level:
                    rows.extend((key, conv, turn, level, n, code, size) for code, size in units(part).items())
        yield pd.DataFrame(rows, columns=["_key", "_conv", "_turn", "level", "passage", "code", "size"])


def linked(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """One row per message: all its columns as struct `row`, `text` without quotes, `quotes`, `reply_to`, `thread`, `position`.

    `quotes` is the number of quoted passages with an original, `reply_to` the turn of the original of the
    largest part quoted at the lowest level that has one (the later turn among equals), null
    without one. `thread` is the turn that the chain of replies starts from and `position` the
    place in the conversation, threads in order of their start and replies after what
    they answer. Null texts count as empty. Messages without conversation or turn are not linked;
    those without conversation are ordered together, null turns first. Equal rows of one turn get equal links.
    """
    rows = messages.select(F.struct("*").alias("row"), F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    place = F.concat_ws("/", F.coalesce(F.col("_conv").cast("string"), F.lit("null")), F.coalesce(F.col("_turn").cast("string"), F.lit("null")))
    rows = rows.withColumn("_key", row_key(place, F.col("_text")))
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("_conv", "_turn")}
    schema = f"_key string, _conv {kinds['_conv']}, _turn {kinds['_turn']}, level int, passage int, code long, size int"
    found = stored(rows.where("_conv is not null and _turn is not null").select("_key", "_conv", "_turn", "_text").mapInPandas(_units_of, schema), "units")
    origins = found.where("level = 0").groupBy("_conv", "code").agg(F.min("_turn").alias("origin"))
    links = found.where("level > 0").dropDuplicates(["_key", "passage", "code"]).join(origins, ["_conv", "code"]).where("origin < _turn")
    best = links.groupBy("_key", "_conv", "_turn", "level", "passage").agg(F.max(F.struct("size", "origin")).alias("best"))
    replies = best.groupBy("_key", "_conv", "_turn").agg(F.count("*").alias("quotes"), F.min(F.struct("level", (-F.col("best.size")).alias("size"), (-F.col("best.origin")).alias("origin"))).alias("low"))
    replies = stored(replies.select("_key", "_conv", "_turn", "quotes", (-F.col("low.origin")).cast(kinds["_turn"]).alias("reply_to")), "replies")

    chain = stored(replies.groupBy("_conv", "_turn").agg(F.min("reply_to").alias("up")), "chain")
    while True:  # pointers double their reach, so rounds grow with the logarithm of the longest chain
        above = chain.select("_conv", F.col("_turn").alias("up"), F.col("up").alias("top"))
        longer = stored(chain.join(above, ["_conv", "up"], "left").select("_conv", "_turn", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")), "chain")
        chain = longer.drop("moved")
        if longer.where("moved").isEmpty():
            break
    strip = F.pandas_udf(lambda s: s.map(body_of), "string")
    bodies = F.when(F.col("_text").contains(">"), strip("_text")).otherwise(F.col("_text"))
    wide = rows.join(replies.select("_key", "quotes", "reply_to"), "_key", "left").join(chain, ["_conv", "_turn"], "left")
    wide = wide.select("row", "_conv", "_turn", "_key", bodies.alias("text"), F.coalesce("quotes", F.lit(0)).alias("quotes"), "reply_to", F.coalesce("up", "_turn").alias("thread"))
    ranked = global_rank(wide, [F.col("_conv"), F.col("thread"), F.col("_turn"), F.col("_key")], "_rank")
    first = ranked.groupBy(F.col("_conv").alias("_of")).agg(F.min("_rank").alias("_first"))
    done = ranked.join(first, F.col("_conv").eqNullSafe(F.col("_of")))
    return done.select("row", "text", "quotes", "reply_to", "thread", (F.col("_rank") - F.col("_first") + 1).alias("position"))


@query("op5_quotations")
def op5_quotations(spark, sf_dir):
    done = linked(documents(spark, sf_dir, "conversations"))
    return done.select("row.conv_id", "row.turn", "row.role", "quotes", "reply_to", "thread", "position", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
