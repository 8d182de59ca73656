"""Repair of conversations by a square-root checkpointed dynamic programme.

A repaired conversation is empty or an optional system turn and then pairs of a user and an assistant
turn. What is left to pay from each of four states (nothing yet, after system, after user, after
assistant) is a vector before every row; it is computed from the end backwards, but kept only at
every sqrt(n)-th row. The walk forward recomputes one block of vectors at a time and emits the
ASCII-least edits that are tight, that is, whose price and what is left after them add up.

Rows are range partitioned by conversation and turn, so a conversation of any length is cut over
partitions; equal rows are one row with a count. The part of a conversation in a partition is a
4 x 4 matrix of least prices, from which the vectors at the cuts follow; two rows per partition
reach the driver for that, and one short walk hands every part the state it starts in.
"""

from __future__ import annotations

import hashlib
import math
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fieldmosaic.llm.common import documents, stored
from fieldmosaic.llm.registry import query
from fieldmosaic.runtime import materialize

NONE, SYSTEM, USER, ASSISTANT = range(4)  # states, by the last turn
FREE = (USER, USER, ASSISTANT, USER)  # the state an inserted or renamed turn leads to
NAMES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
RENAME, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
FAR = 1 << 60
PIECE_ROWS, PIECE_CHARS = 50_000, 1 << 23
BLANKS = " \t\n\x0b\f\r"
Vector = list[int]


def next_state(state: int, initial: int) -> int | None:
    """Where a turn that keeps its role leads, if anywhere; 0 stands for any other initial."""
    if initial == SYSTEM:
        return SYSTEM if state == NONE else None
    return initial if initial and FREE[state] == initial else None


def closed(v: Vector) -> Vector:
    """Least prices if turns may be inserted first; more than two in a row never help."""
    user, assistant = min(v[USER], v[ASSISTANT] + INSERT), min(v[ASSISTANT], v[USER] + INSERT)
    return [min(v[NONE], user + INSERT), min(v[SYSTEM], user + INSERT), user, assistant]


END = closed([0, FAR, FAR, 0])


def before(row: tuple, v: Vector) -> Vector:
    """The vector before a row (initial, head, gone): a turn that may stay (head 1, or 2 if cut off), then `gone` turns that may not."""
    initial, head, gone = row
    v = [x + DELETE * gone for x in v]
    if head:
        more, after = CUT_OFF * (head == 2), v
        v = [min(after[q] + DELETE, after[FREE[q]] + RENAME + more) for q in range(4)]
        for q in range(4):
            to = next_state(q, initial)
            if to is not None:
                v[q] = min(v[q], after[to] + more)
    return closed(v)


def matrix(rows: list[tuple]) -> list[Vector]:
    """Least price from each state before the rows to each state right after them."""
    columns = []
    for state in range(4):
        v = [0 if q == state else FAR for q in range(4)]
        for row in reversed(rows):
            v = before(row, v)
        columns.append(v)
    return [[min(columns[to][q], FAR) for to in range(4)] for q in range(4)]


def through(prices: list[Vector], v: Vector) -> Vector:
    """The vector before the rows of a matrix, given the one after them."""
    return [min(p + x for p, x in zip(line, v)) for line in prices]


def walk(rows: list[tuple], state: int, end: Vector, last: bool):
    """(letter, row number or None, state after it) of the cheapest, then ASCII-least edits; `last` closes the conversation."""
    size = max(1, math.isqrt(len(rows)))
    marks = {len(rows): end}
    v = end
    for k in range(len(rows) - 1, -1, -1):
        v = before(rows[k], v)
        if k % size == 0:
            marks[k] = v
    for start in range(0, len(rows), size):
        stop = min(start + size, len(rows))
        block = [marks[stop]]
        for k in range(stop - 1, start - 1, -1):
            block.append(before(rows[k], block[-1]))
        block.reverse()
        for k in range(start, stop):
            initial, head, gone = rows[k]
            here, after = block[k - start], [x + DELETE * gone for x in block[k - start + 1]]
            while head:
                if after[state] + DELETE == here[state]:
                    yield "D", k, state
                    break
                if here[FREE[state]] + INSERT == here[state]:
                    state = FREE[state]
                    yield "I", None, state
                    continue
                to = next_state(state, initial)
                if to is not None and after[to] + CUT_OFF * (head == 2) == here[state]:
                    state = to
                    yield "K", k, state
                    break
                state = FREE[state]
                yield "R", k, state
                break
            for _ in range(gone):
                yield "D", k, state
    while last and state not in (NONE, ASSISTANT):
        state = FREE[state]
        yield "I", None, state


def placed(rows: DataFrame, conv_id: str, turn: str, role: str, text: str, copies: Column) -> DataFrame:
    """Distinct rows with their counts and faults, in order, cut into partitions `_pid` that stay as they are."""
    filled = rows.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))), copies.cast("long").alias("n"))
    none = F.col("n") == 0  # only the conversation remains
    kinds = dict(filled.dtypes)
    bare = filled.select("conv", *(F.when(~none, F.col(c)).otherwise(F.lit(x).cast(kinds[c])).alias(c) for c, x in (("turn", None), ("role", ""), ("text", ""))), "n")
    some = bare.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))
    body = F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"))
    some = some.withColumn("body", body)
    again = some.where("n > 0").groupBy("conv", "body").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("first"), F.count("*").alias("turns"))
    again = again.where("turns > 1").select(F.col("conv").alias("conv_"), F.col("body").alias("body_"), F.col("first.turn").alias("first"), F.lit(True).alias("repeated"))
    some = some.join(again, F.col("conv").eqNullSafe(F.col("conv_")) & (F.col("body") == F.col("body_")), "left")
    fresh = F.col("repeated").isNull() | F.col("turn").eqNullSafe(F.col("first"))
    tight = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(tight == "", "blank").when(F.substring(tight, -1, 1).isin(".", "!", "?"), "none").otherwise("truncated")
    order = ["conv", "turn", "role", "_front", "body"]
    some = some.select("conv", "turn", "role", "text", "n", "body", fresh.alias("fresh"), fault.alias("fault"), F.substring("text", 1, 64).alias("_front"))
    some = some.repartitionByRange(*order).sortWithinPartitions(*order).drop("_front", "body")
    return materialize(some.withColumn("_pid", F.spark_partition_id()))


def _parts(batches):
    """(conversation, its rows in this partition, types of the columns), in order."""
    kinds = {}

    def rows():
        for batch in batches:
            kinds.update(zip(batch.schema.names, batch.schema.types))
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "n", "fresh", "fault", "_pid")))

    for conv, group in groupby(rows(), key=lambda r: r[0]):
        yield conv, list(group), kinds


def light(row: tuple) -> tuple[int, int, int]:
    """(initial, head, gone) of a distinct row."""
    _, _, role, _, n, fresh, fault, _ = row
    head = int(n > 0 and fresh and fault != "blank") and (2 if fault == "truncated" else 1)
    return INITIALS.get(role[:1], NONE), head, n - (head > 0)


def _ends(batches):
    """Of the first and the last conversation of the partition: prices, the last role and turn."""
    kept = []
    for conv, rows, kinds in _parts(batches):
        del kept[1:]
        kept.append((conv, rows))
    for conv, rows in kept:
        roles, turns = [r[2][:1] for r in rows if r[4]], [r[1] for r in rows if r[4] and r[1] is not None]
        prices = [x for line in matrix([light(r) for r in rows]) for x in line]
        values = rows[0][7], conv, prices, (roles or [None])[-1], (turns or [None])[-1]
        fields = [("pid", pa.int32()), ("conv", kinds["conv"]), ("prices", pa.list_(pa.int64())), ("role", pa.string()), ("turn", kinds["turn"])]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, (_, k) in zip(values, fields)], [n for n, _ in fields])


def _exits(ends: dict[tuple, Vector]):
    """Of each part in `ends`: the states its walk leaves from, by the state it starts in."""

    def run(batches):
        for conv, rows, kinds in _parts(batches):
            end = ends.get((rows[0][7], conv))
            if end is not None:
                plain, out = [light(r) for r in rows], []
                for state in range(4):
                    for _, _, state in walk(plain, state, end, False):
                        pass
                    out.append(state)
                yield pa.RecordBatch.from_arrays([pa.array([rows[0][7]], pa.int32()), pa.array([conv], kinds["conv"]), pa.array([out], pa.list_(pa.int32()))], ["pid", "conv", "states"])

    return run


def _links(rows: DataFrame) -> dict[tuple, tuple]:
    """(state, vector after it, whether it is the last, role and turn before it) of every part of a conversation that is cut.

    Two rows per partition reach the driver, and one per cut.
    """
    kinds = dict(rows.dtypes)
    ends = rows.mapInArrow(_ends, f"pid int, conv {kinds['conv']}, prices array<long>, role string, turn {kinds['turn']}").collect()
    chains: list[list] = []
    for _, parts in groupby(sorted(ends, key=lambda r: r.pid), key=lambda r: r.pid):  # stable: first before last
        for k, part in enumerate(parts):
            if k == 0 and chains and chains[-1][-1].conv == part.conv:
                chains[-1].append(part)
            else:
                chains.append([part])
    chains = [c for c in chains if len(c) > 1]
    after: dict[tuple, Vector] = {}
    for chain in chains:
        v = END
        for part in reversed(chain):
            after[part.pid, part.conv] = v
            v = through([part.prices[4 * q : 4 * q + 4] for q in range(4)], v)
    inner = {key: after[key] for chain in chains for key in ((p.pid, p.conv) for p in chain[:-1])}
    exits = {}
    if inner:
        exits = {(r.pid, r.conv): r.states for r in rows.mapInArrow(_exits(inner), f"pid int, conv {kinds['conv']}, states array<int>").collect()}
    links = {}
    for chain in chains:
        state, role, turn = NONE, None, None
        for part in chain:
            key = part.pid, part.conv
            links[key] = state, after[key], part is chain[-1], role, turn
            state = exits[key][state] if key in exits else state
            role, turn = (part.role if part.role is not None else role), (part.turn if part.turn is not None else turn)
    return links


def _repaired(links: dict[tuple, tuple]):
    def run(batches):
        for conv, rows, kinds in _parts(batches):
            pid = rows[0][7]
            cut = (pid, conv) in links
            state, end, last, role, turn = links.get((pid, conv), (NONE, END, True, None, None))
            plain = [light(r) for r in rows]
            counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0}
            for (initial, head, gone), row in zip(plain, rows):
                n, first = row[4], row[2][:1]
                if not n:
                    continue
                counts["illegal"] += n - 1 + (role is not None and role + first not in ("su", "ua", "au"))
                counts["blank" if row[6] == "blank" else "duplicate"] += gone
                counts["truncated"] += head == 2
                counts["turns"] += row[1] is not None and row[1] != turn
                role, turn = first, turn if row[1] is None else row[1]
            known = [r[1] for r in rows if r[4] and r[1] is not None]
            rest = {**counts, "low": min(known, default=None), "high": max(known, default=None)}
            letters, roles, texts, cost, chars, piece = [], [], [], 0, 0, 0

            def emit(whole: bool):
                values = {"conv": conv, "pid": pid, "piece": piece, "whole": whole, "edits": "".join(letters), "roles": roles, "texts": texts, "cost": cost, **rest}
                types = {"conv": kinds["conv"], "pid": pa.int32(), "piece": pa.int32(), "whole": pa.bool_(), "edits": pa.string(), "roles": pa.list_(pa.string()), "texts": pa.list_(pa.string()), "low": kinds["turn"], "high": kinds["turn"]}
                return pa.RecordBatch.from_arrays([pa.array([v], types.get(c, pa.int64())) for c, v in values.items()], list(values))

            for letter, k, state in walk(plain, state, end, last):
                letters.append(letter)
                if letter == "D":
                    cost += DELETE
                    continue
                cost += {"K": 0, "R": RENAME, "I": INSERT}[letter] + (CUT_OFF if k is not None and plain[k][1] == 2 else 0)
                roles.append(rows[k][2] if letter == "K" else NAMES[state])
                texts.append("" if k is None else rows[k][3])
                chars += len(texts[-1])
                if chars >= PIECE_CHARS or len(letters) >= PIECE_ROWS:
                    yield emit(False)
                    letters, roles, texts, cost, chars, piece = [], [], [], 0, 0, piece + 1
                    rest = {c: None if c in ("low", "high") else 0 for c in rest}
            yield emit(not cut and not piece)

    return run


_COUNTS = ("cost", "blank", "duplicate", "truncated", "illegal", "turns")


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: Column | None = None) -> DataFrame:
    """Pieces of the repaired conversations, in the order of `pid` and `piece`.

    Columns: conv, pid, piece, `whole` (nothing else of this conversation), edits (a letter each), roles and
    texts of the turns that are left, cost, the counts of faults and of adjacent roles out of order, and low,
    high and number of the turns of the piece. `copies` says how often a row stands there (1 if not given); 0 keeps only its
    conversation, which then has a piece without edits. Null roles and texts are one space, null conversations
    are one conversation, rows without a turn come first; rows of one turn go by role, then text (its first
    64 characters, then a digest). Repeated rows are duplicates. An empty table has no pieces. Long texts are
    read by one task each; a part of a conversation has to fit into a partition, which the number of
    shuffle partitions sets. Other columns are not looked at.
    """
    found = placed(rows, conv_id, turn, role, text, F.lit(1) if copies is None else copies)
    kinds = dict(found.dtypes)
    schema = f"conv {kinds['conv']}, pid int, piece int, whole boolean, edits string, roles array<string>, texts array<string>, {', '.join(f'{c} long' for c in _COUNTS)}, low {kinds['turn']}, high {kinds['turn']}"
    return found.mapInArrow(_repaired(_links(found)), schema)


def _digests(batches):
    """One row per conversation out of its pieces, which come in order; texts go through the hash one piece at a time."""
    key, known = None, None

    def closed_row():
        names = list(known)
        columns = [pa.array([known[c]], kinds.get(c, pa.string())) for c in names]
        return pa.RecordBatch.from_arrays([*columns, pa.array([digest.hexdigest()], pa.string())], [*names, "sha256"])

    for batch in batches:
        kinds = dict(zip(batch.schema.names, batch.schema.types))
        for row in batch.to_pylist():
            if known is None or row["conv"] != key:
                if known is not None:
                    known["edits"] = "".join(known["edits"])
                    yield closed_row()
                key, digest, lines = row["conv"], hashlib.sha256(), 0
                known = {"conv": key, "edits": [], **dict.fromkeys(_COUNTS, 0), "low": None, "high": None}
            for name, body in zip(row["roles"], row["texts"]):
                digest.update(f"{chr(10) if lines else ''}{name}:{body}".encode())
                lines += 1
            known["edits"].append(row["edits"])
            for c in _COUNTS:
                known[c] += row[c]
            for c, best in (("low", min), ("high", max)):
                if row[c] is not None:
                    known[c] = row[c] if known[c] is None else best(known[c], row[c])
    if known is not None:
        known["edits"] = "".join(known["edits"])
        yield closed_row()


def digests(pieces: DataFrame) -> DataFrame:
    """One row per conversation: conv, edits, the sums of the counts, low, high and `sha256` of its `role:text` lines.

    Conversations in one piece stay where they are; the pieces of the others are dealt out by conversation and
    go through the hash in order, so memory holds a batch of pieces and the edits.
    """
    kinds = dict(pieces.dtypes)
    names = ["conv", "edits", *_COUNTS, "low", "high"]
    lines = F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t))
    one = pieces.where("whole").select(*names, F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("sha256"))
    more = pieces.where("not whole").repartition("conv").sortWithinPartitions("conv", "pid", "piece")
    return one.union(more.mapInArrow(_digests, ", ".join(f"{c} {kinds[c]}" for c in names) + ", sha256 string"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, by a checksum of conversation and turn; `n` is 0 for a dropped row, 2 for a repeated one."""
    place = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", None, "turn")))
    kind = F.crc32(place.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("n"))


def _remainder(byte: int) -> int:
    for _ in range(8):
        byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
    return byte


def _sql() -> str:
    """The same as one recursive query: per conversation and state the least (price, edits) so far, as a string of both."""
    table = ", ".join(str(_remainder(b)) for b in range(256))

    def longer(state: str, price: str, letters: str) -> str:
        return f"printf('%012d', CAST({state}[1:12] AS BIGINT) + {price}) || {state}[13:] || {letters}"

    def free(n: str, u: str, s: str, a: str) -> str:  # closed under inserted turns
        first = f"least({u}, {longer(n, '3', repr('I'))}, {longer(s, '3', repr('I'))})"
        return f"{n} AS n, {s} AS s, least({first}, {longer(a, '3', repr('I'))}) AS u, least({a}, {longer(first, '3', repr('I'))}) AS a"

    more = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    step = {q: longer(f"x.{q}", "4", "'D'") for q in "nsua"}

    def turn(sources: str, initial: str) -> str:
        ways = [longer(f"x.{q}", more, "'K'") for q in sources]
        renamed = [longer(f"x.{q}", f"3 + {more}", "'R'") for q in sources]
        kept = f"CASE WHEN initial = '{initial}' THEN least({', '.join(ways)}) END"
        return f"least({step[initial]}, CASE WHEN fault IN ('none', 'truncated') THEN least({kept}, {', '.join(renamed)}) END)"

    system = f"least({step['s']}, CASE WHEN fault IN ('none', 'truncated') AND initial = 's' THEN {longer('x.n', more, repr('K'))} END)"
    return rf"""
WITH RECURSIVE b AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda z: ord(z)) AS bytes FROM conversations),
c AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes::BIGINT[]), lambda z, y: xor(z >> 8, ([{table}]::BIGINT[])[(xor(z, y) & 255) + 1])), 4294967295) % 20 AS kind FROM b),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END AS n FROM c),
e AS (SELECT conv_id, turn, role, text, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS tight,
    row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, k) AS seen, lag(role) OVER w AS earlier
  FROM d, range(2) AS t(k) WHERE k < n WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), md5(len(role) || ':' || role || ':' || text), k)),
f AS (SELECT *, CASE WHEN tight = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(tight, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
    left(role, 1) AS initial, coalesce(left(earlier, 1) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS illegal FROM e),
g AS (SELECT conv_id, count(f.i) AS size, coalesce(max(f.turn) - min(f.turn) + 1 - count(DISTINCT f.turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (f.illegal) AS illegal
  FROM (SELECT DISTINCT conv_id AS conv_id FROM conversations) o LEFT JOIN f USING (conv_id) GROUP BY conv_id),
x AS (SELECT conv_id, 0::BIGINT AS i, '000000000000' AS n, NULL::VARCHAR AS s, '000000000003I' AS u, '000000000006II' AS a FROM g
  UNION ALL SELECT conv_id, i, {free('n', 'u', 's', 'a')}
  FROM (SELECT x.conv_id, f.i, {step['n']} AS n, {system} AS s, {turn('nsa', 'u')} AS u, {turn('u', 'a')} AS a FROM x JOIN f ON x.conv_id = f.conv_id AND f.i = x.i + 1)),
y AS (SELECT g.*, least(x.n, x.a) AS best FROM g JOIN x ON g.conv_id = x.conv_id AND x.i = g.size),
l AS (SELECT conv_id, p, best[12 + p] AS letter FROM (SELECT conv_id, best, unnest(range(1, len(best) - 11)) AS p FROM y)),
m AS (SELECT conv_id, p, letter, count(*) FILTER (letter <> 'I') OVER w AS row, count(*) FILTER (letter <> 'D') OVER w AS place,
    count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id) AS size FROM l WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
r AS (SELECT m.conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN f.role WHEN (size - place) % 2 = 0 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY p)) AS sha
  FROM m LEFT JOIN f ON m.conv_id = f.conv_id AND m.row = f.i WHERE letter <> 'D' GROUP BY m.conv_id)
SELECT y.conv_id, CAST(gaps AS BIGINT) AS gaps, blank, duplicate, truncated, illegal, CAST(best[1:12] AS BIGINT) AS cost, best[13:] AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM y LEFT JOIN r ON y.conv_id = r.conv_id"""


@query("op12_conversation_repair", _sql())
def op12_conversation_repair(spark, sf_dir):
    pieces = stored(repair(damaged(documents(spark, sf_dir, "conversations")), copies=F.col("n")), "pieces")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long")
    found = digests(pieces)
    return found.select(F.col("conv").alias("conv_id"), gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", F.col("edits").alias("audit"), F.col("sha256").alias("repaired_sha256"))
