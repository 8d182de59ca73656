"""Segments of a ring that cross each other, found in cells.

A ring is cut into cells until a cell holds few segments: a full cell is halved across the side along which
its segments reach least, so a long thin segment stays in few cells. Pairs are compared within a cell
only.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from fieldmosaic.runtime import materialize

FULL = 32  # segments of a cell that are compared with each other
MAX_ROUNDS = 40
SLACK = 1e-9  # of a cell's side: pieces that end at a border belong to both halves


def segment_cells(lines: DataFrame, ring: list[str], full: int = FULL) -> DataFrame:
    """`lines` (ring, seq, x1, y1, x2, y2) once per cell they run through, with the number `cell`.

    A round counts the segments of every cell, in every task before the shuffle, and halves the full
    ones. A cell stays as it is when halving would double nearly all of its pieces, as then all of them
    run side by side through it.
    """
    box = lines.groupBy(*ring).agg(
        F.min(F.least("x1", "x2")).alias("cx0"), F.max(F.greatest("x1", "x2")).alias("cx1"),
        F.min(F.least("y1", "y2")).alias("cy0"), F.max(F.greatest("y1", "y2")).alias("cy1"))
    whole = F.struct(F.col("x1").alias("ax"), F.col("y1").alias("ay"), F.col("x2").alias("bx"), F.col("y2").alias("by"))
    active = lines.join(box, ring).select("*", whole.alias("p"), F.lit("1").cast("decimal(38,0)").alias("cell"))
    done: list[DataFrame] = []
    names = [*lines.columns, "cell"]
    for _ in range(MAX_ROUNDS):
        active = materialize(active)
        reach = lambda a, b, lo, hi: F.sum(F.try_divide(F.abs(F.col(f"p.{a}") - F.col(f"p.{b}")), F.col(hi) - F.col(lo)))
        sizes = active.groupBy(*ring, "cell").agg(F.count("*").alias("n"), reach("ax", "bx", "cx0", "cx1").alias("rx"), reach("ay", "by", "cy0", "cy1").alias("ry"))
        shortest = F.least(F.coalesce("rx", F.col("n")), F.coalesce("ry", F.col("n")))
        crowded = sizes.where((F.col("n") > full) & (shortest < 0.9 * F.col("n"))).select(*ring, "cell", (F.coalesce("rx", F.col("n")) <= F.coalesce("ry", F.col("n"))).alias("across"))
        crowded = materialize(crowded)
        if crowded.isEmpty():
            break
        done.append(active.join(crowded, [*ring, "cell"], "left_anti").select(*names))
        active = _halves(active.join(crowded, [*ring, "cell"]))
    return reduce(DataFrame.union, done, active.select(*names))


def _halves(rows: DataFrame) -> DataFrame:
    """Every piece in the half, or the halves, of its cell it runs through, cut at the border."""
    lo, hi = (F.when(F.col("across"), F.col(f"cx{k}")).otherwise(F.col(f"cy{k}")) for k in (0, 1))
    rows = rows.withColumns({"_mid": (lo + hi) / 2, "_pad": (hi - lo) * SLACK})
    a, b = (F.when(F.col("across"), F.col(f"p.{k}x")).otherwise(F.col(f"p.{k}y")) for k in "ab")
    low, high = F.least(a, b), F.greatest(a, b)
    share = F.try_divide(F.col("_mid") - a, b - a)
    met = F.struct((F.col("p.ax") + share * (F.col("p.bx") - F.col("p.ax"))).alias("x"), (F.col("p.ay") + share * (F.col("p.by") - F.col("p.ay"))).alias("y"))
    crosses = (low < F.col("_mid")) & (high > F.col("_mid"))

    def piece(first: Column) -> Column:
        """The part on a's side, or on b's."""
        end = lambda k, mine: F.struct(F.when(crosses & ~mine, met.x).otherwise(F.col(f"p.{k}x")).alias("x"), F.when(crosses & ~mine, met.y).otherwise(F.col(f"p.{k}y")).alias("y"))
        one, two = end("a", first), end("b", ~first)
        return F.struct(one.x.alias("ax"), one.y.alias("ay"), two.x.alias("bx"), two.y.alias("by"))

    side = lambda upper, inside: F.struct(F.lit(upper).alias("upper"), piece((a >= F.col("_mid")) if upper else (a <= F.col("_mid"))).alias("p"), inside.alias("in"))
    both = F.array(side(False, low <= F.col("_mid") + F.col("_pad")), side(True, high >= F.col("_mid") - F.col("_pad")))
    cut = rows.select(*[c for c in rows.columns if c != "p"], F.explode(both).alias("_h")).where("_h.in")
    border = {f"c{axis}{k}": F.when((F.col("across") == F.lit(axis == "x")) & (F.col("_h.upper") == F.lit(k == 0)), F.col("_mid")).otherwise(F.col(f"c{axis}{k}")) for axis in "xy" for k in (0, 1)}
    cell = (F.col("cell") * 2 + F.col("_h.upper").cast("int")).cast("decimal(38,0)")
    return cut.withColumns(border).withColumns({"p": F.col("_h.p"), "cell": cell}).drop("_h", "_mid", "_pad", "across")


def crossing_pairs(lines: DataFrame, ring: list[str], full: int = FULL) -> DataFrame:
    """(ring, seq, other, x, y) of every two segments of a ring that properly cross, seq < other; (x, y) is where.

    Segments that only touch or overlap do not count.
    """
    cells = segment_cells(lines, ring, full)
    one, two = cells, cells.withColumnsRenamed({c: f"_{c}" for c in ("seq", "x1", "y1", "x2", "y2")})
    apart = [F.greatest(f"{v}1", f"{v}2") < F.least(f"_{v}1", f"_{v}2") for v in "xy"] + [F.greatest(f"_{v}1", f"_{v}2") < F.least(f"{v}1", f"{v}2") for v in "xy"]
    met = one.join(two, [*ring, "cell"]).where((F.col("seq") < F.col("_seq")) & reduce(and_, [~a for a in apart]))
    side = lambda p, q, r: (F.col(f"{r[0]}") - F.col(f"{p[0]}")) * (F.col(f"{q[1]}") - F.col(f"{p[1]}")) - (F.col(f"{r[1]}") - F.col(f"{p[1]}")) * (F.col(f"{q[0]}") - F.col(f"{p[0]}"))
    a, b, c, d = ("x1", "y1"), ("x2", "y2"), ("_x1", "_y1"), ("_x2", "_y2")
    met = met.withColumns({"_s": side(a, b, c), "_t": side(a, b, d), "_u": side(c, d, a), "_v": side(c, d, b)})
    met = met.where((F.col("_s") * F.col("_t") < -1e-22) & (F.col("_u") * F.col("_v") < -1e-22))
    share = F.col("_u") / (F.col("_u") - F.col("_v"))
    spot = {v: F.col(f"{v}1") + share * (F.col(f"{v}2") - F.col(f"{v}1")) for v in "xy"}
    return met.select(*ring, "seq", F.col("_seq").alias("other"), spot["x"].alias("x"), spot["y"].alias("y")).dropDuplicates([*ring, "seq", "other"])
