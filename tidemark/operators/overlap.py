"""How deep file ranges overlap, and which files hold a timepoint.

Depth is a sweep: a range adds one where it begins and takes one off behind its end; running
sums, per bucket of the order and over the buckets, give the depth between any two such
places.  The files at a timepoint come from an index of aligned blocks: a range is cut
into the few largest blocks of doubling width that make it up, and a timepoint
lies in one block of each width, so looking up is an equi-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.order import floor_div, with_neighbours
from tidemark.operators.ranges import SPAN

#: Widths of blocks are 2**0 to 2**MOST_LEVEL.
MOST_LEVEL = 62


def overlap_depth(ranges: DataFrame, by: Sequence[str] = (), span: int = SPAN, least: int = 1) -> DataFrame:
    """``(by,) lo, hi, depth``: the maximal ranges that equally many of ``ranges`` (lo, hi) hold.

    Those fewer than ``least`` hold are left out.  Ranges whose end is before their start, or
    that lack one, hold nothing.  At most twice as many rows as there are ranges.
    """
    sound = ranges.where("lo <= hi")
    steps = sound.select(
        *by,
        F.inline(F.array(
            F.struct(F.col("lo").alias("at"), F.lit(1).alias("step")),
            F.struct((F.col("hi") + 1).alias("at"), F.lit(-1).alias("step")),
        )),
    )
    # Places where as many begin as end change nothing.
    places = steps.groupBy(*by, "at").agg(F.sum("step").alias("step")).where("step <> 0")
    places = places.withColumn("__span", floor_div(F.col("at"), span))
    upto = Window.unboundedPreceding
    inside = Window.partitionBy(*by, "__span").orderBy("at").rowsBetween(upto, Window.currentRow)
    # One row for each span of a group.
    earlier = Window.partitionBy(*by).orderBy("__span").rowsBetween(upto, -1)
    ahead = places.groupBy(*by, "__span").agg(F.sum("step").alias("step")).select(
        *by, "__span", F.coalesce(F.sum("step").over(earlier), F.lit(0)).alias("ahead")
    )
    keys = [F.col(f"p.`{c}`").eqNullSafe(F.col(f"s.`{c}`")) for c in (*by, "__span")]
    condition = keys[0]
    for k in keys[1:]:
        condition = condition & k
    running = places.withColumn("own", F.sum("step").over(inside)).alias("p").join(ahead.alias("s"), condition).select(
        *(F.col(f"p.`{c}`") for c in by), "p.at", (F.col("own") + F.col("ahead")).alias("depth")
    )
    group = F.struct(*by, floor_div(F.col("at"), span).alias("__part")) if by else floor_div(F.col("at"), span)
    order = [*by, "at"]
    after = with_neighbours(running, group, order, order)
    return after.where(F.col("depth") >= least).select(
        *by, F.col("at").alias("lo"), (F.col("next.at") - 1).alias("hi"), "depth"
    )


def _level(lo: Column, hi: Column) -> Column:
    """The widest aligned block that begins at ``lo`` and ends by ``hi``: its width is 2**level."""
    aligned = F.when(lo == 0, F.lit(MOST_LEVEL)).otherwise(F.bit_count(lo.bitwiseXOR(lo - 1)) - 1)
    room = F.length(F.bin(hi - lo + 1)) - 1
    return F.least(aligned, room).cast("int")


def stab_index(ranges: DataFrame, keep: Sequence[str] = ("file",)) -> DataFrame:
    """``level, block`` and the columns ``keep``: ranges (lo, hi) cut into aligned blocks.

    Not more than twice as many blocks for a range as its width has bits.  Timepoints are not
    negative; the part of a range below 0 is left out.
    """
    sound = ranges.where("lo <= hi and hi >= 0").withColumn("lo", F.greatest("lo", F.lit(0).cast("bigint")))

    def step(state: Column, _: Column) -> Column:
        at, hi = state["at"], F.col("hi")
        level = _level(at, hi)
        width = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        block = F.struct(level.alias("level"), F.call_function("shiftright", at, level).alias("block"))
        more = F.struct((at + width).alias("at"), F.array_append(state["blocks"], block).alias("blocks"))
        return F.when(at <= hi, more).otherwise(state)

    start = F.struct(
        F.col("lo").cast("bigint").alias("at"),
        F.expr("cast(array() as array<struct<level:int,block:bigint>>)").alias("blocks"),
    )
    # Blocks grow towards the middle of a range and shrink behind it.
    most = 2 * F.length(F.bin(F.col("hi") - F.col("lo") + 1))
    cut = F.aggregate(F.sequence(F.lit(1), most), start, step, lambda s: s["blocks"])
    return sound.select(*keep, F.inline(cut))


def files_at(index: DataFrame, timepoints: DataFrame) -> DataFrame:
    """``timepoint`` and the kept columns of every range in the index that holds it."""
    levels = F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(MOST_LEVEL)),
        lambda k: F.call_function("shiftright", F.col("timepoint"), k),
    ))
    wanted = timepoints.where("timepoint >= 0").select("timepoint", levels.alias("level", "block"))
    return wanted.distinct().join(index, ["level", "block"]).drop("level", "block")
