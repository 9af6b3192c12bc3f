"""Missing and duplicate ranges of timepoints, and breaks in their order.

Timepoints are nearly dense, so presence is kept as 64-bit masks: one row per
64 timepoints ("word") with the bits that occur and the number of rows.
Building it is one hash aggregation over fixed-width values, combined before
the shuffle: a sorted log shuffles one row per 64 timepoints, an unsorted one
never more than a plain DISTINCT would, and a single timepoint that holds a
third of the rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.names import common_start, name_bucket
from tidemark.functions.order import floor_div, with_neighbours
from tidemark.session import pin

# Timepoints per window partition.  One row per span meets in one task, so 10^11
# timepoints bring 10^5 rows together.
SPAN = 1 << 20


def _word(tp: Column) -> Column:
    return F.shiftright(tp, 6)


def timepoint_words(ev: DataFrame, *more: Column, by: Sequence[str] = ()) -> DataFrame:
    """``word, mask, odd, n, lo, hi`` for all timepoints of the log, or of each group ``by``.

    ``odd`` has the bits that occur an odd number of times.  ``more`` are further
    aggregates to take in the same pass; rows without a timepoint then make a word of
    their own, NULL.
    """
    tp = F.col("timepoint")
    bit = F.expr("shiftleft(1L, cast(timepoint & 63 as int))")
    rows = ev if more else ev.where(tp.isNotNull())
    return rows.groupBy(*by, _word(tp).alias("word")).agg(
        F.bit_or(bit).alias("mask"),
        F.bit_xor(bit).alias("odd"),
        F.count(tp).alias("n"),
        F.min(tp).alias("lo"),
        F.max(tp).alias("hi"),
        *more,
    )


def merged_words(words: DataFrame, *more: Column, by: Sequence[str] = ()) -> DataFrame:
    """Words of several logs, one row for each, as of all of them together."""
    return words.groupBy(*by, "word").agg(
        F.bit_or("mask").alias("mask"),
        F.bit_xor("odd").alias("odd"),
        F.sum("n").alias("n"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        *more,
    )


def words_summary(words: DataFrame, *more: Column) -> DataFrame:
    """Row count, exact distinct count and bounds of the whole log (one row)."""
    return words.agg(
        *more,
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.bit_count("mask").cast("bigint")), F.lit(0)).alias(
            "distinct_timepoints"
        ),
        F.min("lo").alias("min_tp"),
        F.max("hi").alias("max_tp"),
    ).withColumn("diff_timepoints", F.col("max_tp") - F.col("min_tp") + 1)


def missing_ranges(ev: DataFrame, span: int = SPAN) -> DataFrame:
    """Maximal ranges between the least and greatest timepoint that no event has."""
    return _missing(timepoint_words(ev), span)


_BITS = "transform(filter(sequence(0, 63), i -> getbit({}, i) = 1), i -> word * 64 + i)"


def _missing(words: DataFrame, span: int) -> DataFrame:
    # A word without an inner gap is one interval.  In any other one, runs begin at
    # bits without a lower neighbour and end at bits without a higher one.
    unbroken = F.col("hi") - F.col("lo") + 1 == F.bit_count("mask")
    runs = F.expr(
        "zip_with("
        + _BITS.format("mask & ~shiftleft(mask, 1)")
        + ", "
        + _BITS.format("mask & ~shiftrightunsigned(mask, 1)")
        + ", (lo, hi) -> named_struct('lo', lo, 'hi', hi))"
    )
    present = words.select(
        F.inline(F.when(unbroken, F.array(F.struct("lo", "hi"))).otherwise(runs))
    )
    ordered = with_neighbours(present, floor_div(F.col("lo"), span), ["lo"], ["hi"])
    return ordered.where("lo - prev.hi > 1").select(
        (F.col("prev.hi") + 1).alias("range_min"), (F.col("lo") - 1).alias("range_max")
    )


def duplicate_timepoints(ev: DataFrame) -> DataFrame:
    """Timepoints that occur more than once."""
    return _duplicates(pin(timepoint_words(ev), "words"), lambda: ev)


def _duplicates(words: DataFrame, log: Callable[[], DataFrame]) -> DataFrame:
    """Duplicated timepoints from ``words`` (pinned), as a rule without a second look at the log.

    A bit that is set but not odd occurs at least twice.  Where the rows beyond one per
    bit are as many as these bits, each occurs just twice and none is hidden among the
    odd ones.  Only if a word has more rows than that, the log is counted by timepoint,
    which combines copies before the shuffle.
    """
    twice = "mask & ~odd"
    extra = F.col("n") - F.bit_count("mask")
    settled = extra == F.bit_count(F.expr(twice))
    plain = words.where((extra > 0) & settled).select(
        F.explode(F.expr(_BITS.format(f"({twice})"))).alias("timepoint")
    )
    unclear = words.where(~settled).select("word")
    if unclear.isEmpty():
        return plain
    counted = (
        log()
        .where(F.col("timepoint").isNotNull())
        .groupBy("timepoint")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("timepoint", _word(F.col("timepoint")).alias("word"))
    )
    return plain.unionByName(counted.join(unclear, "word", "left_semi").select("timepoint"))


def duplicate_ranges(ev: DataFrame, span: int = SPAN) -> DataFrame:
    """Maximal runs of consecutive duplicated timepoints."""
    return _runs(duplicate_timepoints(ev), span)


def _runs(timepoints: DataFrame, span: int) -> DataFrame:
    """Maximal runs of distinct timepoints.

    Runs are found per span; only those that touch the edge of their span (two
    per span at most) are joined up across spans.
    """
    tp = F.col("timepoint")
    inside = Window.partitionBy("span").orderBy("timepoint")
    runs = (
        timepoints.withColumn("span", floor_div(tp, span))
        .withColumn("run", tp - F.row_number().over(inside))
        .groupBy("span", "run")
        .agg(F.min(tp).alias("lo"), F.max(tp).alias("hi"))
        .withColumn(
            "at_edge",
            (F.col("lo") == F.col("span") * span) | (F.col("hi") == (F.col("span") + 1) * span - 1),
        )
    )
    order = Window.orderBy("lo")
    starts = F.coalesce((F.col("lo") != F.lag("hi").over(order) + 1).cast("int"), F.lit(1))
    stitched = (
        runs.where("at_edge")
        .withColumn("starts", starts)
        .withColumn("whole", F.sum("starts").over(order))
        .groupBy("whole")
        .agg(F.min("lo").alias("range_min"), F.max("hi").alias("range_max"))
        .select("range_min", "range_max")
    )
    return (
        runs.where("not at_edge")
        .select(F.col("lo").alias("range_min"), F.col("hi").alias("range_max"))
        .unionByName(stitched)
    )


def timepoint_issues(ev: DataFrame, span: int = SPAN) -> DataFrame:
    """Missing and duplicate ranges by start, missing first where both start together.

    Both come from one pass over the log.
    """
    return issues_of_words(pin(timepoint_words(ev), "words"), lambda: ev, span)


def issues_of_words(
    words: DataFrame, log: Callable[[], DataFrame], span: int = SPAN
) -> DataFrame:
    """The same from ``words`` (pinned); the log is read only if a timepoint stands three times."""
    missing = _missing(words, span).withColumn("kind", F.lit("missing"))
    duplicate = _runs(_duplicates(words, log), span).withColumn("kind", F.lit("duplicate"))
    return (
        missing.unionByName(duplicate)
        .select("kind", "range_min", "range_max")
        .orderBy("range_min", F.col("kind").desc())
    )


def duplicate_range(ev: DataFrame) -> DataFrame:
    """Least and greatest duplicated timepoint (one row, NULLs if there is none)."""
    return duplicate_timepoints(ev).agg(
        F.min("timepoint").alias("min_duplicate"), F.max("timepoint").alias("max_duplicate")
    )


def bounds_of(dup: DataFrame) -> tuple[int | None, int | None]:
    """The two numbers of a one-row range.

    As literals they reach the scan, and the log is not searched for duplicates
    once per use.
    """
    least, greatest = dup.select("min_duplicate", "max_duplicate").head()
    return least, greatest


def order_breaks(lines: DataFrame, start: int | None = None, span: int = SPAN) -> DataFrame:
    """Events that do not follow the one before them in arrival order by exactly one.

    ``lines`` has ``file, line_no, timepoint``; files follow each other by name.
    The very first event is compared with ``start``, if given.  A file is cut
    into spans of lines, so one that holds a third of the log is many partitions.
    """
    events = lines.where(F.col("timepoint").isNotNull()).select("file", "line_no", "timepoint")
    ordered = with_neighbours(
        events,
        F.struct("file", floor_div(F.col("line_no"), span).alias("part")),
        ["file", "line_no"],
        ["timepoint"],
        coarse=name_bucket(F.col("file"), common_start(events)),
    )
    previous = F.col("prev.timepoint")
    if start is not None:
        previous = F.coalesce(previous, F.lit(start - 1))
    return ordered.select(
        "file", "line_no", previous.alias("prev_tp"), F.col("timepoint").alias("tp")
    ).where("tp <> prev_tp + 1")
