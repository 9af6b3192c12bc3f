"""Undo a double load: confirm it, plan it, take the range out again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.events import flatten, nest
from tidemark.operators.files import file_contiguity
from tidemark.operators.ranges import (
    bounds_of,
    duplicate_range,
    duplicate_timepoints,
    timepoint_words,
    words_summary,
)


def ledger_missing(wanted: DataFrame, ledger: DataFrame) -> DataFrame:
    """Wanted files the ledger does not know."""
    known = ledger.where(F.col("file").isNotNull()).select("file")
    return wanted.select("file").join(known, "file", "left_anti")


FLAGS = ("range_match", "contiguous", "all_duplicated", "all_in_ledger")


def confirm_double_load(
    ev: DataFrame, rng: DataFrame, ledger: DataFrame, twice: DataFrame | None = None
) -> DataFrame:
    """Are the files ``rng`` exactly the doubly loaded part of the log (one row of flags).

    Their range is the duplicate range, they follow each other without a gap,
    every timepoint in it is duplicated, and all of them were loaded.  One pass over
    the log, or none with its duplicate timepoints ``twice`` (pinned).
    """
    lo, hi = rng.agg(F.min("lo"), F.max("hi")).head()
    doubled = (duplicate_timepoints(ev) if twice is None else twice).agg(
        F.min("timepoint").alias("least"),
        F.max("timepoint").alias("greatest"),
        F.count_if(F.col("timepoint").between(lo, hi)).alias("inside"),
    )
    broken = file_contiguity(rng).agg(
        F.count_if(~F.coalesce("contiguous", F.lit(True))).alias("breaks")
    )
    unknown = ledger_missing(rng, ledger).agg(F.count(F.lit(1)).alias("unknown"))
    return doubled.select(
        F.coalesce((F.col("least") == lo) & (F.col("greatest") == hi), F.lit(False)).alias(
            "range_match"
        ),
        (broken.scalar() == 0).alias("contiguous"),
        F.coalesce(F.col("inside") == F.lit(hi) - F.lit(lo) + 1, F.lit(False)).alias(
            "all_duplicated"
        ),
        (unknown.scalar() == 0).alias("all_in_ledger"),
    )


def require_confirmed(ev: DataFrame, rng: DataFrame, ledger: DataFrame) -> None:
    """Raise unless the files ``rng`` are exactly what was loaded twice."""
    flags = confirm_double_load(ev, rng, ledger).head()
    wrong = [name for name in FLAGS if not flags[name]]
    if wrong:
        raise ValueError(f"not a confirmed double load: {', '.join(wrong)} does not hold")


def _within(dup: DataFrame) -> Column:
    least, greatest = bounds_of(dup)
    if least is None:
        return F.lit(False)
    return F.col("timepoint").between(least, greatest)


def correction_plan(ev: DataFrame, dup: DataFrame) -> DataFrame:
    """What taking the duplicate range out would delete; changes nothing."""
    least, greatest = bounds_of(dup)
    expected = None if least is None else greatest - least + 1
    return words_summary(timepoint_words(ev.where(_within(dup)))).select(
        F.col("row_count").alias("rows_to_delete"),
        F.col("distinct_timepoints").alias("distinct_in_range"),
        F.lit(expected).cast("bigint").alias("expected_after"),
    )


def apply_correction(
    ev: DataFrame, ledger: DataFrame, rng: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Log without the files ``rng`` and ledger without them, to be loaded again once.

    Refused (ValueError) unless they are confirmed.  Both copies of their rows go, by
    file and range; write the results as a new version of the two tables.
    """
    require_confirmed(ev, rng, ledger)
    lo, hi = rng.agg(F.min("lo"), F.max("hi")).head()
    files = rng.select("file")
    inside = F.col("timepoint").between(lo, hi)
    kept = ev.where(~F.coalesce(inside, F.lit(False))).unionByName(
        ev.where(inside).join(files, "file", "left_anti").select(*ev.columns)
    )
    return kept, ledger.join(files, "file", "left_anti")


def rewrite_without_range(
    events: DataFrame, rng: DataFrame, out_dir: str, ledger: DataFrame
) -> DataFrame:
    """Apply a correction to a stored table: write the next version, then check it.

    Nothing is overwritten, so a failed run leaves the old version as it was.
    Returns the duplicate range that remains (NULLs when the log is clean).
    """
    spark = events.sparkSession
    kept, unloaded = apply_correction(flatten(events), ledger, rng)
    nest(kept).write.parquet(f"{out_dir}/rows")
    unloaded.write.parquet(f"{out_dir}/ledger")
    return duplicate_range(flatten(spark.read.parquet(f"{out_dir}/rows")))
