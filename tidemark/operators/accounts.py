"""Company accounts: daily files covered by a longer file are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.order import floor_div, with_running_max
from tidemark.schemas import ACCOUNTS_HISTORY_START, ACCOUNTS_NAME_COLUMNS, DAILY_ACCOUNTS_LIKE


def accounts_dedup(accounts: DataFrame) -> DataFrame:
    """All rows of longer files, and daily rows whose start no longer file covers.

    The range condition becomes an equality on days: at most one range per start
    day is laid out into days.  Dates run from year 1 to 9999, so the covered
    days are under four million 4-byte values however large the accounts are;
    that is the bound that allows the broadcast.
    """
    longer = F.coalesce(~F.col("zip_url").like(DAILY_ACCOUNTS_LIKE), F.lit(False))
    covered = (
        accounts.where(longer & (F.col("zip_start") <= F.col("zip_end")))
        .groupBy("zip_start")
        .agg(F.max("zip_end").alias("zip_end"))
        .select(F.explode(F.sequence("zip_start", "zip_end")).alias("day"))
        .distinct()
    )
    dropped = (F.col("zip_start") == F.col("day")) & ~longer
    return accounts.join(F.broadcast(covered), dropped, "left_anti")


def accounts_dedup_asof(accounts: DataFrame, span_days: int = 4096) -> DataFrame:
    """The same without laying out days: each start looks up how far any range before it reaches.

    Longer ranges and the distinct starts of daily rows go into one order, in which the
    greatest end so far is carried on; a start is covered if that reaches it.  So nothing
    depends on how long ranges are, and what is sent to tasks, if Spark finds it small
    enough, are covered starts only.
    """
    longer = F.coalesce(~F.col("zip_url").like(DAILY_ACCOUNTS_LIKE), F.lit(False))
    ranges = (
        accounts.where(longer & (F.col("zip_start") <= F.col("zip_end")))
        .groupBy(F.col("zip_start").alias("day"))
        .agg(F.max("zip_end").alias("last"))
        .withColumn("kind", F.lit(0))
    )
    starts = accounts.where(~longer & F.col("zip_start").isNotNull()).select(F.col("zip_start").alias("day")).distinct()
    both = ranges.unionByName(
        starts.withColumns({"last": F.lit(None).cast("date"), "kind": F.lit(1)})
    )
    # A range that begins on the day itself is ahead of it.
    bucket = floor_div(F.unix_date("day").cast("bigint"), span_days)
    reach = with_running_max(both, bucket, ["day", "kind"], F.col("last"), "reach")
    covered = reach.where("kind = 1 and reach >= day").select("day")
    return accounts.join(covered, (F.col("zip_start") == F.col("day")) & ~longer, "left_anti")


def accounts_zip_counts(accounts: DataFrame, first: str, last: str) -> DataFrame:
    """Rows per archive whose range starts between two days."""
    return (
        accounts.where(
            F.col("zip_start").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        )
        .groupBy("zip_url", "zip_start", "zip_end")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("zip_start", "zip_url", "zip_end")
    )


def accounts_window(
    accounts: DataFrame, today: str, full_history: bool = False
) -> DataFrame:
    """Rows to publish: the two years up to the last full month, or everything up to it.

    The window is two literal dates by the time the plan is built, so it reaches
    the scan.
    """
    day = F.lit(today).cast("date")
    end = F.last_day(F.add_months(day, -1))
    start = (
        F.lit(ACCOUNTS_HISTORY_START).cast("date")
        if full_history
        else F.trunc(F.add_months(day, -24), "month")
    )
    return accounts.where((F.col("zip_start") >= start) & (F.col("zip_end") <= end)).drop(
        *ACCOUNTS_NAME_COLUMNS
    )
