"""Shape of the event log the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten(events: DataFrame) -> DataFrame:
    """Stored layout (nested ``event``) to the flat one; other columns pass through.

    Only renames struct fields, so filters and column pruning reach the scan.
    """
    rest = [c for c in events.columns if c != "event"]
    return events.select(
        F.col("event.timepoint").alias("timepoint"),
        F.col("event.type").alias("type"),
        F.col("event.published_at").alias("published_at"),
        *rest,
    )


def nest(ev: DataFrame) -> DataFrame:
    """Flat layout back to the stored one."""
    rest = [c for c in ev.columns if c not in ("timepoint", "type", "published_at")]
    return ev.select(*rest, F.struct("timepoint", "published_at", "type").alias("event"))


def is_live(type_col: str = "type"):
    """Not a tombstone; an event without a type is live."""
    return ~F.col(type_col).eqNullSafe(F.lit("deleted"))
