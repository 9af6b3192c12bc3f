"""Neighbours and positions in a total order without sorting it in one task.

A window without PARTITION BY pulls every row into one task.  Here rows are
cut into buckets that follow the order; the window runs per bucket, and only
the first and last row of each bucket meet again to bridge the seams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def floor_div(value: Column, by: int) -> Column:
    """``value`` divided by ``by``, rounded down, in 64-bit integers."""
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by))


def with_neighbours(
    df: DataFrame,
    bucket: Column,
    order: Sequence[str],
    carry: Sequence[str],
    coarse: Column | None = None,
) -> DataFrame:
    """Add structs ``prev`` and ``next`` holding ``carry`` of the adjacent rows.

    ``order`` must be a total order and ``bucket`` monotone in it.  The structs
    are NULL at the two ends.  Where buckets themselves are many, ``coarse``
    buckets their edges once more.  Both branches read one shuffle.
    """
    # Names that cannot meet those of an outer call.
    depth = len(df.columns)
    own, value, own_prev, own_next = (f"__{n}{depth}" for n in ("bucket", "value", "prev", "next"))
    inside = Window.partitionBy(own).orderBy(*order)

    def sides(rows: DataFrame, window: Window) -> DataFrame:
        # One select, so both sides share a window.
        return rows.select(
            "*", F.lag(value).over(window).alias("prev"), F.lead(value).over(window).alias("next")
        )

    # Bucket and value are columns, so both branches below need the same columns
    # of the shuffle and it runs once.
    rows = sides(df.withColumn(own, bucket).withColumn(value, F.struct(*carry)), inside).drop(own)
    at_edge = F.col("prev").isNull() | F.col("next").isNull()
    edges = rows.where(at_edge).withColumnsRenamed({"prev": own_prev, "next": own_next})
    # The edge ahead of a bucket's first row is the last row of the bucket before.
    if coarse is None:
        edges = sides(edges, Window.orderBy(*order))
    else:
        edges = with_neighbours(edges, coarse, order, carry)
    bridged = edges.select(
        *df.columns,
        F.coalesce(own_prev, "prev").alias("prev"),
        F.coalesce(own_next, "next").alias("next"),
    )
    return rows.where(~at_edge).drop(value).unionByName(bridged)


def with_position(
    df: DataFrame, bucket: Column, order: Sequence[str], name: str = "idx"
) -> DataFrame:
    """Add the dense 0-based position of every row in ``order``."""
    rows = df.withColumn("__bucket", bucket)
    earlier = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("__bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("__bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__offset"))
    )
    inside = Window.partitionBy("__bucket").orderBy(*order)
    return (
        rows.withColumn("__n", F.row_number().over(inside))
        .join(offsets, "__bucket")
        .withColumn(name, F.col("__offset") + F.col("__n") - 1)
        .drop("__bucket", "__n", "__offset")
    )


def with_running_max(
    df: DataFrame, bucket: Column, order: Sequence[str], value: Column, name: str
) -> DataFrame:
    """Add the greatest ``value`` of all rows ahead in ``order``, NULL for the first.

    Inside a bucket it is a window; of each bucket one maximum goes on to the later ones.
    """
    rows = df.withColumn("__bucket", bucket).withColumn("__value", value)
    ahead = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy("__bucket")
        .agg(F.max("__value").alias("most"))
        .select("__bucket", F.max("most").over(ahead).alias("__before"))
    )
    inside = (
        Window.partitionBy("__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    own = rows.withColumn("__own", F.max("__value").over(inside)).join(before, "__bucket")
    return own.withColumn(name, F.greatest("__own", "__before")).drop(
        "__bucket", "__value", "__own", "__before"
    )
