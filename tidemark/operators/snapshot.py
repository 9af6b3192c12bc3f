"""Latest state per resource, as a rebuild or incrementally."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.json import field
from tidemark.operators.events import is_live
from tidemark.schemas import check_stream


def newest_rows(ev: DataFrame, key: str = "resource_uri") -> DataFrame:
    """The row with the greatest timepoint of every key, tombstones included.

    ``row_number() = 1`` lets Catalyst limit every key to one row per input
    partition before the shuffle, so a key that holds a third of the log adds
    one row per task to its reducer.  Rows that tie on the timepoint are
    ordered by content, so the choice does not depend on the run.  Keys begin
    alike (they are paths); sorting by their hash first spares most of the
    comparisons of whole strings.
    """
    ties = [c for c in ("published_at", "type", "data", "file") if c in ev.columns]
    newest_first = Window.partitionBy("__hash", key).orderBy(
        F.col("timepoint").desc(), *(F.col(c).desc() for c in ties)
    )
    return (
        ev.withColumn("__hash", F.xxhash64(key))
        .withColumn("__rank", F.row_number().over(newest_first))
        .where("__rank = 1")
        .drop("__rank", "__hash")
    )


def latest_snapshot(ev: DataFrame, key: str = "resource_uri") -> DataFrame:
    """Newest row per key; a key whose newest row is a tombstone is gone."""
    return newest_rows(ev, key).where(is_live())


def _present(name: str) -> Column:
    return field(F.col("data"), name).isNotNull()


def _differs(name: str, value: str) -> Column:
    # NULL (so not kept) where the field is absent; a JSON null does differ.
    return field(F.col("data"), name) != F.lit(f'"{value}"')


def live_predicate(stream: str) -> Column:
    """What counts as live in a stream, beyond not being deleted."""
    check_stream(stream)
    predicates = {
        "companies": lambda: ~_present("date_of_cessation")
        & _differs("company_status", "dissolved"),
        "officers": lambda: ~_present("resigned_on"),
        "persons-with-significant-control": lambda: ~_present("ceased_on"),
        "charges": lambda: _differs("status", "fully-satisfied"),
        "persons-with-significant-control-statements": lambda: ~_present("ceased_on"),
    }
    return predicates.get(stream, lambda: F.lit(True))()


def live_snapshot(ev: DataFrame, stream: str, key: str = "resource_uri") -> DataFrame:
    """Latest snapshot without dissolved, resigned, ceased or satisfied resources.

    The predicate runs after the ranking: only surviving rows are parsed, and a
    resource that has ceased does not fall back to an older row.
    """
    return latest_snapshot(ev, key).where(live_predicate(stream))


def latest_by_join(
    ev: DataFrame,
    key: str = "resource_uri",
    watermark: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rows of the batch after ``watermark`` that are the newest of their key.

    Without a watermark (nothing taken yet) the batch is all events, timepoint 0 too.

    Two narrow passes instead of sorting whole rows: the maximum per key is a
    hash aggregation over two columns, then rows are matched on key and
    timepoint.  ``limit`` cuts the batch to the first ``limit`` events in order (and
    any copies of the last timepoint); only timepoints are sorted for that, and the
    cut is a number the scan can use.
    """
    batch = ev if watermark is None else ev.where(F.col("timepoint") > watermark)
    if limit is not None:
        first = batch.select("timepoint").orderBy("timepoint").limit(limit)
        cut = first.agg(F.max("timepoint")).head()[0]
        batch = batch.where(F.col("timepoint") <= F.lit(cut).cast("bigint"))
    newest = batch.groupBy(key).agg(F.max("timepoint").alias("timepoint"))
    return batch.join(newest, [key, "timepoint"], "left_semi").select(*ev.columns)


def watermark(state: DataFrame) -> int | None:
    """Greatest timepoint of a state that keeps tombstones; None when it is empty."""
    return state.agg(F.max("timepoint").alias("wm")).head().wm


def incremental_snapshot(
    state: DataFrame, ev_batch: DataFrame, key: str = "resource_uri"
) -> DataFrame:
    """Fold a batch into the state.  The state keeps tombstones.

    Timepoints decide, not arrival, so batches may come in any split and order:
    dropping tombstones here would let a late older row revive a deleted key.
    ``live_view`` of the result equals ``latest_snapshot`` of all events.
    """
    return newest_rows(state.unionByName(ev_batch.select(*state.columns)), key)


def live_view(state: DataFrame) -> DataFrame:
    return state.where(is_live())


def upsert_snapshot(
    snap: DataFrame, batch: DataFrame, key: str = "resource_uri"
) -> DataFrame:
    """Replace the rows of ``snap`` that ``batch`` has newer rows for, then drop tombstones.

    ``snap`` may hold exact copies of a row; they collapse.  Ranking the union
    is one shuffle, where an anti join plus union would be two.
    """
    return live_view(incremental_snapshot(snap, batch, key))


def snapshot_counts(snap: DataFrame) -> DataFrame:
    return snap.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("timepoint").alias("distinct_timepoints"),
    )


def check_unique_resources(snap: DataFrame, key: str = "resource_uri") -> DataFrame:
    """Keys that occur more than once; empty for a sound snapshot."""
    return snap.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def snapshot_manifest(
    snap: DataFrame, stream: str, published_at: str, downloads: DataFrame | None = None
) -> DataFrame:
    """One row describing a published snapshot; timepoints stay exact 64-bit integers."""
    facts = snap.agg(
        F.lit(stream).alias("stream"),
        F.lit(published_at).alias("snapshot_published_at"),
        F.count(F.lit(1)).alias("record_count"),
        F.min("timepoint").alias("min_timepoint"),
        F.max("timepoint").alias("max_timepoint"),
        F.min("published_at").alias("min_published_at"),
        F.max("published_at").alias("max_published_at"),
    )
    if downloads is None:
        return facts
    # One entry per export of this snapshot, a handful by construction.
    listed = downloads.agg(
        F.sort_array(F.collect_list(F.struct(*downloads.columns))).alias("d")
    )
    return facts.withColumn("downloads", listed.scalar())


def compare_snapshots(
    a: DataFrame, b: DataFrame, key: str, fields: Sequence[str]
) -> DataFrame:
    """How two snapshots differ: keys on one side only, and differing fields on both."""
    left = a.select(key, F.struct(*fields).alias("a"))
    right = b.select(key, F.struct(*fields).alias("b"))
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    return left.join(right, key, "full_outer").agg(
        F.count_if(F.col("b").isNull()).alias("only_a"),
        F.count_if(F.col("a").isNull()).alias("only_b"),
        F.count_if(both).alias("both"),
        *(
            F.count_if(both & ~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}"))).alias(f"diff_{f}")
            for f in fields
        ),
    )
