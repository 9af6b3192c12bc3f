"""Integrity checks: is the log dense, fresh and complete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import uuid7_millis
from tidemark.operators.ranges import timepoint_words, words_summary
from tidemark.operators.snapshot import check_unique_resources
from tidemark.schemas import (
    FILE_MAX_AGE_HOURS,
    FIRST_CHECKED_TIMEPOINT,
    NEWEST_FILES_CHECKED,
    TABLE_MAX_AGE_HOURS,
    check_stream,
)


def age_seconds(published_at: Column, now: str) -> Column:
    """Seconds from an ISO time (taken as UTC) to ``now``; NULL if it is no time."""
    then = published_at.try_cast("timestamp_ntz")
    at = F.lit(now).cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", then, at)


def _dense() -> Column:
    return F.coalesce(
        (F.col("row_count") == F.col("distinct_timepoints"))
        & (F.col("distinct_timepoints") == F.col("diff_timepoints")),
        F.lit(False),
    )


def check_contiguity(ev: DataFrame, start: int = 0) -> DataFrame:
    """Rows, distinct timepoints and max - min + 1 from ``start`` on must all agree."""
    checked = ev.where(F.col("timepoint") >= start)
    return words_summary(timepoint_words(checked)).select(
        "row_count", "distinct_timepoints", "diff_timepoints", "min_tp", "max_tp",
        _dense().alias("ok"),
    )


def _recent(published_at: Column, now: str, max_age_hours: int) -> Column:
    return F.coalesce(age_seconds(published_at, now) <= max_age_hours * 3600, F.lit(False))


def check_freshness(
    ev: DataFrame, now: str, max_age_hours: int = TABLE_MAX_AGE_HOURS
) -> DataFrame:
    """Oldest and newest ``published_at`` (text order) and whether the newest is recent."""
    return ev.agg(
        F.min("published_at").alias("min_published_at"),
        F.max("published_at").alias("max_published_at"),
    ).select(
        "min_published_at",
        "max_published_at",
        age_seconds(F.col("max_published_at"), now).alias("age_s"),
        _recent(F.col("max_published_at"), now, max_age_hours).alias("ok"),
    )


def null_data() -> Column:
    """Is an event without data, though no tombstone."""
    # An event without a type is not counted: the comparison gives NULL.
    return F.col("data").isNull() & (F.col("type") != "deleted")


def check_null_data(ev: DataFrame) -> DataFrame:
    """Events other than tombstones that carry no data.

    A plain filter, so parquet statistics skip row groups without a null.
    """
    return (
        ev.where(null_data())
        .agg(F.count(F.lit(1)).alias("null_rows"))
        .select("null_rows", (F.col("null_rows") == 0).alias("ok"))
    )


def _report(check: str, ok: Column, detail: Column) -> list[Column]:
    return [F.lit(check).alias("check"), ok.alias("ok"), detail.alias("detail")]


def verify_events(ev: DataFrame, now: str, start: int = 0) -> DataFrame:
    """One row per table check, all from one pass over the log."""
    # Earlier events count for the null check alone.
    inside = F.col("timepoint") >= start
    seen = ev.select(
        *(F.when(inside, F.col(c)).alias(c) for c in ("timepoint", "published_at")),
        null_data().alias("lacks_data"),
    )
    words = timepoint_words(
        seen, F.max("published_at").alias("newest"), F.count_if("lacks_data").alias("null_rows")
    )
    facts = words_summary(
        words,
        F.max("newest").alias("newest"),
        F.coalesce(F.sum("null_rows"), F.lit(0)).alias("null_rows"),
    )
    return table_report(facts, now)


def table_report(facts: DataFrame, now: str) -> DataFrame:
    """One row per table check from the one row of facts."""
    checks = (
        _report(
            "contiguity",
            _dense(),
            F.concat_ws(",", "row_count", "distinct_timepoints", "diff_timepoints"),
        ),
        _report("freshness", _recent(F.col("newest"), now, TABLE_MAX_AGE_HOURS), F.col("newest")),
        _report("null_data", F.col("null_rows") == 0, F.col("null_rows").cast("string")),
    )
    return facts.select(F.inline(F.array(*(F.struct(*c) for c in checks))))


def verify_stream(ev: DataFrame, stream: str, now: str) -> DataFrame:
    """``verify_events`` from the first timepoint of the stream that is to be checked."""
    start = FIRST_CHECKED_TIMEPOINT.get(check_stream(stream), 0)
    return verify_events(ev, now, start)


def verify_snapshot(snap: DataFrame, now: str, key: str = "resource_uri") -> DataFrame:
    """One row per snapshot check: published recently, every resource once."""
    fresh = check_freshness(snap, now).select(
        *_report("freshness", F.col("ok"), F.col("max_published_at"))
    )
    repeated = (
        check_unique_resources(snap, key)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*_report("unique_resources", F.col("n") == 0, F.col("n").cast("string")))
    )
    return fresh.unionByName(repeated)


def require(report: DataFrame) -> None:
    """Raise if a report has a failed check; reports have one row per check."""
    failed = report.where(~F.col("ok")).collect()
    if failed:
        raise ValueError("; ".join(f"{r.check}: {r.detail}" for r in failed))


def check_file_age(
    files: DataFrame, now: str, max_age_hours: int = FILE_MAX_AGE_HOURS
) -> DataFrame:
    """When each file was started, by the UUIDv7 in its name, and whether that is too old."""
    written = F.timestamp_millis(uuid7_millis(F.col("file"))).cast("timestamp_ntz")
    age = F.timestamp_diff("SECOND", written, F.lit(now).cast("timestamp_ntz"))
    return files.select(
        "file",
        F.date_format(written, "yyyy-MM-dd HH:mm:ss.SSS").alias("written_at"),
        age.alias("age_s"),
        (age > max_age_hours * 3600).alias("too_old"),
    )


def newest_files(files: DataFrame, n: int = NEWEST_FILES_CHECKED) -> DataFrame:
    """The last ``n`` files in name order, which is time order."""
    return files.select("file").orderBy(F.col("file").desc()).limit(n)


def newest_file_stats(ev: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Timepoints, publication times and size of the newest file.

    With the listing ``files`` its name is known before anything is read, and as
    a literal it keeps a landing scan from opening any other file.
    """
    newest = (ev if files is None else files).agg(F.max("file")).head()[0]
    return ev.where(F.col("file") == newest).agg(
        F.min("timepoint").alias("min_timepoint"),
        F.max("timepoint").alias("max_timepoint"),
        F.min("published_at").alias("min_published_at"),
        F.max("published_at").alias("max_published_at"),
        F.count(F.lit(1)).alias("row_count"),
    )


def file_stats(ev: DataFrame) -> DataFrame:
    """Range and size of every file; the size counts rows without a timepoint too."""
    return ev.groupBy("file").agg(
        F.min("timepoint").alias("lo"),
        F.max("timepoint").alias("hi"),
        F.count(F.lit(1)).alias("row_count"),
    )


def problem_files(stats: DataFrame) -> DataFrame:
    """Files whose size is not the width of their range."""
    return stats.select(
        "file",
        "lo",
        "hi",
        F.col("row_count").alias("count_diff"),
        (F.col("hi") - F.col("lo") + 1).alias("diff"),
        (F.col("row_count") - (F.col("hi") - F.col("lo") + 1)).alias("extra"),
    ).where("extra <> 0")


def file_range_total(stats: DataFrame) -> DataFrame:
    """All given files together: are they one dense range."""
    return (
        stats.agg(
            F.min("lo").alias("tmin"),
            F.max("hi").alias("tmax"),
            F.sum("row_count").alias("tcount"),
        )
        .withColumn("diff", F.col("tmax") - F.col("tmin") + 1)
        .withColumn("correct", F.col("diff") == F.col("tcount"))
        .withColumn("extra", F.col("tcount") - F.col("diff"))
    )


def verify_landing(
    ev: DataFrame, files: DataFrame, now: str, n: int = NEWEST_FILES_CHECKED
) -> DataFrame:
    """One row per check of the newest ``n`` landing files.

    The newest file is recent by its name and by its content; every file is
    dense; together they are dense.
    """
    # n names at most; as literals they limit a landing scan to these files.
    names = [r.file for r in newest_files(files, n).collect()]
    by_name = (
        check_file_age(newest_files(files, 1), now)
        .agg(F.max("written_at").alias("at"), F.max("too_old").alias("old"))
        .select(*_report("newest_file_age", F.coalesce(~F.col("old"), F.lit(False)), F.col("at")))
    )
    stats = file_stats(ev.where(F.col("file").isin(names)))
    by_content = check_freshness(
        ev.where(F.col("file").isin(names[:1])), now, FILE_MAX_AGE_HOURS
    ).select(*_report("newest_published_at", F.col("ok"), F.col("max_published_at")))
    each = (
        problem_files(stats)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*_report("each_file_dense", F.col("n") == 0, F.col("n").cast("string")))
    )
    together = file_range_total(stats).select(
        *_report(
            "files_dense",
            F.coalesce(F.col("correct"), F.lit(False)),
            F.concat_ws(",", "tmin", "tmax", "tcount"),
        )
    )
    return by_name.unionByName(by_content).unionByName(each).unionByName(together)


def landing_extra_checks(
    ev: DataFrame, kind: str, max_drift_s: int = 3600
) -> DataFrame:
    """Per file: events of another kind, and name time against newest publication time."""
    per_file = ev.groupBy("file").agg(
        F.count_if(~F.col("resource_kind").eqNullSafe(F.lit(kind))).alias("other_kind"),
        F.max("published_at").alias("published_at"),
    )
    named = F.timestamp_millis(uuid7_millis(F.col("file"))).cast("timestamp_ntz")
    drift = F.abs(
        F.timestamp_diff("SECOND", F.col("published_at").try_cast("timestamp_ntz"), named)
    )
    return per_file.select(
        "file",
        "other_kind",
        drift.alias("drift_s"),
        ((F.col("other_kind") == 0) & F.coalesce(drift <= max_drift_s, F.lit(False))).alias("ok"),
    )
