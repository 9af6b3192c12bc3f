"""Whole publications: derive, export in the agreed formats, describe in a manifest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.accounts import accounts_dedup, accounts_window
from tidemark.operators.export import (
    export_manifest,
    export_sample,
    export_snapshot,
    export_split,
)
from tidemark.operators.register import register_counts
from tidemark.operators.snapshot import live_snapshot, snapshot_manifest
from tidemark.session import pin, temporary

# --- Fixed values: format, compression, description, and what is written in it. ---

SNAPSHOT_EXPORTS = (
    ("json", "none", "JSON", {"sample"}),
    ("parquet", "snappy", "Parquet", set()),
    ("json", "gzip", "JSON (gzip)", set()),
    ("json", "zstd", "JSON (zstd)", {"sample", "single"}),
)
REGISTER_EXPORTS = (
    ("parquet", "snappy", "Parquet"),
    ("csv", "zstd", "CSV (zstd)"),
    ("json", "zstd", "JSON (zstd)"),
)
ACCOUNTS_EXPORTS = (
    ("csv", "zstd", "Last two years (CSV Zstd)", False),
    ("parquet", "snappy", "Last two years (Parquet)", False),
    ("parquet", "snappy", "Full history (Parquet)", True),
)

# --- End of fixed values. ---


def _write_manifest(manifest: DataFrame, path: str) -> DataFrame:
    """The manifest as written: nothing of the job behind it is needed any more."""
    manifest.coalesce(1).write.option("ignoreNullFields", False).json(path)
    return manifest.sparkSession.read.schema(manifest.schema).json(path)


def _write_files(exports: Sequence[tuple[str, str]], spark: SparkSession, path: str) -> None:
    """Every file of every export, as a table beside the manifest: (path, file, rows, bytes)."""
    listed = [
        export_manifest(spark, target, fmt).select(F.lit(target).alias("path"), "*")
        for target, fmt in exports
    ]
    reduce(DataFrame.unionByName, listed).write.parquet(path)


def publish_snapshot(
    ev: DataFrame,
    stream: str,
    out: str,
    published_at: str,
    split: bool = False,
    layout: str = "parts",
) -> DataFrame:
    """Export the live snapshot of a stream and write its manifest (one row, returned).

    The snapshot is computed once; all exports read the pinned copy.  ``split``
    writes size-bounded parts of every format, which by default are left out.  The
    names of all files are the table ``<stream>-files`` beside the manifest.
    """
    with temporary(ev.sparkSession):
        rows = pin(live_snapshot(ev, stream), "snapshot")
        day = published_at[:10]
        done, exports = [], []
        for fmt, compression, description, kinds in SNAPSHOT_EXPORTS:
            name = f"{fmt}-{compression}"
            if "single" in kinds:
                target = f"{out}/daily/{stream}_{day}-{name}"
                done.append(
                    export_snapshot(rows, target, fmt, compression, description, layout)
                )
                exports.append((target, fmt))
            if split:
                target = f"{out}/daily/split/{stream}_{day}-{name}"
                exports.append((target, fmt))
                done.append(export_split(rows, target, fmt, compression, description=description))
            if "sample" in kinds:
                target = f"{out}/sample/{stream}-{name}"
                exports.append((target, fmt))
                done.append(
                    export_sample(rows, target, fmt, compression, description=description)
                )
        downloads = reduce(DataFrame.unionByName, done)
        manifest = snapshot_manifest(rows, stream, published_at, downloads)
        _write_files(exports, rows.sparkSession, f"{out}/{stream}-files")
        return _write_manifest(manifest, f"{out}/{stream}-manifest.json")


def publish_accounts(
    accounts: DataFrame, out: str, published_at: str, layout: str = "parts"
) -> DataFrame:
    """Export the last two years and the full history of the accounts, with a manifest."""
    with temporary(accounts.sparkSession):
        rows = pin(accounts_dedup(accounts), "accounts")
        day = published_at[:10]
        done, exports = [], []
        for fmt, compression, description, full in ACCOUNTS_EXPORTS:
            label = "full_history" if full else "last_two_years"
            exports.append((f"{out}/monthly/accounts-{label}-{fmt}", fmt))
            done.append(
                export_snapshot(
                    accounts_window(rows, day, full_history=full),
                    exports[-1][0],
                    fmt,
                    compression,
                    description,
                    layout,
                    **{label: True},
                )
            )
        downloads = reduce(DataFrame.unionByName, done)
        manifest = downloads.agg(
            F.lit("accounts").alias("stream"),
            F.lit(published_at).alias("snapshot_published_at"),
            F.sort_array(F.collect_list(F.struct(*downloads.columns))).alias("downloads"),
        )
        _write_files(exports, rows.sparkSession, f"{out}/accounts-files")
        return _write_manifest(manifest, f"{out}/accounts-manifest.json")


def publish_register(
    tables: Mapping[str, DataFrame], out: str, published_at: str, layout: str = "parts"
) -> DataFrame:
    """Export every register table in every format; one manifest row per table."""
    with temporary(next(iter(tables.values())).sparkSession):
        day = published_at[:10]
        done, exports = [], []
        for table, df in tables.items():
            rows = pin(df, table)
            for fmt, compression, description in REGISTER_EXPORTS:
                target = f"{out}/register/{table}_{day}-{fmt}"
                exports.append((target, fmt))
                done.append(
                    export_snapshot(rows, target, fmt, compression, description, layout).withColumn(
                        "table", F.lit(table)
                    )
                )
        downloads = reduce(DataFrame.unionByName, done)
        entries = downloads.groupBy("table").agg(
            F.sort_array(
                F.collect_list(F.struct(*(c for c in downloads.columns if c != "table")))
            ).alias("downloads")
        )
        manifest = (
            register_counts(tables)
            .join(entries, "table")
            .withColumn("snapshot_published_at", F.lit(published_at))
        )
        _write_files(exports, rows.sparkSession, f"{out}/register-files")
        return _write_manifest(manifest, f"{out}/register-manifest.json")
