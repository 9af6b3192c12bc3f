"""Published files and their descriptions."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.schemas import SAMPLE_ROWS, SPLIT_FILE_BYTES
from tidemark.session import pin, temporary

EXTENSIONS = {"json": ".json", "csv": ".csv", "parquet": ".parquet"}
# Text as zstd needs a native Hadoop library that Spark's own distribution lacks, so it
# is written as gzip everywhere: an export must not depend on the machine it ran on.
_TEXT_CODECS = {"zstd": "gzip"}


def _codec(fmt: str, compression: str) -> str:
    """Codec that is used for the one asked for."""
    return compression if fmt == "parquet" else _TEXT_CODECS.get(compression, compression)


def _write(df: DataFrame, path: str, fmt: str, compression: str, rows_per_file: int) -> None:
    (
        df.write.format(fmt)
        .option("compression", _codec(fmt, compression))
        .option("header", True)
        .option("escape", '"')
        .option("ignoreNullFields", False)
        .option("maxRecordsPerFile", rows_per_file)
        .save(path)
    )


def _stored_bytes(rows: DataFrame) -> int:
    """Size of the parquet files behind a pinned DataFrame."""
    files = rows.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.coalesce(F.sum("file_size"), F.lit(0))).head()[0]


def export_manifest(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """``file, rows, bytes`` of the files written to ``path``.

    Counting parquet rows touches footers only; of text formats one column at most.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    if fmt == "csv":
        data = reader.option("multiLine", True).csv(path)
    else:
        data = spark.read.text(path) if fmt == "json" else spark.read.parquet(path)
    rows = data.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    sizes = spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("file"), F.col("length").alias("bytes")
    )
    return sizes.join(rows, "file", "left").select(
        "file", F.coalesce("rows", F.lit(0)).alias("rows"), "bytes"
    )


def describe_export(
    files: DataFrame, fmt: str, compression: str, description: str, path: str, **labels: bool
) -> DataFrame:
    """One manifest entry for an export: where it is, files, rows, bytes and labels.

    The names themselves stay rows of ``files``: there are as many as there are parts.
    The entry names the codec that was used, also where it is not the one asked for.
    """
    used = _codec(fmt, compression)
    if used != compression:
        description = re.sub(compression, used, description, flags=re.IGNORECASE)
    suffix = {"gzip": ".gz", "zstd": ".zst"}.get(used, "") if fmt != "parquet" else ""
    return files.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("count"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_size_bytes"),
    ).select(
        F.lit(path).alias("path"),
        "*",
        F.lit(fmt).alias("format"),
        F.lit(EXTENSIONS[fmt] + suffix).alias("extension"),
        F.lit(used).alias("compression"),
        F.lit(description).alias("description"),
        F.array(*(F.lit(k) for k, on in sorted(labels.items()) if on))
        .cast("array<string>")
        .alias("labels"),
    )


def export_snapshot(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    compression: str = "snappy",
    description: str = "",
    layout: str = "parts",
    **labels: bool,
) -> DataFrame:
    """Write all rows and describe what was written; ``export_manifest`` lists the files.

    ``layout`` is ``parts``, a file per task, or ``single``: one file, written by one
    task whatever its size.  The caller decides; nothing follows from the data.  ``df``
    is evaluated once; where several exports share a plan, pin it before.
    """
    if layout not in ("parts", "single"):
        raise ValueError(f"unknown layout {layout!r}")
    rows = df.coalesce(1) if layout == "single" else df
    _write(rows, path, fmt, compression, 0)
    labels = labels | {"single": layout == "single"}
    written = export_manifest(df.sparkSession, path, fmt)
    return describe_export(written, fmt, compression, description, path, **labels)


def export_split(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    compression: str = "snappy",
    file_bytes: int = SPLIT_FILE_BYTES,
    description: str = "",
) -> DataFrame:
    """Write parts of about ``file_bytes``.  ``df`` must be pinned.

    Rows per part follow from the bytes per row of the pinned copy (parquet), so
    the target is for parquet; ``export_split_text`` cuts text by its own bytes.
    """
    row_bytes = _stored_bytes(df) / max(df.count(), 1)
    per_file = max(1, int(file_bytes / max(1.0, row_bytes)))
    _write(df, path, fmt, compression, per_file)
    written = export_manifest(df.sparkSession, path, fmt)
    return describe_export(written, fmt, compression, description, path, split=True)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their number in the task and the bytes of the lines ahead of them there."""
    number = ahead = 0
    for batch in batches:
        size = pc.binary_length(batch["line"]).to_numpy().astype(np.int64) + 1
        after = ahead + np.cumsum(size)
        yield pa.record_batch(
            [batch["block"], pa.array(np.arange(number, number + len(size))), pa.array(after - size),
             pa.array(size), batch["line"]],
            names=["block", "number", "start", "size", "line"],
        )
        if len(size):
            number, ahead = number + len(size), int(after[-1])


def _lines(df: DataFrame, fmt: str) -> tuple[Column, str | None]:
    """A row as a line of text, and the line ahead of all rows."""
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    if fmt == "json":
        return F.to_json(row, {"ignoreNullFields": "false"}), None
    if fmt != "csv":
        raise ValueError(f"no text format: {fmt!r}")
    names = df.sparkSession.range(1).select(F.to_csv(F.struct(*(F.lit(c).alias(f"c{i}") for i, c in enumerate(df.columns))), {"escape": '"'}))
    return F.to_csv(row, {"escape": '"'}), names.head()[0]


def export_split_text(
    df: DataFrame,
    path: str,
    fmt: str = "json",
    compression: str = "gzip",
    file_bytes: int = SPLIT_FILE_BYTES,
    description: str = "",
    order: Sequence[str] = (),
) -> DataFrame:
    """Write JSON or CSV in parts ``part=<i>`` of ``file_bytes`` before the codec.

    Rows are encoded once.  Running sums of their bytes, in each task and then over the
    tasks, give the place of every row in the whole text, which is cut at multiples of
    the target: a row belongs to the part that it begins in, so a part misses the target
    by less than a row (the last one holds what is left).  Parts of CSV begin with the
    header, which counts.  Parts follow ``order``, or else the order of the rows.  A table
    without rows is one part with no row.
    """
    spark = df.sparkSession
    line, header = _lines(df, fmt)
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    encoded = rows.select(F.spark_partition_id().cast("bigint").alias("block"), line.alias("line"))
    schema = "block bigint, number bigint, start bigint, size bigint, line string"
    with temporary(spark):
        lines = pin(encoded.mapInArrow(_measured, schema), "lines")
        earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        # One row for each task.
        ahead = lines.groupBy("block").agg(F.sum("size").alias("bytes")).select(
            "block", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("ahead")
        )
        of_header = 0 if header is None else len(header.encode()) + 1
        room = F.lit(max(1, file_bytes - of_header))
        part = F.floor((F.col("ahead") + F.col("start")) / room)
        placed = lines.join(ahead, "block").select(part.alias("part"), "block", "number", "line")
        if header is not None:
            none = F.lit(-1).cast("bigint")
            known = placed.select("part").unionByName(spark.range(1).select(F.col("id").alias("part")))
            heads = known.distinct().select(
                "part", none.alias("block"), none.alias("number"), F.lit(header).alias("line")
            )
            placed = placed.unionByName(heads)
        (
            placed.repartition("part")
            .sortWithinPartitions("part", "block", "number")
            .select("part", "line")
            .write.partitionBy("part")
            .option("compression", _codec(fmt, compression))
            .text(path)
        )
    written = export_manifest(spark, path, fmt)
    return describe_export(written, fmt, compression, description, path, split=True)


def sample_rows(
    df: DataFrame, key: str = "resource_uri", n: int = SAMPLE_ROWS, seed: str = "sample"
) -> DataFrame:
    """``min(n, rows)`` rows, every set of ``n`` equally likely over seeds.

    Rows are ranked by a hash of their key, so the sample does not depend on the
    layout of the data and a task that runs again picks the same rows; each task
    keeps at most ``n``.
    """
    order = F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")))
    return df.orderBy(order, key).limit(n)


def export_sample(
    df: DataFrame,
    path: str,
    fmt: str = "json",
    compression: str = "none",
    key: str = "resource_uri",
    n: int = SAMPLE_ROWS,
    seed: str = "sample",
    description: str = "",
) -> DataFrame:
    """At most ``n`` rows, as one file."""
    rows = sample_rows(df, key, n, seed)
    return export_snapshot(rows, path, fmt, compression, description, "single", sample=True)
