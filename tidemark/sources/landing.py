"""Landing files: listing, event scans and raw line scans."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.json import json_ok, parse_one
from tidemark.operators.events import flatten
from tidemark.schemas import EVENT_DDL

Paths = str | Sequence[str]
_WHITESPACE = " \t\r\n\f\v"
_PIECE = 1 << 20


def _paths(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _text_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    lines = spark.read.text(_paths(paths)).select(
        trimmed(F.col("value")).alias("line"), F.col("_metadata.file_path").alias("file")
    )
    return lines.where("line <> ''")


def scan_events(spark: SparkSession, paths: Paths) -> DataFrame:
    """Stored layout plus ``file``; a line that is not one whole object fails the job.

    The JSON reader fails on malformed lines but stops reading a line after its first
    object, so a second look at the text fails on two objects in one line and on text
    behind an object.  Blank heartbeat lines and lines without a timepoint (error
    objects) are dropped.  ``data`` keeps the raw text of its object.
    """
    events = (
        spark.read.schema(EVENT_DDL)
        .option("mode", "FAILFAST")
        .json(_paths(paths))
        .withColumn("file", F.col("_metadata.file_path"))
    )
    bad = F.concat(
        F.lit("malformed line in "), F.col("file"), F.lit(": "), F.substring("line", 1, 200)
    )
    # Never gives a row.  The columns come from the line, so that no filter on them can
    # prove this side empty and drop the test.
    refused = (
        _text_lines(spark, paths)
        .where(F.when(~json_ok(F.col("line")), F.raise_error(bad).cast("boolean")).otherwise(False))
        .select(F.from_json("line", EVENT_DDL).alias("parsed"), "file")
        .select("parsed.*", "file")
    )
    return events.where(F.col("event.timepoint").isNotNull()).unionByName(refused)


def scan_events_tolerant(spark: SparkSession, paths: Paths) -> DataFrame:
    """Same columns plus ``_corrupt_record``: malformed lines stay, as their text and NULLs.

    ``data`` is written anew, without white space between its tokens.
    """
    lines = _text_lines(spark, paths).withColumn(
        "parsed", parse_one(F.col("line"), f"struct<{EVENT_DDL}>")
    )
    corrupt = F.when(F.col("parsed").isNull(), F.col("line"))
    return lines.select("parsed.*", "file", corrupt.alias("_corrupt_record"))


def scan_flat(spark: SparkSession, paths: Paths) -> DataFrame:
    """Every parsed line, flat, with its file; for checks that count all lines."""
    return flatten(scan_events_tolerant(spark, paths).drop("_corrupt_record"))


def list_sink_files(spark: SparkSession, glob: Paths) -> DataFrame:
    """Names, sizes and times of files; their content is not read."""
    return (
        spark.read.format("binaryFile")
        .load(_paths(glob))
        .select(
            F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified")
        )
    )


def _known(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("file").isNotNull()).select("file")


def loaded_files(ledger: DataFrame, stream: str) -> DataFrame:
    """Event files of a stream in the ledger, in name order."""
    return (
        _known(ledger)
        .where(F.col("file").contains(f"/{stream}/") & F.col("file").endswith(".json.gz"))
        .orderBy("file")
    )


def unloaded_files(files: DataFrame, ledger: DataFrame, limit: int | None = None) -> DataFrame:
    """Files the ledger does not know, oldest name first."""
    pending = files.select("file").join(_known(ledger), "file", "left_anti").orderBy("file")
    return pending if limit is None else pending.limit(limit)


def late_unloaded_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Unloaded files whose name sorts before the newest loaded one."""
    newest = _known(ledger).agg(F.max("file")).scalar()
    return unloaded_files(files.where(F.col("file") < newest), ledger)


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(_WHITESPACE))


def cut_files(spark: SparkSession, paths: Paths) -> DataFrame:
    """``file`` of gzip files that end before their last block is complete.

    What can be read of them comes as whole lines, so the lines do not tell.
    """

    def incomplete(batches):
        for batch in batches:
            cut = []
            for content in batch["content"]:
                stream = zlib.decompressobj(31)
                rest = content.as_buffer()
                whole = False
                try:
                    # Pieces bound what is decompressed at a time; members may follow each other.
                    for at in range(0, len(rest), _PIECE):
                        piece = rest[at : at + _PIECE].to_pybytes()
                        while piece:
                            if whole:
                                stream, whole = zlib.decompressobj(31), False
                            stream.decompress(piece)
                            piece, whole = stream.unused_data, stream.eof
                except zlib.error:
                    whole = False
                cut.append(not whole)
            yield pa.record_batch([batch["file"].filter(pa.array(cut, pa.bool_()))], ["file"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(_paths(paths))
    # Whole files are in memory, as many as ``prepare`` allows a batch in bytes.
    return files.select(F.col("path").alias("file"), "content").mapInArrow(
        incomplete, "file string"
    )


def read_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """Non-empty trimmed lines: ``file, block, id, line, ok``.

    For diagnosis: of a gzip file that was cut off, the lines before the cut.

    ``block`` is the start of the split a line was read from and ``id`` grows
    along it without holes, so (``block``, ``id``) orders the lines of a file.
    ``id`` depends on how the scan was split: ``pin`` the lines before they are
    joined with something derived from them.
    """
    reader = spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", True)
    text = reader.text(_paths(paths))
    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        trimmed(F.col("value")).alias("line"),
    ).where("line <> ''")
    return lines.select(
        "file", "block", F.monotonically_increasing_id().alias("id"), "line"
    ).withColumn("ok", json_ok(F.col("line")))
