"""What file and stream names encode."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def schema_name(stream: str) -> str:
    """Table-safe spelling of a stream name."""
    return re.sub(r"[^a-z0-9_]", "_", stream, flags=re.IGNORECASE)


def common_stream(files: list[str], root: str) -> str:
    """Stream of sink files under ``root``; raises unless all are event files of one stream."""
    root = root.rstrip("/") + "/"
    wrong = [f for f in files if not (f.startswith(root) and f.endswith(".json.gz"))]
    if wrong or not files:
        raise ValueError(f"expected .json.gz files under {root}, got {wrong or 'none'}")
    streams = {f[len(root) :].split("/")[0] for f in files}
    if len(streams) > 1:
        raise ValueError(f"files of several streams: {', '.join(sorted(streams))}")
    return streams.pop()


def stream_of(file: Column) -> Column:
    """Folder a sink file lies in, which is the name of its stream; empty without a folder."""
    return F.coalesce(F.try_element_at(F.split(file, "/"), F.lit(-2)), F.lit(""))


def base_name(file: Column) -> Column:
    return F.element_at(F.split(file, "/"), -1)


def uuid7_millis(file: Column) -> Column:
    """Epoch milliseconds in the first 48 bits of the UUIDv7 a sink file is named by."""
    name = F.regexp_extract(file, r"([0-9a-fA-F]{8}-[0-9a-fA-F]{4})-[^/]*\.json\.gz$", 1)
    return F.when(name != "", F.conv(F.replace(name, F.lit("-")), 16, 10).cast("bigint"))


# Accounts CSV names end in "<start>--<end>.csv"; a folder of parts may bear the name.
_CSV_SPAN = r"(\d{4}-\d{2}-\d{2})--(\d{4}-\d{2}-\d{2})\.csv(/[^/]*)?$"


def csv_start(file: Column) -> Column:
    return F.to_date(F.nullif(F.regexp_extract(file, _CSV_SPAN, 1), F.lit("")))


def csv_end(file: Column) -> Column:
    return F.to_date(F.nullif(F.regexp_extract(file, _CSV_SPAN, 2), F.lit("")))


def common_start(files: DataFrame) -> int:
    """How many letters the names (without folders) of all files begin with alike."""
    least, greatest = files.agg(
        F.min(base_name(F.col("file"))), F.max(base_name(F.col("file")))
    ).head()
    return len(os.path.commonprefix([least or "", greatest or ""]))


def name_bucket(file: Column, alike: int = 0) -> Column:
    """Order-preserving bucket of files: folder plus the name up to three letters that differ.

    ``alike`` is what :func:`common_start` finds; three letters behind it make some
    thousand buckets, whatever the names look like.
    """
    return F.regexp_extract(file, f"^(.*/)?[^/]{{0,{alike + 3}}}", 0)
