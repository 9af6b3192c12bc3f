"""Load landing files into parquet tables exactly once.

A table is two folders: ``rows/load=<n>`` holds what load ``n`` read, and
``ledger/load=<n>`` names its files and is written last.  Both writes replace
their own folder, so a load that runs again changes nothing, and rows count only
once the ledger has their load.

New files are found by a stream over the listing of the landing folder: every
file is one row, its content is not read by the source.  A batch of the stream is
several loads, written by one job.  The checkpoint gives a batch that runs again the
same files, and the ledger then gives them the same loads.  Files taken out of the
ledger by a correction are old to that stream; ``load_pending`` finds them by comparing
the listing with the ledger.  Stream loads count up from 0, pending ones down from
-1, so the two never share a folder.  One job at a time writes to a table.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.files import exists, hadoop_path
from tidemark.functions.names import common_stream, schema_name, stream_of
from tidemark.operators.correction import require_confirmed
from tidemark.operators.events import flatten
from tidemark.operators.ranges import duplicate_range
from tidemark.operators.tables import sort_events
from tidemark.schemas import check_stream
from tidemark.session import pin, temporary
from tidemark.sources.accounts import scan_accounts
from tidemark.sources.landing import list_sink_files, scan_events, unloaded_files

Scan = Callable[[SparkSession, list[str]], DataFrame]

_LISTING_DDL = "path string, modificationTime timestamp, length bigint, content binary"
_LEDGER_DDL = "file string, load bigint"
_PLAIN_NAME = re.compile(r"[A-Za-z0-9_.:=/-]*")
_FILES_PER_CORE = 16
#: Files that one batch takes, in as many loads (or parts of an index) as that makes.
_FILES_PER_BATCH = 4096


def table_path(lake: str, stream: str) -> str:
    """Folder of a stream's table; the stream must be a known one."""
    return f"{lake}/{schema_name(check_stream(stream))}"


def read_ledger(spark: SparkSession, table: str) -> DataFrame:
    """``file, load`` of everything loaded into ``table``; empty before the first load."""
    if not exists(spark, f"{table}/ledger"):
        return spark.createDataFrame([], _LEDGER_DDL)
    return spark.read.schema(_LEDGER_DDL).parquet(f"{table}/ledger")


def read_loads(spark: SparkSession, table: str) -> tuple[int, int]:
    """Least and greatest number in the ledger; (0, -1) before the first load."""
    least, greatest = read_ledger(spark, table).agg(F.min("load"), F.max("load")).head()
    return (0, -1) if least is None else (least, greatest)


def read_loaded(spark: SparkSession, table: str) -> DataFrame:
    """Rows of the loads the ledger has.

    While a correction is unfinished (``correct_loaded``) that may still be both copies.
    """
    return spark.read.parquet(f"{table}/rows").where(
        F.col("load").between(*read_loads(spark, table))
    )


def store_load(
    spark: SparkSession, table: str, load: int, paths: list[str], scan: Scan, order: str
) -> None:
    """Write the rows of some files as load ``load``, then its ledger entry."""
    # Each task writes its rows in order: files are in order already, so this is
    # no shuffle and row groups stay narrow.
    scan(spark, paths).sortWithinPartitions(order).write.mode("overwrite").parquet(
        f"{table}/rows/load={load}"
    )
    names = spark.createDataFrame([(p,) for p in paths], "file string")
    names.coalesce(1).write.mode("overwrite").parquet(f"{table}/ledger/load={load}")


def store_loads(
    spark: SparkSession,
    table: str,
    loads: dict[int, list[str]],
    scan: Scan,
    order: str,
    file_column: str = "file",
) -> None:
    """``store_load`` of several loads, whose rows are one job and whose ledger entries another."""
    if len(loads) == 1:
        [(load, paths)] = loads.items()
        return store_load(spark, table, load, paths, scan, order)
    named = [(p, n) for n, paths in loads.items() for p in paths]
    for load in loads:
        # What a batch that was stopped has left; a load without rows would keep it.
        fs, path = hadoop_path(spark, f"{table}/rows/load={load}")
        fs.delete(path, True)
    rows = scan(spark, [p for p, _ in named])
    scanned = [(_as_scanned(spark, p), n) for p, n in named]
    of_file = F.broadcast(_listed(spark, scanned).withColumnRenamed("file", file_column))
    lost = F.raise_error(F.concat(F.lit("not a file of this load: "), F.col(file_column)))
    placed = rows.join(of_file, file_column, "left").select(
        *rows.columns, F.coalesce("load", lost.cast("bigint")).alias("load")
    )
    # Loads of some small files come to a few files, a large load to many.
    together = placed.hint("rebalance", F.col("load"))
    together.sortWithinPartitions("load", order).write.mode("append").partitionBy("load").parquet(
        f"{table}/rows"
    )
    for load, paths in loads.items():
        if not exists(spark, f"{table}/rows/load={load}"):
            store_load(spark, table, load, paths, scan, order)
    # One task: a file for each load.
    (
        _listed(spark, named).coalesce(1)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("load").parquet(f"{table}/ledger")
    )


def _listed(spark: SparkSession, named: list[tuple[str, int]]) -> DataFrame:
    """Names and loads as a table; it is made without a Python task."""
    files, loads = zip(*named, strict=True)
    return spark.createDataFrame(pa.table({"file": pa.array(files, pa.string()), "load": pa.array(loads, pa.int64())}))


def _as_scanned(spark: SparkSession, name: str) -> str:
    """A listed name as ``_metadata.file_path`` has it: characters that URIs escape are escaped."""
    if _PLAIN_NAME.fullmatch(name):
        return name
    return spark._jvm.org.apache.hadoop.fs.Path(name).toUri().toString()


def _numbered(
    spark: SparkSession, table: str, names: list[str], max_files: int
) -> dict[int, list[str]]:
    """The loads that a batch of names becomes: they follow those that the ledger has of others.

    So a batch that runs again, after some of its loads or all of them, has the same ones.
    """
    others = read_ledger(spark, table).where("load >= 0").join(
        F.broadcast(_listed(spark, [(n, 0) for n in names]).select("file")), "file", "left_anti"
    )
    last = others.agg(F.max("load")).head()[0]
    first = 0 if last is None else last + 1
    parts = range(0, len(names), max_files)
    return {first + k: names[at : at + max_files] for k, at in enumerate(parts)}


def _added(
    spark: SparkSession, table: str, before: tuple[int, int], file_column: str
) -> DataFrame:
    """Rows per file of the loads outside ``before``."""
    new = ~F.col("load").between(*before)
    files = read_ledger(spark, table).where(new).select("file")
    if read_loads(spark, table) == before:
        return files.select("file", F.lit(0).cast("bigint").alias("rows"))
    rows = (
        read_loaded(spark, table)
        .where(new)
        .groupBy(F.col(file_column).alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return files.join(rows, "file", "left").select(
        "file", F.coalesce("rows", F.lit(0)).alias("rows")
    )


def for_each_batch_of_files(
    spark: SparkSession,
    landing: str,
    pattern: str,
    checkpoint: str,
    max_files: int,
    store: Callable[[SparkSession, list[str], int], None],
) -> None:
    """Call ``store(session, names, batch)`` for all files not seen yet, then return.

    A batch has at most ``max_files`` names, or as many times that as make some thousands;
    one that failed comes again with the same names and number.
    """
    many = max_files * max(1, _FILES_PER_BATCH // max_files)

    def take(files: DataFrame, batch: int) -> None:
        names = [r.path for r in files.sort("path").collect()]
        if names:
            store(files.sparkSession, names, batch)

    (
        spark.readStream.format("binaryFile")
        .schema(_LISTING_DDL)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", many)
        .load(landing)
        .select("path")
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _load(
    spark: SparkSession,
    landing: str,
    pattern: str,
    table: str,
    checkpoint: str,
    max_files: int,
    scan: Scan,
    order: str,
    file_column: str,
) -> DataFrame:
    _require_whole(spark, table)
    before = read_loads(spark, table)

    def store(session: SparkSession, names: list[str], batch: int) -> None:
        store_loads(session, table, _numbered(session, table, names, max_files), scan, order, file_column)

    for_each_batch_of_files(spark, landing, pattern, checkpoint, max_files, store)
    return _added(spark, table, before, file_column)


def _batch(spark: SparkSession) -> int:
    return max(1000, _FILES_PER_CORE * spark.sparkContext.defaultParallelism)


def scan_for_load(spark: SparkSession, paths: list[str]) -> DataFrame:
    return scan_events(spark, paths).withColumn("stream", stream_of(F.col("file")))


def load_events(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    max_files: int | None = None,
    stream: str | None = None,
) -> DataFrame:
    """Load all event files not loaded yet; returns rows per newly loaded file.

    ``max_files`` bounds one load (by default some files for each core, since a gzip
    file is one task); a run goes on until nothing is left.  With ``stream`` the landing
    folder must be that of a known stream.
    """
    if stream is not None and not landing.rstrip("/").endswith(f"/{check_stream(stream)}"):
        raise ValueError(f"{landing} is not the folder of {stream}")
    return _load(
        spark, landing, "*.json.gz", table, checkpoint, max_files or _batch(spark), scan_for_load,
        "event.timepoint", "file",
    )


def load_accounts(
    spark: SparkSession, landing: str, table: str, checkpoint: str, max_files: int = 1000
) -> DataFrame:
    """Load all accounts CSV files not loaded yet; returns rows per newly loaded file."""
    return _load(
        spark, landing, "*.csv", table, checkpoint, max_files, scan_accounts,
        "zip_start", "csv_name",
    )


def load_pending(
    spark: SparkSession, glob: str, table: str, max_files: int | None = None
) -> DataFrame:
    """Load the event files under ``glob`` that the ledger lacks, oldest name first."""
    _require_whole(spark, table)
    before = read_loads(spark, table)
    size = max_files or _batch(spark)
    with temporary(spark):
        # Listed and compared with the ledger once.
        files = unloaded_files(list_sink_files(spark, glob), read_ledger(spark, table))
        pending, last = pin(files, "pending"), None
        while True:
            rest = pending if last is None else pending.where(F.col("file") > last)
            names = [r.file for r in rest.orderBy("file").limit(size).collect()]
            if not names:
                break
            load = min(read_loads(spark, table)[0], 0) - 1
            store_load(spark, table, load, names, scan_for_load, "event.timepoint")
            last = names[-1]
    return _added(spark, table, before, "file")


def _job(table: str) -> str:
    return f"{table}/correction"


def _require_whole(spark: SparkSession, table: str) -> None:
    if exists(spark, _job(table)):
        raise RuntimeError(f"a correction of {table} was not finished: run correct_loaded again")


def correct_loaded(
    spark: SparkSession, table: str, files: DataFrame | None = None, root: str | None = None
) -> DataFrame:
    """Take doubly loaded files out of a loaded table, to be loaded again once.

    Refused (ValueError) unless ``files`` are event files of one stream (under ``root``,
    by default the folder above the stream's) and exactly what was loaded twice.  The
    confirmed job is stored before anything changes; then the files leave the ledger,
    then both copies of their rows go, by file and range.  A run that was stopped is
    finished by the next call, whose ``files`` are not needed, and until then nothing is
    loaded.  Returns the duplicate range that remains (NULLs when the log is clean).
    """
    if not exists(spark, _job(table)):
        _confirmed_job(spark, table, files, root)
    with temporary(spark):
        job = spark.read.parquet(_job(table))
        named = job.select("file")
        ledger = read_ledger(spark, table)
        cut = ledger.join(named, "file", "left_semi").select("load").distinct()
        _replace_loads(spark, f"{table}/ledger", ledger, cut, ledger.join(named, "file", "left_anti"))
        rows = spark.read.parquet(f"{table}/rows")
        lo, hi = job.agg(F.min("lo"), F.max("hi")).head()
        hit = F.col("event.timepoint").between(lo, hi)
        touched = rows.where(hit).join(named, "file", "left_semi").select("load").distinct()
        # Rows outside the range stay without being compared by file.
        kept = rows.where(~F.coalesce(hit, F.lit(False))).unionByName(
            rows.where(hit).join(named, "file", "left_anti").select(*rows.columns)
        )
        _replace_loads(spark, f"{table}/rows", rows, touched, kept, "event.timepoint")
    fs, path = hadoop_path(spark, _job(table))
    fs.delete(path, True)
    return duplicate_range(flatten(read_loaded(spark, table)))


def _confirmed_job(
    spark: SparkSession, table: str, files: DataFrame | None, root: str | None
) -> None:
    if files is None:
        raise ValueError("no files to take out")
    # The files of one mistaken load: a handful of names.
    names = sorted({r.file for r in files.select("file").collect()})
    common_stream(names, root or "/".join(names[0].split("/")[:-2]) if names else "")
    log = flatten(read_loaded(spark, table))
    ranges = pin(
        log.join(files.select("file").distinct(), "file", "left_semi")
        .groupBy("file")
        .agg(F.min("timepoint").alias("lo"), F.max("timepoint").alias("hi")),
        "corrected-files",
    )
    require_confirmed(log, ranges, read_ledger(spark, table))
    ranges.write.parquet(_job(table))


def _replace_loads(
    spark: SparkSession,
    folder: str,
    before: DataFrame,
    touched: DataFrame,
    after: DataFrame,
    order: str = "file",
) -> None:
    """Rewrite the loads ``touched`` of a table with what ``after`` has of them, in one job."""
    loads = pin(touched, "touched")
    staged = pin(after.join(loads, "load", "left_semi"), "corrected")
    (
        staged.repartition("load", F.spark_partition_id())
        .sortWithinPartitions("load", order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("load")
        .parquet(folder)
    )
    # Loads of which nothing is left: those made by mistake alone.
    empty = loads.join(staged.select("load"), "load", "left_anti")
    for row in empty.toLocalIterator():
        fs, path = hadoop_path(spark, f"{folder}/load={row.load}")
        fs.delete(path, True)


def compact_loaded(
    spark: SparkSession,
    table: str,
    out: str,
    target_rows: int = 5_000_000,
    by: str = "event.timepoint",
) -> None:
    """Merge the small files of all loads into sorted large ones, as a new table ``out``.

    Rows and ledger go under the number of the last load, so a loader with the
    same checkpoint goes on with ``out`` where it left off.
    """
    last = read_loads(spark, table)[1]
    rows = read_loaded(spark, table).drop("load")
    parts = max(1, -(-rows.count() // target_rows))
    sort_events(rows, parts, by).write.parquet(f"{out}/rows/load={last}")
    read_ledger(spark, table).select("file").write.parquet(f"{out}/ledger/load={last}")
