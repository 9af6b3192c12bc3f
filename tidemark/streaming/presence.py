"""Presence of timepoints, kept beside a loaded table, load by load.

``presence/words/load=<n>`` has one row for each 64 timepoints of load ``n`` (mask, bits
that occur an odd number of times, count); ``presence/marks/load=<n>`` is written last and
says which files of ``rows/load=<n>`` that was made from, and what the words add up to.
A load whose files are the ones its mark knows is not read again; one that a correction
rewrote, or that was never indexed, is.  So a daily check reads the rows of new loads, one
mark of every load, and the words of the places where loads meet.

The checks begin at the timepoint ``start``; words are cut there, so those of the whole log
are kept as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.files import exists, hadoop_path
from tidemark.operators.checks import null_data, table_report
from tidemark.operators.events import flatten
from tidemark.operators.ranges import SPAN, issues_of_words, merged_words, timepoint_words
from tidemark.schemas import FIRST_CHECKED_TIMEPOINT, check_stream
from tidemark.session import pin, temporary
from tidemark.streaming.load import read_loaded, read_loads

_WORDS_DDL = (
    "checked boolean, word bigint, mask bigint, odd bigint, n bigint, lo bigint, hi bigint, "
    "newest string, null_rows bigint, load bigint"
)
_MARKS_DDL = (
    "files bigint, digest bigint, start bigint, row_count bigint, distinct_timepoints bigint, "
    "min_tp bigint, max_tp bigint, newest string, null_rows bigint, load bigint"
)
#: Ranges of words that are compared across loads; beyond it the nearest are taken together.
_MOST_SEAMS = 64


def _read(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(path)


def read_marks(spark: SparkSession, table: str) -> DataFrame:
    """One row for each load that is indexed."""
    return _read(spark, f"{table}/presence/marks", _MARKS_DDL)


def stored_files(spark: SparkSession, table: str) -> DataFrame:
    """``load, files, digest``: names and sizes of the files of each load, none of them opened.

    Written files have names that never come again, so a load that was rewritten differs.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(f"{table}/rows")
        .select("path", "length")
    )
    load = F.regexp_extract("path", r"/load=(-?\d+)/", 1).cast("bigint")
    name = F.regexp_extract("path", "[^/]+$", 0)
    return listed.groupBy(load.alias("load")).agg(
        F.count(F.lit(1)).alias("files"), F.bit_xor(F.xxhash64(name, "length")).alias("digest")
    )


def in_table(spark: SparkSession, table: str) -> Column:
    """Is a load one of those the ledger has."""
    return F.col("load").between(*read_loads(spark, table))


def _words(rows: DataFrame, start: int) -> DataFrame:
    ev = flatten(rows)
    checked = F.coalesce(F.col("timepoint") >= start, F.lit(False))
    seen = ev.select(
        F.col("load").cast("bigint").alias("load"),
        checked.alias("checked"),
        "timepoint",
        F.when(checked, F.col("published_at")).alias("published_at"),
        null_data().alias("lacks_data"),
    )
    return timepoint_words(
        seen,
        F.max("published_at").alias("newest"),
        F.count_if("lacks_data").alias("null_rows"),
        by=["load", "checked"],
    )


def refresh_presence(spark: SparkSession, table: str, start: int | None = None) -> DataFrame:
    """Index the loads that are new or were rewritten; returns their numbers.

    Without ``start`` that of the marks stays (0 at first); with another one than before,
    all loads are indexed anew.  Marks of loads that are gone are deleted.  A run
    that was stopped leaves a load without a valid mark, which the next run indexes.
    """
    stored = pin(stored_files(spark, table).where(in_table(spark, table)), "stored-files")
    same = ["load", "files", "digest"]
    known = read_marks(spark, table)
    if start is None:
        start = known.agg(F.max("start")).head()[0] or 0
    known = known.where(F.col("start") == start)
    stale = pin(stored.join(known.select(*same), same, "left_anti"), "stale-loads")
    # One number for each load that came since the last run; no other folder is listed or opened.
    loads = [r.load for r in stale.select("load").collect()]
    if loads:
        folders = [f"{table}/rows/load={n}" for n in loads]
        rows = spark.read.option("basePath", f"{table}/rows").parquet(*folders)
        write_loads(_words(rows, start).repartitionByRange("load", "word").sortWithinPartitions("load", "word"),
               f"{table}/presence/words")
        write_loads(_marks(spark, table, stale, start), f"{table}/presence/marks")
    gone = read_marks(spark, table).join(stored, "load", "left_anti").select("load")
    for row in gone.toLocalIterator():
        for kind in ("marks", "words"):
            fs, path = hadoop_path(spark, f"{table}/presence/{kind}/load={row.load}")
            fs.delete(path, True)
    return spark.createDataFrame([(n,) for n in sorted(loads)], "load bigint")


def write_loads(df: DataFrame, path: str) -> None:
    """Replace the folders ``load=<n>`` that ``df`` has rows of."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("load").parquet(path)
    )


def _marks(spark: SparkSession, table: str, stale: DataFrame, start: int) -> DataFrame:
    """What the words of each of some loads add up to; a load without events has a mark too."""
    words = _read(spark, f"{table}/presence/words", _WORDS_DDL)

    def checked(value: Column) -> Column:
        return F.when(F.col("checked"), value)

    sums = words.join(stale.select("load"), "load", "left_semi").groupBy("load").agg(
        F.sum(checked(F.col("n"))).alias("row_count"),
        F.sum(checked(F.bit_count("mask").cast("bigint"))).alias("distinct_timepoints"),
        F.min(checked(F.col("lo"))).alias("min_tp"),
        F.max(checked(F.col("hi"))).alias("max_tp"),
        F.max("newest").alias("newest"),
        F.sum("null_rows").alias("null_rows"),
    )
    return stale.join(sums, "load", "left").withColumn("start", F.lit(start).cast("bigint")).coalesce(1)


def seams(bounds: list[tuple[int, int]], most: int = _MOST_SEAMS) -> list[tuple[int, int]]:
    """Disjoint ranges that hold every number inside two of the given ranges.

    Beyond ``most`` of them, those next to each other become one, nearest first; what
    that adds lies in one range only and changes no sum.
    """
    shared: list[tuple[int, int]] = []
    reach = None
    for lo, hi in sorted(bounds):
        if reach is not None and lo <= reach:
            to = min(hi, reach)
            if shared and lo <= shared[-1][1] + 1:
                shared[-1] = (shared[-1][0], max(shared[-1][1], to))
            else:
                shared.append((lo, to))
        reach = hi if reach is None else max(reach, hi)
    if len(shared) <= most:
        return shared
    holes = [(later[0] - earlier[1], k) for k, (earlier, later) in enumerate(zip(shared, shared[1:], strict=False))]
    keep = {k for _, k in sorted(holes, reverse=True)[: most - 1]}
    out = [shared[0]]
    for k, part in enumerate(shared[1:]):
        if k in keep:
            out.append(part)
        else:
            out[-1] = (out[-1][0], part[1])
    return out


def _counted_again(spark: SparkSession, table: str, marks: list) -> DataFrame:
    """``again``: timepoints that the sums of the loads count more than once."""
    bounds = [(m.min_tp >> 6, m.max_tp >> 6) for m in marks if m.min_tp is not None]
    words = _read(spark, f"{table}/presence/words", _WORDS_DDL).where(in_table(spark, table))
    inside = F.lit(False)
    for lo, hi in seams(bounds):
        inside = inside | F.col("word").between(lo, hi)
    bits = F.bit_count("mask").cast("bigint")
    met = words.where(F.col("checked") & inside).groupBy("word").agg(
        F.sum(bits).alias("bits"), F.bit_or("mask").alias("mask")
    )
    return met.agg(F.coalesce(F.sum(F.col("bits") - bits), F.lit(0)).alias("again"))


def verify_loaded(spark: SparkSession, table: str, now: str, start: int = 0) -> DataFrame:
    """``verify_events`` of a loaded table; rows are read of new loads only."""
    with temporary(spark):
        refresh_presence(spark, table, start)
    marks = read_marks(spark, table)
    # One row for each load.
    again = _counted_again(spark, table, marks.collect()).scalar()
    facts = marks.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        (F.coalesce(F.sum("distinct_timepoints"), F.lit(0)) - again).alias("distinct_timepoints"),
        F.min("min_tp").alias("min_tp"),
        F.max("max_tp").alias("max_tp"),
        F.max("newest").alias("newest"),
        F.coalesce(F.sum("null_rows"), F.lit(0)).alias("null_rows"),
    ).withColumn("diff_timepoints", F.col("max_tp") - F.col("min_tp") + 1)
    return table_report(facts, now)


def verify_loaded_stream(spark: SparkSession, table: str, stream: str, now: str) -> DataFrame:
    """``verify_loaded`` from the first timepoint of the stream that is to be checked."""
    return verify_loaded(spark, table, now, FIRST_CHECKED_TIMEPOINT.get(check_stream(stream), 0))


def loaded_words(spark: SparkSession, table: str) -> DataFrame:
    """``timepoint_words`` of a loaded table, merged from its loads."""
    refresh_presence(spark, table)
    words = _read(spark, f"{table}/presence/words", _WORDS_DDL)
    return merged_words(words.where(F.col("word").isNotNull() & in_table(spark, table)))


def loaded_issues(spark: SparkSession, table: str, span: int = SPAN) -> DataFrame:
    """Missing and duplicate ranges of a loaded table, from its words.

    The log itself is read only where one timepoint stands three times or more.
    """
    words = pin(loaded_words(spark, table), "words")
    return issues_of_words(words, lambda: flatten(read_loaded(spark, table)), span)


def carry_presence(spark: SparkSession, table: str, out: str) -> None:
    """Presence of the compacted table ``out`` from that of the table it was made from.

    Compaction changes no event, so the words are merged and no row is read; refused
    (ValueError) if the two do not hold equally many rows.
    """
    with temporary(spark):
        refresh_presence(spark, table)
        counts = [read_loaded(spark, path).count() for path in (table, out)]
        if counts[0] != counts[1]:
            raise ValueError(f"{out} has {counts[1]} rows, {table} has {counts[0]}")
        stored = pin(stored_files(spark, out), "stored-files")
        load = stored.select("load").head()[0]
        words = _read(spark, f"{table}/presence/words", _WORDS_DDL).where(in_table(spark, table))
        newest = (F.max("newest").alias("newest"), F.sum("null_rows").alias("null_rows"))
        whole = merged_words(words, *newest, by=["checked"]).withColumn("load", F.lit(load))
        write_loads(whole.repartitionByRange("word").sortWithinPartitions("word"), f"{out}/presence/words")
        start = read_marks(spark, table).agg(F.max("start")).head()[0]
        write_loads(_marks(spark, out, stored, start), f"{out}/presence/marks")
