"""Samples of a loaded table from sketches kept per load.

``sample/rows/load=<n>`` has, for every day of publication in load ``n``, the rows with the
least hashes of their key.  Sketches merge: the least of a table, or of some days, are
among the least of their parts.  As with presence, a load is read again only if its files
are other ones than its mark knows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.files import exists, hadoop_path
from tidemark.operators.events import flatten
from tidemark.schemas import SAMPLE_ROWS
from tidemark.session import pin, temporary
from tidemark.streaming.presence import in_table, stored_files, write_loads

_MARKS_DDL = "files bigint, digest bigint, rows int, seed string, key string, load bigint"


def _marks(spark: SparkSession, table: str) -> DataFrame:
    path = f"{table}/sample/marks"
    return spark.read.schema(_MARKS_DDL).parquet(path) if exists(spark, path) else spark.createDataFrame([], _MARKS_DDL)


def _order(key: str, seed: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")))


def refresh_samples(
    spark: SparkSession, table: str, n: int = SAMPLE_ROWS, seed: str = "sample", key: str = "timepoint"
) -> int:
    """Sketch the loads that are new or were rewritten; returns how many.

    With another size, seed or key than before all loads are sketched anew.
    """
    with temporary(spark):
        stored = pin(stored_files(spark, table).where(in_table(spark, table)), "stored-files")
        marks = _marks(spark, table)
        alike = (F.col("rows") == n) & (F.col("seed") == seed) & (F.col("key") == key)
        same = ["load", "files", "digest"]
        stale = pin(stored.join(marks.where(alike).select(*same), same, "left_anti"), "stale-loads")
        # One number for each load that came since the last run.
        loads = [r.load for r in stale.select("load").collect()]
        if loads:
            folders = [f"{table}/rows/load={k}" for k in loads]
            rows = flatten(spark.read.option("basePath", f"{table}/rows").parquet(*folders))
            rows = rows.withColumns(
                {"day": F.substring("published_at", 1, 10), "hash": _order(key, seed), "load": F.col("load").cast("bigint")}
            )
            # Each task keeps at most n of a load and day before anything moves.
            of_day = Window.partitionBy("load", "day").orderBy("hash", key, "file")
            least = rows.withColumn("__rank", F.row_number().over(of_day)).where(F.col("__rank") <= n)
            write_loads(least.drop("__rank").repartition("load"), f"{table}/sample/rows")
            write_loads(
                stale.withColumns({"rows": F.lit(n), "seed": F.lit(seed), "key": F.lit(key)}).coalesce(1),
                f"{table}/sample/marks",
            )
        gone = _marks(spark, table).join(stored, "load", "left_anti").select("load")
        for row in gone.toLocalIterator():
            for kind in ("marks", "rows"):
                fs, path = hadoop_path(spark, f"{table}/sample/{kind}/load={row.load}")
                fs.delete(path, True)
    return len(loads)


def sample_loaded(
    spark: SparkSession,
    table: str,
    n: int = SAMPLE_ROWS,
    seed: str = "sample",
    key: str = "timepoint",
    first_day: str | None = None,
    last_day: str | None = None,
) -> DataFrame:
    """The rows of ``sample_rows`` over the loaded table, or its days, read from sketches.

    Rows are flat.  Those that have a key in common are taken in the order of their files.
    """
    refresh_samples(spark, table, n, seed, key)
    rows = spark.read.parquet(f"{table}/sample/rows").where(in_table(spark, table))
    if first_day is not None:
        rows = rows.where(F.col("day") >= first_day)
    if last_day is not None:
        rows = rows.where(F.col("day") <= last_day)
    return rows.orderBy("hash", key, "file").limit(n).drop("hash", "day", "load")
