"""Layout of the stored event table: order by timepoint, merge small files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sort_events(ev: DataFrame, partitions: int | None = None, by: str = "timepoint") -> DataFrame:
    """Rows ordered by timepoint across and within partitions.

    Parquet row groups then cover narrow ranges and range filters skip the rest.
    Rows with one timepoint are spread by arrival, so a timepoint that holds a
    third of the log is still cut into many partitions.
    """
    tagged = ev.withColumn("__arrival", F.monotonically_increasing_id())
    keys = [F.col(by), F.col("__arrival")]
    ranged = (
        tagged.repartitionByRange(partitions, *keys)
        if partitions
        else tagged.repartitionByRange(*keys)
    )
    return ranged.sortWithinPartitions(*keys).drop("__arrival")


def compact_events(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    target_rows: int = 5_000_000,
    by: str = "event.timepoint",
) -> DataFrame:
    """Rewrite a table of many small files as few sorted ones; returns ``file, rows, lo, hi``.

    A new version is written; the old one is superseded, not touched.
    """
    table = spark.read.parquet(in_dir)
    # The row count comes from footers.
    parts = max(1, -(-table.count() // target_rows))
    sort_events(table, parts, by).write.option("maxRecordsPerFile", target_rows).parquet(out_dir)
    return (
        spark.read.parquet(out_dir)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(by).alias("lo"),
            F.max(by).alias("hi"),
        )
    )


def drop_superseded(spark: SparkSession, old_dir: str, new_dir: str, by: str = "event.timepoint") -> None:
    """Delete the old version of a table once the new one holds the same rows.

    Compared by row count, bounds and sum of ``by``; on a difference nothing is
    deleted.
    """

    def facts(path: str) -> tuple:
        value = F.col(by).cast("decimal(38,0)")
        return tuple(
            spark.read.parquet(path)
            .agg(F.count(F.lit(1)), F.min(by), F.max(by), F.sum(value))
            .head()
        )

    if facts(old_dir) != facts(new_dir):
        raise ValueError(f"{new_dir} does not hold the rows of {old_dir}")
    path = spark._jvm.org.apache.hadoop.fs.Path(old_dir)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
