"""Latest row per key in hash buckets: a batch rewrites the buckets it touches, no others.

``rows/bucket=<b>/version=<n>`` is bucket ``b`` as batch ``n`` left it, tombstones
included; ``commits/version=<n>`` names the buckets that batch rewrote and is written last.
The newest committed version of every bucket is the state, and a batch that runs again
writes its own version again from the ones before it.  One job at a time writes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.files import exists, hadoop_path
from tidemark.operators.events import flatten
from tidemark.operators.snapshot import live_view, newest_rows
from tidemark.session import pin, temporary

#: As many buckets as leave a bucket one task's work; ``rebucket`` changes it.
BUCKETS = 256

_COMMIT_DDL = "bucket int, buckets int, row_count bigint, version bigint"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_commits(spark: SparkSession, state: str) -> DataFrame:
    """``bucket, buckets, row_count, version`` of every bucket rewritten so far."""
    if not exists(spark, f"{state}/commits"):
        return spark.createDataFrame([], _COMMIT_DDL)
    return spark.read.schema(_COMMIT_DDL).parquet(f"{state}/commits")


def _current(spark: SparkSession, state: str, before: int | None = None) -> dict[int, int]:
    """Newest committed version of each bucket; as many as there are buckets."""
    commits = read_commits(spark, state)
    if before is not None:
        commits = commits.where(F.col("version") < before)
    return {r.bucket: r.version for r in commits.groupBy("bucket").agg(F.max("version").alias("version")).collect()}


def _stored(spark: SparkSession, state: str, versions: dict[int, int]) -> DataFrame | None:
    """Rows of these versions; no other folder is listed."""
    folders = [f"{state}/rows/bucket={b}/version={n}" for b, n in sorted(versions.items())]
    if not folders:
        return None
    return spark.read.option("basePath", f"{state}/rows").parquet(*folders).drop("version")


def _write(df: DataFrame, path: str, *folders: str) -> None:
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders).parquet(path)
    )


def apply_batch(
    spark: SparkSession,
    state: str,
    events: DataFrame,
    version: int,
    key: str = "resource_uri",
    buckets: int = BUCKETS,
) -> int:
    """Fold a batch of flat events into the state; returns how many buckets it rewrote.

    Timepoints decide, not arrival, so batches may come in any split and order.  The number
    of buckets is fixed by the first batch.  ``version`` grows from batch to batch; the
    last one may be applied again.
    """
    last, fixed = read_commits(spark, state).agg(F.max("version"), F.max("buckets")).head()
    if last is not None and version < last:
        raise ValueError(f"batch {version} comes after batch {last}")
    buckets = fixed or buckets
    with temporary(spark):
        new = newest_rows(events, key).withColumn("bucket", bucket_of(F.col(key), buckets))
        new = pin(new, "batch")
        touched = {r.bucket for r in new.select("bucket").distinct().collect()}
        if not touched:
            return 0
        before = _current(spark, state, version)
        old = _stored(spark, state, {b: n for b, n in before.items() if b in touched})
        rows = new if old is None else new.unionByName(old.select(*new.columns))
        # Dealt by bucket, which also brings the rows of a key together.
        newest = _newest_in_bucket(rows.repartition("bucket"), key)
        _write(
            newest.withColumn("version", F.lit(version)).sortWithinPartitions("bucket", key),
            f"{state}/rows", "bucket", "version",
        )
        written = _stored(spark, state, dict.fromkeys(touched, version))
        commit = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("row_count")).select(
            "bucket", F.lit(buckets).alias("buckets"), "row_count"
        )
        commit.coalesce(1).write.mode("overwrite").parquet(f"{state}/commits/version={version}")
    return len(touched)


def _newest_in_bucket(rows: DataFrame, key: str) -> DataFrame:
    ties = [c for c in ("published_at", "type", "data", "file") if c in rows.columns]
    newest_first = Window.partitionBy("bucket", key).orderBy(
        F.col("timepoint").desc(), *(F.col(c).desc() for c in ties)
    )
    return rows.withColumn("__rank", F.row_number().over(newest_first)).where("__rank = 1").drop("__rank")


def read_buckets(spark: SparkSession, state: str) -> DataFrame:
    """Newest row per key with tombstones."""
    rows = _stored(spark, state, _current(spark, state))
    if rows is None:
        raise ValueError(f"{state} holds no batch")
    return rows.drop("bucket")


def bucketed_snapshot(spark: SparkSession, state: str) -> DataFrame:
    """Live rows; equals ``latest_snapshot`` of every event folded in so far."""
    return live_view(read_buckets(spark, state))


def lookup(
    spark: SparkSession, state: str, keys: Sequence[str], key: str = "resource_uri"
) -> DataFrame:
    """Rows of some keys (tombstones too), read from their buckets alone."""
    current = _current(spark, state)
    buckets = read_commits(spark, state).agg(F.max("buckets")).head()[0]
    wanted = spark.createDataFrame([(k,) for k in dict.fromkeys(keys)], f"{key} string")
    hit = {
        r.bucket
        for r in wanted.select(bucket_of(F.col(key), buckets or 1).alias("bucket")).distinct().collect()
    }
    rows = _stored(spark, state, {b: n for b, n in current.items() if b in hit})
    if rows is None:
        # No bucket holds any of them: no row, with the columns of the state.
        return read_buckets(spark, state).where("false")
    return rows.drop("bucket").where(F.col(key).isin(list(keys)))


def maintain_buckets(
    spark: SparkSession,
    table: str,
    state: str,
    checkpoint: str,
    max_files: int = 1000,
    key: str = "resource_uri",
    buckets: int = BUCKETS,
) -> None:
    """Fold all stored event files not seen yet into the state (``table`` holds parquet)."""
    schema = spark.read.parquet(table).schema

    def store(events: DataFrame, batch: int) -> None:
        apply_batch(events.sparkSession, state, flatten(events), batch, key, buckets)

    (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(table)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def rebucket(spark: SparkSession, state: str, out: str, buckets: int, key: str = "resource_uri") -> None:
    """The state in another number of buckets, as a new state that goes on from the last batch."""
    last = read_commits(spark, state).agg(F.max("version")).head()[0]
    apply_batch(spark, out, read_buckets(spark, state), last, key, buckets)


def drop_old_versions(spark: SparkSession, state: str) -> int:
    """Delete the versions of buckets that later ones replaced; returns how many.

    Their commits stay: they are the history of the state, and small.
    """
    current = _current(spark, state)
    gone = 0
    for row in read_commits(spark, state).select("bucket", "version").toLocalIterator():
        if row.version < current[row.bucket]:
            fs, path = hadoop_path(spark, f"{state}/rows/bucket={row.bucket}/version={row.version}")
            gone += fs.delete(path, True)
    return gone
