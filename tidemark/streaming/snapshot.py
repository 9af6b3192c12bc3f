"""Keep the latest state per resource as events are loaded.

Each batch stores only its own newest row per key, tombstones included.  The
state is the newest row over all batches; taking a maximum does not depend on
how events were split into batches or in which order those came.  A batch so
costs what it holds, not the size of the state; ``fold_state`` merges the batches
into one when reading them becomes the larger cost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.events import flatten
from tidemark.operators.snapshot import live_view, newest_rows


def maintain_snapshot(
    spark: SparkSession,
    table: str,
    state: str,
    checkpoint: str,
    max_files: int = 1000,
    key: str = "resource_uri",
) -> None:
    """Fold all stored event files not seen yet into the state (``table`` holds parquet)."""
    schema = spark.read.parquet(table).schema

    def store(events: DataFrame, batch: int) -> None:
        newest_rows(flatten(events), key).write.mode("overwrite").parquet(
            f"{state}/batch={batch}"
        )

    query = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(table)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_state(spark: SparkSession, state: str, key: str = "resource_uri") -> DataFrame:
    """Newest row per key with tombstones."""
    return newest_rows(spark.read.parquet(state).drop("batch"), key)


def current_snapshot(spark: SparkSession, state: str, key: str = "resource_uri") -> DataFrame:
    """Live rows; equals ``latest_snapshot`` of every event folded in so far."""
    return live_view(read_state(spark, state, key))


def fold_state(
    spark: SparkSession, state: str, folded: str, key: str = "resource_uri"
) -> None:
    """Merge all batches of ``state`` into one folder of a new state.

    The folder is named as batch -1, before any batch the stream may add.
    """
    read_state(spark, state, key).write.parquet(f"{folded}/batch=-1")


def next_timepoint(events: DataFrame) -> DataFrame:
    """Where a capture that feeds ``events`` goes on; NULL before the first event."""
    return events.agg((F.max("timepoint") + 1).alias("next_timepoint"))
