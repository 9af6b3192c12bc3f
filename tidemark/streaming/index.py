"""Keep the index of what each landing file holds, reading every file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.files import update_file_index
from tidemark.sources.landing import scan_flat
from tidemark.streaming.load import for_each_batch_of_files

INDEX_DDL = "filename string, min bigint, max bigint, stream string"


def maintain_index(
    spark: SparkSession, landing: str, index: str, checkpoint: str, max_files: int = 1000
) -> DataFrame:
    """Add all files not indexed yet, damaged ones too, and return the index."""

    def store(session: SparkSession, names: list[str], batch: int) -> None:
        none = session.createDataFrame([], INDEX_DDL)
        update_file_index(none, scan_flat(session, names)).coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{index}/batch={batch}")

    for_each_batch_of_files(spark, landing, "*.json.gz", checkpoint, max_files, store)
    return read_index(spark, index)


def read_index(spark: SparkSession, index: str) -> DataFrame:
    return spark.read.schema(INDEX_DDL).parquet(index)
