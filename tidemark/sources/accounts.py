"""Company accounts CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import csv_end, csv_start
from tidemark.schemas import ACCOUNTS_DDL, ACCOUNTS_NAME_COLUMNS
from tidemark.sources.landing import Paths, _paths


def accounts_schema(in_file: bool = False) -> T.StructType:
    """All 42 columns, or those that are in the CSV itself (needs a running session)."""
    schema = T.StructType.fromDDL(" ".join(ACCOUNTS_DDL.split()))
    return T.StructType(
        [f for f in schema if not in_file or f.name not in ACCOUNTS_NAME_COLUMNS]
    )


def scan_accounts(spark: SparkSession, paths: Paths) -> DataFrame:
    """All 42 columns; rows that report an error are dropped.

    A file whose header is not the expected one fails the job.
    """
    rows = (
        spark.read.schema(accounts_schema(in_file=True))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(_paths(paths))
    )
    file = F.col("_metadata.file_path")
    return rows.where(F.col("error").isNull()).select(
        "*",
        csv_start(file).alias("zip_start"),
        csv_end(file).alias("zip_end"),
        file.alias("csv_name"),
    )
