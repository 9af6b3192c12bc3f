"""Register tables: tab-separated text or a JSON array, one table per file set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import REGISTER_DDL
from tidemark.session import settings
from tidemark.sources.landing import Paths, _paths
from tidemark.sources.records import json_records, quoted_records

REJECTED = "_rejected"


def register_schema(table: str) -> T.StructType:
    """Documented columns of a register table."""
    if table not in REGISTER_DDL:
        raise ValueError(f"unknown register table {table!r}")
    return T.StructType.fromDDL(REGISTER_DDL[table])


def scan_register(
    spark: SparkSession, table: str, paths: Paths, json_array: bool = False
) -> DataFrame:
    """One register table with its documented columns, and ``_rejected``.

    A file whose header is not exactly the documented one, in order, fails the job;
    of JSON objects fields go by name.  A value that does not fit its type is NULL
    and stands in ``_rejected`` (column name to text), which is NULL for sound rows.
    Nothing is inferred, so the data is read once.  Fields may hold tabs and line
    breaks in quotes, so a file is read by one task; land large tables as several files.
    """
    schema = register_schema(table)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    reader = spark.read.schema(text).option("multiLine", True)
    if json_array:
        raw = reader.option("mode", "FAILFAST").json(_paths(paths))
    else:
        raw = (
            reader.option("sep", "\t")
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", "FAILFAST")
            .option("escape", '"')
            .csv(_paths(paths))
        )
    return _typed(raw, schema)


def scan_register_split(
    spark: SparkSession,
    table: str,
    paths: Paths,
    json_array: bool = False,
    split_bytes: int | None = None,
) -> DataFrame:
    """``scan_register`` in which one file is read by many tasks, whatever its records hold.

    Splits are cut at bytes; where records begin in a split follows from the quotes (of a
    JSON array also the brackets) of those before it.  ``split_bytes`` is the size of a
    split, by default that of the session.  A file of JSON must be one array of objects;
    a nested value, which no documented column has, is written without white space.
    The text is written once to the shared folder, cut into pieces.
    """
    schema = register_schema(table)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    size = {} if split_bytes is None else {"spark.sql.files.maxPartitionBytes": str(split_bytes)}
    with settings(spark, size):
        if json_array:
            records = json_records(spark, paths)
            parsed = F.from_json("record", text, {"mode": "FAILFAST"})
            return _typed(records.select(parsed.alias("row")).select("row.*"), schema)
        records = quoted_records(spark, paths, "\t")
    options = {"sep": "\t", "escape": '"', "mode": "FAILFAST", "multiLine": "true"}
    row = F.from_csv("record", F.lit(text.simpleString()), options)
    wrong = F.concat(F.lit("not the documented header in "), F.col("file"), F.lit(": "), F.substring("record", 1, 200))
    names = F.array(*(F.lower(F.col(f"row.`{f.name}`")) for f in schema))
    header = names == F.array(*(F.lit(f.name.lower()) for f in schema))
    # The header of each file is checked and left out.
    body = records.select("file", "record", "first", row.alias("row")).where(
        ~F.col("first") | F.when(~F.coalesce(header, F.lit(False)), F.raise_error(wrong).cast("boolean")).otherwise(False)
    )
    return _typed(body.select("row.*"), schema)


def _typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    misfits = [
        F.when(
            F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(),
            F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("text")),
        )
        for f in schema
        if f.dataType != T.StringType()
    ]
    found = F.array_compact(F.array(*misfits))
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    rejected = F.when(F.size(found) > 0, F.map_from_entries(found)).alias(REJECTED)
    return raw.select(*typed, rejected)


def rejected_rows(scanned: dict[str, DataFrame]) -> DataFrame:
    """``table, column, rows`` of the values that did not fit, over several scans."""
    parts = [
        df.select(F.explode(F.map_keys(REJECTED)).alias("column"))
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(table).alias("table"), "column", "rows")
        for table, df in scanned.items()
    ]
    return reduce(DataFrame.unionByName, parts)
