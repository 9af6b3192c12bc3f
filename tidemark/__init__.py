"""tidemark: Spark jobs over an append-only event log keyed by a dense timepoint.

The log is a DataFrame (parquet at rest, gzip NDJSON on arrival).  Every
operator takes DataFrames and returns a DataFrame, so Catalyst sees the whole
plan and callers decide when to run it.
"""

__version__ = "0.1.0"
