"""Exact duplicates by 128-bit content hash, with the bytes compared inside groups.

Texts are equal when they are after deleting white space.  The grouping key is
the hash followed by the normalised text, so rows are sorted and spread by the
hash while Spark's aggregation itself compares bytes: texts whose hashes collide
stay apart.  Copies meet in the map-side aggregation already, so a huge group
costs one row for each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def normalised(text: Column | str = "text") -> Column:
    """The text without ``[\\x20\\x09-\\x0D]``; NULL is empty."""
    out = F.coalesce(text, F.lit(""))
    for space in _SPACES:
        out = F.replace(out, F.lit(space), F.lit(""))
    return out


def _hashed(docs: DataFrame) -> DataFrame:
    """With the hash, the normalised text and the rank: least stays."""
    return docs.withColumn("__norm", normalised()).withColumns(
        {
            "__hash": F.unhex(F.md5("__norm")),
            # Longest original text first, then the smallest id; NULL ids last.
            "__rank": F.struct(
                (-F.char_length(F.coalesce("text", F.lit("")))).alias("chars"),
                F.col("doc_id").isNull().alias("no_id"),
                F.col("doc_id").alias("id"),
            ),
        }
    )


def decisions(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    NULL texts are empty, and empty texts equal each other.  group_size counts
    rows.  Rows equal in doc_id and text length inside a group are one document:
    all of them are kept or none.
    """
    rows = _hashed(docs.select("doc_id", "text"))
    groups = (
        rows.groupBy("__hash", "__norm")
        .agg(F.count("*").alias("group_size"), F.min("__rank").alias("best"))
        .select("__hash", F.sha2("__norm", 256).alias("text_sha256"), "group_size", "best")
    )
    # Back to the rows by hash and a second, independent hash: no texts move here.
    return (
        rows.select("doc_id", "__hash", "__rank", F.sha2("__norm", 256).alias("text_sha256"))
        .join(groups, ["__hash", "text_sha256"])
        .select(
            "doc_id",
            F.col("best.id").alias("keep_id"),
            "group_size",
            F.col("__rank").eqNullSafe(F.col("best")).alias("kept"),
            "text_sha256",
        )
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """Exactly one whole row of every group, with the columns of ``docs``."""
    order = F.struct("__rank", F.xxhash64(F.coalesce("text", F.lit(""))))
    # The caller's row is one column, so no name of it can meet one of ours.
    rows = _hashed(docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")))
    return rows.groupBy("__hash", "__norm").agg(F.min_by("row", order).alias("row")).select("row.*")


ORACLE = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents)
select doc_id,
       first_value(doc_id) over (partition by norm order by chars desc, doc_id) as keep_id,
       count(*) over (partition by norm) as group_size,
       doc_id = first_value(doc_id) over (partition by norm order by chars desc, doc_id) as kept,
       sha256(norm) as text_sha256
from d
"""
