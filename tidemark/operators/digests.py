"""Comparing two snapshots by digests of hash ranges; only ranges that differ are joined.

Rows are dealt to the leaves of a tree by the first bits of their key's hash.  A leaf has
the number of its rows and two sums of their hashes that do not depend on the order, all
made before any shuffle, so equal tables move one row for each leaf and task.  Leaves
that differ are looked into with more bits while that leaves out rows; what is
left is compared row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.snapshot import compare_snapshots
from tidemark.session import pin

#: Bits of the first level, and of each further one.
BITS = 12
#: Rows that are joined without looking for a finer level, and the deepest level.
JOIN_ROWS, MOST_BITS = 1_000_000, 36


def leaf(key: str, bits: int) -> Column:
    """Number of a key's leaf; rows without a key have a leaf of their own, -1."""
    number = F.shiftrightunsigned(F.xxhash64(key), 64 - bits)
    return F.when(F.col(key).isNotNull(), number).otherwise(F.lit(-1).cast("bigint"))


def digest_leaves(snap: DataFrame, key: str, fields: Sequence[str], bits: int = BITS) -> DataFrame:
    """``leaf, n, x, y``: rows of each leaf and two sums over the hashes of their content."""
    content = [key, *fields]
    # Two hashes of the same columns that have nothing to do with each other.
    one, two = F.xxhash64(*content), F.xxhash64(F.lit("second"), *content)
    nulls = sum((F.col(c).isNull().cast("int") * (1 << i) for i, c in enumerate(fields)), F.lit(0))
    return (
        snap.select(leaf(key, bits).alias("leaf"), one.alias("one"), F.xxhash64(two, nulls).alias("two"))
        .groupBy("leaf")
        .agg(F.count(F.lit(1)).alias("n"), F.bit_xor("one").alias("x"), _wrapping_sum(F.col("two")).alias("y"))
    )


def _wrapping_sum(value: Column) -> Column:
    """A sum of 64-bit values that wraps: of the halves, which cannot overflow."""
    low = F.sum(value.bitwiseAND(F.lit((1 << 32) - 1)))
    high = F.sum(F.shiftrightunsigned(value, 32))
    return F.struct(low.alias("low"), high.alias("high"))


def compared_leaves(a: DataFrame, b: DataFrame) -> DataFrame:
    """``leaf, rows_a, rows_b, same`` of two tables of digests."""
    left = a.select("leaf", F.struct("n", "x", "y").alias("a"))
    right = b.select("leaf", F.struct("n", "x", "y").alias("b"))
    return left.join(right, "leaf", "full_outer").select(
        "leaf",
        F.coalesce("a.n", F.lit(0)).alias("rows_a"),
        F.coalesce("b.n", F.lit(0)).alias("rows_b"),
        # Rows without a key are in neither side's pairs.
        (F.col("a").eqNullSafe(F.col("b")) & (F.col("leaf") >= 0)).alias("same"),
    )


def differing_rows(
    a: DataFrame, b: DataFrame, key: str, fields: Sequence[str], bits: int = BITS, join_rows: int = JOIN_ROWS
) -> tuple[DataFrame, DataFrame, int]:
    """Rows of both sides in leaves that differ, and how many rows of each are in equal ones."""
    equal, part_a, part_b, at = 0, a, b, bits
    before = None
    while True:
        leaves = pin(
            compared_leaves(digest_leaves(part_a, key, fields, at), digest_leaves(part_b, key, fields, at)), "leaves"
        )
        same, rest_a, rest_b, odd = leaves.agg(
            F.coalesce(F.sum(F.when(F.col("same"), F.col("rows_a"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~F.col("same"), F.col("rows_a"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~F.col("same"), F.col("rows_b"))), F.lit(0)),
            F.count_if(~F.col("same")),
        ).first()
        equal += same
        hit = leaves.where("not same").select(F.col("leaf").alias("__leaf"))

        def inside(df: DataFrame, hit: DataFrame = hit, at: int = at) -> DataFrame:
            # Numbers of leaves: small beside the rows; Spark's own size check picks the join.
            return df.join(hit, leaf(key, at) == F.col("__leaf"), "left_semi")

        part_a, part_b = (inside(part_a), inside(part_b)) if odd else (a.where("false"), b.where("false"))
        rest = rest_a + rest_b
        # A level that leaves out few rows was the last one worth it.
        if rest <= join_rows or at + bits > MOST_BITS or (before is not None and 2 * rest > before):
            return part_a, part_b, equal
        before, at = rest, at + bits


def compare_by_digest(
    a: DataFrame, b: DataFrame, key: str, fields: Sequence[str], bits: int = BITS, join_rows: int = JOIN_ROWS
) -> DataFrame:
    """``compare_snapshots`` of two snapshots with unique keys, joining only what differs."""
    part_a, part_b, equal = differing_rows(a, b, key, fields, bits, join_rows)
    found = compare_snapshots(part_a, part_b, key, fields)
    return found.withColumn("both", F.col("both") + F.lit(equal).cast("bigint"))


def repeated_keys(snap: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, as ``check_unique_resources`` gives them.

    Hashes of keys are counted first; whole keys move only where a hash stands twice.
    """
    hashes = snap.groupBy(F.xxhash64(key).alias("__hash")).count().where("count > 1").select("__hash")
    hashes = pin(hashes, "repeated-hashes")
    some = snap.select(key).join(hashes, F.xxhash64(key) == F.col("__hash"), "left_semi")
    return some.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
