"""What the operators share: reading tables, Arrow batches, byte hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import pin

#: Rows and bytes of one Arrow batch: bounds the memory of a Python task.
BATCH_ROWS = 2_000
BATCH_BYTES = 8 << 20

_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` over batches of bounded size."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def texts_of(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; NULL is empty."""
    return column.fill_null("").cast(pa.binary()).to_pylist()


def chunks(texts: Sequence[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of ``limit`` bytes together, or one text beyond it."""
    lo, size = 0, 0
    for i, text in enumerate(texts):
        if i > lo and size + len(text) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(text) + 1
    if lo < len(texts):
        yield lo, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


#: A 64-bit value for each byte.
BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))

_PLACES = np.zeros(0, _U)


def _places(n: int) -> np.ndarray:
    """An odd factor for each place of a span; kept for the next call."""
    global _PLACES
    if len(_PLACES) >= n:
        return _PLACES[:n]
    made = mix(np.arange(1, max(n, 1 << 12) + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
    if n <= 1 << 20:  # a single huge word: not worth keeping
        _PLACES = made
    return made[:n]


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, values: np.ndarray = BYTE) -> np.ndarray:
    """Of each ``buf[start:end]``; spans are in order, not empty, and do not overlap.

    A sum over the places of a span, each with a factor of its own: no pattern of bytes
    cancels, as it can where factors are powers of one number.
    """
    if not len(start):
        return np.zeros(0, _U)
    size = end - start
    first = np.cumsum(size) - size
    inner = np.arange(int(size.sum())) - np.repeat(first, size)
    at = inner + np.repeat(start, size)
    total = np.add.reduceat(values[buf[at]] * _places(int(size.max()))[inner], first)
    return mix(total + size.astype(_U) * _U(0xC2B2AE3D27D4EB4F))


def grams(buf: np.ndarray, sizes: tuple[int, ...], seed: int = 0) -> list[np.ndarray]:
    """Hashes of every ``k`` bytes in a row, for ascending ``sizes``.

    Hashes of twice the length are made from two that follow each other, and of any length
    from two that overlap, scrambled at every step: equal only for equal bytes.
    """
    first, second = mix(np.array([2 * seed + 1, 2 * seed + 2], _U)) | _U(1)

    def joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = x * first
        out += y * second
        out ^= out >> _U(31)
        return out

    out = []
    level, span = mix(BYTE + _U(seed))[buf], 1
    for k in sizes:
        while 2 * span <= k:
            level = joined(level[:-span], level[span:]) if len(level) > span else level[:0]
            span *= 2
        n = max(0, len(buf) - k + 1)
        out.append(mix(level[:n] if span == k else joined(level[:n], level[k - span : k - span + n])))
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def text_key() -> F.Column:
    """Tells rows of one doc_id apart by their text."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    """Add ``doc`` and ``tie``, never NULL, that together name a document.

    ``doc`` is doc_id, ``tie`` is 0.  Rows whose doc_id is NULL (they come last)
    or stands on several rows are told apart by a hash of their text in ``tie``;
    rows equal in both are one document.  The list of such ids is written first:
    as a rule it is empty, and Spark's own size check picks the join.
    """
    again = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    again = pin(again.select(F.col("doc_id").alias("__id"), F.lit(True).alias("__again")), "again")
    out = docs.join(again, F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    return out.withColumns(
        {
            "doc": F.coalesce("doc_id", F.lit(2**63 - 1)),
            "tie": F.when(F.col("__again"), text_key()).otherwise(F.lit(0)),
        }
    ).drop("__id", "__again")
