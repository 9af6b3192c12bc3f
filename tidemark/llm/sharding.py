"""Shards of bounded size by extendible hashing.

A document's hash is read from its highest bit.  The directory is a set of hash
prefixes: a bucket over the byte limit is split on one more bit, a bucket that
fits is a shard.  Bits are settled several at a time: sums for all prefix lengths
of a round come from one small histogram of the buckets still over the limit, so
a round reads less than the one before and the driver sees one count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import pin

HASH_BITS = 60
#: Bits settled by one round.
ROUND_BITS = 8
#: Byte limit of a shard in the registered query.
SHARD_BYTES = 1 << 20
_EXPLODE = 10_000


def document_hash() -> Column:
    """The first 60 bits of an MD5 of the id and the text."""
    name = F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
        F.lit(":"),
        F.md5(F.coalesce("text", F.lit(""))),
    )
    return F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(value: Column | str, drop: Column) -> Column:
    return F.call_function("shiftright", F.col(value) if isinstance(value, str) else value, drop)


def _settle(open_: DataFrame, done: int, level: int, limit: int) -> DataFrame:
    """(cell, depth): the shortest fitting prefix of each cell of ``level`` bits, or NULL."""
    cells = open_.groupBy(_prefix("hash", F.lit(HASH_BITS - level)).alias("cell")).agg(
        F.sum(F.col("n_bytes") * F.col("copies")).alias("bytes"),
        F.min("hash").alias("low"),
        F.max("hash").alias("high"),
    )
    # The length that the last round ended on is known not to fit.
    deep = cells.withColumn("depth", F.explode(F.sequence(F.lit(done), F.lit(level)))).withColumn(
        "prefix", _prefix("cell", F.lit(level) - F.col("depth"))
    )
    fits = (
        deep.groupBy("depth", "prefix")
        .agg(F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high"))
        # One hash cannot be split any further.
        .where((F.col("bytes") <= limit) | (F.col("low") == F.col("high")))
        .select("depth", "prefix", F.col("depth").alias("fit"))
    )
    return (
        deep.select("cell", "depth", "prefix")
        .join(fits, ["depth", "prefix"], "left")
        .groupBy("cell")
        .agg(F.min("fit").alias("depth"))
    )


def _places(docs: DataFrame, limit: int) -> DataFrame:
    """(hash, doc_id, n_bytes, copies, depth) for each distinct row of ``docs``."""
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    rows = docs.select("doc_id", size.alias("n_bytes"), document_hash().alias("hash"))
    open_ = pin(
        rows.groupBy("hash", "doc_id", "n_bytes").agg(F.count("*").alias("copies")), "shard-rows"
    )
    settled = []
    start = 0
    for level in [*range(ROUND_BITS, HASH_BITS, ROUND_BITS), HASH_BITS]:
        depth = _settle(open_, start, level, limit)
        cell = _prefix("hash", F.lit(HASH_BITS - level))
        found = pin(open_.withColumn("cell", cell).join(depth, "cell").drop("cell"), "shard-depth")
        settled.append(found.where("depth is not null"))
        open_ = found.where("depth is null").drop("depth")
        start = level + 1
        if open_.isEmpty():
            break
    return reduce(DataFrame.unionByName, settled)


def _label() -> Column:
    bits = F.bin(_prefix("hash", F.lit(HASH_BITS) - F.col("depth")))
    return F.when(F.col("depth") == 0, "").otherwise(F.lpad(bits, F.col("depth"), F.lit("0")))


def shards(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, shard, depth, overflow) for each row of ``docs``.

    ``shard`` is the bucket's hash prefix of ``depth`` bits, '' if all fits in one.
    NULL texts have 0 bytes, a NULL id is an id like others.  Rows equal in id and
    text have one hash: where they alone exceed the limit they fill overflow
    buckets 0, 1, ... of their shard.  A text beyond the limit is alone in its own.
    """
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("n_bytes"), F.lit(1))))
    # Copies come back as rows, in two steps so that no array is long.
    step = F.lit(_EXPLODE).cast("long")
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, step))
    last = F.least(F.col("block") + step, F.col("copies")) - 1
    spread = _places(docs, limit).withColumn("block", block)
    return spread.withColumn("copy", F.explode(F.sequence("block", last))).select(
        "doc_id",
        "n_bytes",
        _label().alias("shard"),
        F.col("depth").cast("int").alias("depth"),
        F.floor(F.col("copy") / each).cast("long").alias("overflow"),
    )


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """Write ``docs`` as Parquet, one folder for each shard, with all columns.

    Rows equal in id and text stay in one folder, in several files beyond the limit.
    """
    place = _places(docs, limit).select(F.col("hash").alias("__hash"), _label().alias("shard"))
    (
        docs.drop("shard")
        .withColumn("__hash", document_hash())
        .join(place, "__hash")
        .drop("__hash")
        .repartition("shard")
        .write.partitionBy("shard")
        .parquet(path)
    )


ORACLE = f"""
with d as (
  select doc_id, strlen(coalesce(text, '')) as n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || ':' || md5(coalesce(text, ''))),
                         1, {HASH_BITS // 4}))::bigint as hash
  from documents),
p as (
  select hash, n_bytes, k::int as depth, hash >> ({HASH_BITS} - k)::int as prefix
  from d, range({HASH_BITS + 1}) r(k)),
fit as (
  select depth, prefix from p group by all having sum(n_bytes) <= {SHARD_BYTES} or min(hash) = max(hash)),
leaf as (select hash, min(depth) as depth from p join fit using (depth, prefix) group by hash),
o as (select *, row_number() over (partition by hash) - 1 as copy from d)
select doc_id, n_bytes,
       case depth when 0 then '' else lpad(bin(hash >> ({HASH_BITS} - depth)), depth, '0') end as shard,
       depth,
       cast(floor(copy / greatest(1, floor({SHARD_BYTES} / greatest(n_bytes, 1)))) as bigint) as overflow
from o join leaf using (hash)
"""
