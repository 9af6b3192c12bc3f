"""Records that may hold their own separators, from files read in any number of splits.

A file is read as pieces (lines; of JSON the text up to each closing brace) by tasks that do
not know whether their split begins inside quotes.  So each piece is a function of that
one bit, and so is each split: the pieces of a split are folded under both states,
the splits of a file are joined in order, and then every piece has its state.  Records
of one piece go straight on; the others, few as a rule, are put together from their pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.session import pin
from tidemark.sources.landing import Paths, _paths


def _split() -> WindowSpec:
    return Window.partitionBy("file", "block").orderBy("id")


def _in_split() -> WindowSpec:
    return _split().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _file() -> WindowSpec:
    """Over the splits of a file, one row for each."""
    return Window.partitionBy("file").orderBy("block")


def _splits() -> WindowSpec:
    return _file().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _earlier_splits() -> WindowSpec:
    return _file().rowsBetween(Window.unboundedPreceding, -1)


def _pieces(spark: SparkSession, paths: Paths, separator: str) -> DataFrame:
    """``file, block, id, value``; (``block``, ``id``) is the order in the file."""
    return (
        spark.read.option("lineSep", separator)
        .text(_paths(paths))
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("id"),
            "value",
        )
    )


def _after(start: Column, set_to: Column, flips: Column) -> Column:
    """The bit after pieces that last set it to ``set_to`` (or never) and flipped it ``flips`` times.

    ``set_to`` counts the flips up to its own piece in, so that all flips can be added.
    """
    return F.pmod(F.coalesce(set_to, start) + flips, F.lit(2))


def _folded(pieces: DataFrame) -> DataFrame:
    """Add ``before_s`` and ``after_s``: the bit around each piece if its split begins with ``s``.

    ``f0`` and ``f1`` are what a piece makes of the two states.
    """
    rows = pieces.withColumns(
        {"__flips": F.sum((F.col("f0") > F.col("f1")).cast("int")).over(_in_split())}
    )
    set_to = F.when(F.col("f0") == F.col("f1"), F.col("f0") + F.col("__flips"))
    rows = rows.withColumn("__set", F.last(set_to, ignorenulls=True).over(_in_split()))
    rows = rows.withColumns(
        {f"after_{s}": _after(F.lit(s), F.col("__set"), F.col("__flips")) for s in (0, 1)}
    )
    rows = rows.withColumns(
        {f"before_{s}": F.lag(f"after_{s}", 1, s).over(_split()) for s in (0, 1)}
    )
    return rows.drop("__flips", "__set", "f0", "f1")


def _starts(folded: DataFrame) -> DataFrame:
    """``file, block, start``: the bit that each split begins with."""
    ends = folded.groupBy("file", "block").agg(
        F.max_by(F.struct("after_0", "after_1"), "id").alias("end")
    )
    f0, f1 = F.col("end.after_0"), F.col("end.after_1")
    ends = ends.withColumn("flips", F.sum((f0 > f1).cast("int")).over(_splits()))
    set_to = F.last(F.when(f0 == f1, f0 + F.col("flips")), ignorenulls=True)
    after = _after(F.lit(0), set_to.over(_splits()), F.col("flips"))
    ends = ends.withColumn("after", after)
    return ends.select("file", "block", F.lag("after", 1, 0).over(_file()).alias("start"))


def _chosen(name: str) -> Column:
    return F.when(F.col("start") == 0, F.col(f"{name}_0")).otherwise(F.col(f"{name}_1")).alias(name)


def _joined(rest: DataFrame, separator: str) -> DataFrame:
    """Records of several pieces, from those pieces; ``begins`` marks the first of each.

    A record is named by its first piece, which may stand in an earlier split.
    """
    own = F.last(F.when(F.col("begins"), F.col("id")), ignorenulls=True).over(_in_split())
    rows = rest.withColumn("__own", own)
    lasts = rest.groupBy("file", "block").agg(F.max(F.when(F.col("begins"), F.col("id"))).alias("id"))
    named = F.when(F.col("id").isNotNull(), F.struct("block", "id"))
    earlier = lasts.select("file", "block", F.last(named, ignorenulls=True).over(_earlier_splits()).alias("__earlier"))
    here = F.when(F.col("__own").isNotNull(), F.struct(F.col("block"), F.col("__own").alias("id")))
    keyed = rows.join(earlier, ["file", "block"]).withColumn("__key", F.coalesce(here, F.col("__earlier")))
    return keyed.groupBy("file", "__key").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("block", "id", "value"))), lambda p: p["value"]),
            separator,
        ).alias("record"),
        F.max("first").alias("first"),
    ).select("file", "record", "first")


_FIELD = r'"(?:[^"]++|"")*+"[^{sep}]*+|(?!")[^{sep}]*+'
_OPEN = r'^(?:(?:' + _FIELD + r'){sep})*+"(?:[^"]++|"")*+$'


def _first_of_file() -> Column:
    """The first piece of a file: the scan gives it the least number of block 0."""
    return (F.col("block") == 0) & F.lag("id").over(_split()).isNull()


def quoted_records(spark: SparkSession, paths: Paths, separator: str) -> DataFrame:
    """``file, record, first``: the records of separated text with quoted fields.

    A field that begins with a quote goes on to the next single quote, over separators and
    line breaks; two quotes stand for one.  Empty lines between records are no
    records; one at the start of a file fails.  ``first`` marks the first record of a file.
    """
    pattern = _OPEN.replace("{sep}", rf"\x{ord(separator):02x}")
    pieces = _pieces(spark, paths, "\n")
    line = F.regexp_replace("value", "^﻿", "")
    pieces = pieces.withColumns(
        {
            "value": F.when((F.col("block") == 0), line).otherwise(F.col("value")),
            "f0": F.col("value").rlike(pattern).cast("int"),
            # A line inside quotes is one that begins with a quote.
            "f1": F.concat(F.lit('"'), "value").rlike(pattern).cast("int"),
        }
    )
    folded = pin(_folded(pieces).withColumn("first", _first_of_file()), "pieces")
    rows = folded.join(_starts(folded), ["file", "block"]).select(
        "file", "block", "id", "value", "first", _chosen("before"), _chosen("after")
    )
    empty = F.rtrim(F.col("value"), F.lit("\r")) == ""
    wrong = F.concat(F.lit("an empty line before the header of "), F.col("file"))
    blank = F.when(empty & F.col("first"), F.raise_error(wrong).cast("boolean")).otherwise(empty)
    whole = (F.col("before") == 0) & (F.col("after") == 0)
    single = rows.where(whole & ~blank).select("file", F.col("value").alias("record"), "first")
    rest = rows.where(~whole).withColumn("begins", F.col("before") == 0)
    records = single.unionByName(_joined(rest, "\n"))
    return records.withColumn("record", F.regexp_replace("record", "\r$", ""))


#: A string, or the part of one that the piece has; escapes are gone.
_STRING = r'"[^"]*+(?:"|$)'


def _count(text: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{chars}]", ""))


def json_records(spark: SparkSession, paths: Paths) -> DataFrame:
    """``file, record``: the objects of files that are one JSON array of objects each.

    Fails on a file that does not begin as an array, or whose brackets do not close.
    """
    plain = F.regexp_replace("value", r"\\.", "")
    quotes = F.pmod(_count(plain, '"'), F.lit(2))
    pieces = _pieces(spark, paths, "}").withColumns({"f0": quotes, "f1": 1 - quotes})

    def delta(s: int) -> Column:
        """Brackets opened less closed, with the brace that ends the piece."""
        text = F.when(F.col(f"before_{s}") == 1, F.concat(F.lit('"'), plain)).otherwise(plain)
        bare = F.regexp_replace(text, _STRING, "")
        closed = F.when(F.col(f"after_{s}") == 0, 1).otherwise(0)
        return _count(bare, r"\[{") - _count(bare, r"\]") - closed

    folded = _folded(pieces).withColumn("first", _first_of_file())
    folded = folded.withColumns({f"delta_{s}": delta(s) for s in (0, 1)})
    folded = folded.withColumns({f"depth_{s}": F.sum(f"delta_{s}").over(_in_split()) for s in (0, 1)})
    folded = pin(folded, "pieces")
    sums = folded.groupBy("file", "block").agg(F.sum("delta_0").alias("sum_0"), F.sum("delta_1").alias("sum_1"))
    splits = sums.join(_starts(folded), ["file", "block"])
    splits = splits.withColumn("sum", _chosen("sum"))
    ahead = F.coalesce(F.sum("sum").over(_earlier_splits()), F.lit(0))
    # One array, closed: what follows it counts as one brace more.
    total = F.sum("sum").over(Window.partitionBy("file"))
    splits = splits.select("file", "block", "start", ahead.alias("ahead"), (total == -1).alias("closed"))
    rows = folded.join(splits, ["file", "block"]).select(
        "file", "block", "id", "value", "first", "closed", _chosen("after"),
        (F.col("ahead") + _chosen("depth") - _chosen("delta")).alias("outer"),
        (F.col("ahead") + _chosen("depth")).alias("inner"),
    )
    start = F.regexp_replace("value", "^[﻿\\s]+", "")
    wrong = F.concat(F.lit("not a JSON array: "), F.col("file"))
    checked = F.when(
        F.col("first") & ~(start.startswith("[") & F.col("closed")), F.raise_error(wrong).cast("string")
    ).otherwise(F.col("value"))
    # An object ends where the depth is that of the array again.
    begins = F.col("first") | (F.col("outer") == 1)
    ends = (F.col("after") == 0) & (F.col("inner") == 1)
    rows = rows.withColumns({"value": checked, "begins": begins, "ends": ends})
    single = rows.where("begins and ends").select("file", F.concat("value", F.lit("}")).alias("record"))
    rest = rows.where("not (begins and ends)")
    # What follows the last object closes the array; its own end counted as a brace.
    closing = F.regexp_replace("record", r"\s+", "").isin("]", "[]")
    several = _joined(rest, "}").select("file", "record").where(~closing)
    several = several.select("file", F.concat("record", F.lit("}")).alias("record"))
    return single.unionByName(several).withColumn(
        "record", F.regexp_replace("record", "^[﻿\\s,\\[]+", "")
    )
