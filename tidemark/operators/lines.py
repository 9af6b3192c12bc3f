"""Line-level diagnosis of landing files.

Input is ``read_lines``: ``file, block, id, line, ok``.  Most answers need only
a few facts per split, so they come from one aggregation that combines before
the shuffle; the text of the lines is not moved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.json import line_error, line_timepoint
from tidemark.functions.names import common_start, name_bucket, stream_of
from tidemark.functions.order import with_neighbours


def _blocks(lines: DataFrame) -> DataFrame:
    """Per split of a file: its first ``id`` and how many lines lie ahead of it."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        lines.groupBy("file", "block")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
        .select(
            "file", "block", "first_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")
        )
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``line_no``, 1-based among the non-empty lines of each file.

    Ids have no holes inside a split, so a line's number follows from two facts
    about its split; lines are neither sorted nor grouped by file.  Two passes
    over ``lines``: pin them first.
    """
    return lines.join(_blocks(lines), ["file", "block"]).select(
        "file", (F.col("ahead") + F.col("id") - F.col("first_id") + 1).alias("line_no"), "line", "ok"
    )


def classify_files(lines: DataFrame, cut: DataFrame | None = None) -> DataFrame:
    """``ok``, ``broken_at_end`` (first bad line is the last one) or ``broken_mid_file``.

    Broken files come with number and text of their first bad line.  A file in ``cut``
    (``sources.landing.cut_files``) without a bad line is broken at its end as well: the
    line after its last one is lost.
    """
    bad = F.when(~F.col("ok"), F.col("id"))
    # Text rides along only on bad lines.
    splits = lines.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("id").alias("first_id"),
        F.min(bad).alias("bad_id"),
        F.min_by(F.when(~F.col("ok"), F.col("line")), bad).alias("bad_line"),
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    numbered = splits.select(
        "file",
        "n",
        (
            F.coalesce(F.sum("n").over(before), F.lit(0))
            + F.col("bad_id")
            - F.col("first_id")
            + 1
        ).alias("bad_no"),
        "bad_line",
    )
    files = numbered.groupBy("file").agg(
        F.sum("n").alias("n"),
        F.min("bad_no").alias("line_no"),
        F.min_by("bad_line", "bad_no").alias("line"),
    )
    kind = (
        F.when(F.col("line_no").isNull(), "ok")
        .when(F.col("line_no") == F.col("n"), "broken_at_end")
        .otherwise("broken_mid_file")
    )
    classified = files.select("file", kind.alias("kind"), "line_no", "line", "n")
    if cut is not None:
        # Cut files may not have a single whole line.
        found = classified.join(
            cut.select("file", F.lit(True).alias("cut")), "file", "full_outer"
        )
        lost = F.coalesce("cut", F.lit(False)) & (F.coalesce("kind", F.lit("ok")) == "ok")
        classified = found.withColumns(
            {
                "line_no": F.when(lost, F.coalesce("n", F.lit(0)) + 1).otherwise(F.col("line_no")),
                "kind": F.when(lost, "broken_at_end").otherwise(F.col("kind")),
            }
        )
    return classified.select("file", "kind", "line_no", "line")


def find_broken_files(
    lines: DataFrame, unloaded: DataFrame, limit: int | None = None
) -> DataFrame:
    """Broken files among those not loaded yet, in name order."""
    # Files are few; their lines are reduced before they meet the list.
    broken = classify_files(lines).where("kind <> 'ok'")
    broken = broken.join(unloaded.select("file"), "file", "left_semi").orderBy("file")
    return broken if limit is None else broken.limit(limit)


def file_first_last(lines: DataFrame) -> DataFrame:
    """Timepoint of a file's first line, and of its last line that is a whole event.

    The last one skips malformed lines and error objects; the first line counts
    as it is, so a file that starts with a bad line has no first timepoint.
    """
    facts = lines.select(
        "file",
        "block",
        "id",
        F.when(F.col("ok"), line_timepoint(F.col("line"))).alias("tp"),
        (F.col("ok") & ~line_error(F.col("line"))).alias("whole"),
    )
    splits = facts.groupBy("file", "block").agg(
        F.min_by("tp", "id").alias("first_tp"),
        F.max(F.when(F.col("whole"), F.col("id"))).alias("last_id"),
        F.max_by("tp", F.when(F.col("whole"), F.col("id"))).alias("last_tp"),
    )
    return splits.groupBy("file").agg(
        F.min_by("first_tp", "block").alias("first_tp"),
        F.max_by("last_tp", F.when(F.col("last_id").isNotNull(), F.col("block"))).alias(
            "last_tp"
        ),
    )


def resume_offset(first_last: DataFrame) -> DataFrame:
    """Where capture of each stream goes on: one past the last event of its newest file."""
    return first_last.groupBy(stream_of(F.col("file")).alias("stream")).agg(
        (F.max_by("last_tp", "file") + 1).alias("next_timepoint")
    )


def boundary_check(first_last: DataFrame) -> DataFrame:
    """Does each file's successor in its stream start one past its last whole event.

    NULL for the newest of a stream.  Several passes over ``first_last``: pin it first.
    """
    rows = first_last.withColumn("stream", stream_of(F.col("file")))
    bucket = F.struct("stream", name_bucket(F.col("file"), common_start(first_last)).alias("part"))
    joined = with_neighbours(rows, bucket, ["stream", "file"], ["stream", "first_tp"])
    same = F.col("next.stream") == F.col("stream")
    following = F.when(same, F.col("next.first_tp"))
    return joined.select(
        "file",
        "last_tp",
        following.alias("next_first_tp"),
        F.when(same, F.coalesce(following == F.col("last_tp") + 1, F.lit(False))).alias("ok"),
    )


def valid_prefix(lines: DataFrame) -> DataFrame:
    """Lines of each file before its first bad one.

    Two passes over ``lines``: pin them first.
    """
    numbered = number_lines(lines)
    first_bad = (
        numbered.where(~F.col("ok")).groupBy("file").agg(F.min("line_no").alias("first_bad"))
    )
    return (
        numbered.join(first_bad, "file", "left")
        .where("first_bad is null or line_no < first_bad")
        .select("file", "line_no", "line")
    )


def without_cut_tails(lines: DataFrame) -> DataFrame:
    """``lines`` less those last lines of files that a broken connection cut off.

    Only the last line of a file can be cut, so only there a malformed one is
    dropped; damage elsewhere stays for ``classify_files`` to report.  Two
    passes over ``lines``: pin them first.
    """
    splits = lines.groupBy("file", "block").agg(
        F.max("id").alias("id"), F.max_by("ok", "id").alias("ok")
    )
    tails = (
        splits.groupBy("file")
        .agg(F.max_by(F.struct("block", "id", "ok"), "block").alias("t"))
        .where(~F.col("t.ok"))
        .select("file", "t.block", "t.id")
    )
    return lines.join(tails, ["file", "block", "id"], "left_anti").select(*lines.columns)


def clean_landing(lines: DataFrame) -> DataFrame:
    """The complete lines of each file."""
    return without_cut_tails(lines).select("file", "line")
