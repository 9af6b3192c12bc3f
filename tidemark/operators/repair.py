"""Repair of files whose end was cut off, with the outcome per file."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.files import exists, move, place_parts
from tidemark.functions.names import base_name, stream_of
from tidemark.operators.lines import (
    boundary_check,
    classify_files,
    file_first_last,
    number_lines,
    without_cut_tails,
)
from tidemark.session import pin, scratch
from tidemark.sources.landing import Paths, cut_files, read_lines


def write_files(lines: DataFrame, order: list[str], out_dir: str) -> None:
    """Gzip text files ``out_dir/<stream>/<name>`` as the ``file`` of each line says.

    A gzip file cannot be split, so each is one part, written by one task as it was
    read by one; it then gets its name.
    """
    staged = scratch(lines.sparkSession, "files")
    (
        lines.withColumns({"stream": stream_of(F.col("file")), "name": base_name(F.col("file"))})
        .repartition("stream", "name")
        .sortWithinPartitions("stream", "name", *order)
        .select("stream", "name", "line")
        .write.partitionBy("stream", "name")
        .option("compression", "gzip")
        .text(staged)
    )
    place_parts(lines.sparkSession, staged, out_dir)


def write_clean(lines: DataFrame, out_dir: str) -> bool:
    """Write the complete lines of captured files; files of blank lines leave nothing.

    Names stay, so the result can be loaded.  Returns whether there was anything to
    write.  ``lines`` must be pinned.
    """
    whole = without_cut_tails(lines)
    if whole.isEmpty():
        return False
    write_files(whole, ["block", "id"], out_dir)
    return True


def _kept_lines(lines: DataFrame, broken: DataFrame) -> DataFrame:
    return (
        number_lines(lines)
        .join(broken, "file")
        .where("line_no < first_bad")
        .select("file", "line_no", "line")
    )


def _verified(broken: DataFrame, found: DataFrame) -> DataFrame:
    """``file, kept_lines, verified``: whether the lines ``found`` are just those to keep."""
    written = found.groupBy("stream", "name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("ok")).alias("bad")
    )
    names = {"stream": stream_of(F.col("file")), "name": base_name(F.col("file"))}
    # A file may have no valid line at all: then nothing is written for it.
    report = broken.withColumns(names).join(written, ["stream", "name"], "left")
    whole = (F.coalesce("n", F.lit(0)) == F.col("first_bad") - 1) & (
        F.coalesce("bad", F.lit(0)) == 0
    )
    return report.select("file", (F.col("first_bad") - 1).alias("kept_lines"), whole.alias("verified"))


def _named(lines: DataFrame) -> DataFrame:
    plain = F.url_decode(F.col("file"))
    return lines.withColumns({"stream": stream_of(plain), "name": base_name(plain)})


def _at_end(classified: DataFrame) -> DataFrame:
    return classified.where("kind = 'broken_at_end'").select(
        "file", F.col("line_no").alias("first_bad")
    )


def repair_files(lines: DataFrame, out_dir: str, cut: DataFrame | None = None) -> DataFrame:
    """Write the valid part of every file broken at its end to ``out_dir/<stream>/<name>``.

    The originals stay where they are; ``swap_repaired`` puts the copies in their place.
    Returns ``file, kept_lines, verified``.  ``lines`` must be pinned.
    """
    spark = lines.sparkSession
    broken = pin(_at_end(classify_files(lines, cut)), "broken")
    write_files(_kept_lines(lines, broken), ["line_no"], out_dir)
    if not exists(spark, out_dir):
        return _verified(broken, _named(lines.limit(0)))
    return _verified(broken, _named(read_lines(spark, f"{out_dir}/*/*")))


def repair_outcomes(
    classified: DataFrame, boundary: DataFrame, verified: DataFrame
) -> DataFrame:
    """``fixed``, ``skipped_mid_file`` or ``failed`` with a reason, for every broken file."""
    checked = (
        classified.where("kind <> 'ok'")
        .join(boundary.select("file", F.col("ok").alias("follows")), "file", "left")
        .join(verified.select("file", "verified"), "file", "left")
    )
    # The successor must continue where the whole lines end; the newest file has none.
    gap = ~F.coalesce("follows", F.lit(True))
    status = (
        F.when(F.col("kind") == "broken_mid_file", "skipped_mid_file")
        .when(gap, "failed")
        .when(~F.coalesce("verified", F.lit(False)), "failed")
        .otherwise("fixed")
    )
    reason = (
        F.when(
            F.col("kind") == "broken_mid_file", F.concat(F.lit("bad line "), F.col("line_no"))
        )
        .when(gap, "next file does not continue")
        .when(~F.coalesce("verified", F.lit(False)), "repaired copy is not valid")
    )
    return checked.select("file", status.alias("status"), reason.alias("reason"))


def swap_repaired(
    spark: SparkSession, files: Mapping[str, int], repaired: str, backup: str
) -> list[str]:
    """Put repaired copies in the place of broken files; returns those that were restored.

    ``files`` has the lines to find in each.  The originals move to ``backup``; a file
    that does not read as expected in its place is moved out again and the original
    restored.  Only names pass through the driver, those of the broken files.
    """

    def own(file: str, folder: str) -> str:
        return "/".join([folder, *file.split("/")[-2:]])

    for file, count in files.items():
        # A run that was stopped here finds the original in the backup already.
        if exists(spark, file) and not exists(spark, own(file, backup)):
            move(spark, file, own(file, backup))
        if count and not exists(spark, file):
            move(spark, own(file, repaired), file)
    placed = [f for f, count in files.items() if count]
    sound: set[str] = set()
    if placed:
        report = read_lines(spark, placed).groupBy("file").agg(
            F.count(F.lit(1)).alias("n"), F.bool_and("ok").alias("ok")
        )
        sound = {r.file for r in report.collect() if r.ok and r.n == files.get(r.file)}
    wrong = [f for f in placed if f not in sound]
    for file in wrong:
        if exists(spark, file):
            move(spark, file, own(file, f"{backup}/not-valid"))
        move(spark, own(file, backup), file)
    return wrong


def repair_landing(
    spark: SparkSession, paths: Paths, unloaded: DataFrame, out_dir: str, swap: bool = False
) -> DataFrame:
    """Diagnose, repair and report all unloaded files, of any number of streams, in one job.

    Files already loaded are read for the continuity check only.  Repaired copies go to
    ``out_dir/repaired``.  With ``swap`` the files that are ``fixed`` take the place of
    the broken ones, which move to ``out_dir/backup``; one that fails there is restored.
    """
    lines = pin(read_lines(spark, paths), "lines")
    cut = pin(cut_files(spark, paths).join(unloaded.select("file"), "file", "left_semi"), "cut")
    pending = pin(lines.join(unloaded.select("file"), "file", "left_semi"), "pending")
    repaired = pin(repair_files(pending, f"{out_dir}/repaired", cut), "repaired")
    first_last = pin(file_first_last(lines), "first-last")
    outcomes = pin(
        repair_outcomes(classify_files(pending, cut), boundary_check(first_last), repaired),
        "outcomes",
    )
    if not swap:
        return outcomes
    fixed = outcomes.where("status = 'fixed'").join(repaired, "file")
    files = {r.file: r.kept_lines for r in fixed.select("file", "kept_lines").collect()}
    restored = swap_repaired(spark, files, f"{out_dir}/repaired", f"{out_dir}/backup")
    back = F.col("file").isin(restored)
    return outcomes.withColumns(
        {
            "status": F.when(back, "restored").otherwise(F.col("status")),
            "reason": F.when(back, "not valid in its place").otherwise(F.col("reason")),
        }
    )


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
