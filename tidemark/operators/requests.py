"""What is asked for, checked as tables: stream names, files of one request, captures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import stream_of
from tidemark.operators.lines import without_cut_tails
from tidemark.schemas import STREAMS


def stream_names(files: DataFrame) -> DataFrame:
    """``stream, known, table`` of every stream that files lie in.

    ``known`` is whether it is one of the documented streams, ``table`` its spelling that is
    safe as a name.
    """
    streams = files.select(stream_of(F.col("file")).alias("stream")).distinct()
    return streams.select(
        "stream",
        F.col("stream").isin(*STREAMS).alias("known"),
        F.regexp_replace("stream", "[^A-Za-z0-9_]", "_").alias("table"),
    )


def check_requests(requests: DataFrame, root: str) -> DataFrame:
    """``request, files, stream, problem`` of requests for event files (``request, file``).

    All files of a request must lie under ``root``, end in ``.json.gz`` and be of one known
    stream; ``problem`` names the first of these that does not hold and is NULL for a
    sound request, which alone has a ``stream``.  Groups are combined before the shuffle,
    so a request of very many files is no burden.
    """
    folder = root.rstrip("/") + "/"
    below = F.substring("file", len(folder) + 1, 1 << 30)
    inside = F.coalesce(F.col("file").startswith(folder), F.lit(False))
    named = F.coalesce(F.col("file").endswith(".json.gz"), F.lit(False))
    stream = F.when(inside, F.element_at(F.split(below, "/"), 1))
    found = requests.groupBy("request").agg(
        F.count(F.lit(1)).alias("files"),
        F.min(inside).alias("inside"),
        F.min(named).alias("named"),
        F.min(stream).alias("stream"),
        F.max(stream).alias("last"),
    )
    problem = (
        F.when(~F.col("inside"), F.lit("outside the root"))
        .when(~F.col("named"), F.lit("not an event file"))
        .when(F.col("stream") != F.col("last"), F.lit("several streams"))
        .when(~F.col("stream").isin(*STREAMS), F.lit("unknown stream"))
    )
    return found.select(
        "request", "files", F.when(problem.isNull(), F.col("stream")).alias("stream"), problem.alias("problem")
    )


def captures(files: DataFrame, lines: DataFrame) -> DataFrame:
    """``file, lines, upload``: complete lines of each captured file, and whether it is worth keeping.

    ``lines`` are those of ``read_lines`` (pinned).  Blank lines and a cut last line are no
    lines; a file that has no other one, or is empty, is not uploaded.
    """
    whole = without_cut_tails(lines).groupBy("file").agg(F.count(F.lit(1)).alias("lines"))
    return files.select("file").join(whole, "file", "left").select(
        "file",
        F.coalesce("lines", F.lit(0)).alias("lines"),
        F.col("lines").isNotNull().alias("upload"),
    )
