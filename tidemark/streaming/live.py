"""Order of events watched while they land: breaks, idle streams, and limits of a run.

The tasks that read the files compare neighbouring events; what is left of a file (or of a
split of one) is its two ends, and those meet in a keyed state, one for each stream,
that holds the timepoint expected next.  So a stream with all of the events is one
small group, and a batch in which every event is out of order is spread over many.
"""

from __future__ import annotations

import time
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.json import line_timepoint
from tidemark.functions.names import stream_of
from tidemark.sources.landing import trimmed

#: Seconds without any event, seconds without another one, and seconds in all, after which a run ends.
FIRST_DATA_S, IDLE_S, CAP_S = 240, 10, 300
_POLL_S = 0.1
#: Groups that breaks inside files are spread over.
_SALTS = 64

_FOUND = (
    "stream string, salt int, file string, block bigint, line_no bigint, lines bigint, "
    "has boolean, prev_tp bigint, tp bigint, last_tp bigint"
)
_OUT = "kind string, stream string, file string, line_no bigint, prev_tp bigint, tp bigint"
_STATE = "next bigint, known boolean, idle boolean"


def _lines(
    spark: SparkSession, landing: str, pattern: str, max_files: int | None, name: Callable[[Column], Column] | None
) -> DataFrame:
    reader = (
        spark.readStream.format("text").option("lineSep", "\n")
        .option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    file = F.col("_metadata.file_path")
    text = reader.load(landing).select(
        (name(file) if name else file).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        trimmed(F.col("value")).alias("line"),
    )
    tp = line_timepoint(F.col("line"))
    return text.where("line <> ''").select(
        stream_of(F.col("file")).alias("stream"), "file", "block", tp.alias("tp")
    )


class _Part:
    """What a task has seen of one split of a file."""

    def __init__(self, stream: str, file: str, block: int):
        self.name = (stream, file, block)
        self.lines = 0
        self.first: tuple[int, int] | None = None
        self.last: int | None = None

    def read(self, tp: pa.Array) -> Iterator[tuple]:
        """Breaks between events of the part: line, timepoint before, timepoint."""
        held = np.flatnonzero(tp.is_valid().to_numpy(zero_copy_only=False))
        values = tp.drop_null().to_numpy().astype(np.int64)
        if len(values):
            line = self.lines + held + 1
            if self.first is None:
                self.first = (int(line[0]), int(values[0]))
                before = np.concatenate([values[:1] - 1, values[:-1]])
            else:
                before = np.concatenate([[self.last], values[:-1]])
            for i in np.flatnonzero(values != before + 1).tolist():
                yield int(line[i]), int(before[i]), int(values[i])
            self.last = int(values[-1])
        self.lines += len(tp)

    def ends(self) -> tuple:
        line, tp = self.first or (0, 0)
        stream, file, block = self.name
        return stream, 0, file, block, line, self.lines, self.first is not None, 0, tp, self.last or 0


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Breaks inside the parts of files that a task reads, and the two ends of each part."""
    part = None
    names = [c.split()[0] for c in _FOUND.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    kinds += [pa.int64()] * 3

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch["file"].to_pylist(), batch["block"].to_numpy()
        streams = batch["stream"].to_pylist()
        code = pd.factorize(np.array(files, object))[0]
        cuts = np.flatnonzero((code[1:] != code[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        rows = []
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            name = (streams[lo], files[lo], int(blocks[lo]))
            if part is None or part.name != name:
                if part is not None:
                    rows.append(part.ends())
                part = _Part(*name)
            salt = 1 + zlib.crc32(name[1].encode()) % _SALTS
            for line, before, tp in part.read(batch["tp"].slice(lo, hi - lo)):
                rows.append((name[0], salt, name[1], name[2], line, 0, True, before, tp, tp))
        if rows:
            yield batch_of(rows)
    if part is not None:
        yield batch_of([part.ends()])


def _followed(starts: dict[str, int], idle_ms: int | None):
    columns = [c.split()[0] for c in _OUT.split(", ")]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=columns)
        return out.astype({c: "Int64" for c in columns[3:]})

    def follow(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        stream, salt = key
        if salt:
            for found in parts:
                yield frame(list(zip(
                    ["break"] * len(found), found.stream, found.file, found.line_no, found.prev_tp, found.tp,
                    strict=True,
                )))
            return
        if state.hasTimedOut:
            following, known, _ = state.get
            state.update((following, known, True))
            yield frame([("idle", stream, None, None, following - 1 if known else None, None)])
            return
        following, known, _ = state.get if state.exists else (starts.get(stream, 0), stream in starts, False)
        ends = pd.concat(list(parts)).sort_values(["file", "block"])
        ahead = ends.groupby("file").lines.cumsum() - ends.lines
        rows = []
        for end, before in zip(ends.itertuples(), ahead, strict=True):
            if end.has:
                if known and end.tp != following:
                    rows.append(("break", stream, end.file, end.line_no + before, following - 1, end.tp))
                following, known = int(end.last_tp) + 1, True
        state.update((following, known, False))
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)
        yield frame(rows)

    return follow


def watch_order(
    spark: SparkSession,
    landing: str,
    out: str,
    checkpoint: str,
    starts: dict[str, int] | None = None,
    idle_s: float | None = None,
    pattern: str = "*.json.gz",
    max_files: int | None = None,
    interval: str | None = None,
    name: Callable[[Column], Column] | None = None,
) -> StreamingQuery:
    """Start a stream that appends to ``out`` every event that does not follow the one before.

    Rows are ``kind, stream, file, line_no, prev_tp, tp``: ``break`` as ``order_breaks`` gives
    them for each stream, and ``idle`` (``prev_tp`` is its last timepoint) when a stream had no
    event for ``idle_s`` seconds.  Files of one batch follow each other by name, batches as they
    land.  ``starts`` has the timepoint that a stream's first event is compared with.  Lines
    without a timepoint are counted and skipped.  ``line_no`` counts non-empty lines of the
    file; for breaks inside a later split of an uncompressed file, those of the split.  ``name``
    makes the name of a file from its path, where it lies under another one; no two may be equal.

    Without ``interval`` all that has landed is read and the stream ends.  What a batch
    found is committed with it, so a stream that is started again repeats nothing.
    """
    timers = GroupStateTimeout.NoTimeout if idle_s is None else GroupStateTimeout.ProcessingTimeTimeout
    found = _lines(spark, landing, pattern, max_files, name).mapInArrow(_neighbours, _FOUND)
    rows = found.groupBy("stream", "salt").applyInPandasWithState(
        _followed(starts or {}, None if idle_s is None else int(idle_s * 1000)),
        _OUT, _STATE, "append", timers,
    )
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start(out)


def read_watch(spark: SparkSession, out: str) -> DataFrame:
    """What a watch has found so far."""
    return spark.read.schema(_OUT).parquet(out)


def run_bounded(
    query: StreamingQuery,
    first_data_s: float = FIRST_DATA_S,
    idle_s: float = IDLE_S,
    cap_s: float = CAP_S,
) -> str:
    """Let a query run until a limit, then stop it: ``no data``, ``idle``, ``cap`` or ``ended``.

    The limits are seconds without any row, without another row, and in all.  A batch that is
    stopped half way comes again when the query is started again.
    """
    begun = last = time.monotonic()
    seen = -1
    rows = 0
    try:
        while query.isActive:
            for progress in query.recentProgress:
                if progress.batchId > seen and progress.numInputRows:
                    seen, last = progress.batchId, time.monotonic()
                    rows += progress.numInputRows
            now = time.monotonic()
            if now - begun >= cap_s:
                return "cap"
            if rows and now - last >= idle_s:
                return "idle"
            if not rows and now - begun >= first_data_s:
                return "no data"
            query.awaitTermination(_POLL_S)
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    return "ended"
