"""Packing documents into token windows with as few windows as possible: best two fit.

A document that fits a window is one item and never cut; of a longer one, all windows but
the first piece are full.  Only the sizes of items matter, so the plan is made from their
counts: at most one number for each size, whatever the corpus.  A window is filled
greedily, largest item first; then its smallest item is replaced by two unpacked ones if
these fit the gap it leaves more tightly, again until nothing improves.  The
filling is used as often as the counts allow.

Items find their place by number: the tasks that tokenise number the items of each size,
and running sums of the tasks' counts make these numbers whole.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow
from tidemark.llm.packing import TOKENIZER, encoder
from tidemark.session import pin

WINDOW = 1024
END_ID = 2
#: Sequences of full pieces are numbered by task from here on, those of the plan from 0.
_FULL = 1 << 62

_TOKENS = "doc_id long, tokens long, crcs binary, part long, size int, number long, full long, count long"


def _tokenised(folder_file: str, window: int, end_id: int):
    """Documents with the number of their item among those of its size in the task; then the counts."""

    def run(batches):
        encode = encoder(folder_file).ids
        part = TaskContext.get().partitionId()
        count, full = np.zeros(window, np.int64), 0
        names = [c.split()[0] for c in _TOKENS.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = np.append(encode(text or ""), np.array([end_id], "<u2")).astype("<u4")
                size = len(ids) % window
                cuts = [*([0] if size else []), *range(size, len(ids), window)]
                crcs = np.array([zlib.crc32(ids[a : size if a < size else a + window].tobytes()) for a in cuts], "<u4")
                rows.append((doc_id, len(ids), crcs.tobytes(), part, size, int(count[size]), full, None))
                count[size] += 1
                full += len(ids) // window
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32()] + [pa.int64()] * 3
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.record_batch(columns, names=names)
        size = np.flatnonzero(count[1:]) + 1
        if len(size):
            nulls = [pa.nulls(len(size), pa.int64())] * 2
            yield pa.record_batch(
                [*nulls, pa.nulls(len(size), pa.binary()), pa.array(np.full(len(size), part)),
                 pa.array(size.astype(np.int32)), *nulls, pa.array(count[size])],
                names=names,
            )

    return run


def _fill(count: np.ndarray, window: int) -> list[int]:
    """Sizes of one window, of those left in ``count``, which has them taken away."""
    taken, room = [], window
    while True:
        sizes = np.flatnonzero(count[: room + 1])
        if not len(sizes):
            break
        size = int(sizes[-1])
        n = min(int(count[size]), room // size)
        taken += [size] * n
        count[size] -= n
        room -= n * size
    while room:
        smallest = taken[-1]
        pair = _two(count, smallest, smallest + room)
        if pair is None:
            break
        count[smallest] += 1
        count[pair[0]] -= 1
        count[pair[1]] -= 1
        room += smallest - sum(pair)
        taken = sorted([*taken[:-1], *pair], reverse=True)
    return taken


def _two(count: np.ndarray, above: int, room: int) -> tuple[int, int] | None:
    """Two unpacked sizes with the greatest sum over ``above``, at most ``room``; the largest item of those."""
    sizes = np.flatnonzero(count[: room + 1])
    if not len(sizes):
        return None
    # For each size the largest partner that fits; one of a single item cannot be its own.
    at = np.searchsorted(sizes, room - sizes, side="right") - 1
    own = (at == np.arange(len(sizes))) & (count[sizes] < 2)
    at = at - own
    total = np.where(at >= 0, sizes + sizes[np.maximum(at, 0)], 0)
    best = len(total) - 1 - int(np.argmax(total[::-1]))
    if total[best] <= above:
        return None
    return int(sizes[best]), int(sizes[at[best]])


def plan(count: np.ndarray, window: int) -> list[tuple[list[int], int]]:
    """Fillings of a window, from the largest item to the smallest, and how often each is used."""
    left, out = count.copy(), []
    while left.any():
        after = left.copy()
        sizes = _fill(after, window)
        size, n = np.unique(sizes, return_counts=True)
        times = int((left[size] // n).min())
        left[size] -= times * n
        out.append((sizes, times))
    return out


def _places(fillings: list[tuple[list[int], int]], window: int) -> tuple[np.ndarray, ...]:
    """Runs of the items of a size, in order: size, first number, first sequence, offset."""
    given = np.zeros(window + 1, np.int64)
    runs, sequence = [], 0
    for sizes, times in fillings:
        offset = 0
        for size in sizes:
            runs.append((size, int(given[size]), sequence, offset))
            given[size] += times
            offset += size
        sequence += times
    runs.sort()
    return tuple(np.array(c, np.int64) for c in zip(*runs, strict=True)) if runs else (np.zeros(0, np.int64),) * 4


_PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
)


def _pieces(places: tuple[np.ndarray, ...], window: int):
    size, first, sequence, begin = places
    # Numbers of one size are below 2**50.
    key = (size << 50) | first

    def run(batches):
        for batch in batches:
            tokens, part, rest, number, full = (
                batch[c].to_numpy(zero_copy_only=False) for c in ("tokens", "part", "size", "number", "full")
            )
            crcs = [np.frombuffer(c, "<u4") for c in batch["crcs"].to_pylist()]
            n = np.array([len(c) for c in crcs])
            doc = np.repeat(np.arange(len(n)), n)
            piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            short = (rest[doc] > 0) & (piece == 0)
            # Full pieces of a document follow the short one, each a sequence of its own.
            whole = piece - (rest[doc] > 0)
            start = np.where(short, 0, rest[doc] + whole * window)
            out_sequence = _FULL | (part[doc].astype(np.int64) << 40) | (full[doc] + whole)
            offset = np.zeros(len(doc), np.int64)
            mine = doc[short]
            run_of = np.searchsorted(key, (rest[mine].astype(np.int64) << 50) | number[mine], side="right") - 1
            out_sequence[short] = sequence[run_of] + number[mine] - first[run_of]
            offset[short] = begin[run_of]
            length = np.where(short, rest[doc], window)
            yield pa.record_batch(
                [batch["doc_id"].take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                 pa.array(length.astype(np.int64)),
                 pa.array(np.concatenate(crcs).astype(np.int64) if crcs else np.zeros(0, np.int64)),
                 pa.array(out_sequence), pa.array(offset)],
                names=[c.split()[0] for c in _PIECES.split(", ")],
            )

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and then ``end_id``; NULL and empty texts are that id
    alone.  Repeated rows are packed each; a NULL doc_id stays NULL.  An empty table
    gives no pieces.  Columns beyond doc_id and text are ignored.  ``tokenizer`` is the
    path of the vocabulary files without their endings.
    """
    folder_file = tokenizer or public_tokenizers.path(f"{TOKENIZER}.json").removesuffix(".json")
    rows = pin(arrow(docs.select("doc_id", "text"), _tokenised(folder_file, window, end_id), _TOKENS), "items")
    counts = rows.where("count is not null").select("part", "size", "count")
    # At most one row for each size below the window.
    found = counts.groupBy("size").agg(F.sum("count").alias("n")).toArrow()
    count = np.zeros(window + 1, np.int64)
    count[found["size"].to_numpy()] = found["n"].to_numpy()
    places = _places(plan(count, window), window)
    ahead = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "size", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("before"))
    items = rows.where("count is null").join(before, ["part", "size"], "left")
    numbered = items.withColumn("number", F.coalesce(F.col("number") + F.col("before"), "number"))
    columns = numbered.select("doc_id", "tokens", "crcs", "part", "size", "number", "full")
    return arrow(columns, _pieces(places, window), _PIECES)
