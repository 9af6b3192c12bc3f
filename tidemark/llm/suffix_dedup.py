"""Removal of long repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are compared through ``WINDOW`` bytes only, most significant digit
first, and a suffix leaves as soon as its group has one member:

1. *Anchor pass.*  The first digit is a gram of ``GRAM`` bytes.  Of the grams in
   a window the one with the smallest hash is its anchor; equal windows have the
   same anchor at the same place, so groups of equal anchors hold all repeats,
   while only one suffix in about forty is moved.
2. *Run pass.*  Neighbouring windows with one anchor form a run.  Its digit is
   the whole text of the run: runs equal to an earlier one are repeats as they
   stand, in groups with one text nothing else can be.
3. *Window pass.*  What is left, the first run of each text in groups of several
   texts, is ordered by whole windows.

Equal groups after the last digit are the repeated windows.  Digits are compared
as 64-bit hashes, and every decision rests on two of them (anchor and text), made from
different seeds by scrambling steps that no pattern of bytes passes unseen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow, chunks, grams, keyed, mix, signed, texts_of
from tidemark.session import pin

WINDOW = 100
GRAM = 24
_CHUNK = 1 << 18
#: Runs gathered before equal ones are combined.
_COMBINE = 150_000
_SHIFT = 7  # bits for the windows of a run; there are at most 77

_U = np.uint64
_RUNS = "anchor long, text long, doc long, tie long, at long, spans binary"


def _anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of every ``width`` grams in a row, the first of equals."""
    # Minima from the left and the right of blocks meet in every window.
    low = _U((1 << 32) - 1)
    key = (grams & ~low) | np.arange(len(grams), dtype=_U)
    blocks = -(-len(key) // width)
    padded = np.full(blocks * width, ~_U(0))
    padded[: len(key)] = key
    padded = padded.reshape(blocks, width)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(key) - width + 1
    return (np.minimum(right[:n], left[width - 1 : width - 1 + n]) & low).astype(np.int64)


def _runs(texts: list[bytes], window: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text no, anchor hash, text hash, start, windows) of all runs."""
    for lo, hi in chunks(texts, _CHUNK):
        sizes = np.array([len(t) for t in texts[lo:hi]])
        if sizes.max() < window:
            continue
        buf = np.frombuffer(b"\n".join(texts[lo:hi]), np.uint8)
        begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        gram_hash = grams(buf, (gram,), 1)[0]
        anchor = _anchors(gram_hash, window - gram + 1)
        start = np.arange(len(anchor))
        doc = np.repeat(np.arange(hi - lo), sizes + 1)[: len(anchor)]
        inside = start + window <= (begin + sizes)[doc]
        start, anchor, doc = start[inside], anchor[inside], doc[inside]
        first = np.ones(len(start), bool)
        first[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        i = np.flatnonzero(first)
        j = np.append(i[1:], len(start)) - 1
        p, q = start[i], start[j]
        # First and last window of a run overlap, so they are its whole text.  The place of
        # the anchor goes with it: equal runs are equal there too.
        whole = grams(buf, (window,), 2)[0]
        text = mix(whole[p] + mix(whole[q] + (q - p).astype(_U))) + (anchor[i] - p).astype(_U)
        yield doc[i] + lo, gram_hash[anchor[i]], text, p - begin[doc[i]], q - p + 1


def _merge(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals, in order."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    first = np.ones(len(start), bool)
    first[1:] = start[1:] > reach[:-1]
    i = np.flatnonzero(first)
    return start[i], reach[np.append(i[1:], len(start)) - 1]


def _pack(start: np.ndarray, end: np.ndarray) -> bytes:
    return np.column_stack((start, end)).astype("<i8").tobytes()


def _span_rows(doc, tie, start, end) -> Iterator[tuple[int, int, bytes]]:
    """Intervals as one row for each document."""
    order = np.lexsort((tie, doc))
    doc, tie, start, end = doc[order], tie[order], start[order], end[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])
    cut = np.append(np.flatnonzero(new), len(doc))
    for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        yield int(doc[i]), int(tie[i]), _pack(*_merge(start[i:j], end[i:j]))


def _first_runs(window: int, gram: int):
    """Runs of a task; those that repeat an earlier run of it become spans at once."""

    def combine(parts):
        anchor, text, doc, tie, at = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((at, tie, doc, text, anchor))
        anchor, text, doc, tie, at = (c[order] for c in (anchor, text, doc, tie, at))
        first = np.ones(len(anchor), bool)
        first[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        start = at[~first] >> _SHIFT
        end = start + (at[~first] & ((1 << _SHIFT) - 1)) + window - 1
        rows = list(_span_rows(doc[~first], tie[~first], start, end))
        # Spans ride along under their document's key, apart from all anchors.
        own = [np.array([r[i] for r in rows], np.int64) for i in (0, 1)]
        none = np.zeros(len(rows), np.int64)
        n, m = int(first.sum()), len(rows)

        def column(runs, spans, absent=False):
            mask = np.concatenate((np.zeros(n, bool), np.full(m, absent)))
            return pa.array(np.concatenate((runs, spans)), pa.int64(), mask=mask)

        blobs = pa.array([None] * n + [r[2] for r in rows], pa.binary())
        return pa.record_batch(
            [
                column(anchor[first], own[0] * 31 + own[1]),
                column(text[first], none, True),
                column(doc[first], own[0]),
                column(tie[first], own[1]),
                column(at[first], none),
                blobs,
            ],
            names=["anchor", "text", "doc", "tie", "at", "spans"],
        )

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            doc = batch["doc"].to_numpy()
            tie = batch["tie"].to_numpy()
            for no, anchor, text, start, count in _runs(texts_of(batch["text"]), window, gram):
                at = (start << _SHIFT) | count
                parts.append((signed(anchor), signed(text), doc[no], tie[no], at))
                size += len(no)
            if size >= _COMBINE:
                yield combine(parts)
                parts, size = [], 0
        if parts:
            yield combine(parts)

    return run


def _contexts(window: int):
    """Texts of the runs named in ``runs`` (anchor, at)."""

    def run(batches):
        for batch in batches:
            out = []
            rows = zip(
                batch["doc"].to_pylist(), batch["tie"].to_pylist(), texts_of(batch["text"]),
                batch["runs"].to_pylist(), strict=True,
            )
            for doc, tie, text, runs in rows:
                for r in runs:
                    start, count = r["at"] >> _SHIFT, r["at"] & ((1 << _SHIFT) - 1)
                    out.append((r["anchor"], doc, tie, r["at"],
                                text[start : start + count + window - 1]))
                if len(out) >= 20_000:
                    yield _context_batch(out)
                    out = []
            if out:
                yield _context_batch(out)

    return run


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["anchor", "doc", "tie", "at", "bytes"]
    kinds = [pa.int64()] * 4 + [pa.binary()]
    columns = zip(*rows, strict=True)
    return pa.record_batch(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


def _repeated_windows(window: int):
    """Spans of windows that stand earlier too; rows come ordered by (anchor, doc, tie, at)."""

    def spans(rows, seen):
        """One block of rows of whole anchors, or of a piece of one (then ``seen`` goes on)."""
        anchor, doc, tie, at, texts = rows
        sizes = np.array([len(t) for t in texts])
        begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        count = sizes - window + 1
        whole = grams(np.frombuffer(b"\n".join(texts), np.uint8), (window,), 2)[0]
        row = np.repeat(np.arange(len(texts)), count)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        p = begin[row] + inner
        digit = whole[p]
        group = anchor[row].view(_U)
        order = np.lexsort((np.arange(len(row)), digit, group))
        again = np.zeros(len(row), bool)
        same = (digit[order][1:] == digit[order][:-1]) & (group[order][1:] == group[order][:-1])
        again[order[1:][same]] = True
        last = anchor.view(_U)[-1]
        tail = np.unique(digit[group == last])
        if seen is not None:
            mine = group == seen[0]
            again[mine] |= np.isin(digit[mine], seen[1])
            if seen[0] == last:
                tail = np.union1d(tail, seen[1])
        hit = np.flatnonzero(again)
        start = (at[row[hit]] >> _SHIFT) + inner[hit]
        found = list(_span_rows(doc[row[hit]], tie[row[hit]], start, start + window))
        return found, (last, tail)

    def run(batches):
        seen = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch[c].to_numpy() for c in ("anchor", "doc", "tie", "at")]
            found, seen = spans((*columns, batch["bytes"].to_pylist()), seen)
            yield pa.record_batch(
                [pa.array([r[i] for r in found], k)
                 for i, k in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                names=["doc", "tie", "spans"],
            )

    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc, tie, spans): byte spans covered by windows that also start earlier.

    Takes rows of :func:`keyed`.  Earlier is a smaller (doc, tie), or an earlier
    start in the same document.  ``spans`` holds pairs of little-endian longs; a
    document may have several rows, whose spans overlap.
    """
    rows = arrow(docs.select("doc", "tie", "text"), _first_runs(window, gram), _RUNS)
    group = Window.partitionBy("anchor")
    first = F.row_number().over(Window.partitionBy("anchor", "text").orderBy("doc", "tie", "at"))
    left = pin(
        rows.select(
            "*",
            (F.min("text").over(group) != F.max("text").over(group)).alias("several"),
            (first > 1).alias("repeat"),
        ).where("spans is not null or repeat or several"),
        "runs",
    )
    width = (1 << _SHIFT) - 1
    start = F.shiftright("at", _SHIFT)
    whole = left.where("spans is null and repeat").select(
        "doc", "tie",
        F.struct(start.alias("a"), (start + F.col("at").bitwiseAND(width) + window - 1).alias("b"))
        .alias("span"),
    )
    early = left.where("spans is not null").select("doc", "tie", "spans")
    # Runs to look into, with their texts.
    open_runs = left.where("spans is null and not repeat and several").groupBy("doc", "tie").agg(
        F.collect_list(F.struct("anchor", "at")).alias("runs")
    )
    texts = docs.select("doc", "tie", "text").join(open_runs, ["doc", "tie"])
    contexts = arrow(
        texts, _contexts(window), "anchor long, doc long, tie long, at long, bytes binary"
    )
    ordered = contexts.repartition("anchor").sortWithinPartitions("anchor", "doc", "tie", "at")
    inside = arrow(ordered, _repeated_windows(window), "doc long, tie long, spans binary")
    packed = whole.groupBy("doc", "tie").agg(F.collect_list("span").alias("list"))
    none = F.lit(None)
    return (
        packed.withColumn("spans", none.cast("binary"))
        .unionByName(early.unionByName(inside).withColumn(
            "list", none.cast("array<struct<a:bigint,b:bigint>>")))
    )


def _kept(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, bytes]]:
    """(bytes, bytes removed, maximal runs of them, bytes that stay) of each row."""
    for text, blobs, lists in zip(
        texts_of(batch["text"]), batch["__blobs"].to_pylist(), batch["__lists"].to_pylist(),
        strict=True,
    ):
        pairs = [np.frombuffer(b, "<i8").reshape(-1, 2) for b in blobs or ()]
        pairs += [np.array([(s["a"], s["b"]) for s in part], np.int64) for part in lists or ()]
        # Spans that only touch are one run.
        start, end = _merge(*np.concatenate(pairs).T) if pairs else ((), ())
        keep, last = [], 0
        for a, b in zip(map(int, start), map(int, end), strict=True):
            keep.append(text[last:a])
            last = b
        keep.append(text[last:])
        kept = b"".join(keep)
        yield len(text), len(text) - len(kept), len(start), kept


def _measure(batches):
    for batch in batches:
        columns = list(zip(*_kept(batch), strict=True)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.record_batch(
            [batch["row"]] + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["row", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def _cut(batches):
    for batch in batches:
        out, some = [], []
        for text, (_, removed, _, kept) in zip(batch["text"].to_pylist(), _kept(batch), strict=True):
            # A character that lost some of its bytes goes.
            left = kept.decode("utf-8", "ignore") if removed else text
            out.append(left)
            some.append(not removed or bool(left))
        rows = pa.record_batch([batch["row"], pa.array(out, pa.string())], names=["row", "left"])
        yield rows.filter(pa.array(some, pa.bool_()))


def _with_spans(docs: DataFrame, window: int, gram: int, *without: str) -> DataFrame:
    """``row`` (the caller's columns but ``without``), ``text``, ``__blobs`` and ``__lists``."""
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in without]
    named = keyed(docs.select("doc_id", "text", F.struct(*columns).alias("row")))
    # Rows equal in both are one document: its text counts once, its spans go to each.
    # Only rows of ids that stand on several have a tie: the others need no shuffle.
    rows = named.select("doc", "tie", "text")
    once = rows.where("tie = 0").unionByName(rows.where("tie <> 0").dropDuplicates(["doc", "tie"]))
    spans = repeated_spans(once, window, gram).groupBy("doc", "tie").agg(
        F.collect_list("spans").alias("__blobs"), F.collect_list("list").alias("__lists")
    )
    joined = named.join(spans, ["doc", "tie"], "left")
    return joined.select("row", "text", "__blobs", "__lists")


def _row_type(df: DataFrame) -> str:
    return df.schema["row"].dataType.simpleString()


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Documents without the bytes that repeat an earlier string of ``window`` bytes.

    Every column but ``text`` stays; n_bytes, n_removed, n_spans and ``kept``
    (binary) are added, replacing columns of these names.  NULL texts are empty.
    Rows equal in doc_id and text are one document, each reported; rows that share
    a doc_id are ordered by a hash of their text; NULL ids come last.
    """
    own = ("n_bytes", "n_removed", "n_spans", "kept")
    joined = _with_spans(docs, window, gram, "text", *own)
    schema = f"row {_row_type(joined)}, n_bytes long, n_removed long, n_spans long, kept binary"
    return arrow(joined, _measure, schema).select("row.*", *own)


def cut_texts(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs``, all columns, with the repeats cut out of ``text``.

    A character that loses some of its bytes goes whole.  A document of which nothing
    is left goes too; one that was empty or NULL before stays as it is.
    """
    joined = _with_spans(docs, window, gram, "text")
    rows = arrow(joined, _cut, f"row {_row_type(joined)}, left string")
    return rows.select(
        *(F.col("left").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns)
    )


def digest(docs: DataFrame) -> DataFrame:
    """What the check compares: sizes and the hash of the bytes that are kept."""
    return remove_repeats(docs.select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def brute_force(texts: list[bytes], window: int = WINDOW) -> list[tuple[int, int, int, str]]:
    """The definition itself, over texts in document order; for tests."""
    seen: set[bytes] = set()
    out = []
    for text in texts:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - window + 1):
            piece = text[i : i + window]
            if piece in seen:
                gone[i : i + window] = True
            seen.add(piece)
        edge = np.diff(np.concatenate(([0], gone.astype(np.int8))))
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        out.append((len(text), int(gone.sum()), int((edge == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return out
