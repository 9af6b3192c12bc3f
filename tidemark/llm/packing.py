"""Packing documents into token windows by lexical retrieval.

Documents are tokenised once.  Windows that a long document fills alone are done;
what remains of each document is packed.  The remainders of the whole corpus are put in
an order by content: the terms of a document, weighted by BM25, are projected to a
vector, a tree of centroids learned from a sample gives its leaf, and the signs of what
is left its place in the leaf.  Runs of that order, wherever their documents were read,
are the shards, of at most ``SHARD`` documents; each shard has an inverted index with BM25 weights.  Terms
and lengths are those of whole documents, not of what remains, and document frequencies
those of the whole corpus; a seed asks with all its terms.  A seed takes its
nearest unused neighbours, best first, until its window is full; the last of them
is cut, and its rest stays in the shard.  Only the last window of a shard has room.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow, mix, texts_of
from tidemark.session import pin

WINDOW = 1024
SHARD = 1024
K1, B = 1.2, 0.75
TOKENIZER = "byte_bpe_50k"
#: Size of a content vector, documents the tree is learned from, branches of each level.
DIMS, SAMPLE, BRANCHES = 128, 8192, 32
#: Shards that a task packs, and postings that close one early: bound the time and memory of a task.
_TASK_SHARDS = 4
_SHARD_TERMS = 4_000_000
#: A term of one in so many documents of a shard is a row of a table.
_OFTEN = 8
_SPECIAL = "<|endoftext|>"
#: Separates documents, and ends each of them.
END_ID = 0

#: Characters encoded at once.
_LONG = 1 << 20
_CUT = re.compile(r"(?<=[!-~])[ \n]")


def _parts(text: str) -> Iterator[str]:
    """A very long text cut ahead of blanks, over which the tokenizer's own pattern joins nothing."""
    at = 0
    while len(text) - at > _LONG:
        found = _CUT.search(text, at + _LONG)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


class Encoder:
    """Token ids (16 bits) of texts."""

    def __init__(self, folder_file: str):
        import tiktoken

        with open(f"{folder_file}.tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._plain = tiktoken.Encoding(
            "pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._json = f"{folder_file}.json"

    def _ordinary(self, text: str) -> bytes:
        if not text:
            return b""
        try:
            ids = self._plain.encode_ordinary(text)
        except BaseException as error:  # its pattern engine panics on some very long runs
            if isinstance(error, KeyboardInterrupt | SystemExit | MemoryError):
                raise
            ids = _whole_tokenizer(self._json).encode(text, add_special_tokens=False).ids
        return array("H", ids).tobytes()

    def ids(self, text: str) -> np.ndarray:
        special = np.array([50256], "<u2").tobytes()
        parts = text.split(_SPECIAL) if _SPECIAL in text else [text]
        encoded = [b"".join(map(self._ordinary, _parts(p) if len(p) > _LONG else [p])) for p in parts]
        return np.frombuffer(special.join(encoded), "<u2")


@lru_cache(maxsize=1)
def _whole_tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def encoder(folder_file: str) -> Encoder:
    return Encoder(folder_file)


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


_TOKENS = (
    "doc_id long, place long, doc_tokens long, crcs binary, tail binary, "
    "terms binary, token int, count long"
)


def _pack_terms(term: np.ndarray, tf: np.ndarray) -> bytes:
    return term.astype("<u2").tobytes() + tf.astype("<u4").tobytes()


def _unpack_terms(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(blob) // 6
    return np.frombuffer(blob, "<u2", n), np.frombuffer(blob, "<u4", n, 2 * n)


def _tokenised(folder_file: str, window: int):
    """Documents and where they were read; then counts of a task's documents per token."""

    def run(batches):
        encode = encoder(folder_file).ids
        part = TaskContext.get().partitionId()
        seen = 0
        counts = np.zeros(1 << 16, np.int64)
        for batch in batches:
            n = batch.num_rows
            total, crcs, tails, terms = [], [], [], []
            for text in batch["text"].to_pylist():
                ids = np.append(encode(text or ""), np.array([END_ID], "<u2"))
                full = len(ids) // window
                total.append(len(ids))
                crcs.append(
                    np.array([_crc(ids[k * window : (k + 1) * window]) for k in range(full)], "<u4")
                    .tobytes()
                )
                tail = ids[full * window :]
                tails.append(tail.tobytes())
                ordered = np.sort(ids)
                edge = np.concatenate(([0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, [len(ids)]))
                term, tf = ordered[edge[:-1]], np.diff(edge)
                counts[term] += 1
                # Without a rest a document is neither seed nor neighbour.
                terms.append(_pack_terms(term, tf) if len(tail) else b"")
            no = np.arange(seen, seen + n)
            seen += n
            yield pa.record_batch(
                [batch["doc_id"], pa.array((part << 40) | no), pa.array(total, pa.int64()),
                 pa.array(crcs, pa.binary()), pa.array(tails, pa.binary()),
                 pa.array(terms, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())],
                names=["doc_id", "place", "doc_tokens", "crcs", "tail", "terms", "token",
                       "count"],
            )
        token = np.flatnonzero(counts)
        n = len(token)
        if n:
            yield pa.record_batch(
                [pa.nulls(n, k) for k in (pa.int64(), pa.int64(), pa.int64(),
                                          pa.binary(), pa.binary(), pa.binary())]
                + [pa.array(token.astype(np.int32)), pa.array(counts[token])],
                names=["doc_id", "place", "doc_tokens", "crcs", "tail", "terms", "token",
                       "count"],
            )

    return run


@lru_cache(maxsize=1)
def _projection() -> np.ndarray:
    return np.random.default_rng(8).standard_normal((1 << 16, DIMS), np.float32)


def _vectors(blobs: list[bytes], size: np.ndarray, idf: np.ndarray, mean: float) -> np.ndarray:
    """Unit vectors of documents, near each other where their weighted terms are."""
    out = np.zeros((len(blobs), DIMS), np.float32)
    for i, blob in enumerate(blobs):
        term, tf = _unpack_terms(blob)
        weight = tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[i] / mean)) * idf[term]
        out[i] = weight.astype(np.float32) @ _projection()[term]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _centroids(x: np.ndarray) -> np.ndarray:
    """Spherical k-means; each centroid is followed by the one most like it."""
    k = min(BRANCHES, len(x))
    c = x[np.random.default_rng(9).choice(len(x), k, replace=False)]
    for _ in range(8):
        near = np.argmax(x @ c.T, axis=1)
        for b in range(k):
            if (near == b).any():
                c[b] = x[near == b].mean(axis=0)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    like, chain = c @ c.T, [0]
    while len(chain) < k:
        row = like[chain[-1]].copy()
        row[chain] = -np.inf
        chain.append(int(np.argmax(row)))
    return c[chain]


def learn(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Two levels of centroids."""
    top = _centroids(x)
    near = np.argmax(x @ top.T, axis=1)
    return top, [_centroids(x[near == b]) if (near == b).any() else top[b : b + 1]
                 for b in range(len(top))]


def _codes(x: np.ndarray, tree: tuple[np.ndarray, list[np.ndarray]]) -> np.ndarray:
    """Leaf, then signs against its centroid: like documents have near codes."""
    top, below = tree
    near = np.argmax(x @ top.T, axis=1)
    out = np.zeros(len(x), np.int64)
    bits = np.int64(1) << np.arange(31, -1, -1)
    for b in np.unique(near):
        mine = np.flatnonzero(near == b)
        leaf = np.argmax(x[mine] @ below[b].T, axis=1)
        signs = (x[mine] - below[b][leaf])[:, :32] > 0
        out[mine] = ((b * BRANCHES + leaf) << 32) | (signs @ bits)
    return out


def _project(idf: np.ndarray, mean: float):
    def run(batches):
        for batch in batches:
            x = _vectors(batch["terms"].to_pylist(), batch["doc_tokens"].to_numpy(), idf, mean)
            yield pa.record_batch([pa.array([v.tobytes() for v in x], pa.binary())], names=["vector"])

    return run


def _coded(idf: np.ndarray, mean: float, tree, cuts: np.ndarray):
    """Codes, and the part of the order that ``cuts`` puts each in.

    A code that several cuts have is spread over their parts, by the place of the row.
    """

    def run(batches):
        for batch in batches:
            x = _vectors(batch["terms"].to_pylist(), batch["doc_tokens"].to_numpy(), idf, mean)
            code = _codes(x, tree)
            low, high = (np.searchsorted(cuts, code, side=s) for s in ("left", "right"))
            place = mix(batch["place"].to_numpy().view(np.uint64))
            part = low + (place % (high - low + 1).astype(np.uint64)).astype(np.int64)
            yield pa.record_batch([*batch.columns, pa.array(code), pa.array(part.astype(np.int32))],
                                  names=[*batch.schema.names, "code", "part"])

    return run


class Index:
    """BM25 inverted index of one shard: postings of each term, with weights."""

    def __init__(self, blobs: list[bytes], size: np.ndarray, idf: np.ndarray, mean: float):
        parts = [_unpack_terms(b) for b in blobs]
        term = np.concatenate([t for t, _ in parts])
        tf = np.concatenate([f for _, f in parts])
        length = np.array([len(t) for t, _ in parts])
        doc = np.repeat(np.arange(len(parts)), length)
        weight = tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[doc] / mean)) * idf[term]
        by_term = np.argsort(term, kind="stable")
        self._doc, self._weight = doc[by_term], weight[by_term]
        known, first = np.unique(term[by_term], return_index=True)
        cut = np.append(first, len(term))
        # The postings of every term of a document, as ranges.
        place = np.searchsorted(known, term)
        self._from, self._to = cut[place], cut[place + 1]
        self._begin = np.concatenate(([0], np.cumsum(length)))
        self._n = len(parts)
        # Terms that many documents have are rows of a table: whole rows are added faster.
        often = np.flatnonzero(np.diff(cut) >= max(8, self._n // _OFTEN))
        row = np.full(len(known), -1)
        row[often] = np.arange(len(often))
        self._row = row[place]
        self._table = np.zeros((len(often), self._n))
        of = np.repeat(row, np.diff(cut))
        self._table[of[of >= 0], self._doc[of >= 0]] = self._weight[of >= 0]

    def neighbours(self, seed: int) -> np.ndarray:
        """All documents, best match first; equals and strangers in their order."""
        i, j = self._begin[seed], self._begin[seed + 1]
        row = self._row[i:j]
        rare = row < 0
        start = self._from[i:j][rare]
        size = self._to[i:j][rare] - start
        at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
        score = np.bincount(self._doc[at], self._weight[at], self._n)
        score = score + self._table[row[~rare]].sum(axis=0)
        return np.argsort(-score, kind="stable")


def fill(tails: list[np.ndarray], index: Index | None, window: int) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (document, start in its tail, length); all but the last are full."""
    at = [0] * len(tails)
    size = [len(t) for t in tails]
    unused = np.array([s > 0 for s in size])
    windows, first = [], 0
    while True:
        while first < len(tails) and not unused[first]:
            first += 1
        if first == len(tails):
            return windows
        room, pieces = window, []

        def take(i: int, room: int) -> int:
            n = min(room, size[i] - at[i])
            pieces.append((i, at[i], n))
            at[i] += n
            unused[i] = at[i] < size[i]
            return n

        room -= take(first, room)
        if room:
            order = index.neighbours(first)
            for i in order[unused[order]].tolist():
                room -= take(i, room)
                if not room:
                    break
        windows.append(pieces)


_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def _pack_shard(items: list[dict], base: int, idf: np.ndarray, mean: float, window: int) -> pa.RecordBatch:
    ids, totals = [r["doc_id"] for r in items], [r["doc_tokens"] for r in items]
    tails = [np.frombuffer(r["tail"], "<u2") for r in items]
    rows, sequence = [], 0
    for r in items:
        for k, crc in enumerate(np.frombuffer(r["crcs"], "<u4").tolist()):
            rows.append((r["doc_id"], k * window, window, crc, r["doc_tokens"], base + sequence, 0))
            sequence += 1
    if any(len(t) for t in tails):
        index = Index([r["terms"] for r in items], np.array(totals), idf, mean)
        for pieces in fill(tails, index, window):
            offset = 0
            for i, start, n in pieces:
                before = totals[i] - len(tails[i])
                rows.append((ids[i], before + start, n, _crc(tails[i][start : start + n]),
                             totals[i], base + sequence, offset))
                offset += n
            sequence += 1
    names = [c.split()[0] for c in _PIECES.split(", ")]
    columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
    return pa.record_batch(columns, names=names)


def _packed(idf: np.ndarray, mean: float, window: int, shard_docs: int):
    """Shards are runs of the rows of a task, which come in the order of content."""

    def run(batches):
        part = TaskContext.get().partitionId()
        shard, items, terms = 0, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if items and (len(items) == shard_docs or terms + len(row["terms"]) // 6 > _SHARD_TERMS):
                    yield _pack_shard(items, ((part << 16) | shard) << 26, idf, mean, window)
                    shard, items, terms = shard + 1, [], 0
                items.append(row)
                terms += len(row["terms"]) // 6
        if items:
            yield _pack_shard(items, ((part << 16) | shard) << 26, idf, mean, window)

    return run


def pack(
    docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, shard_docs: int = SHARD
) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its token ids and then END_ID; every id lies in one piece, pieces of
    a sequence follow each other from offset 0.  NULL and empty texts are the one
    END_ID.  Repeated rows are packed each; a NULL doc_id stays NULL.  ``tokenizer``
    is the path of the vocabulary files without their endings.
    """
    folder_file = tokenizer or public_tokenizers.path(f"{TOKENIZER}.json").removesuffix(".json")
    rows = pin(
        arrow(docs.select("doc_id", "text"), _tokenised(folder_file, window), _TOKENS),
        "tokens",
    )
    items = rows.where("token is null")
    n, length = items.agg(F.count("*"), F.sum("doc_tokens")).first()
    # At most one row for each id of the vocabulary.
    found = rows.where("token is not null").groupBy("token").agg(F.sum("count").alias("n")).toArrow()
    count = np.zeros(1 << 16)
    count[found["token"].to_numpy()] = found["n"].to_numpy()
    idf = np.log1p((n - count + 0.5) / (count + 0.5))
    mean = max(1.0, (length or 0) / max(n, 1))
    if not n:
        return items.sparkSession.createDataFrame([], _PIECES)
    # The only rows that reach the driver: at most SAMPLE vectors of half a kilobyte.
    sample = items.where("octet_length(tail) > 0").select("terms", "doc_tokens", "place")
    share = SAMPLE / n
    if share < 0.5:
        sample = sample.where(F.pmod(F.xxhash64("place"), F.lit(1 << 30)) < int(2 * share * (1 << 30)))
    sample = sample.orderBy(F.xxhash64("place")).limit(SAMPLE).select("terms", "doc_tokens")
    x = arrow(sample, _project(idf, mean), "vector binary").toArrow()["vector"].to_pylist()
    x = np.frombuffer(b"".join(x), np.float32).reshape(-1, DIMS) if x else np.zeros((1, DIMS), np.float32)
    columns = items.select("doc_id", "place", "doc_tokens", "crcs", "tail", "terms")
    tasks = -(-n // (shard_docs * _TASK_SHARDS))
    tree = learn(x)
    # The sample's codes cut the order into parts of about equal size.
    known = np.sort(_codes(x, tree))
    cuts = known[np.arange(1, tasks) * len(known) // tasks]
    coded = arrow(columns, _coded(idf, mean, tree, cuts),
                  "doc_id long, place long, doc_tokens long, crcs binary, tail binary, terms binary, code long, part int")
    ordered = coded.repartitionById(tasks, "part").sortWithinPartitions("code", "place")
    return arrow(ordered, _packed(idf, mean, window, shard_docs), _PIECES)
