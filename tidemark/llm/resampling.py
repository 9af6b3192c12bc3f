"""Importance resampling towards a target distribution, over hashed n-grams.

Features are runs of words, hashed to buckets by CRC-32.  The checksum is linear over
XOR, so a table of what each byte contributes at each distance from the end of a span
gives all features of a buffer at once: look up, ``bitwise_xor.reduceat`` over the spans,
and XOR a constant of the length.  Spans longer than the table fold block by block: the
register so far, moved on by one block, is a contribution of its four bytes.

The buckets of corpus and target are counted; a document's weight is the sum of the
log ratios of its features, and the documents of highest weight plus Gumbel noise
(from a hash of the id) are a sample without replacement.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow, chunks, texts_of
from tidemark.session import pin

BUCKETS, WORDS, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
#: Distances that the table covers, and so the bytes of one block of a long span.
REACH = 64
#: Bytes of text worked on at a time.
CHUNK = 1 << 19
_ONES = 0xFFFFFFFF

#: Lower-cased bytes; 0 where no word goes on.  Bytes of characters beyond ASCII are letters.
_LETTER = np.zeros(256, np.uint8)
_LETTER[0x30:0x3A] = np.arange(0x30, 0x3A)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """What a byte so far from the end adds; the register after 0 to REACH zero bytes."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1)
    far = np.empty((REACH, 256), np.uint32)
    far[0] = byte
    for k in range(1, REACH):
        far[k] = (far[k - 1] >> 8) ^ byte[far[k - 1] & 255]
    zeros = np.empty(REACH + 1, np.uint32)
    zeros[0] = _ONES
    for k in range(REACH):
        zeros[k + 1] = (zeros[k] >> 8) ^ byte[zeros[k] & 255]
    return far.ravel(), zeros


def _moved(register: np.ndarray) -> np.ndarray:
    """Registers after one block of zero bytes."""
    far, _ = _tables()
    out = np.zeros_like(register)
    for k in range(4):
        out ^= far[((REACH - 1 - k) << 8) + ((register >> np.uint32(8 * k)) & np.uint32(255)).astype(np.int64)]
    return out


def _folded(span: np.ndarray) -> int:
    """CRC-32 of one huge span, with memory for a chunk of it."""
    far, zeros = _tables()
    back = np.arange(REACH - 1, -1, -1) << 8
    head = (len(span) - 1) % REACH + 1
    register = int(zeros[head] ^ np.bitwise_xor.reduce(far[back[-head:] + span[:head]]))
    step, of = max(1, CHUNK // REACH) * REACH, [far[k << 8 : (k + 1) << 8].tolist() for k in range(REACH - 4, REACH)]
    for lo in range(head, len(span), step):
        blocks = span[lo : lo + step].reshape(-1, REACH)
        for part in np.bitwise_xor.reduce(far[back + blocks], axis=1).tolist():
            register = (
                of[3][register & 255] ^ of[2][(register >> 8) & 255]
                ^ of[1][(register >> 16) & 255] ^ of[0][register >> 24] ^ part
            )
    return register ^ _ONES


def checksums(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of every span of ``buf``; spans are in order, not empty, and do not overlap."""
    if not len(start):
        return np.zeros(0, np.uint32)
    far, zeros = _tables()
    size = end - start
    if size.max() > CHUNK:
        out = np.empty(len(size), np.uint32)
        huge = size > CHUNK
        out[huge] = [_folded(buf[a:b]) for a, b in zip(start[huge], end[huge], strict=True)]
        out[~huge] = checksums(buf, start[~huge], end[~huge])
        return out
    blocks = -(-size // REACH)
    first = np.concatenate(([0], np.cumsum(blocks)))
    # Blocks end at multiples of REACH from the end of their span; the first may be shorter.
    before = np.arange(first[-1]) - np.repeat(first[:-1], blocks)
    stop = np.repeat(end, blocks) - (np.repeat(blocks, blocks) - 1 - before) * REACH
    head = np.maximum(np.repeat(start, blocks), stop - REACH)
    length = stop - head
    at = np.cumsum(length) - length
    distance = np.repeat(stop - 1, length) - np.repeat(head - at, length) - np.arange(length.sum())
    place = np.repeat(stop - 1, length) - distance
    parts = np.bitwise_xor.reduceat(far[(distance << 8) + buf[place]], at)
    out = zeros[length[first[:-1]]] ^ parts[first[:-1]]
    long = np.flatnonzero(blocks > 1)
    step = 1
    while len(long):
        out[long] = _moved(out[long]) ^ parts[first[long] + step]
        step += 1
        long = long[blocks[long] > step]
    return out ^ np.uint32(_ONES)


def _spans(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a buffer."""
    inside = np.concatenate(([False], letters != 0, [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def features(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Checksums of all features, the text of each, and the words of each text.

    Features of one length follow each other; within it they are in the order of texts.
    """
    letters = _LETTER[np.frombuffer(b"\x00".join(texts), np.uint8)]
    size = np.array([len(t) + 1 for t in texts])
    start, end = _spans(letters)
    text = np.searchsorted(np.cumsum(size), start, side="right")
    found, owner = [checksums(letters, start, end)], [text]
    if words > 1:
        # Words of a text with one space between: runs of words are spans of that buffer.
        length = end - start
        new = np.cumsum(length + 1) - length - 1
        spaced = np.full(int((length + 1).sum()), 0x20, np.uint8)
        at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        spaced[np.repeat(new, length) + at] = letters[np.repeat(start, length) + at]
        for n in range(2, words + 1):
            run = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1 :]) if len(text) >= n else []
            sums, who = [], []
            # Runs that start n apart do not overlap.
            for k in range(n):
                mine = np.array([], np.int64) if not len(run) else run[run % n == k]
                sums.append(checksums(spaced, new[mine], new[mine + n - 1] + length[mine + n - 1]))
                who.append(text[mine])
            found.append(np.concatenate(sums))
            owner.append(np.concatenate(who))
    return np.concatenate(found), np.concatenate(owner), np.bincount(text, minlength=len(texts))


def _windows(text: bytes) -> list[bytes]:
    """A huge text cut where no word goes on; a word is never cut, whatever its length."""
    out, at = [], 0
    while len(text) - at > CHUNK:
        cut = at + CHUNK
        letters = _LETTER[np.frombuffer(text, np.uint8, cut - at, at)]
        gap = np.flatnonzero(letters == 0)
        if len(gap):
            cut = at + int(gap[-1]) + 1
        else:
            while cut < len(text):
                letters = _LETTER[np.frombuffer(text, np.uint8, min(CHUNK, len(text) - cut), cut)]
                gap = np.flatnonzero(letters == 0)
                cut += int(gap[0]) if len(gap) else len(letters)
                if len(gap):
                    break
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def _hashed(texts: list[bytes], words: int, buckets: int):
    """Buckets of all features by pieces of the batch: (first text, buckets, text, words of texts)."""
    for lo, hi in chunks(texts, CHUNK):
        # With runs of several words a text must stay whole.
        whole = words > 1 or hi - lo > 1 or len(texts[lo]) <= CHUNK
        for piece in [texts[lo:hi]] if whole else [[w] for w in _windows(texts[lo])]:
            sums, text, count = features(piece, words)
            yield lo, (sums % np.uint32(buckets)).astype(np.int64), text, count


def _counted(words: int, buckets: int):
    def run(batches):
        count = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, bucket, _, _ in _hashed(texts_of(batch["text"]), words, buckets):
                count += np.bincount(bucket, minlength=buckets)
        bucket = np.flatnonzero(count)
        if len(bucket):
            yield pa.record_batch([pa.array(bucket), pa.array(count[bucket])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, words: int = WORDS, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: features of all texts; a task sends each bucket once."""
    rows = arrow(texts.select("text"), _counted(words, buckets), "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, words: int = WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """Whole thousandths of the log ratio of target and corpus, for each bucket."""

    def counts(texts: DataFrame) -> list[int]:
        # At most one row for each bucket.
        found = bucket_counts(texts, words, buckets).toArrow()
        out = np.zeros(buckets, np.int64)
        out[found["bucket"].to_numpy()] = found["n"].to_numpy()
        return out.tolist()

    s, t = counts(corpus), counts(target)
    all_s, all_t = sum(s), sum(t)
    return np.array([
        math.floor(1000 * math.log(float(y + 1) * float(all_s + buckets) / (float(x + 1) * float(all_t + buckets))))
        for x, y in zip(s, t, strict=True)
    ])


def _weighed(words: int, gain: np.ndarray):
    def run(batches):
        for batch in batches:
            texts = texts_of(batch["text"])
            n_words, n, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
            for lo, bucket, text, count in _hashed(texts, words, len(gain)):
                to = lo + len(count)
                n_words[lo:to] += count
                n[lo:to] += np.bincount(text, minlength=len(count))
                np.add.at(weight, lo + text, gain[bucket])
            yield pa.record_batch(
                [batch["doc_id"], pa.array(n_words), pa.array(n), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return run


def _noise(seed: int) -> Column:
    """Gumbel noise in whole thousandths, from a hash of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    words: int = WORDS,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; rank NULL if not drawn.

    ``docs`` has doc_id and text, ``target`` has text; further columns are ignored.  A
    NULL or empty text has no features and weight 0.  Repeated rows count and are ranked
    each for itself, in no fixed order among equals.  A NULL doc_id is hashed as an empty
    one and comes last among equal scores.  An empty table gives no rows, an empty target
    gains of the corpus alone.  Texts are worked on in chunks; with ``words`` above 1 a
    text is one chunk.
    """
    gain = gains(docs, target, words, buckets)
    rows = arrow(
        docs.select("doc_id", "text"), _weighed(words, gain),
        "doc_id long, n_words long, n_features long, weight long",
    )
    scored = pin(rows.withColumn("score", F.col("weight") + _noise(seed)), "scores")
    fits = F.col("n_words") >= least_words
    drawn = scored.where(fits).count() * percent // 100
    # Ranges of the order; a row's rank is its place in its range and the sizes of those ahead.
    placed = (
        scored.where(fits)
        .repartitionByRange(F.desc("score"), F.asc_nulls_last("doc_id"))
        .sortWithinPartitions(F.desc("score"), F.asc_nulls_last("doc_id"))
        .select("doc_id", "n_features", "weight", "score", F.monotonically_increasing_id().alias("id"))
    )
    placed = pin(
        placed.withColumns({"part": F.shiftright("id", 33), "at": F.col("id").bitwiseAND(F.lit((1 << 33) - 1))}),
        "ranked",
    )
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("part").agg(F.max("at").alias("last"))
    sizes = sizes.select("part", F.coalesce(F.sum(F.col("last") + 1).over(ahead), F.lit(0)).alias("ahead"))
    rank = F.col("ahead") + F.col("at") + 1
    ranked = placed.join(sizes, "part").select(
        "doc_id", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank")
    )
    rest = scored.where(~fits).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)
