"""Words and five-word shingles of whole texts, hashed in bulk.

Words are runs of anything but ``[\\x20\\x09-\\x0D]`` after lower-casing A-Z.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

from tidemark.llm.common import BYTE, chunks, mix, span_hashes

SIZE = 5
_CHUNK = 1 << 18
_U = np.uint64

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLDED = BYTE.copy()
_FOLDED[65:91] = BYTE[97:123]
#: Odd factors, one for each word of a shingle.
PLACE = mix(np.arange(11, 11 + SIZE, dtype=_U)) | _U(1)


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text cut at white space, so that no buffer is much larger than a chunk."""
    at = 0
    while len(text) - at > 2 * _CHUNK:
        cut = max(text.rfind(s, at, at + _CHUNK) for s in (b" ", b"\n", b"\t"))
        if cut < 0:  # a word longer than a chunk
            found = [text.find(s, at) for s in (b" ", b"\n", b"\t")]
            cut = min((f for f in found if f >= 0), default=-1)
            if cut < 0:
                break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def word_hashes(texts: Sequence[bytes]) -> Iterator[np.ndarray]:
    """64-bit hashes of the words of each text, in order."""
    for lo, hi in chunks(texts, _CHUNK):
        if len(texts[lo]) > 2 * _CHUNK:
            yield np.concatenate([_hashes([p])[0] for p in _pieces(texts[lo])])
        else:
            yield from _hashes(texts[lo:hi])


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of a buffer that ends in white space."""
    inside = np.concatenate(([False], ~_SPACE[buf]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    return start, end, span_hashes(buf, start, end, _FOLDED)


def _hashes(texts: Sequence[bytes]) -> list[np.ndarray]:
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    start, _, hashes = word_spans(buf)
    size = np.array([len(t) + 1 for t in texts])
    cut = np.searchsorted(start, np.concatenate(([0], np.cumsum(size))))
    return [hashes[i:j] for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Distinct shingles, sorted; all words as one shingle where there are fewer."""
    if len(words) < SIZE:
        if not len(words):
            return words
        with np.errstate(over="ignore"):
            one = (words * PLACE[: len(words)]).sum(dtype=_U) + _U(len(words))
        return mix(np.array([one], _U))
    n = len(words) - SIZE + 1
    total = words[:n] * PLACE[0]
    for k in range(1, SIZE):
        total += words[k : k + n] * PLACE[k]
    total = mix(total)
    total.sort()
    keep = np.ones(n, bool)
    keep[1:] = total[1:] != total[:-1]
    return total[keep]


def shingle_sets(texts: Sequence[bytes]) -> Iterator[np.ndarray]:
    for words in word_hashes(texts):
        yield shingle_set(words)


def set_hash(shingles: np.ndarray) -> int:
    """A signed 64-bit hash of a set, its size included."""
    with np.errstate(over="ignore"):
        total = mix(shingles ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U) + _U(len(shingles))
    return int(mix(np.array([total], _U)).view(np.int64)[0])


def plain_set(text: str | None) -> set[tuple[str, ...]]:
    """The definition, word by word; for tests."""
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        folded = folded.replace(space, " ")
    words = [w for w in folded.split(" ") if w]
    if len(words) < SIZE:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + SIZE]) for i in range(len(words) - SIZE + 1)}


def linked(a: set, b: set) -> bool:
    """Jaccard similarity of at least 0.8."""
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)
