"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Every passage is encoded as
a vector of what its bytes and words look like; a hidden layer and a gated
attention (tanh times sigmoid, softmax over the bag) weigh the passages, and the
weighted sum gives the score.  Only labels of whole documents are known, so the
attention has to find out which passages decide.  Training takes a bounded sample
of labelled documents; scoring reads every word of every document.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow, chunks, span_hashes, texts_of
from tidemark.session import pin

PASSAGE = 64
#: Documents to train on, chosen by a hash of their id among all labelled ones.
SAMPLE = 4_000
#: Passages of one document to train on, evenly spaced; scoring takes all.
SAMPLE_PASSAGES = 256
FOLDS, HELD_OUT = 3, 1

_CHUNK = 1 << 20
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MARKS = b"!%#$&*|.,:;?-"


def _byte_classes() -> np.ndarray:
    """Class of every byte: marks of their own, then kinds of characters."""
    kind = np.full(256, len(_MARKS), np.int64)  # other printable
    kind[:32] = len(_MARKS) + 1
    kind[[9, 10, 11, 12, 13, 32]] = len(_MARKS) + 2
    kind[48:58] = len(_MARKS) + 3
    kind[65:91] = len(_MARKS) + 4
    kind[97:123] = len(_MARKS) + 5
    kind[128:] = len(_MARKS) + 6
    for i, mark in enumerate(_MARKS):
        kind[mark] = i
    return kind


_CLASS = _byte_classes()
_CLASSES = int(_CLASS.max()) + 1
#: Byte classes, then: word length, repeated at once, repeated nearby, new words,
#: words without letters, length of the passage, and whether there is any.
FEATURES = _CLASSES + 7
_NEAR = 12


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(passages x FEATURES, bag number of each passage); an empty text is one zero row."""
    rows, bags = [], []
    for lo, hi in chunks(texts, _CHUNK):
        x, bag = _encode(texts[lo:hi])
        rows.append(x)
        bags.append(bag + lo)
    if not rows:
        return np.zeros((0, FEATURES), np.float32), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(bags)


def _encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    size = np.array([len(t) + 1 for t in texts])
    begin = np.concatenate(([0], np.cumsum(size)))
    inside = np.concatenate(([False], ~_SPACE[buf]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    cut = np.searchsorted(start, begin)
    count = np.diff(cut)
    doc = np.repeat(np.arange(len(texts)), count)
    number = np.arange(len(start)) - np.repeat(cut[:-1], count)
    # Passages in a row over all texts; texts without words get an empty one.
    per_text = np.maximum(1, -(-count // PASSAGE))
    base = np.concatenate(([0], np.cumsum(per_text)[:-1]))
    n = int(per_text.sum())
    passage = base[doc] + number // PASSAGE
    x = np.zeros((n, FEATURES))
    bag = np.repeat(np.arange(len(texts)), per_text)
    if len(start):
        # A passage takes its bytes up to the next one or the end of its text.
        head = np.flatnonzero(number % PASSAGE == 0)
        stop = np.minimum(np.append(start[head[1:]], len(buf)), begin[doc[head] + 1] - 1)
        length = stop - start[head]
        of_byte = np.repeat(passage[head], length)
        at = np.arange(len(of_byte)) + np.repeat(start[head] - np.cumsum(length) + length, length)
        kinds = np.bincount(of_byte * _CLASSES + _CLASS[buf[at]], minlength=n * _CLASSES)
        kinds = kinds.reshape(n, _CLASSES)
        x[:, :_CLASSES] = kinds / np.maximum(1, kinds.sum(axis=1, keepdims=True))
        hashes = span_hashes(buf, start, end)
        words = np.bincount(passage, minlength=n)
        share = 1 / np.maximum(1, words)

        def mean(values):
            return np.bincount(passage, values, minlength=n) * share

        at_once = np.zeros(len(start))
        near = np.zeros(len(start), bool)
        for k in range(1, min(_NEAR, len(start) - 1) + 1):
            same = (hashes[k:] == hashes[:-k]) & (doc[k:] == doc[:-k])
            near[k:] |= same
            if k == 1:
                at_once[1:] = same
        fresh = np.zeros(len(start))
        order = np.lexsort((hashes, doc))
        first = np.ones(len(order), bool)
        first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        # The stable sort leaves the earliest of equal words first.
        fresh[order[first]] = 1
        letters = np.concatenate(
            ([0], np.cumsum((_CLASS[buf] >= len(_MARKS) + 4), dtype=np.int64))
        )
        x[:, _CLASSES] = mean(np.log1p(end - start)) / 3
        x[:, _CLASSES + 1] = mean(at_once)
        x[:, _CLASSES + 2] = mean(near)
        x[:, _CLASSES + 3] = mean(fresh)
        x[:, _CLASSES + 4] = mean(letters[end] == letters[start])
        x[:, _CLASSES + 5] = words / PASSAGE
        x[:, _CLASSES + 6] = words > 0
    return x.astype(np.float32), bag


@dataclass(frozen=True)
class Model:
    """Weights of the network; a few kilobytes."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def scores(self, x: np.ndarray, bag: np.ndarray, n: int) -> np.ndarray:
        """Score of each of ``n`` bags; passages of a bag stand together."""
        start = np.searchsorted(bag, np.arange(n))
        logit = _forward(self.weights, (x - self.mean) / self.scale, bag, start)[0]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _forward(w, x, bag, start):
    hidden = np.tanh(x @ w["h"] + w["hb"])
    v, u = np.tanh(hidden @ w["v"]), 1 / (1 + np.exp(-(hidden @ w["u"])))
    weight = (v * u) @ w["a"]
    # Softmax over each bag.
    weight = np.exp(weight - np.maximum.reduceat(weight, start)[bag])
    weight /= np.add.reduceat(weight, start)[bag]
    bags = np.add.reduceat(hidden * weight[:, None], start)
    return bags @ w["o"] + w["ob"], (hidden, v, u, weight, bags)


def train(x: np.ndarray, bag: np.ndarray, label: np.ndarray, steps: int = 400) -> Model:
    """Fit the network by Adam on all bags at once, both labels weighing the same."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 0.02
    x = (x - mean) / scale
    start = np.searchsorted(bag, np.arange(len(label)))
    rnd = np.random.default_rng(17)
    h, a = 16, 8
    w = {
        "h": rnd.normal(0, 0.3, (x.shape[1], h)), "hb": np.zeros(h),
        "v": rnd.normal(0, 0.3, (h, a)), "u": rnd.normal(0, 0.3, (h, a)),
        "a": rnd.normal(0, 0.3, a), "o": rnd.normal(0, 0.3, h), "ob": np.zeros(1),
    }
    positive = label.mean()
    if 0 < positive < 1:
        cost = np.where(label == 1, 0.5 / positive, 0.5 / (1 - positive)) / len(label)
    else:
        cost = np.full(len(label), 1 / len(label))
    m = {k: np.zeros_like(v) for k, v in w.items()}
    s = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, steps + 1):
        logit, (hidden, v, u, weight, bags) = _forward(w, x, bag, start)
        d = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label) * cost
        g = {"o": bags.T @ d, "ob": np.array([d.sum()])}
        d_bag = d[:, None] * w["o"]
        d_hidden = d_bag[bag] * weight[:, None]
        d_weight = (d_bag[bag] * hidden).sum(axis=1)
        d_soft = weight * (d_weight - np.add.reduceat(weight * d_weight, start)[bag])
        g["a"] = (v * u).T @ d_soft
        d_v = d_soft[:, None] * w["a"] * u * (1 - v * v)
        d_u = d_soft[:, None] * w["a"] * v * u * (1 - u)
        g["v"], g["u"] = hidden.T @ d_v, hidden.T @ d_u
        d_hidden += d_v @ w["v"].T + d_u @ w["u"].T
        d_pre = d_hidden * (1 - hidden * hidden)
        g["h"], g["hb"] = x.T @ d_pre, d_pre.sum(axis=0)
        for k in w:
            g[k] += 1e-4 * w[k] * (k != "ob")
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
            w[k] -= 0.02 * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, w)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def _encoded(batches):
    for batch in batches:
        texts = texts_of(batch["text"])
        x, bag = encode(texts)
        cut = np.searchsorted(bag, np.arange(len(texts) + 1))
        out = []
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            keep = np.unique(np.linspace(i, j - 1, SAMPLE_PASSAGES).astype(int))
            out.append(x[keep].tobytes())
        yield pa.record_batch(
            [batch["doc_id"], batch["quality"].cast(pa.int32()), pa.array(out, pa.binary())],
            names=["doc_id", "quality", "passages"],
        )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Train on at most ``sample`` labelled documents outside the held-out fold.

    Labels but 0 and 1 are left out, as are ids without a document.  None if there
    is nothing to learn from.
    """
    usable = (
        labels.where("quality in (0, 1) and doc_id is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
    )
    chosen = pin(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "labelled")
    rows = arrow(
        docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "quality", "text"),
        _encoded, "doc_id long, quality int, passages binary",
    ).toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("passages", "ascending")])
    if not rows.num_rows:
        return None
    bags = [np.frombuffer(p, np.float32).reshape(-1, FEATURES) for p in rows["passages"].to_pylist()]
    bag = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    label = rows["quality"].to_numpy().astype(float)
    return train(np.concatenate(bags).astype(float), bag, label)


def _scorer(model: Model | None):
    def run(batches):
        for batch in batches:
            texts = texts_of(batch["text"])
            if model is None:
                scores = np.full(len(texts), 0.5)
            else:
                x, bag = encode(texts)
                scores = model.scores(x, bag, len(texts)) if texts else np.zeros(0)
            yield pa.record_batch(
                [*batch.columns, pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "score"],
            )

    return run


def with_score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``score`` (replacing a column of that name), from the text alone.

    NULL texts are empty.  Without a model all score 0.5.
    """
    docs = docs.drop("score")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return arrow(docs, _scorer(model), f"{schema}, score double")


def predicted() -> Column:
    return (F.col("score") >= 0.5).cast("int")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row; a NULL doc_id is not held out."""
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted().alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that the classifier does not reject."""
    model = fit(docs, labels)
    # A column of the input may be called score.
    apart = docs.withColumnRenamed("score", "__score")
    kept = with_score(apart, model).where(predicted() == 1).drop("score")
    return kept.withColumnRenamed("__score", "score").select(*docs.columns)


def in_held_out_fold(doc_id: int) -> bool:
    """As :func:`held_out`; for tests."""
    return zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT
