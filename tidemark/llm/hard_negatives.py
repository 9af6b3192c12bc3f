"""Hard negatives by Kronecker-packed inner products.

Components become integers.  The components of several candidates, biased so that none
is negative, stand in separate fields of one 64-bit integer; an anchor's component is
multiplied with that integer once, and after the last component each field holds one
candidate's product sum, from which bias and offset are taken.  Fields are as wide as
the largest sum of the block needs, so the scores are exact; where not even one field
fits 64 bits the wide integers are Python's.

Anchors and candidates meet in blocks.  Two passes read the same blocks: the first finds
the positives of every anchor, the second the negatives inside the bands that the
scores of the positives give.  A task keeps, for a group of anchors, only the best rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow
from tidemark.session import pin

ANCHOR_EVERY, POSITIVES, NEGATIVES = 50, 5, 3
#: Negatives lie between these shares (percent) of the positive's score.
LEAST, MOST = 50, 95
SCALE = 256
#: Rows of a block of candidates, anchors of a group, bytes of either.
BLOCK_ROWS, GROUP_ROWS, BLOCK_BYTES = 2_048, 512, 4 << 20
#: Anchors whose scores are worked out together.
_STRIP = 32
#: Scores beyond 64 bits count as these.
_MOST = 2**63 - 2
#: No candidate.
_NONE = -(2**63 - 1)

_ROWS = "vec_id long, label long, vector binary"
_BLOCK = "{0} long, {1}ids binary, {1}labels binary, {1}rows binary, {1}size binary, {1}vectors binary, {1}scores binary"


def _quantised(batches):
    for batch in batches:
        vectors = [
            np.floor(SCALE * np.asarray(v, np.float64)).tobytes()
            for v in batch["embedding"].to_pylist()
        ]
        yield pa.record_batch(
            [batch["vec_id"], batch["label"], pa.array(vectors, pa.binary())],
            names=["vec_id", "label", "vector"],
        )


def quantised(vectors: DataFrame, relabel_every: int = 7, labels: int = 10) -> DataFrame:
    """Rows that take part: vec_id, label, integer components (as doubles, bytes)."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % relabel_every == 0, (label + 1) % labels).otherwise(label)
    whole = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & label.isNotNull() & whole)
    return arrow(
        rows.select(F.col("vec_id").cast("long"), moved.alias("label"), "embedding"), _quantised, _ROWS
    )


@dataclass
class Block:
    """Rows in the order of their ids; ``vectors`` are padded with zeros."""

    key: int
    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    size: np.ndarray
    vectors: np.ndarray
    scores: np.ndarray

    @classmethod
    def of(cls, key: int, items: list[tuple]) -> Block:
        items.sort(key=lambda r: (r[0], r[2]))
        size = np.array([len(r[3]) // 8 for r in items], np.int64)
        vectors = np.zeros((len(items), max(1, size.max())))
        for i, r in enumerate(items):
            vectors[i, : size[i]] = np.frombuffer(r[3], np.float64)
        scores = [np.array([*(r[4] or ()), *[_NONE] * (POSITIVES - len(r[4] or ()))]) for r in items]
        ids, labels, rows = (np.array([r[k] for r in items], np.int64) for k in (0, 1, 2))
        return cls(key, ids, labels, rows, size, vectors, np.array(scores, np.int64))

    @classmethod
    def read(cls, row: dict, key: str, prefix: str) -> Block:
        ids, labels, rows, size, scores = (
            np.frombuffer(row[f"{prefix}{c}"], np.int64) for c in ("ids", "labels", "rows", "size", "scores")
        )
        vectors = np.frombuffer(row[f"{prefix}vectors"]).reshape(len(ids), -1)
        return cls(row[key], ids, labels, rows, size, vectors, scores.reshape(-1, POSITIVES))

    def cells(self) -> list[bytes]:
        columns = (self.ids, self.labels, self.rows, self.size, self.vectors, self.scores)
        return [c.tobytes() for c in columns]


def _blocks(key: str, prefix: str, most: int):
    """Neighbouring rows of one ``key`` as blocks of bounded rows and bytes."""
    schema = _BLOCK.format(key, prefix)
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64()] + [pa.binary()] * (len(names) - 1)

    def run(batches):
        items, at, widest = [], None, 0

        def row():
            cells = [at, *Block.of(at, items).cells()]
            return pa.record_batch([pa.array([c], k) for c, k in zip(cells, kinds, strict=True)], names=names)

        for batch in batches:
            columns = [batch[c].to_pylist() for c in (key, "vec_id", "label", "row", "vector", "scores")]
            for where, *item in zip(*columns, strict=True):
                wide = max(widest, len(item[3]))
                full = len(items) == most or len(items) and (len(items) + 1) * wide > BLOCK_BYTES
                if items and (where != at or full):
                    yield row()
                    items, wide = [], len(item[3])
                at, widest = where, wide
                items.append(tuple(item))
        if items:
            yield row()

    return run, schema


def products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products (64 bits; beyond: the nearest) of rows of integers held as doubles."""
    width = min(anchors.shape[1], candidates.shape[1])
    a, c = anchors[:, :width], candidates[:, :width]
    low, top, size = float(min(0, c.min(initial=0))), float(c.max(initial=0)), float(np.abs(a).max(initial=0))
    exact = max(-low, top, size) < 2**62
    bias = -int(low)
    most = width * int(size) * (int(top) + bias)
    bits = most.bit_length() + 1
    if exact and bits <= 64:
        kind, fields = np.uint64, 64 // bits
        a, c = a.astype(np.int64).view(np.uint64), (c.astype(np.int64) + bias).astype(np.uint64)
    else:
        kind, fields = object, 8
        integers = np.frompyfunc(int, 1, 1)
        a, c = integers(a), integers(c) + bias
    # Several candidates in one wide integer for each component.
    n = len(c)
    groups = -(-n // fields)
    spread = np.zeros((groups * fields, width), kind)
    spread[:n] = c
    spread = spread.reshape(groups, fields, width)
    packed = np.zeros((width, groups), kind)
    shift = [kind(k * bits) if kind is np.uint64 else k * bits for k in range(fields)]
    for k in range(fields):
        packed += spread[:, k].T << shift[k]
    # A field starts from half its range: sums of negative anchors never borrow.
    half = 1 << (bits - 1)
    start = sum(half << (k * bits) for k in range(fields))
    mask = (1 << bits) - 1
    of_bias = a.sum(axis=1, keepdims=True) * (kind(bias) if kind is np.uint64 else bias)
    out = np.empty((len(a), groups * fields), np.int64)
    for i in range(0, len(a), _STRIP):
        strip = a[i : i + _STRIP]
        total = np.full((len(strip), groups), start, kind)
        one = np.empty_like(total)
        for j in range(width):
            total += np.multiply(strip[:, j, None], packed[j], out=one)
        for k in range(fields):
            field = (total >> shift[k]) & (kind(mask) if kind is np.uint64 else mask)
            score = field - (kind(half) if kind is np.uint64 else half) - of_bias[i : i + _STRIP]
            if kind is object:
                score = np.clip(score, -_MOST, _MOST).astype(np.int64)
            out[i : i + len(strip), k::fields] = score.view(np.int64)
    return out[:, :n]


def _order(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of each row: highest score, then smallest id."""
    return np.lexsort((ids, -score), axis=1)[:, :k]


@dataclass
class Best:
    """The best candidates of each anchor (of each band of it) that a task has met."""

    score: np.ndarray
    ids: np.ndarray
    rows: np.ndarray

    @classmethod
    def none(cls, n: int, k: int) -> Best:
        return cls(*(np.full((n, k), v, np.int64) for v in (_NONE, 2**63 - 1, 2**63 - 1)))

    def meet(self, score: np.ndarray, block: Block, place: np.ndarray) -> None:
        k = self.score.shape[1]
        score = np.concatenate([self.score, score], axis=1)
        ids = np.concatenate([self.ids, block.ids[place]], axis=1)
        rows = np.concatenate([self.rows, block.rows[place]], axis=1)
        take = _order(score, ids, k)
        self.score, self.ids, self.rows = (np.take_along_axis(x, take, 1) for x in (score, ids, rows))


def _bounds(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of a negative for positives' scores; both ends belong."""
    whole, rest = np.divmod(score, 100)
    return LEAST * whole - (-LEAST * rest) // 100, MOST * whole + MOST * rest // 100


def _positives(a: Block, c: Block, score: np.ndarray, best: list[Best]) -> None:
    own = (a.labels[:, None] != c.labels) | (a.rows[:, None] == c.rows)
    score = np.where(own, _NONE, score)
    # Candidates come in the order of ids, so a stable sort settles ties.
    place = np.argsort(-score, axis=1, kind="stable")[:, :POSITIVES]
    best[0].meet(np.take_along_axis(score, place, 1), c, place)


def _negatives(a: Block, c: Block, score: np.ndarray, best: list[Best]) -> None:
    score = np.where(a.labels[:, None] == c.labels, _NONE, score)
    order = np.argsort(-score, axis=1, kind="stable")
    down = np.take_along_axis(score, order, 1)
    low, high = _bounds(a.scores)
    for k in range(POSITIVES):
        first = (down > high[:, k, None]).sum(axis=1)
        at = first[:, None] + np.arange(NEGATIVES)
        inside = at < down.shape[1]
        at = np.minimum(at, down.shape[1] - 1)
        found, place = np.take_along_axis(down, at, 1), np.take_along_axis(order, at, 1)
        inside &= (found >= low[:, k, None]) & (found != _NONE) & (a.scores[:, k, None] != _NONE)
        best[k].meet(np.where(inside, found, _NONE), c, place)


_FOUND = "anchor long, slot int, id long, row long, score long"


def _compare(step, slots: int, keep: int):
    """Scores of joined blocks; the best of each anchor as the group of anchors changes."""

    def rows(a: Block, best: list[Best]):
        for slot, b in enumerate(best):
            i, j = np.nonzero(b.score != _NONE)
            yield pa.record_batch(
                [pa.array(a.rows[i]), pa.array(np.full(len(i), slot, np.int32)), pa.array(b.ids[i, j]),
                 pa.array(b.rows[i, j]), pa.array(b.score[i, j])],
                names=["anchor", "slot", "id", "row", "score"],
            )

    def run(batches):
        a, best = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                group = Block.read(row, "group", "a_")
                c = Block.read(row, "stripe", "c_")
                if a is None or not np.array_equal(a.rows, group.rows):
                    if a is not None:
                        yield from rows(a, best)
                    a, best = group, [Best.none(len(group.ids), keep) for _ in range(slots)]
                step(a, c, products(a.vectors, c.vectors), best)
        if a is not None:
            yield from rows(a, best)

    return run


def _met(anchors: DataFrame, candidates: DataFrame, groups: int, stripes: int, step, slots, keep):
    """All groups of anchors against all blocks of candidates, by an equi-join on the pair."""

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    a = anchors.select("*", numbers(stripes).alias("stripe"))
    c = candidates.select("*", numbers(groups).alias("group"))
    pairs = a.join(c.hint("merge"), ["group", "stripe"])
    return arrow(pairs, _compare(step, slots, keep), _FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, relabel_every: int = 7, labels: int = 10, anchor_every: int = ANCHOR_EVERY
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a NULL vec_id (nothing could name them), label or vector, or a component
    that is NULL or not finite, take no part.  A component that the shorter of two
    vectors lacks counts as 0; an empty vector scores 0.  Ties go to the smaller vec_id.
    Rows with equal vec_id are rows of their own: each is an anchor, and a candidate of
    the others.  Scores beyond 64 bits count as the nearest 64-bit value.  An anchor
    without positives, or a positive without negatives, gives no row; so does an empty
    table.  Columns beyond vec_id, label and embedding are ignored.
    """
    ready = quantised(vectors, relabel_every, labels)
    # A row's number lasts, as it is written.
    rows = pin(ready.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, most = rows.agg(F.count("*"), F.coalesce(F.max(F.octet_length("vector")), F.lit(8))).first()
    block = max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(8, most)))
    # One stripe has about one block of candidates, one group one block of anchors.
    stripes = max(1, -(-n // block))
    groups = max(1, -(-n // (anchor_every * min(GROUP_ROWS, block))))
    scores = F.lit(None).cast("array<long>").alias("scores")
    candidates = _grouped(rows.select("*", scores), "stripe", stripes, "c_", BLOCK_ROWS)
    anchors = rows.where(F.col("vec_id") % anchor_every == 0)
    first = _met(
        _grouped(anchors.select("*", scores), "group", groups, "a_", GROUP_ROWS),
        candidates, groups, stripes, _positives, 1, POSITIVES,
    )
    positives = pin(_first(first, POSITIVES).select("anchor", "rank", "id", "score"), "positives")
    banded = positives.groupBy(F.col("anchor").alias("row")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "score"))).getField("score").alias("scores")
    )
    anchors = anchors.join(banded, "row")
    second = _met(
        _grouped(anchors, "group", groups, "a_", GROUP_ROWS),
        candidates, groups, stripes, _negatives, POSITIVES, NEGATIVES,
    )
    negatives = _first(second, NEGATIVES).select(
        "anchor", (F.col("slot") + 1).alias("positive_rank"), "rank", F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    named = positives.select(
        "anchor", F.col("rank").alias("positive_rank"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    ).join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    return named.join(negatives, ["anchor", "positive_rank"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _grouped(rows: DataFrame, key: str, n: int, prefix: str, most: int) -> DataFrame:
    """Rows dealt to ``n`` keys by their hash, as blocks."""
    dealt = rows.withColumn(key, F.pmod(F.xxhash64("row"), F.lit(n)))
    run, schema = _blocks(key, prefix, most)
    return arrow(dealt.repartition(key).sortWithinPartitions(key), run, schema)


#: The same rows in DuckDB.
ORACLE = """
with rows as (
    select row_number() over () as row, vec_id,
           case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as vector
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select a.row as anchor, a.vec_id as anchor_id, c.vec_id, c.row, a.label = c.label as same,
           list_sum(list_transform(range(1, least(len(a.vector), len(c.vector)) + 1),
                                   lambda i: a.vector[i] * c.vector[i]))::bigint as score
    from rows a join rows c on a.row <> c.row where a.vec_id % 50 = 0
), positives as (
    select anchor, anchor_id, vec_id as positive_id, row as positive, score as positive_score
    from scored where same
    qualify row_number() over (partition by anchor order by score desc, vec_id, row) <= 5
)
select p.anchor_id, p.positive_id, p.positive_score, n.vec_id as negative_id, n.score as negative_score,
       (row_number() over (partition by p.anchor, p.positive order by n.score desc, n.vec_id, n.row))::int as rank
from positives p join scored n on p.anchor = n.anchor
where not n.same and 50 * p.positive_score <= 100 * n.score and 100 * n.score <= 95 * p.positive_score
qualify rank <= 3
"""
