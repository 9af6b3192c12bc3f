"""Approximate nearest neighbours by cosine over learned partitions.

On a bounded sample the neighbour graph is cut into balanced parts (repeated
bisection at the median of a smooth vector of the graph, then swaps), and a small
classifier learns from a vector the parts its neighbours lie in.  It places every
row in its most probable part and routes a query to its most probable ones, whose
rows are compared exactly.  How many those are is measured: some queries are compared
with every row, and all search as many parts as hold ``RECALL`` of what those found;
vectors without any structure are compared with all.  Parts are cut into blocks, so a part
of any size, a single vector repeated a million times included, is many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow
from tidemark.session import pin

#: Vectors to fit on, chosen by a hash of their id; every vector is indexed.
SAMPLE = 8_192
#: Sample vectors for each part, and the most parts.
PART, MOST_PARTS = 256, 32
#: The least number of parts to search.
PROBES = 10
#: Share of the nearest vectors to be found, and the queries on which that is measured.
RECALL, MEASURED = 0.97, 512
NEIGHBOURS = 5
QUERY_EVERY = 50
GRAPH = 12
BLOCK_ROWS, BLOCK_QUERIES = 4_096, 1_024


def unit(x: np.ndarray) -> np.ndarray:
    # Divide by the largest component first: squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the ``k`` nearest rows of each row of unit vectors."""
    out = []
    for i in range(0, len(x), 256):
        near = x[i : i + 256] @ x.T
        near[np.arange(len(near)), np.arange(i, i + len(near))] = -2
        # A copy: a slice would keep the numbers of all rows, eight bytes for each pair.
        out.append(np.argpartition(-near, k - 1, axis=1)[:, :k].copy())
    return np.concatenate(out)


def _halves(a: np.ndarray, b: np.ndarray, n: int, rnd: np.random.Generator) -> np.ndarray:
    """Two equal sides of a graph with edges (a, b), few edges between them."""
    degree = np.bincount(a, minlength=n) + np.bincount(b, minlength=n) + 1e-9

    def spread(v):
        return np.bincount(a, v[b], minlength=n) + np.bincount(b, v[a], minlength=n)

    v = rnd.normal(size=n)
    for _ in range(60):
        v = v - (v * degree).sum() / degree.sum()
        v = 0.5 * v + 0.5 * spread(v) / degree
        v /= np.linalg.norm(v) + 1e-30
    side = np.zeros(n, bool)
    side[np.argsort(v, kind="stable")[n // 2 :]] = True
    for _ in range(10):
        # Edges to the other side less those to the own one; swap the best pairs.
        sign = np.where(side, 1.0, -1.0)
        gain = -sign * spread(sign)
        one = np.flatnonzero(side)
        two = np.flatnonzero(~side)
        one, two = one[np.argsort(-gain[one])], two[np.argsort(-gain[two])]
        m = min(len(one), len(two))
        swaps = np.flatnonzero(gain[one[:m]] + gain[two[:m]] > 2)[: max(1, m // 8)]
        if not len(swaps):
            break
        side[one[swaps]], side[two[swaps]] = False, True
    return side


def balanced_parts(graph: np.ndarray, parts: int) -> np.ndarray:
    """Part of each node; parts (a power of two) differ by a node or so in size."""
    rnd = np.random.default_rng(5)
    n, k = graph.shape
    label = np.zeros(n, np.int64)
    a, b = np.repeat(np.arange(n), k), graph.ravel()
    count = 1
    while count < parts:
        new = label * 2
        for part in range(count):
            nodes = np.flatnonzero(label == part)
            place = np.full(n, -1)
            place[nodes] = np.arange(len(nodes))
            inner = (label[a] == part) & (label[b] == part)
            new[nodes] += _halves(place[a[inner]], place[b[inner]], len(nodes), rnd)
        label = new
        count *= 2
    return label


@dataclass(frozen=True)
class Router:
    """A network with one hidden layer: a vector to the scores of the parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def train_router(x: np.ndarray, target: np.ndarray, epochs: int = 30, hidden: int = 128) -> Router:
    """Fit soft targets by Adam on small batches."""
    rnd = np.random.default_rng(3)
    d, p = x.shape[1], target.shape[1]
    w = [rnd.normal(0, (2 / d) ** 0.5, (d, hidden)), np.zeros(hidden),
         rnd.normal(0, (1 / hidden) ** 0.5, (hidden, p)), np.zeros(p)]
    m, s = [np.zeros_like(v) for v in w], [np.zeros_like(v) for v in w]
    step = 0
    for _ in range(epochs):
        order = rnd.permutation(len(x))
        for i in range(0, len(x), 256):
            rows = order[i : i + 256]
            h = np.maximum(x[rows] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            d_z = (z / z.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            d_h = (d_z @ w[2].T) * (h > 0)
            g = [x[rows].T @ d_h, d_h.sum(axis=0), h.T @ d_z, d_z.sum(axis=0)]
            step += 1
            for k in range(4):
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                w[k] -= 3e-3 * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return Router(*w)


def fit(x: np.ndarray) -> Router:
    """Partition the neighbour graph of ``x`` and learn to route to its parts."""
    x = unit(x.astype(float))
    parts = 1
    while parts < MOST_PARTS and parts * 2 * PART <= len(x):
        parts *= 2
    if parts == 1:
        d = x.shape[1]
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    graph = neighbour_graph(x, GRAPH)
    label = balanced_parts(graph, parts)
    target = np.zeros((len(x), parts))
    near = np.concatenate((np.arange(len(x))[:, None], graph), axis=1)
    np.add.at(target, (np.arange(len(x))[:, None], label[near]), 1 / near.shape[1])
    return train_router(x, target)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _placer(router: Router):
    """The part of each vector."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            part = router.scores(unit(_matrix(batch["embedding"]).astype(float))).argmax(axis=1)
            yield pa.record_batch(
                [*batch.columns, pa.array(part.astype(np.int32))],
                names=[*batch.schema.names, "part"],
            )

    return run


def _route(router: Router, x: np.ndarray) -> np.ndarray:
    """Parts for each vector, the most probable one first."""
    return np.argsort(-router.scores(unit(x.astype(float))), axis=1, kind="stable")


def _routed(router: Router, sizes: np.ndarray, probes: int, k: int):
    """Parts to search for each query: the most probable ones, more if they hold few rows."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            order = _route(router, _matrix(batch["embedding"]))
            before = np.cumsum(sizes[order], axis=1) - sizes[order]
            take = (np.arange(order.shape[1]) < probes) | (before < 4 * k + 4)
            parts = [o[t].tolist() for o, t in zip(order, take, strict=True)]
            yield pa.record_batch(
                [*batch.columns, pa.array(parts, pa.list_(pa.int32()))],
                names=[*batch.schema.names, "parts"],
            )

    return run


def exact_top(
    query_id: np.ndarray, q: np.ndarray, vec_id: np.ndarray, x: np.ndarray, k: int,
    places: bool = False,
) -> list[tuple[int, int, float]]:
    """(query_id, vec_id, cosine) of the ``k`` best of each query, ties to smaller ids.

    With ``places`` the number of the row in ``x`` stands for its id.
    """
    q, x = q.astype(float), x.astype(float)
    qn, xn = unit(q), unit(x)
    rough = qn @ xn.T
    rough[query_id[:, None] == vec_id[None, :]] = -np.inf
    out = []
    for i in range(len(q)):
        row = rough[i]
        limit = np.partition(row, max(len(row) - k, 0))[max(len(row) - k, 0)]
        # Products of matrices round by position; score what may tie one by one.
        near = np.flatnonzero((row >= limit - 1e-9) & (row > -np.inf))
        score = cosine(q[i], x[near])
        best = np.lexsort((vec_id[near], -score))[:k]
        named = near[best] if places else vec_id[near[best]]
        out += [(int(query_id[i]), int(v), float(score[b])) for v, b in zip(named, best, strict=True)]
    return out


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of a vector with each row of ``b``, in double precision."""
    big, bigs = np.abs(a).max(), np.abs(b).max(axis=1, keepdims=True)
    a, b = a / big, b / bigs
    return (b * a).sum(axis=1) / np.sqrt((a * a).sum() * (b * b).sum(axis=1))


def _compare(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            rows = exact_top(
                left["vec_id"].to_numpy(), _matrix(left["embedding"]),
                right["vec_id"].to_numpy(), _matrix(right["embedding"]), k,
            )
        columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
        return pa.table(
            {
                "query_id": pa.array(columns[0], pa.int64()),
                "vec_id": pa.array(columns[1], pa.int64()),
                "score": pa.array(columns[2], pa.float64()),
            }
        )

    return run


def _nearest_with_part(query_id: np.ndarray, q: np.ndarray, k: int):
    """(query_id, vec_id, score, part): the ``k`` nearest of the rows that a task reads."""

    def run(batches):
        held = np.empty((0, 4), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch["vec_id"].to_numpy(zero_copy_only=False)
            # Rows are told apart by their place: of a repeated id each has its own part.
            found = exact_top(query_id, q, ids, _matrix(batch["embedding"]), k, places=True)
            parts = batch["part"].to_numpy(zero_copy_only=False)
            new = [(i, int(ids[at]), score, int(parts[at])) for i, at, score in found]
            held = np.concatenate((held, np.array(new, object).reshape(-1, 4)))
            order = np.lexsort((held[:, 1].astype(np.int64), -held[:, 2].astype(float), held[:, 0].astype(np.int64)))
            held = held[order]
            own = held[:, 0].astype(np.int64)
            held = held[np.arange(len(own)) - np.searchsorted(own, own) < k]
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32())
        names = ["query_id", "vec_id", "score", "part"]
        yield pa.record_batch([pa.array(held[:, i].tolist(), t) for i, t in enumerate(kinds)], names)

    return run


def enough_probes(
    placed: DataFrame, queries: DataFrame, router: Router, k: int, least: int,
    recall: float = RECALL, measured: int = MEASURED,
) -> int:
    """Parts to search so that ``recall`` of the ``k`` nearest of some queries are in them.

    ``measured`` queries, chosen by a hash, are compared with all rows.
    """
    parts = router.w2.shape[1]
    if least >= parts:
        return parts
    sample = queries.orderBy(F.xxhash64("own", F.lit("recall")), "own").limit(measured).select(
        "vec_id", "embedding").toArrow()
    if not sample.num_rows:
        return least
    ids, q = sample["vec_id"].to_numpy(), _matrix(sample["embedding"])
    near = arrow(
        placed.select("vec_id", "embedding", "part"), _nearest_with_part(ids, q, k),
        "query_id long, vec_id long, score double, part int",
    ).groupBy("query_id", "vec_id").agg(
        F.max("score").alias("score"), F.max_by("part", "score").alias("part")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # At most k rows for each measured query.
    truth = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "part").toArrow()
    place = np.argsort(_route(router, q), axis=1)
    first = {}
    for i, row in zip(ids.tolist(), place, strict=True):
        first[i] = np.minimum(first[i], row) if i in first else row
    asked, held = truth["query_id"].to_pylist(), truth["part"].to_pylist()
    need = np.array([first[i][p] for i, p in zip(asked, held, strict=True)], np.int64)
    found = np.cumsum(np.bincount(need, minlength=parts)) >= recall * len(need)
    return max(least, int(np.argmax(found)) + 1)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of rows that can be compared.

    Out are NULL ids, vectors that are NULL, empty, zero or hold NULL or non-finite
    components, and vectors of another length than most.
    """
    finite = F.forall(
        "embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    )
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite
        & F.exists("embedding", lambda v: v != 0)
    )
    usual = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(
        F.desc("count"), "size"
    ).first()
    return rows.where(F.size("embedding") == (usual["size"] if usual else 0))


def search(
    vectors: DataFrame, is_query: Column, k: int = NEIGHBOURS, probes: int = PROBES,
    sample: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query row.

    Candidates are all usable rows with another vec_id.  Rows that share a vec_id are
    one candidate, and one query, with the best of their scores.
    """
    rows = usable(vectors)
    # A row of a repeated id is told apart by a hash of its vector, in the blocks only.
    rows = rows.withColumn("own", F.xxhash64("vec_id", "embedding"))
    sampled = rows.dropDuplicates(["own"]).orderBy(F.xxhash64("own"), "own").limit(sample).select(
        "embedding").toArrow()
    schema = "vec_id long, embedding array<double>"
    if not sampled.num_rows:
        return vectors.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score double"
        )
    router = fit(_matrix(sampled["embedding"]))
    placed = pin(
        arrow(rows, _placer(router), f"{schema}, own long, part int").distinct(), "vectors"
    )
    per_part = placed.groupBy("part").count().collect()
    sizes = np.zeros(router.w2.shape[1], np.int64)
    for row in per_part:
        sizes[row["part"]] = row["count"]
    asking = placed.where(is_query).select("vec_id", "embedding", "own")
    probes = enough_probes(placed, asking, router, k, probes)
    queries = arrow(
        asking, _routed(router, sizes, probes, k), f"{schema}, own long, parts array<int>",
    ).withColumn("part", F.explode("parts")).drop("parts")
    asked = queries.groupBy("part").count().collect()
    # A row for each part: how many blocks its rows and its queries make.
    cuts = {r["part"]: [1, 1] for r in [*per_part, *asked]}
    for r in per_part:
        cuts[r["part"]][0] = -(-r["count"] // BLOCK_ROWS)
    for r in asked:
        cuts[r["part"]][1] = -(-r["count"] // BLOCK_QUERIES)
    grid = vectors.sparkSession.createDataFrame(
        [(p, a, b) for p, (a, b) in cuts.items()], "part int, row_blocks int, query_blocks int"
    )

    def block(of: str) -> Column:
        return F.pmod("own", F.col(of)).cast("int")

    def every(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    blocks = F.broadcast(grid)
    left = queries.join(blocks, "part").select(
        "vec_id", "embedding", "part", block("query_blocks").alias("qb"), every("row_blocks").alias("rb")
    )
    right = placed.join(blocks, "part").select(
        "vec_id", "embedding", "part", every("query_blocks").alias("qb"), block("row_blocks").alias("rb")
    )
    keys = ("part", "qb", "rb")
    found = (
        left.groupBy(*keys).cogroup(right.groupBy(*keys))
        .applyInArrow(_compare(k), "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def digest(vectors: DataFrame) -> DataFrame:
    """Each row with an id divisible by 50 against all rows."""
    return search(vectors, F.col("vec_id") % QUERY_EVERY == 0)
