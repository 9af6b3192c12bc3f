import tracemalloc

import numpy as np
import pytest
from conftest import SF, SF01
from pyspark.sql import functions as F

from tidemark.llm import nearest
from tidemark.llm.common import table

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, k=5, every=50):
    """Exact nearest vectors, pair by pair."""
    out = {}
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q, v in vectors.items():
        if q % every:
            continue
        scored = [(-float((v * w).sum() / np.sqrt((v * v).sum() * (w * w).sum())), i)
                  for i, w in vectors.items() if i != q]
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("sf", [SF, SF01, "/root/testdata/sf0.1"])
def test_recall_and_scores(spark, sf):
    df = table(spark, sf, "embeddings")
    got = by_query(nearest.digest(df).collect())
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, found in got.items():
        known = dict(want[q])
        assert all(abs(known[i] - s) < 1e-12 for i, s in found if i in known)
        assert found == sorted(found, key=lambda p: (-p[1], p[0]))


def test_parts_are_balanced():
    rnd = np.random.default_rng(0)
    centres = rnd.normal(size=(8, 16))
    x = nearest.unit(np.repeat(centres, 64, axis=0) + 0.1 * rnd.normal(size=(512, 16)))
    graph = nearest.neighbour_graph(x, 8)
    label = nearest.balanced_parts(graph, 8)
    sizes = np.bincount(label, minlength=8)
    assert sizes.max() - sizes.min() <= 3
    assert (label[graph] == label[:, None]).mean() > 0.8
    target = np.eye(8)[label]
    assert (nearest.train_router(x, target).scores(x).argmax(axis=1) == label).mean() > 0.95


def test_neighbour_graph_keeps_only_neighbours():
    """Memory of some blocks of rows, not of all pairs."""
    x = nearest.unit(np.random.default_rng(1).normal(size=(4_096, 8)))
    tracemalloc.start()
    graph = nearest.neighbour_graph(x, 4)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < len(x) ** 2 * 8 / 2
    near = x @ x.T
    np.fill_diagonal(near, -2)
    assert np.allclose(np.sort(np.take_along_axis(near, graph, 1)), np.sort(near)[:, -4:])


def test_ties_and_a_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 64)
    monkeypatch.setattr(nearest, "BLOCK_QUERIES", 4)
    rnd = np.random.default_rng(4)
    hot = rnd.normal(size=8).astype(np.float32).tolist()
    rows = [(i, hot if i % 3 else rnd.normal(size=8).astype(np.float32).tolist()) for i in range(900)]
    got = by_query(nearest.digest(spark.createDataFrame(rows, VECTORS)).collect())
    want = brute(rows)
    same = [q for q, v in rows if q % 50 == 0 and q % 3]
    assert same and all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in same)


def test_rows_that_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, []), (None, [1.0, 0.0]), (8, [1.0, 2.0, 3.0]), (50, [0.0, 0.0]),
            (100, [2.0, 0.0]), (9, [0.0, -3.0]), (9, [0.0, -3.0])]
    df = spark.createDataFrame(rows, VECTORS).withColumn("part", F.lit(1)).withColumn("own", F.lit("a"))
    got = by_query(nearest.digest(df).collect())
    assert set(got) == {0, 100}
    assert [i for i, _ in got[0]] == [100, 1, 9] and [i for i, _ in got[100]] == [0, 1, 9]
    assert got[0][0][1] == 1.0 and got[0][2][1] == 0.0
    assert nearest.digest(spark.createDataFrame([], VECTORS)).collect() == []
    assert nearest.digest(spark.createDataFrame([(0, [1.0])], VECTORS)).collect() == []
    big = [(0, [3e38, 3e38]), (1, [1e-40, 1e-40]), (2, [3e38, -3e38])]
    out = by_query(nearest.digest(spark.createDataFrame(big, VECTORS)).collect())
    assert [i for i, _ in out[0]] == [1, 2] and abs(out[0][0][1] - 1) < 1e-12


def test_repeated_query_ids(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0]), (3, [-1.0, -1.0])]
    got = by_query(nearest.digest(spark.createDataFrame(rows, VECTORS)).collect())
    assert [i for i, _ in got[50]] == [1, 2, 3]


def test_recall_without_structure(spark):
    rnd = np.random.default_rng(8)
    x = rnd.normal(size=(9_000, 48)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], VECTORS).repartition(4)
    got = by_query(nearest.digest(df).collect())
    unit = nearest.unit(x.astype(float))
    queries = np.arange(0, len(x), 50)
    near = unit[queries] @ unit.T
    near[np.arange(len(queries)), queries] = -2
    want = np.argsort(-near, axis=1)[:, :5]
    hits = sum(len({i for i, _ in got[q]} & set(w.tolist())) for q, w in zip(queries.tolist(), want, strict=True))
    assert hits >= 0.9 * want.size
