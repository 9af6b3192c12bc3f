import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from llm_sql import agrees

from tidemark.llm import hard_negatives as hard
from tidemark.llm.common import table

SCHEMA = "vec_id long, label int, embedding array<float>, row long"


def brute(rows):
    """The definition, in plain integers."""
    ready = []
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not np.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        ready.append((vec_id, label, [int(np.floor(256 * float(np.float32(x)))) for x in vector]))
    out = []
    for i, (anchor, label, a) in enumerate(ready):
        if anchor % 50:
            continue
        limit = 2**63 - 2
        scored = sorted(
            (-max(-limit, min(limit, sum(x * y for x, y in zip(a, c)))), v, other == label)
            for j, (v, other, c) in enumerate(ready) if j != i
        )
        for p, positive, _ in [s for s in scored if s[2]][:5]:
            fits = [s for s in scored if not s[2] and 50 * -p <= 100 * -s[0] <= 95 * -p]
            out += [(anchor, positive, k + 1, n, -p, -s) for k, (s, n, _) in enumerate(fits[:3])]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    out = hard.hard_negatives(df)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def test_whole_table(spark):
    assert agrees(hard.hard_negatives(table(spark, SF, "embeddings")), hard.ORACLE)


def test_odd_rows(spark):
    rnd = random.Random(4)

    def vector(k=6):
        return [rnd.choice([-1.5, -0.5, 0.0, 0.3, 0.5, 1.0, 1.25]) for _ in range(k)]

    rows = [(v, rnd.randrange(3), vector()) for v in range(0, 400, 2)]
    rows += [(None, 1, vector()), (700, None, vector()), (701, 1, None), (703, 1, [0.1, None]),
             (705, 2, [float("nan")] * 6), (707, 2, [float("inf")] * 6),
             (900, 1, []), (901, 1, vector(9)), (950, 2, vector(3)), (951, -4, vector())]
    # Repeated rows, and one id with several vectors.
    rows += [rows[0]] * 3 + [rows[5]] * 4 + [(50, 1, vector()), (50, 1, vector())]
    want = brute(rows)
    assert len(want) > 20
    assert mined(spark, rows) == want


def test_equal_vectors(spark):
    rows = [(v, v % 2, [0.5, 0.5]) for v in range(0, 300, 5)]
    rows += [(v, 1 - v % 2, [0.4, 0.45]) for v in range(1, 300, 7)]
    assert mined(spark, rows) == brute(rows)


def test_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(50, 1, [1.0])]) == []


def test_blocks_of_any_size(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(v, rnd.randrange(4), [rnd.uniform(-1, 1) for _ in range(5)]) for v in range(0, 1500, 5)]
    monkeypatch.setattr(hard, "BLOCK_ROWS", 16)
    monkeypatch.setattr(hard, "GROUP_ROWS", 3)
    assert mined(spark, rows) == brute(rows)


@pytest.mark.parametrize("size", [1, 255, 2**20, 2**29, 2**40])
def test_products_are_exact(size):
    rnd = random.Random(size)
    a = np.array([[rnd.randint(-size, size) for _ in range(7)] for _ in range(40)], float)
    c = np.array([[rnd.randint(-size, size) for _ in range(7)] for _ in range(33)], float)
    limit = 2**63 - 2
    want = [[max(-limit, min(limit, sum(int(x) * int(y) for x, y in zip(r, s)))) for s in c] for r in a]
    assert hard.products(a, c).tolist() == want
    assert hard.products(a, np.abs(c)).tolist() == [
        [max(-limit, min(limit, sum(int(x) * abs(int(y)) for x, y in zip(r, s)))) for s in c] for r in a
    ]


def test_huge_components(spark):
    rows = [(v, v % 2, [3e38, -2e38 if v % 3 else 1.0, float(v)]) for v in range(0, 120, 10)]
    assert mined(spark, rows) == brute(rows)


def test_sql_with_odd_rows(spark):
    rows = [(50, 1, [0.5, 0.5]), (1, 1, [0.5, 0.6]), (2, 2, [0.4, 0.5]), (3, 2, None), (4, None, [1.0, 1.0]),
            (50, 1, [0.5, 0.5]), (5, 3, [0.3, float("nan")])]
    names = ["vec_id", "label", "embedding"]
    given = pa.table({n: [r[k] for r in rows] for k, n in enumerate(names)})
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    assert agrees(hard.hard_negatives(df), hard.ORACLE, {"embeddings": given})
