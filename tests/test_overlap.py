"""Depth of overlapping ranges and the files at a timepoint, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import overlap

SCHEMA = "file string, lo bigint, hi bigint"


def nested(seed, n=60, size=400):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        lo = rnd.randrange(-20 if seed % 2 else 0, size)
        out.append((f"f{i}", lo, lo + rnd.choice([0, 1, 5, 30, 200, -1])))
    return [*out, ("none", None, 5), ("whole", 0, size), ("copy", 0, size)]


def depths(rows, least=1):
    sound = [(lo, hi) for _, lo, hi in rows if lo is not None and hi is not None and lo <= hi]
    out, at = [], None
    for x in range(-30, 700):
        d = sum(lo <= x <= hi for lo, hi in sound)
        if out and out[-1][2] == d and out[-1][1] == x - 1:
            out[-1] = (out[-1][0], x, d)
        elif d >= least:
            out.append((x, x, d))
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("span", [3, 64, 1 << 20])
def test_depth(spark, seed, span):
    rows = nested(seed)
    got = overlap.overlap_depth(spark.createDataFrame(rows, SCHEMA), span=span)
    assert sorted(map(tuple, got.collect())) == depths(rows)
    deep = overlap.overlap_depth(spark.createDataFrame(rows, SCHEMA), span=span, least=3)
    assert sorted(map(tuple, deep.collect())) == [d for d in depths(rows) if d[2] >= 3]


def test_depth_of_each_stream(spark):
    parts = {s: nested(k) for k, s in enumerate(["a", None, "b"])}
    df = spark.createDataFrame([(s, *r) for s, rows in parts.items() for r in rows], f"stream string, {SCHEMA}")
    got = overlap.overlap_depth(df, ["stream"], span=50)
    want = [(s, *d) for s, rows in parts.items() for d in depths(rows)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_output_grows_with_the_files(spark):
    # Every file holds all later ones: n * n / 2 pairs.
    rows = [(f"f{i}", i, 10_000 - i) for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert overlap.overlap_depth(df).count() == 2 * 2000 - 1
    assert overlap.stab_index(df).count() < 2000 * 2 * 14


@pytest.mark.parametrize("seed", range(4))
def test_files_at(spark, seed):
    rows = nested(seed)
    index = overlap.stab_index(spark.createDataFrame(rows, SCHEMA))
    points = [*range(0, 620, 7), 0, 1, 399, 400, -3]
    got = overlap.files_at(index, spark.createDataFrame([(p,) for p in points], "timepoint bigint"))
    want = {(p, f) for p in points if p >= 0 for f, lo, hi in rows if lo is not None and lo <= p <= hi}
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_wide_ranges(spark):
    rows = [("a", 0, 2**60), ("b", 1, 2**60 - 1), ("c", 2**40 - 1, 2**40), ("d", 2**53 + 1, 2**53 + 1)]
    index = overlap.stab_index(spark.createDataFrame(rows, SCHEMA))
    widths = index.groupBy("file").agg(F.sum(F.expr("shiftleft(1L, level)")).alias("n")).collect()
    assert {r.file: r.n for r in widths} == {f: hi - lo + 1 for f, lo, hi in rows}
    points = spark.createDataFrame([(2**53 + 1,), (2**60,), (0,), (2**40,)], "timepoint bigint")
    found = {}
    for r in overlap.files_at(index, points).collect():
        found.setdefault(r.timepoint, set()).add(r.file)
    assert found == {2**53 + 1: {"a", "b", "d"}, 2**60: {"a"}, 0: {"a"}, 2**40: {"a", "b", "c"}}
