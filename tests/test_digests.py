"""Snapshots compared by digests, against the full join."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import digests
from tidemark.operators.snapshot import check_unique_resources, compare_snapshots

SCHEMA = "k string, a bigint, b string, c double"
FIELDS = ["a", "b", "c"]


def shuffled(spark, job):
    """Rows written to shuffles while ``job`` runs."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def stages():
        none = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
        found = store.stageList(None, False, False, none, None)
        return {(s := found.apply(i)).stageId(): s.shuffleWriteRecords() for i in range(found.size())}

    before = stages()
    job()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return sum(n for stage, n in stages().items() if stage not in before)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def changed(rows, rnd, n):
    rows = [r for r in rows if rnd.random() > n / len(rows)]
    for i in rnd.sample(range(len(rows)), n):
        k, a, b, c = rows[i]
        rows[i] = rnd.choice([(k, a + 1, b, c), (k, None, b, c), (k, a, None, c), (k, a, b + "x", c), (k, a, b, -1.0)])
    return [*rows, *((f"new{i}", i, "n", None) for i in range(n))]


ROWS = [(f"key{i}", i, f"b{i % 7}", i / 3) for i in range(3000)]


@pytest.mark.parametrize("n, bits, join_rows", [(0, 12, 100), (3, 12, 100), (40, 4, 50), (40, 4, 10**6), (900, 2, 10)])
def test_equals_the_full_join(spark, n, bits, join_rows):
    rnd = random.Random(n)
    a, b = table(spark, ROWS), table(spark, changed(ROWS, rnd, n) if n else ROWS)
    got = digests.compare_by_digest(a, b, "k", FIELDS, bits, join_rows)
    want = compare_snapshots(a, b, "k", FIELDS)
    assert got.columns == want.columns and got.head() == want.head()


def test_keys_without_a_value(spark):
    a, b = table(spark, [(None, 1, "x", 1.0), ("a", 1, "x", 1.0)]), table(spark, [(None, 1, "x", 1.0)])
    for left, right in ((a, b), (b, a), (a, a), (a, a.where("false")), (a.where("false"), b.where("false"))):
        assert digests.compare_by_digest(left, right, "k", FIELDS).head() == compare_snapshots(left, right, "k", FIELDS).head()


def test_nulls_in_other_columns_differ(spark):
    a = table(spark, [("a", 5, None, None)]).withColumn("d", F.lit(None).cast("bigint"))
    b = table(spark, [("a", None, None, None)]).withColumn("d", F.lit(5).cast("bigint"))
    assert digests.compare_by_digest(a, b, "k", ["a", "d"]).head() == compare_snapshots(a, b, "k", ["a", "d"]).head()


def test_equal_tables_shuffle_no_rows(spark, tmp_path):
    for name in ("a", "b"):
        table(spark, ROWS * 1).write.parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in ("a", "b"))
    moved = shuffled(spark, lambda: digests.compare_by_digest(a, b, "k", FIELDS, bits=3).collect())
    # Digests: eight leaves of each task and side; the join of rows has none.
    assert moved < 200
    assert shuffled(spark, lambda: compare_snapshots(a, b, "k", FIELDS).collect()) >= 6000
    # One row that differs brings its leaf and no more.
    table(spark, [*ROWS[:-1], ("key2999", -1, "", 0.0)]).write.parquet(str(tmp_path / "c"))
    c = spark.read.parquet(str(tmp_path / "c"))
    moved = shuffled(spark, lambda: digests.compare_by_digest(a, c, "k", FIELDS, bits=7, join_rows=10).collect())
    assert moved < 3000


def test_repeated_keys(spark):
    rows = [*ROWS[:50], *ROWS[10:20], ROWS[15], (None, 1, "x", 1.0), (None, 2, "x", 1.0)]
    got = digests.repeated_keys(table(spark, rows), "k")
    want = check_unique_resources(table(spark, rows), "k")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
