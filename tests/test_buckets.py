"""State in hash buckets against a rebuild from all events."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.events import nest
from tidemark.operators.snapshot import latest_snapshot, newest_rows
from tidemark.streaming import buckets


def rows(df):
    return sorted(tuple(r[c] for c in ("resource_uri", "timepoint", "type", "data")) for r in df.collect())


@pytest.fixture
def log(make_log):
    rnd = random.Random(2)
    return [
        (tp, f"/r/{rnd.randrange(40) if rnd.random() < 0.7 else 0}", rnd.choice(["changed"] * 4 + ["deleted"]))
        for tp in rnd.sample(range(1000), 300)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_any_split_and_order(spark, tmp_path, make_log, log, seed):
    rnd = random.Random(seed)
    rnd.shuffle(log)
    state, at, n = str(tmp_path / "state"), 0, 0
    while at < len(log):
        size = rnd.randrange(1, 150)
        buckets.apply_batch(spark, state, make_log(log[at : at + size]), n, buckets=8)
        at, n = at + size, n + 1
    assert rows(buckets.bucketed_snapshot(spark, state)) == rows(latest_snapshot(make_log(log)))
    assert rows(buckets.read_buckets(spark, state)) == rows(newest_rows(make_log(log)))


def test_a_batch_rewrites_the_buckets_it_touches(spark, tmp_path, make_log, log):
    state = str(tmp_path / "state")
    assert buckets.apply_batch(spark, state, make_log(log), 0, buckets=16) > 10
    before = {p.relative_to(tmp_path): p.stat().st_mtime_ns for p in tmp_path.glob("state/rows/**/*.parquet")}
    two = make_log([(2000, "/r/1", "changed"), (2001, "/r/2", "deleted"), (2002, "/r/1", "changed")])
    assert buckets.apply_batch(spark, state, two, 1) == 2
    after = {p.relative_to(tmp_path): p.stat().st_mtime_ns for p in tmp_path.glob("state/rows/**/*.parquet")}
    assert before.items() <= after.items() and len({str(p).split("/")[2] for p in after.keys() - before.keys()}) == 2
    assert buckets.read_commits(spark, state).where("version = 1").count() == 2
    assert buckets.apply_batch(spark, state, two.where("false"), 2) == 0
    total = make_log(log).unionByName(two)
    assert rows(buckets.bucketed_snapshot(spark, state)) == rows(latest_snapshot(total))
    assert buckets.drop_old_versions(spark, state) == 2
    assert rows(buckets.bucketed_snapshot(spark, state)) == rows(latest_snapshot(total))


def test_a_batch_may_run_again(spark, tmp_path, make_log, log):
    state = str(tmp_path / "state")
    buckets.apply_batch(spark, state, make_log(log[:200]), 0, buckets=4)
    for _ in range(3):
        buckets.apply_batch(spark, state, make_log(log[200:]), 5)
    assert rows(buckets.bucketed_snapshot(spark, state)) == rows(latest_snapshot(make_log(log)))
    # Rows without a commit are not seen: the batch was stopped before it.
    make_log([(5000, "/r/1", "changed")]).withColumns({"bucket": F.lit(1), "version": F.lit(9)}).write.mode(
        "append").partitionBy("bucket", "version").parquet(f"{state}/rows")
    assert rows(buckets.bucketed_snapshot(spark, state)) == rows(latest_snapshot(make_log(log)))
    with pytest.raises(ValueError, match="comes after"):
        buckets.apply_batch(spark, state, make_log(log), 4)


def test_lookup_reads_its_buckets_alone(spark, tmp_path, make_log, log):
    state = str(tmp_path / "state")
    buckets.apply_batch(spark, state, make_log(log), 0, buckets=16)
    newest = {r.resource_uri: r.timepoint for r in newest_rows(make_log(log)).collect()}
    found = buckets.lookup(spark, state, ["/r/1", "/r/2", "/r/none"])
    assert {r.resource_uri: r.timepoint for r in found.collect()} == {k: newest[k] for k in ("/r/1", "/r/2")}
    folders = {f.split("/bucket=")[1].split("/")[0] for f in buckets.lookup(spark, state, ["/r/1"]).inputFiles()}
    assert len(folders) == 1
    assert buckets.lookup(spark, state, []).collect() == []


def test_rebucket_and_stream(spark, tmp_path, make_log, log):
    table, state, mark, out = (str(tmp_path / n) for n in ("table", "state", "mark", "out"))
    flat = make_log(log).withColumns({"resource_kind": F.lit("k"), "resource_id": F.lit("i"), "file": F.lit("f")})
    nest(flat).repartition(5).write.parquet(table)
    buckets.maintain_buckets(spark, table, state, mark, max_files=2, buckets=8)
    buckets.maintain_buckets(spark, table, state, mark, max_files=2)
    want = rows(latest_snapshot(make_log(log)))
    assert rows(buckets.bucketed_snapshot(spark, state)) == want
    buckets.rebucket(spark, state, out, 32)
    assert rows(buckets.bucketed_snapshot(spark, out)) == want
    assert buckets.read_commits(spark, out).agg(F.max("buckets")).head()[0] == 32


def test_an_empty_state(spark, tmp_path):
    with pytest.raises(ValueError, match="no batch"):
        buckets.read_buckets(spark, str(tmp_path / "none"))
