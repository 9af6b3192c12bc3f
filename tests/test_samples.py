"""Samples from sketches against those of the whole table."""

import pytest
from test_lines import event, write
from test_presence import spoil

from tidemark.operators.events import flatten
from tidemark.operators.export import sample_rows
from tidemark.streaming import load, samples


@pytest.fixture
def dirs(tmp_path):
    return [str(tmp_path / n) for n in ("landing", "table", "mark")]


def tps(df):
    return sorted(r.timepoint for r in df.collect())


def test_sketches_give_the_sample(spark, tmp_path, dirs):
    landing, table, mark = dirs
    for day in range(3):
        for k in range(2):
            lines = "".join(event(t) + "\n" for t in range(day * 200 + k * 100, day * 200 + k * 100 + 100))
            write(tmp_path / "landing" / "s", f"{day}{k}.json.gz", lines)
        load.load_events(spark, landing, table, mark, max_files=1)
        log = flatten(load.read_loaded(spark, table))
        for n, seed in ((20, "a"), (20, "b"), (1000, "a")):
            want = sample_rows(log, "timepoint", n, seed)
            assert tps(samples.sample_loaded(spark, table, n, seed)) == tps(want)
    samples.refresh_samples(spark, table, 20, "a")
    old = [r.load for r in load.read_ledger(spark, table).select("load").distinct().collect()]
    write(tmp_path / "landing" / "s", "9.json.gz", "".join(event(t) + "\n" for t in range(600, 700)))
    want = sample_rows(log.select("timepoint").unionByName(spark.range(600, 700).toDF("timepoint")), "timepoint", 20, "a")
    want = tps(want)
    load.load_events(spark, landing, table, mark)
    # Only the new load can be read.
    spoil(table, old)
    assert tps(samples.sample_loaded(spark, table, 20, "a")) == want
    assert samples.refresh_samples(spark, table, 20, "a") == 0


def test_rewritten_loads_and_days(spark, tmp_path, dirs):
    landing, table, mark = dirs
    write(tmp_path / "landing" / "s", "a.json.gz", "".join(event(t) + "\n" for t in range(50)))
    write(tmp_path / "landing" / "s", "b.json.gz", "".join(event(t) + "\n" for t in range(50, 80)))
    load.load_events(spark, landing, table, mark, max_files=1)
    assert samples.refresh_samples(spark, table, 10) == 2
    names = [r.file for r in load.read_ledger(spark, table).collect() if r.file.endswith("b.json.gz")]
    load.store_load(spark, table, -1, names, load.scan_for_load, "event.timepoint")
    assert samples.refresh_samples(spark, table, 10) == 1
    load.correct_loaded(spark, table, load.read_ledger(spark, table).where(f"file = '{names[0]}'"))
    log = flatten(load.read_loaded(spark, table))
    assert tps(samples.sample_loaded(spark, table, 10)) == tps(sample_rows(log, "timepoint", 10))
    days = {r.published_at[:10] for r in log.collect()}
    assert samples.sample_loaded(spark, table, 10, first_day=max(days), last_day=max(days)).count() == 10
    assert samples.sample_loaded(spark, table, 10, first_day="9999").count() == 0
