"""Presence kept per load against checks that read the whole log."""

import glob
import os
import random

import pytest
from test_lines import event, write

from tidemark.operators import checks, ranges
from tidemark.operators.events import flatten
from tidemark.streaming import load, presence

NOW = "2024-01-02T00:00:00"


@pytest.fixture
def dirs(tmp_path):
    return [str(tmp_path / n) for n in ("landing", "table", "mark")]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def same(spark, table, start=0):
    log = flatten(load.read_loaded(spark, table))
    report = presence.verify_loaded(spark, table, NOW, start)
    assert rows(report) == rows(checks.verify_events(log, NOW, start))


def issues_agree(spark, table):
    log = flatten(load.read_loaded(spark, table))
    assert rows(presence.loaded_issues(spark, table)) == rows(ranges.timepoint_issues(log))


def spoil(table, loads):
    """Rows of these loads can no longer be read, though names and sizes stay."""
    for n in loads:
        for name in glob.glob(f"{table}/rows/load={n}/*.parquet"):
            size = os.path.getsize(name)
            with open(name, "wb") as f:
                f.write(b"x" * size)
            for crc in glob.glob(f"{table}/rows/load={n}/.*.crc"):
                os.remove(crc)


def test_random_loads(spark, tmp_path, dirs):
    landing, table, mark = dirs
    rnd = random.Random(7)
    for day in range(4):
        for k in range(3):
            tps = [rnd.randrange(-200, 900) for _ in range(rnd.randrange(0, 120))]
            lines = [event(t) for t in tps] + ['{"error":"x"}', ""]
            write(tmp_path / "landing" / "s", f"{day}{k}.json.gz", "\n".join(lines) + "\n")
        load.load_events(spark, landing, table, mark, max_files=2)
        same(spark, table)
        issues_agree(spark, table)
    # Another start indexes anew; events before it count for the null check alone.
    for start in (100, 130, 0):
        same(spark, table, start)
        issues_agree(spark, table)


def test_only_new_loads_are_read(spark, tmp_path, dirs):
    landing, table, mark = dirs
    write(tmp_path / "landing" / "s", "a.json.gz", "".join(event(t) + "\n" for t in range(100)))
    write(tmp_path / "landing" / "s", "b.json.gz", "".join(event(t) + "\n" for t in range(100, 150)))
    load.load_events(spark, landing, table, mark, max_files=1)
    assert presence.refresh_presence(spark, table).count() == 2
    old = [r.load for r in load.read_ledger(spark, table).select("load").distinct().collect()]
    write(tmp_path / "landing" / "s", "c.json.gz", "".join(event(t) + "\n" for t in range(150, 170)))
    load.load_events(spark, landing, table, mark)
    spoil(table, old)
    report = {r.check: r for r in presence.verify_loaded(spark, table, NOW).collect()}
    assert report["contiguity"].detail == "170,170,170" and report["contiguity"].ok
    assert presence.refresh_presence(spark, table).count() == 0
    assert presence.loaded_issues(spark, table).count() == 0


def test_rewritten_and_lost_loads(spark, tmp_path, dirs):
    landing, table, mark = dirs
    for n, tps in {"a": range(50), "b": range(50, 90), "c": range(90, 95)}.items():
        write(tmp_path / "landing" / "s", f"{n}.json.gz", "".join(event(t) + "\n" for t in tps))
    load.load_events(spark, landing, table, mark, max_files=1)
    same(spark, table)
    names = [r.file for r in load.read_ledger(spark, table).collect() if r.file.endswith("b.json.gz")]
    load.store_load(spark, table, -1, names, load.scan_for_load, "event.timepoint")
    same(spark, table)
    issues_agree(spark, table)
    twice = load.read_ledger(spark, table).where(f"file = '{names[0]}'")
    load.correct_loaded(spark, table, twice)
    same(spark, table)
    issues_agree(spark, table)
    load.load_pending(spark, f"{landing}/*/*.gz", table)
    same(spark, table)
    out = f"{table}-2"
    load.compact_loaded(spark, table, out)
    presence.carry_presence(spark, table, out)
    # Nothing is left to read.
    assert presence.refresh_presence(spark, out).count() == 0
    same(spark, out)
    issues_agree(spark, out)


def test_a_stopped_run_is_done_again(spark, tmp_path, dirs):
    landing, table, mark = dirs
    write(tmp_path / "landing" / "s", "a.json.gz", "".join(event(t) + "\n" for t in (1, 2, 2, 7)))
    load.load_events(spark, landing, table, mark)
    presence.refresh_presence(spark, table)
    # Words are there, the mark is not.
    for name in glob.glob(f"{table}/presence/marks/load=*/*"):
        os.remove(name)
    same(spark, table)
    issues_agree(spark, table)


def test_empty_loads(spark, tmp_path, dirs):
    landing, table, mark = dirs
    write(tmp_path / "landing" / "s", "a.json.gz", "\n")
    write(tmp_path / "landing" / "s", "b.json.gz", event(64) + "\n" + event(64) + "\n" + event(64) + "\n")
    load.load_events(spark, landing, table, mark, max_files=1)
    same(spark, table)
    issues_agree(spark, table)


@pytest.mark.parametrize("most", [1, 2, 64])
def test_seams_hold_all_that_is_shared(most):
    rnd = random.Random(most)
    for _ in range(200):
        bounds = []
        for _ in range(rnd.randrange(8)):
            lo = rnd.randrange(60)
            bounds.append((lo, lo + rnd.randrange(12)))
        found = presence.seams(bounds, most)
        assert len(found) <= most
        assert all(a[1] < b[0] for a, b in zip(found, found[1:]))
        for x in range(80):
            if sum(lo <= x <= hi for lo, hi in bounds) > 1:
                assert any(lo <= x <= hi for lo, hi in found)
