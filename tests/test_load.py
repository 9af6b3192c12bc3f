import gzip
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F
from test_lines import event, write

from tidemark.operators import tables
from tidemark.operators.events import flatten, nest
from tidemark.operators.files import file_ranges
from tidemark.streaming import load
from tidemark.streaming.index import maintain_index


@pytest.fixture
def dirs(tmp_path):
    return [str(tmp_path / n) for n in ("landing", "table", "mark")]


def added(df):
    return {r.file.rsplit("/", 1)[-1]: r.rows for r in df.collect()}


def test_load_is_exactly_once(spark, tmp_path, dirs):
    landing, table, mark = dirs
    stream = tmp_path / "landing" / "companies"
    write(stream, "a.json.gz", event(1) + "\n" + event(2) + "\n")
    write(stream, "b.json.gz", "\n" + event(3) + '\n{"error":"x"}\n')
    write(stream, "empty.json.gz", "\n \n")
    (stream / "note.txt").write_text("not an event file")
    assert added(load.load_events(spark, landing, table, mark, max_files=1)) == {
        "a.json.gz": 2, "b.json.gz": 1, "empty.json.gz": 0,
    }
    assert added(load.load_events(spark, landing, table, mark)) == {}
    write(stream, "c.json.gz", event(4) + "\n")
    assert added(load.load_events(spark, landing, table, mark)) == {"c.json.gz": 1}
    rows = flatten(load.read_loaded(spark, table))
    assert sorted(r.timepoint for r in rows.collect()) == [1, 2, 3, 4]
    assert {r.stream for r in rows.select("stream").distinct().collect()} == {"companies"}
    assert load.read_ledger(spark, table).count() == 4


@pytest.mark.parametrize("lost", ["commit", "commit and ledger"])
def test_batch_that_runs_again_loads_nothing_twice(spark, tmp_path, dirs, lost):
    landing, table, mark = dirs
    for i in range(4):
        write(tmp_path / "landing" / "s", f"{i}.json.gz", event(i) + "\n")
    load.load_events(spark, landing, table, mark, max_files=2)
    last = max(int(n) for n in os.listdir(f"{mark}/commits") if n.isdigit())
    # The checksum file goes too, as if the commit had never been written.
    os.remove(f"{mark}/commits/{last}")
    os.remove(f"{mark}/commits/.{last}.crc")
    if "ledger" in lost:
        shutil.rmtree(f"{table}/ledger/load={last}")
        # Rows without a ledger entry are not seen by readers.
        assert load.read_loaded(spark, table).count() == 2
    load.load_events(spark, landing, table, mark, max_files=2)
    assert sorted(r.timepoint for r in flatten(load.read_loaded(spark, table)).collect()) == [
        0, 1, 2, 3,
    ]
    assert load.read_ledger(spark, table).count() == 4


def test_loads_of_one_batch(spark, tmp_path, dirs, monkeypatch):
    """Several loads are one batch; stopped between rows and ledger, it comes again with the same loads."""
    landing, table, mark = dirs
    for i in range(7):
        # Listings print the blank plain, scans escaped.
        write(tmp_path / "landing" / "s", f"{i} a.json.gz", "" if i in (2, 3) else event(i) + "\n")
    with monkeypatch.context() as patch:
        patch.setattr(load, "exists", _stopped_at_rows(load.exists))
        with pytest.raises(Exception, match="stopped"):
            load.load_events(spark, landing, table, mark, max_files=2)
    load.load_events(spark, landing, table, mark, max_files=2)
    assert [n for n in os.listdir(f"{mark}/commits") if n.isdigit()] == ["0"]
    ledger = {}
    for r in load.read_ledger(spark, table).collect():
        ledger.setdefault(r.load, []).append(r.file)
    assert sorted(len(ledger[n]) for n in range(4)) == [1, 2, 2, 2]
    rows = load.read_loaded(spark, table)
    assert sorted(r.timepoint for r in flatten(rows).collect()) == [0, 1, 4, 5, 6]
    for r in rows.collect():
        assert r.file.replace("%20", " ") in ledger[r.load]
    # A load whose files are all blank has a folder as well.
    assert all(os.path.exists(f"{table}/rows/load={n}") for n in range(4))
    write(tmp_path / "landing" / "s", "8.json.gz", event(8) + "\n")
    load.load_events(spark, landing, table, mark, max_files=2)
    assert load.read_loads(spark, table) == (0, 4)


def _stopped_at_rows(exists):
    def stopped(spark, name):
        if "/rows/load=" in name:
            raise RuntimeError("stopped")
        return exists(spark, name)

    return stopped


def test_correction_and_second_load(spark, tmp_path, dirs):
    landing, table, mark = dirs
    for i in range(4):
        lines = "".join(event(tp) + "\n" for tp in range(i * 10, i * 10 + 10))
        write(tmp_path / "landing" / "s", f"{i}.json.gz", lines)
    load.load_events(spark, landing, table, mark, max_files=3)
    names = [r.file for r in load.read_ledger(spark, table).orderBy("file").collect()][1:3]
    load.store_load(spark, table, -1, names, load.scan_for_load, "event.timepoint")
    log = flatten(load.read_loaded(spark, table))
    assert log.count() == 60
    files = spark.createDataFrame([(n,) for n in names], "file string")
    for wrong in (names[:1], [], ["/x/s/1.json.gz"]):
        given = spark.createDataFrame([(n,) for n in wrong], "file string")
        with pytest.raises(ValueError):
            load.correct_loaded(spark, table, given)
    assert load.read_loaded(spark, table).count() == 60
    left = load.correct_loaded(spark, table, files)
    assert tuple(left.head()) == (None, None)
    assert sorted(r.timepoint for r in flatten(load.read_loaded(spark, table)).collect()) == [
        *range(10), *range(30, 40),
    ]
    assert load.read_ledger(spark, table).select("file").distinct().count() == 2
    again = load.load_pending(spark, f"{landing}/s/*.json.gz", table, max_files=1)
    assert added(again) == {"1.json.gz": 10, "2.json.gz": 10}
    assert load.load_pending(spark, f"{landing}/s/*.json.gz", table).count() == 0
    assert sorted(r.timepoint for r in flatten(load.read_loaded(spark, table)).collect()) == [
        *range(40)
    ]
    write(tmp_path / "landing" / "s", "4.json.gz", event(40) + "\n")
    assert added(load.load_events(spark, landing, table, mark)) == {"4.json.gz": 1}
    assert load.read_loaded(spark, table).count() == 41


def test_partial_overlap_is_refused(spark, tmp_path, dirs):
    """Files that share only part of their range: taking both ranges out would lose data."""
    landing, table, mark = dirs
    for name, span in (("a", range(10)), ("b", range(5, 15))):
        text = "".join(event(tp) + "\n" for tp in span)
        write(tmp_path / "landing" / "s", f"{name}.json.gz", text)
    load.load_events(spark, landing, table, mark)
    for chosen in ("b", "ab"):
        files = load.read_ledger(spark, table).where(
            F.substring_index("file", "/", -1).isin([f"{c}.json.gz" for c in chosen])
        )
        with pytest.raises(ValueError, match="range_match"):
            load.correct_loaded(spark, table, files)
    assert load.read_loaded(spark, table).count() == 20


@pytest.mark.parametrize("stop", ["ledger", "rows"])
def test_correction_survives_a_stop(spark, tmp_path, dirs, monkeypatch, stop):
    landing, table, mark = dirs
    for i in range(4):
        text = "".join(event(tp) + "\n" for tp in range(i * 10, i * 10 + 10))
        write(tmp_path / "landing" / "s", f"{i}.json.gz", text)
    load.load_events(spark, landing, table, mark, max_files=2)
    twice = load.read_ledger(spark, table).orderBy("file").collect()[1:3]
    names = [r.file for r in twice]
    load.store_load(spark, table, -1, names, load.scan_for_load, "event.timepoint")
    files = spark.createDataFrame([(n,) for n in names], "file string")
    whole = load._replace_loads

    def stopped(session, folder, *rest):
        if folder.endswith(stop):
            raise KeyboardInterrupt
        whole(session, folder, *rest)

    monkeypatch.setattr(load, "_replace_loads", stopped)
    with pytest.raises(KeyboardInterrupt):
        load.correct_loaded(spark, table, files)
    monkeypatch.setattr(load, "_replace_loads", whole)
    glob = f"{landing}/s/*.json.gz"
    with pytest.raises(RuntimeError):
        load.load_pending(spark, glob, table)
    assert tuple(load.correct_loaded(spark, table).head()) == (None, None)
    load.load_pending(spark, glob, table)
    rows = flatten(load.read_loaded(spark, table)).collect()
    assert sorted(r.timepoint for r in rows) == [*range(40)]


def test_stream_is_checked(spark, dirs):
    landing, table, mark = dirs
    with pytest.raises(ValueError):
        load.load_events(spark, f"{landing}/parties", table, mark, stream="parties")
    with pytest.raises(ValueError):
        load.load_events(spark, f"{landing}/charges", table, mark, stream="officers")
    assert load.table_path("/lake", "insolvency-cases") == "/lake/insolvency_cases"
    with pytest.raises(ValueError):
        load.table_path("/lake", "parties")


def test_pending_load_alone(spark, tmp_path, dirs):
    landing, table, _ = dirs
    for i in range(3):
        write(tmp_path / "landing" / "s", f"{i}.json.gz", event(i) + "\n")
    glob = f"{landing}/s/*.json.gz"
    assert len(added(load.load_pending(spark, glob, table, max_files=2))) == 3
    assert load.load_pending(spark, glob, table).count() == 0
    assert load.read_loaded(spark, table).count() == 3


def test_index_reads_every_file_once(spark, tmp_path, dirs):
    landing, index, mark = dirs
    write(tmp_path / "landing" / "charges", "a.json.gz", event(5) + "\n{bad\n" + event(9) + "\n")
    write(tmp_path / "landing" / "filings", "b.json.gz", '{"error":"x"}\n')
    maintain_index(spark, landing, index, mark, max_files=1)
    write(tmp_path / "landing" / "charges", "c.json.gz", event(10) + "\n")
    rows = maintain_index(spark, landing, index, mark).collect()
    got = sorted((r.filename.rsplit("/", 1)[-1], r.min, r.max, r.stream) for r in rows)
    assert got == [
        ("a.json.gz", 5, 9, "charges"), ("b.json.gz", None, None, "filings"),
        ("c.json.gz", 10, 10, "charges"),
    ]


def test_malformed_file_stops_the_load(spark, tmp_path, dirs):
    landing, table, mark = dirs
    write(tmp_path / "landing" / "s", "a.json.gz", event(1) + "\n{bad\n")
    with pytest.raises(Exception):
        load.load_events(spark, landing, table, mark)
    # The repaired file takes its place under the same name.
    (tmp_path / "landing" / "s" / "a.json.gz").write_bytes(
        gzip.compress((event(1) + "\n").encode())
    )
    load.load_events(spark, landing, table, mark)
    assert load.read_loaded(spark, table).count() == 1


def test_sorted_table_survives_a_hot_timepoint(spark):
    values = [500] * 3000 + random.Random(3).sample(range(6000), 6000)
    ev = spark.createDataFrame([(v,) for v in values], "timepoint bigint").repartition(5)
    out = tables.sort_events(ev, 6).select("timepoint", F.spark_partition_id().alias("p"))
    rows = out.collect()
    assert sorted(r.timepoint for r in rows) == sorted(values)
    by_part = {}
    for r in rows:
        by_part.setdefault(r.p, []).append(r.timepoint)
    parts = [by_part[p] for p in sorted(by_part)]
    assert all(p == sorted(p) for p in parts)
    assert all(a[-1] <= b[0] for a, b in zip(parts, parts[1:]))
    assert max(len(p) for p in parts) < 0.45 * len(values)


def test_compact(spark, make_log, tmp_path):
    log = make_log([(tp, f"/r{tp}", "changed") for tp in range(1, 501)])
    many, few = str(tmp_path / "many"), str(tmp_path / "few")
    nest(log).repartition(20).write.parquet(many)
    files = tables.compact_events(spark, many, few, target_rows=150).orderBy("lo").collect()
    assert 4 <= len(files) <= 6 and sum(f.rows for f in files) == 500
    assert all(a.hi < b.lo for a, b in zip(files, files[1:]))
    back = flatten(spark.read.parquet(few))
    assert back.select(*log.columns).exceptAll(log).count() == 0
    named = back.withColumn("file", F.col("_metadata.file_path"))
    assert file_ranges(named).count() == len(files)
    tables.drop_superseded(spark, many, few)
    assert not (tmp_path / "many").exists()
    nest(log.where("timepoint < 9")).write.parquet(many)
    with pytest.raises(ValueError):
        tables.drop_superseded(spark, many, few)
    assert (tmp_path / "many").exists()
