"""The running order check against the one over all lines, and the limits of a run."""

import random
import time

import pytest
from pyspark.sql import functions as F
from test_lines import event, write

from tidemark.functions.json import line_timepoint
from tidemark.operators import lines as lin
from tidemark.operators import ranges
from tidemark.plans import catalog, views
from tidemark.session import pin, settings
from tidemark.sources import landing
from tidemark.streaming import live


@pytest.fixture
def dirs(tmp_path):
    return [str(tmp_path / n) for n in ("landing", "out", "mark")]


def watch(spark, dirs, **more):
    live.watch_order(spark, *dirs, **more).awaitTermination()
    return [r for r in live.read_watch(spark, dirs[1]).collect()]


def breaks(rows):
    return sorted((r.file, r.line_no, r.prev_tp, r.tp) for r in rows)


def batch(spark, path, start=None):
    lines = lin.number_lines(pin(landing.read_lines(spark, path), "lines"))
    numbered = lines.select("file", "line_no", line_timepoint(F.col("line")).alias("timepoint"))
    return breaks(ranges.order_breaks(numbered, start).collect())


def test_breaks_equal_the_batch_check(spark, tmp_path, dirs):
    rnd = random.Random(3)
    tp = 5
    for wave in range(3):
        for k in range(4):
            lines = []
            for _ in range(rnd.randrange(0, 40)):
                tp += rnd.choice([1, 1, 1, 1, 1, 1, 2, 0, -3])
                lines += [event(tp)] + rnd.choice([[], [], [""], ['{"error":"x"}'], ["{cut"]])
            write(tmp_path / "landing" / "s", f"{wave}{k}.json.gz", "\n".join(lines) + "\n")
        # Started anew for each wave; what was found before is not repeated.
        rows = watch(spark, dirs, starts={"s": 6})
        assert {r.kind for r in rows} <= {"break"} and {r.stream for r in rows} <= {"s"}
        assert breaks(rows) == batch(spark, f"{dirs[0]}/*", 6)
    assert breaks(watch(spark, dirs)) == batch(spark, f"{dirs[0]}/*", 6)


def test_streams_are_kept_apart(spark, tmp_path, dirs):
    write(tmp_path / "landing" / "a", "1.json.gz", event(1) + "\n" + event(2) + "\n")
    write(tmp_path / "landing" / "b", "1.json.gz", event(7) + "\n" + event(9) + "\n")
    assert [(r.stream, r.prev_tp, r.tp) for r in watch(spark, dirs, max_files=1)] == [("b", 7, 9)]
    write(tmp_path / "landing" / "a", "2.json.gz", event(3) + "\n")
    write(tmp_path / "landing" / "b", "2.json.gz", event(9) + "\n")
    assert sorted((r.stream, r.prev_tp, r.tp) for r in watch(spark, dirs)) == [("b", 7, 9), ("b", 9, 9)]


def test_files_of_several_splits(spark, tmp_path, dirs):
    folder = tmp_path / "landing" / "s"
    folder.mkdir(parents=True)
    (folder / "1.json").write_text("\n".join(event(t) for t in [*range(60), *range(70, 90)]))
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "700"}):
        rows = watch(spark, dirs, pattern="*.json", starts={"s": 0})
    assert [(r.prev_tp, r.tp) for r in rows] == [(59, 70)]


def test_idle_streams_and_limits(spark, tmp_path, dirs):
    write(tmp_path / "landing" / "s", "1.json.gz", event(1) + "\n" + event(2) + "\n")
    query = live.watch_order(spark, *dirs, idle_s=0.5, interval="100 milliseconds")
    assert live.run_bounded(query, first_data_s=60, idle_s=4, cap_s=90) == "idle"
    rows = live.read_watch(spark, dirs[1]).collect()
    assert [(r.kind, r.stream, r.prev_tp) for r in rows] == [("idle", "s", 2)]
    # The state outlives the run: the next event is compared with the last one.
    write(tmp_path / "landing" / "s", "2.json.gz", event(4) + "\n")
    query = live.watch_order(spark, *dirs, idle_s=60, interval="100 milliseconds")
    assert live.run_bounded(query, first_data_s=60, idle_s=4, cap_s=90) == "idle"
    rows = live.read_watch(spark, dirs[1]).where("kind = 'break'").collect()
    assert [(r.prev_tp, r.tp) for r in rows] == [(2, 4)]


def test_no_data_and_cap(spark, tmp_path, dirs):
    (tmp_path / "landing").mkdir()
    query = live.watch_order(spark, *dirs, interval="100 milliseconds")
    assert live.run_bounded(query, first_data_s=1) == "no data"
    query = live.watch_order(spark, *dirs, interval="100 milliseconds")
    begun = time.monotonic()
    assert live.run_bounded(query, cap_s=1) == "cap"
    assert time.monotonic() - begun < 60 and not query.isActive
    write(tmp_path / "landing" / "s", "1.json.gz", event(1) + "\n")
    assert live.run_bounded(live.watch_order(spark, *dirs)) == "ended"


def test_files_under_other_names(spark, tmp_path, dirs):
    """Files that stay in the folders they were written to give what they give under their names."""
    for k, tps in enumerate(([1, 2, 4], [5, 7])):
        write(tmp_path / "landing" / "wave-0" / "stream=s" / f"name={k}.json.gz", "part-0.txt.gz",
              "\n".join(map(event, tps)) + "\n")
    rows = watch(spark, dirs, pattern="*.gz", name=views.placed_name, starts={"s": 1})
    assert sorted((r.stream, r.file.split("/wave-0/")[1], r.line_no, r.prev_tp, r.tp) for r in rows) == [
        ("s", "s/0.json.gz", 3, 2, 4), ("s", "s/1.json.gz", 2, 5, 7)]


def test_no_file_is_renamed_by_the_driver(spark, monkeypatch):
    monkeypatch.setattr(views, "place_parts", lambda *_: pytest.fail("renames every file"))
    sf = "/root/testdata/sf0.001"
    assert catalog.queries()["watch_order"](spark, sf).count() > 0
