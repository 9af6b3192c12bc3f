"""Hand-written landing files: blank lines, cut tails, bad lines, error objects, cut gzip."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lines as lin
from tidemark.operators import repair
from tidemark.operators.events import flatten
from tidemark.session import pin
from tidemark.sources import landing
from tidemark.streaming import load


def event(tp, **extra):
    return json.dumps(
        {
            "resource_kind": "company",
            "resource_id": str(tp),
            "resource_uri": f"/c/{tp}",
            "data": {"b": 1, "a": "ü"},
            "event": {"timepoint": tp, "published_at": "2024-01-01T00:00:00", "type": "changed"},
            **extra,
        },
        ensure_ascii=False,
    )


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(gzip.compress(text.encode()))


@pytest.fixture(scope="module")
def sink(tmp_path_factory):
    folder = tmp_path_factory.mktemp("sink") / "companies"
    lines = {
        "a": [event(1), "", event(2), "   ", event(3), event(4), event(5)],
        "b": [event(6), event(7), event(8), "", '{"event":{"timep'],
        "c": [event(9), "{bad", event(10)],
        "d": [event(11), '{"a":1}{"b":2}', event(12)],
        "e": [event(13), '{"error":"x"}'],
    }
    for name, content in lines.items():
        tail = "" if name == "b" else "\n"
        write(folder, f"{name}.json.gz", "\n".join(content) + tail)
    write(folder, "g.json.gz", " \n\n\t\n")
    return folder


def short(df, *columns):
    name = F.substring_index("file", "/", -1)
    return {r[0][0]: tuple(r)[1:] for r in df.select(name, *columns).collect()}


@pytest.fixture(scope="module")
def lines(spark, sink):
    return pin(landing.read_lines(spark, str(sink)), "lines")


def test_classify(lines):
    got = short(lin.classify_files(lines), "kind", "line_no")
    assert got == {
        "a": ("ok", None),
        "b": ("broken_at_end", 4),
        "c": ("broken_mid_file", 2),
        "d": ("broken_mid_file", 2),
        "e": ("ok", None),
    }


def test_classify_reports_the_text(lines):
    got = short(lin.classify_files(lines), "line")
    assert got["b"] == ('{"event":{"timep',) and got["c"] == ("{bad",)


def test_first_and_last_whole_event(lines):
    got = short(lin.file_first_last(lines), "first_tp", "last_tp")
    assert got == {"a": (1, 5), "b": (6, 8), "c": (9, 10), "d": (11, 12), "e": (13, 13)}


def test_first_line_counts_as_it_is(spark, tmp_path):
    write(tmp_path, "x.json.gz", "{bad\n" + event(3) + "\n")
    write(tmp_path, "y.json.gz", event(4).replace("4,", '"4",', 1) + "\n")
    got = short(
        lin.file_first_last(landing.read_lines(spark, str(tmp_path))), "first_tp", "last_tp"
    )
    assert got["x"] == (None, 3)
    # A timepoint in quotes is no number.
    assert got["y"] == (None, None)


def test_resume_offset(spark, lines):
    assert lin.resume_offset(lin.file_first_last(lines)).collect() == [("companies", 14)]
    none = lin.file_first_last(lines.limit(0))
    assert lin.resume_offset(none).collect() == []


def test_boundary(lines):
    got = short(lin.boundary_check(lin.file_first_last(lines)), "last_tp", "next_first_tp", "ok")
    assert got == {
        "a": (5, 6, True), "b": (8, 9, True), "c": (10, 11, True), "d": (12, 13, True),
        "e": (13, None, None),
    }


def test_valid_prefix(lines):
    counted = lin.valid_prefix(lines).groupBy("file").count()
    assert short(counted, "count") == {"a": (5,), "b": (3,), "c": (1,), "d": (1,), "e": (2,)}


def test_clean_landing_drops_only_the_cut_tail(lines):
    counted = lin.clean_landing(lines).groupBy("file").count()
    assert short(counted, "count") == {"a": (5,), "b": (3,), "c": (3,), "d": (3,), "e": (2,)}


def test_number_lines_over_many_splits(spark, tmp_path):
    """One plain-text file cut into many splits keeps its numbering and its diagnosis."""
    texts = [event(i) if i % 7 else "" for i in range(1, 2000)]
    texts[1500] = "{bad"
    (tmp_path / "big.json").write_text("\n".join(texts) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = pin(landing.read_lines(spark, str(tmp_path)), "big")
        assert lines.select("block").distinct().count() > 5
        kept = [t for t in texts if t]
        numbered = lin.number_lines(lines).orderBy("line_no").collect()
        assert [(r.line_no, r.line) for r in numbered] == list(enumerate(kept, 1))
        row = lin.classify_files(lines).head()
        assert (row.kind, row.line_no) == ("broken_mid_file", kept.index("{bad") + 1)
        ends = lin.file_first_last(lines).head()
        assert (ends.first_tp, ends.last_tp) == (1, 1999)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_repair_outcomes(spark, sink, tmp_path):
    files = landing.list_sink_files(spark, str(sink))
    ledger = files.where(F.col("file").endswith("a.json.gz")).select("file")
    out = str(tmp_path / "fixed")
    outcomes = repair.repair_landing(
        spark, str(sink), landing.unloaded_files(files, ledger), out
    )
    assert short(outcomes, "status", "reason") == {
        "b": ("fixed", None),
        "c": ("skipped_mid_file", "bad line 2"),
        "d": ("skipped_mid_file", "bad line 2"),
    }
    counts = {r.status: r.n for r in repair.outcome_counts(outcomes).collect()}
    assert counts == {"fixed": 1, "skipped_mid_file": 2}
    fixed = landing.scan_events(spark, f"{out}/repaired/companies/b.json.gz")
    assert sorted(r.event.timepoint for r in fixed.collect()) == [6, 7, 8]


def test_repaired_files_take_their_place_and_load(spark, tmp_path):
    """Two streams, a cut line, a cut gzip and a bad line inside, all in one run."""
    land, out = tmp_path / "land", tmp_path / "out"
    for stream in ("charges", "officers"):
        write(land / stream, "a.json.gz", event(1) + "\n" + event(2) + "\n" + '{"cut')
        write(land / stream, "b.json.gz", "".join(event(i) + "\n" for i in range(3, 5)))
    many = gzip.compress("".join(event(i) + "\n" for i in range(5, 30_005)).encode())
    (land / "charges" / "c.json.gz").write_bytes(many[:-40])
    write(land / "officers" / "..", "x.txt", "no landing file")
    glob = f"{land}/*/*.json.gz"
    with pytest.raises(Exception):
        load.load_events(spark, str(land), str(tmp_path / "t"), str(tmp_path / "m"))
    pending = landing.list_sink_files(spark, glob)
    outcomes = repair.repair_landing(spark, glob, pending, str(out), swap=True).collect()
    got = {tuple(r.file.split("/")[-2:]): r.status for r in outcomes}
    assert got == {("charges", "a.json.gz"): "fixed", ("officers", "a.json.gz"): "fixed",
                   ("charges", "c.json.gz"): "fixed"}
    load.load_events(spark, str(land), str(tmp_path / "t"), str(tmp_path / "m"))
    rows = flatten(load.read_loaded(spark, str(tmp_path / "t"))).collect()
    charges = sorted(r.timepoint for r in rows if r.stream == "charges")
    assert charges == list(range(1, len(charges) + 1)) and len(charges) > 20_000
    assert sorted(r.timepoint for r in rows if r.stream == "officers") == [1, 2, 3, 4]
    assert (out / "backup" / "charges" / "c.json.gz").read_bytes() == many[:-40]


def test_swap_restores_what_is_not_valid(spark, tmp_path):
    write(tmp_path / "s", "a.json.gz", event(1) + "\n{bad")
    write(tmp_path / "repaired" / "s", "a.json.gz", event(1) + "\n" + event(2) + "\n")
    file = f"file://{tmp_path}/s/a.json.gz"
    before = (tmp_path / "s" / "a.json.gz").read_bytes()
    assert repair.swap_repaired(
        spark, {file: 1}, f"{tmp_path}/repaired", f"{tmp_path}/backup"
    ) == [file]
    assert (tmp_path / "s" / "a.json.gz").read_bytes() == before


def test_streams_are_kept_apart(spark, tmp_path):
    for stream, first in (("charges", 1), ("officers", 50)):
        write(tmp_path / stream, "a.json.gz", event(first) + "\n")
        write(tmp_path / stream, "b.json.gz", event(first + 1) + "\n")
    lines = pin(landing.read_lines(spark, str(tmp_path / "*" / "*.gz")), "streams")
    ends = pin(lin.file_first_last(lines), "ends")
    got = {tuple(r.file.split("/")[-2:]): r.ok for r in lin.boundary_check(ends).collect()}
    assert got == {("charges", "a.json.gz"): True, ("charges", "b.json.gz"): None,
                   ("officers", "a.json.gz"): True, ("officers", "b.json.gz"): None}
    assert {r.stream: r.next_timepoint for r in lin.resume_offset(ends).collect()} == {
        "charges": 3, "officers": 52}


def test_cut_gzip_is_that_files_outcome(spark, tmp_path):
    text = "".join(event(i) + "\n" for i in range(20_000)).encode()
    write(tmp_path / "s", "a.json.gz", event(1) + "\n")
    (tmp_path / "s" / "b.json.gz").write_bytes(gzip.compress(text)[:-30])
    # Two members one after the other are whole; so is an empty file's single one.
    (tmp_path / "s" / "c.json.gz").write_bytes(gzip.compress(text) + gzip.compress(b"\n"))
    (tmp_path / "s" / "d.json.gz").write_bytes(gzip.compress(b""))
    # A file without a byte is no partition to Spark: nothing reads it, nothing is lost.
    (tmp_path / "s" / "e.json.gz").write_bytes(b"")
    cut = landing.cut_files(spark, str(tmp_path / "s"))
    assert {r.file.rsplit("/", 1)[1] for r in cut.collect()} == {"b.json.gz"}
    lines = pin(landing.read_lines(spark, str(tmp_path / "s")), "cut")
    got = short(lin.classify_files(lines, cut), "kind")
    assert got == {"a": ("ok",), "b": ("broken_at_end",), "c": ("ok",)}


def test_repair_fails_where_the_next_file_does_not_continue(spark, tmp_path):
    write(tmp_path / "s", "b.json.gz", event(1) + "\n" + '{"cut')
    write(tmp_path / "s", "c.json.gz", event(3) + "\n")
    files = landing.list_sink_files(spark, str(tmp_path / "s"))
    outcomes = repair.repair_landing(
        spark, str(tmp_path / "s"), files, str(tmp_path / "out")
    )
    assert short(outcomes, "status") == {"b": ("failed",)}


def test_file_of_one_bad_line(spark, tmp_path):
    write(tmp_path / "s", "b.json.gz", '{"cut')
    write(tmp_path / "s", "c.json.gz", event(1) + "\n" + event(2) + "\n" + '{"c')
    lines = pin(landing.read_lines(spark, str(tmp_path / "s")), "one")
    got = short(repair.repair_files(lines, str(tmp_path / "o")), "kept_lines", "verified")
    assert got == {"b": (0, True), "c": (2, True)}


def test_strict_scan(spark, sink):
    good = landing.scan_events(spark, [str(sink / "a.json.gz"), str(sink / "e.json.gz")])
    rows = good.orderBy("event.timepoint").collect()
    assert [r.event.timepoint for r in rows] == [1, 2, 3, 4, 5, 13]
    assert rows[0].data == '{"b": 1, "a": "ü"}'
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
        landing.scan_events(spark, str(sink / "c.json.gz")).collect()


GLUED = ['{"event":{"timepoint":3}}{"event":{"timepoint":4}}', '{"event":{"timepoint":5}} junk',
         '{"event":{"timepoint":8}},"__end__":7} tail', '{"event":{"timepoint":9}}}',
         '{"event":{"timepoint":"10"}}']


@pytest.mark.parametrize("line", GLUED)
def test_nothing_behind_an_object_is_lost(spark, tmp_path, line):
    write(tmp_path / "s", "a.json.gz", event(1) + "\n" + line + "\n" + event(2) + "\n")
    path = str(tmp_path / "s")
    strict = landing.scan_events(spark, path)
    for df in (strict, strict.where("event.timepoint > 1"), strict.select("file")):
        with pytest.raises(Exception):
            df.collect()
    rows = landing.scan_events_tolerant(spark, path).collect()
    assert [r._corrupt_record for r in rows if r._corrupt_record] == [line]
    assert sorted(r.event.timepoint for r in rows if r.event) == [1, 2]
    with pytest.raises(Exception):
        load.load_events(spark, str(tmp_path), str(tmp_path / "t"), str(tmp_path / "m"))


def test_tolerant_scan_keeps_bad_lines(spark, sink):
    rows = landing.scan_events_tolerant(spark, str(sink / "c.json.gz")).collect()
    assert len(rows) == 3
    assert [r._corrupt_record for r in rows if r.event is None] == ["{bad"]
    assert flatten(landing.scan_events_tolerant(spark, str(sink / "e.json.gz"))).count() == 2


def test_cut_gzip(spark, tmp_path):
    whole = gzip.compress("".join(event(i) + "\n" for i in range(50_000)).encode())
    (tmp_path / "f.json.gz").write_bytes(whole[:-40])
    with pytest.raises(Exception, match="FAILED_READ_FILE|Unexpected end"):
        landing.scan_events(spark, str(tmp_path)).count()
    lenient = spark.read.option("ignoreCorruptFiles", True).text(str(tmp_path))
    assert 45_000 < lenient.count() < 50_000


def test_find_broken_files_in_name_order(spark, lines):
    pending = lines.select("file").distinct()
    first = lin.find_broken_files(lines, pending, limit=1).collect()
    assert len(first) == 1 and first[0].file.endswith("b.json.gz")


def test_write_clean(spark, sink, tmp_path):
    lines = pin(landing.read_lines(spark, [str(sink / n) for n in ("b.json.gz", "g.json.gz")]), "c")
    assert repair.write_clean(lines, str(tmp_path / "o"))
    kept = landing.scan_events(spark, f"{tmp_path}/o/companies").collect()
    assert sorted(r.event.timepoint for r in kept) == [6, 7, 8]
    blank = pin(landing.read_lines(spark, str(sink / "g.json.gz")), "g")
    assert not repair.write_clean(blank, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
