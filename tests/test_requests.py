"""Checks of what is asked for, and scopes of scratch folders."""

import threading

import pytest
from test_lines import write

from tidemark.functions.names import common_stream
from tidemark.operators import requests
from tidemark.session import pin, scratch, temporary
from tidemark.sources import landing


def test_requests_as_the_driver_checks_them(spark):
    root = "s3://sink"
    cases = {
        1: ["s3://sink/charges/a.json.gz", "s3://sink/charges/b.json.gz"],
        2: ["s3://sink/charges/a.json.gz", "s3://sink/officers/b.json.gz"],
        3: ["s3://sinks/charges/a.json.gz"],
        4: ["s3://sink/charges/a.json"],
        5: [None],
        6: ["s3://sink/unheard/a.json.gz"],
        7: ["s3://sink/charges/deep/er.json.gz"],
    }
    rows = [(r, f) for r, files in cases.items() for f in files]
    got = {r.request: r for r in requests.check_requests(spark.createDataFrame(rows, "request int, file string"), root).collect()}
    assert {k: (r.files, r.stream, r.problem) for k, r in got.items()} == {
        1: (2, "charges", None), 2: (2, None, "several streams"), 3: (1, None, "outside the root"),
        4: (1, None, "not an event file"), 5: (1, None, "outside the root"), 6: (1, None, "unknown stream"),
        7: (1, "charges", None),
    }
    for k in (1, 7):
        assert common_stream(cases[k], root) == got[k].stream
    for k in (2, 3, 4):
        with pytest.raises(ValueError):
            common_stream(cases[k], root)


def test_stream_names(spark):
    files = spark.createDataFrame([("/s/company-exemptions/a",), ("/s/company-exemptions/b",), ("/s/x y/a",), ("a",)], "file string")
    got = {r.stream: (r.known, r.table) for r in requests.stream_names(files).collect()}
    assert got == {"company-exemptions": (True, "company_exemptions"), "x y": (False, "x_y"), "": (False, "")}


def test_blank_captures_are_not_uploaded(spark, tmp_path):
    write(tmp_path / "s", "a.json.gz", '{"a":1}\n\n{"b":2}\n{"cut')
    write(tmp_path / "s", "b.json.gz", "\n \n\t\n")
    write(tmp_path / "s", "c.json.gz", "")
    write(tmp_path / "s", "d.json.gz", '{"cut')
    lines = pin(landing.read_lines(spark, f"{tmp_path}/s"), "lines")
    got = requests.captures(landing.list_sink_files(spark, f"{tmp_path}/s/*"), lines).collect()
    assert {r.file[-9:]: (r.lines, r.upload) for r in got} == {
        "a.json.gz": (2, True), "b.json.gz": (0, False), "c.json.gz": (0, False), "d.json.gz": (0, False),
    }


def test_scopes_of_threads_are_apart(spark):
    """A job that ends does not delete what another one in the session has made."""
    kept, began, ended = [], threading.Event(), threading.Event()

    def other():
        with temporary(spark):
            path = scratch(spark, "other")
            spark.range(3).write.parquet(path)
            kept.append(path)
            began.set()
            ended.wait(60)
            kept.append(spark.read.parquet(path).count())

    job = threading.Thread(target=other)
    with temporary(spark):
        job.start()
        began.wait(60)
        mine = scratch(spark, "mine")
        spark.range(2).write.parquet(mine)
    ended.set()
    job.join()
    assert kept[1] == 3
    with pytest.raises(Exception, match="(?i)path"):
        spark.read.parquet(mine)
