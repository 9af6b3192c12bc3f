"""Text exports cut by their own bytes."""

import gzip

import pytest
from pyspark.sql import functions as F

from tidemark.operators import export

SCHEMA = "id bigint, name string, note string"


def parts(path):
    out = {}
    for name in sorted(path.glob("part=*/*.gz")):
        number = int(name.parent.name.split("=")[1])
        assert number not in out, "one file for each part"
        out[number] = gzip.decompress(name.read_bytes())
    return [out[k] for k in range(len(out))]


ROWS = [(i, "x" * (i * 7 % 50), None if i % 5 else 'é "quoted", and\nmore') for i in range(400)]


@pytest.mark.parametrize("fmt", ["json", "csv"])
@pytest.mark.parametrize("target", [300, 1000, 10**6])
def test_parts_miss_the_target_by_less_than_a_row(spark, tmp_path, fmt, target):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    entry = export.export_split_text(df, str(tmp_path / "out"), fmt, file_bytes=target, order=["id"]).head()
    assert entry["count"] == 400
    found = parts(tmp_path / "out")
    assert entry["file_count"] == len(found)
    longest = 160
    assert all(abs(len(p) - target) < longest for p in found[:-1]) and len(found[-1]) < target + longest
    read = spark.read.schema(SCHEMA)
    if fmt == "json":
        back = read.json(str(tmp_path / "out"))
        assert b"".join(found).count(b"\n") == 400
    else:
        back = read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path / "out"))
        assert all(p.startswith(b"id,name,note\n") for p in found)
    got = sorted(tuple(r) for r in back.select("id", F.coalesce("name", F.lit("")), "note").collect())
    assert got == ROWS


def test_parts_follow_the_order(spark, tmp_path):
    df = spark.range(2000).select("id").repartition(7)
    export.export_split_text(df, str(tmp_path / "out"), file_bytes=500, order=["id"])
    ids = [int(line.split(b":")[1][:-1]) for p in parts(tmp_path / "out") for line in p.splitlines()]
    assert ids == list(range(2000))


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_without_rows(spark, tmp_path, fmt):
    df = spark.createDataFrame([], SCHEMA)
    entry = export.export_split_text(df, str(tmp_path / "out"), fmt).head()
    assert entry["count"] == 0
    assert b"".join(parts(tmp_path / "out")) == (b"id,name,note\n" if fmt == "csv" else b"")
    with pytest.raises(ValueError, match="no text format"):
        export.export_split_text(df, str(tmp_path / "out"), "parquet")


def test_a_row_beyond_the_target(spark, tmp_path):
    df = spark.createDataFrame([(1, "a" * 5000, None), (2, "b", None), (3, "c", None)], SCHEMA).coalesce(1)
    export.export_split_text(df, str(tmp_path / "out"), file_bytes=100, order=["id"])
    lines = gzip.decompress(next((tmp_path / "out" / "part=0").glob("*.gz")).read_bytes()).splitlines()
    assert len(lines) == 1
    assert spark.read.json(str(tmp_path / "out")).count() == 3
    export.export_split_text(df, str(tmp_path / "csv"), "csv", file_bytes=100, order=["id"])
    # No part of a header alone.
    assert len(list((tmp_path / "csv").glob("part=*"))) == 2
