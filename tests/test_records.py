"""Files read in splits against the same files read by one task each."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.plans import views
from tidemark.session import settings
from tidemark.sources import records
from tidemark.sources import register as reg

NAMES = ["date_of_extract", "organisation_number", "registered_charity_number", "linked_charity_number", "policy_name"]
ODD = [
    'plain', '', '"quoted"', '"tab\there"', '"line\nbreak"', '"two\n\nbreaks\n"', '"say ""so"""', '""""', '""',
    '"""\n"', 'in"side', 'ends"', '"a""\n""b\t""c"', '"\t"', 'é"ü', '"\n\t""\n"', '"x" junk', "back\\slash", '"\\"',
]


def rows(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))


def both(spark, path, size, json_array=False):
    whole = reg.scan_register(spark, "charity_policy", path, json_array)
    split = reg.scan_register_split(spark, "charity_policy", path, json_array, size)
    assert split.columns == whole.columns and split.dtypes == whole.dtypes
    return rows(split), rows(whole)


@pytest.mark.parametrize("size, end", [(37, "\n"), (64, "\n"), (53, "\r\n"), (1 << 20, "\n")])
def test_quoted_files_cut_anywhere(spark, tmp_path, size, end):
    rnd = random.Random(size)
    for k in range(12):
        lines = ["\t".join(NAMES), "\t".join(["2024-01-31", str(k), "x" * k * 3, "", "pad"])]
        for i in range(12):
            lines.append("\t".join(["2024-01-31", str(100 * k + i), rnd.choice(ODD), rnd.choice(["", "7", '"8"']), rnd.choice(ODD)]))
            if i % 5 == 4:
                lines.append("")
        text = end.join(lines) + (end if k % 2 else "")
        if k % 3 == 0:
            text = "﻿" + text if k == 3 else text
        (tmp_path / f"{k}.txt").write_text(text, newline="")
    split, whole = both(spark, str(tmp_path), size)
    assert len(whole) == 12 * 13
    assert split == whole


@pytest.mark.parametrize("size", [29, 64, 1 << 20])
def test_arrays_cut_anywhere(spark, tmp_path, size):
    rnd = random.Random(size)
    odd = ["plain", "", "}", "}{", '"', '\\', '\\"}', "[", "],[", "a\nb", "é}", "\\}", None, 5, 1.5, True]
    for k in range(8):
        items = [{"organisation_number": 100 * k + i, "policy_name": rnd.choice(odd),
                  rnd.choice(["linked_charity_number", "more"]): rnd.choice([1, "x", {"in": {"side": [1, {"a": "}"}]}}])}
                 for i in range(10)]
        items[0]["date_of_extract"] = "x" * k
        text = json.dumps(items, ensure_ascii=k % 2 == 0, indent=None if k % 3 else 1)
        (tmp_path / f"{k}.json").write_text(text + "\n" * (k % 3))
    split, whole = both(spark, str(tmp_path), size, True)
    assert len(whole) == 80

    def bare(found):
        # Nested values, which no documented column has, are written without white space.
        return sorted(tuple(re.sub(r"\\n|\s", "", v) for v in r) for r in found)

    assert bare(split) == bare(whole)


def test_empty_files_and_arrays(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\t".join(NAMES))
    (tmp_path / "b.txt").write_text("")
    assert both(spark, str(tmp_path / "a.txt"), 10) == ([], [])
    assert both(spark, str(tmp_path / "b.txt"), 10) == ([], [])
    (tmp_path / "a.json").write_text(" [ ]\n")
    (tmp_path / "b.json").write_text('[{}, {"policy_name": "a"}]')
    split, whole = both(spark, str(tmp_path / "b.json"), 10, True)
    assert split == whole and len(split) == 2
    assert both(spark, str(tmp_path / "a.json"), 10, True)[0] == []


@pytest.mark.parametrize("text", ['{"policy_name": "a"}', '[{"policy_name": "a"}', '[{"policy_name": "a"', '[{"policy_name": "a}]'])
def test_what_is_no_array_fails(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="not a JSON array"):
        reg.scan_register_split(spark, "charity_policy", str(tmp_path), True, 10).collect()


def test_other_headers_fail(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\t".join(reversed(NAMES)) + "\n" + "\t" * 4 + "\n")
    with pytest.raises(Exception, match="header"):
        reg.scan_register_split(spark, "charity_policy", str(tmp_path), split_bytes=10).collect()
    (tmp_path / "a.txt").write_text("\n" + "\t".join(NAMES) + "\n")
    with pytest.raises(Exception, match="empty line"):
        reg.scan_register_split(spark, "charity_policy", str(tmp_path), split_bytes=10).collect()


def test_one_file_is_many_tasks(spark, tmp_path):
    body = "\n".join("\t".join(["2024-01-31", str(i), "", "", '"a\nb"']) for i in range(500))
    (tmp_path / "a.txt").write_text("\t".join(NAMES) + "\n" + body)
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "1024"}):
        found = records._pieces(spark, str(tmp_path), "\n")
        assert found.rdd.getNumPartitions() > 10
    split = reg.scan_register_split(spark, "charity_policy", str(tmp_path), split_bytes=1024)
    assert split.count() == 500
    # The session's own setting is as before.
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != "1024"


def test_landed_arrays_have_files_of_their_own(spark, tmp_path):
    rows = [(n, f"name {n}", n % 25, float(n), "segment") for n in range(200)]
    ddl = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/customer.parquet")
    # As many tasks as large tables have.
    spread = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    with settings(spark, spread):
        path = views.land_register(spark, str(tmp_path), "charity_policy", json_array=True)
    held = spark.read.text(path).groupBy(F.col("_metadata.file_path")).count()
    assert [r["count"] for r in held.collect()] == [1] * 4
    scan = reg.scan_register_split(spark, "charity_policy", path, True, split_bytes=1 << 10)
    assert sorted(r.organisation_number for r in scan.collect()) == list(range(200))
