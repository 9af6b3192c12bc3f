"""Shapes of physical plans that results at scale depend on."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import accounts as acc
from tidemark.operators import checks, correction, files, ranges, snapshot, tables
from tidemark.operators.events import flatten, nest
from tidemark.operators.files import file_contiguity, replay_events, update_file_index
from tidemark.plans import views
from tidemark.plans.catalog import queries
from tidemark.sources import landing

# These run jobs of their own before they return a plan that only reads files back.
QUERIES = sorted(queries())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "log")
    log = nest(views.events(spark, SF))
    tables.sort_events(log, 8, "event.timepoint").write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", [q for q in QUERIES if not q.startswith(("publish", "export"))])
def test_no_nested_loops(spark, name):
    text = plan(queries()[name](spark, SF))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_latest_limits_before_the_shuffle(stored):
    text = plan(snapshot.latest_snapshot(flatten(stored)))
    partial = text.index("Partial")
    assert "WindowGroupLimit" in text
    assert text.index("Exchange hashpartitioning(__hash") < partial
    assert text.count("Exchange") == 1


def test_live_predicate_runs_after_the_ranking(stored):
    text = plan(snapshot.live_snapshot(flatten(stored), "companies"))
    assert text.index("parseJson") < text.index("Window")
    assert "parseJson" not in text[text.index("Window") :]


def test_checks_read_only_the_timepoint(stored):
    text = plan(checks.check_contiguity(flatten(stored), start=500))
    assert "ReadSchema: struct<event:struct<timepoint:bigint>>" in text
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(event.timepoint,500\)", text)
    assert "SortAggregate" not in text and text.count("Exchange hashpartitioning") == 1


def test_range_filters_skip_files(stored):
    """The table is sorted, so a range touches few row groups."""
    bounds = (
        stored.selectExpr("_metadata.file_path as f", "event.timepoint as tp")
        .groupBy("f")
        .agg({"tp": "min"})
        .count()
    )
    assert bounds == 8


def test_gaps_scan_once(stored):
    text = final_plan(ranges.missing_ranges(flatten(stored)))
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


def scans_of(monkeypatch, make):
    """File scans of a whole job: those of its pinned parts and of its final plan.

    Reading a pinned part back is no scan of the log.
    """
    seen = []
    keep = session.pin

    def watched(df, label):
        seen.append(final_plan(df))
        return keep(df, label)

    for module in (ranges, files, correction):
        monkeypatch.setattr(module, "pin", watched, raising=False)
    seen.append(final_plan(make()))
    lines = "\n".join(seen).split("\n")
    # Pinned parts lie in a folder of their own.
    return sum("FileScan" in line and "/tidemark/" not in line for line in lines)


def test_duplicates_come_from_one_pass(monkeypatch, stored):
    """Also where there are some: copies that occur twice are read off the words."""
    twice = flatten(stored)
    count = scans_of(monkeypatch, lambda: ranges.duplicate_timepoints(twice))
    assert count == 1
    count = scans_of(monkeypatch, lambda: ranges.timepoint_issues(twice))
    assert count == 1


def test_file_ranges_read_the_log_once(monkeypatch, stored):
    named = flatten(stored).withColumn("file", F.col("_metadata.file_path"))
    count = scans_of(monkeypatch, lambda: files.file_ranges(named))
    assert count == 1


def test_checks_of_a_table_are_one_scan(stored):
    assert final_plan(checks.verify_events(flatten(stored), "2024-01-31T00:00:00")).count("FileScan") == 1


def test_file_windows_share_a_shuffle(spark):
    text = final_plan(file_contiguity(views.ranges(spark, SF)))
    assert text.count("FileScan") == 1


def test_dedup_is_one_scan_and_an_anti_join(spark):
    text = plan(acc.accounts_dedup(views.accounts(spark, SF)))
    assert re.search(r"BroadcastHashJoin .*LeftAnti", text)
    assert text.count("FileScan") == 2


def files_read(df):
    df.collect()

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            yield from walk(node.executedPlan())
        elif "QueryStage" in name:
            yield from walk(node.plan())
        else:
            if name.startswith("Scan"):
                yield node.metrics().apply("numFiles").value()
            children = node.children()
            for i in range(children.size()):
                yield from walk(children.apply(i))

    return list(walk(df._jdf.queryExecution().executedPlan()))


def test_file_names_prune_a_landing_scan(spark, tmp_path):
    path = str(tmp_path / "companies")
    log = nest(views.events(spark, SF).drop("file"))
    tables.sort_events(log, 6, "event.timepoint").write.option("compression", "gzip").json(path)
    ev = landing.scan_flat(spark, path)
    listed = landing.list_sink_files(spark, path)
    assert files_read(ev) == [6]
    newest = listed.agg({"file": "max"}).head()[0]
    assert files_read(ev.where(ev.file == newest)) == [1]
    empty = spark.createDataFrame([], "filename string, min bigint, max bigint, stream string")
    index = update_file_index(empty, ev)
    assert max(files_read(replay_events(ev, index, "companies", 990))) == 1


def test_hot_key_does_not_swell_the_shuffle(spark):
    """A key with a third of the rows adds one row per task behind the partial limit."""
    hot = spark.range(30_000, numPartitions=6).selectExpr(
        "id as timepoint",
        "if(id % 3 = 0, 'hot', concat('r', id)) as resource_uri",
        "'changed' as type", "'p' as published_at", "'{}' as data",
    )
    df = snapshot.newest_rows(hot)
    df.collect()

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            yield from walk(node.executedPlan())
        elif "QueryStage" in name:
            yield from walk(node.plan())
        else:
            if name == "Exchange":
                yield node.metrics().apply("shuffleRecordsWritten").value()
            children = node.children()
            for i in range(children.size()):
                yield from walk(children.apply(i))

    written = list(walk(df._jdf.queryExecution().executedPlan()))
    assert written == [20_000 + 6]
