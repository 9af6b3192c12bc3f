import random

import pytest
from conftest import SF01
from pyspark.sql import functions as F

from tidemark.functions.json import field, json_ok
from tidemark.operators import snapshot as snp
from tidemark.operators.events import nest
from tidemark.plans import views
from tidemark.streaming import snapshot as stream


def brute(rows):
    newest = {}
    for tp, uri, kind in rows:
        if uri not in newest or tp > newest[uri][0]:
            newest[uri] = (tp, kind)
    return {(uri, tp) for uri, (tp, kind) in newest.items() if kind != "deleted"}


def pairs(df):
    return {(r.resource_uri, r.timepoint) for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    # One key holds a third of the log.
    return [
        (tp, "/hot" if tp % 3 == 0 else f"/r{rng.randrange(40)}",
         "deleted" if rng.random() < 0.2 else "changed")
        for tp in range(1, 901)
    ]


def test_known_answers(spark):
    ev = views.events(spark, SF01)
    snap = snp.latest_snapshot(ev)
    assert tuple(snap.agg(F.count("*"), F.sum("timepoint")).head()) == (120, 1183246)
    assert snp.live_snapshot(ev, "companies").count() == 44


def test_latest_equals_brute_force(make_log, rows):
    shuffled = random.Random(1).sample(rows, len(rows))
    assert pairs(snp.latest_snapshot(make_log(shuffled))) == brute(rows)


def test_deleted_key_does_not_fall_back(make_log):
    log = make_log([(1, "/a", "changed"), (2, "/a", "deleted"), (3, "/b", None)])
    assert pairs(snp.latest_snapshot(log)) == {("/b", 3)}


def test_ties_do_not_depend_on_layout(make_log):
    log = make_log([(5, "/a", "changed")]).unionByName(
        make_log([(5, "/a", "changed")]).withColumn("data", F.lit('{"z":1}'))
    )
    for n in (1, 2, 3):
        assert [r.data for r in snp.latest_snapshot(log.repartition(n)).collect()] == ['{"z":1}']


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_incremental_equals_rebuild(make_log, rows, seed):
    rng = random.Random(seed)
    mixed = rng.sample(rows, len(rows))
    cuts = sorted(rng.sample(range(1, len(rows)), 3))
    batches = [mixed[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    state = snp.newest_rows(make_log(batches[0]))
    for batch in batches[1:]:
        state = snp.incremental_snapshot(state, make_log(batch))
    assert pairs(snp.live_view(state)) == brute(rows)
    assert snp.watermark(state) == 900


def test_stream_state_equals_rebuild(spark, make_log, rows, tmp_path):
    table, state, mark = (str(tmp_path / n) for n in ("table", "state", "mark"))
    log = make_log(rows)
    nest(log.where("timepoint > 300")).repartition(3).write.parquet(table)
    stream.maintain_snapshot(spark, table, state, mark, max_files=1)
    # Older events arrive late.
    nest(log.where("timepoint <= 300")).repartition(2).write.mode("append").parquet(table)
    stream.maintain_snapshot(spark, table, state, mark, max_files=1)
    assert pairs(stream.current_snapshot(spark, state)) == brute(rows)
    batches = spark.read.parquet(state).select("batch").distinct().count()
    stream.maintain_snapshot(spark, table, state, mark)
    assert spark.read.parquet(state).select("batch").distinct().count() == batches
    folded = str(tmp_path / "folded")
    stream.fold_state(spark, state, folded)
    assert pairs(stream.current_snapshot(spark, folded)) == brute(rows)


def test_latest_by_join(make_log, rows):
    got = snp.latest_by_join(make_log(rows), watermark=100, limit=200)
    batch = [r for r in rows if 100 < r[0] <= 300]
    newest = {}
    for tp, uri, _ in batch:
        newest[uri] = max(tp, newest.get(uri, 0))
    assert pairs(got) == set(newest.items())


def test_upsert_collapses_copies(make_log):
    snap = make_log([(1, "/a", "changed"), (1, "/a", "changed"), (2, "/b", "changed")])
    batch = make_log([(3, "/b", "deleted"), (4, "/c", "changed")])
    out = snp.upsert_snapshot(snap, batch)
    assert sorted((r.resource_uri, r.timepoint) for r in out.collect()) == [("/a", 1), ("/c", 4)]


def test_manifest_keeps_large_timepoints(make_log):
    manifest = snp.snapshot_manifest(make_log([(213772890, "/a", "changed")]), "filings", "now")
    assert manifest.head().max_timepoint == 213772890


def test_json_null_is_not_absent(spark):
    data = ['{"a":null}', "{}", '{"a":"x"}', None, "not json", '{"a":1,"a":"x"}']
    df = spark.createDataFrame([(i, d) for i, d in enumerate(data)], "i int, data string")
    a = field(F.col("data"), "a")
    out = df.select("i", a.isNull().alias("absent"), (a != '"x"').alias("differs")).orderBy("i")
    assert [(r.absent, r.differs) for r in out.collect()] == [
        (False, True), (True, None), (False, False), (True, None), (True, None), (False, False),
    ]


@pytest.mark.parametrize(
    "text,ok",
    [
        ('{"a":1}', True), ("[1,2]", True), ("5", True), ('"x"', True), ("null", True),
        ('{"a":1} x', False), ('{"a":1}{"b":2}', False), ('{"a":1}}', False), ('{"a":1', False),
        ("{bad", False), ("1,2", False), ("1],[2", False), ('1,"x":2', False), ("", False),
        ('1,"__end__"]', False), ('{"a":1},"__end__"],"x":3', False), ('1,"__end__"', False),
        ('{"a":"__end__"}', True), ('"__end__"', True), ('{"a":1},{"b":2}', False),
        ('{"a":{"b":[1,{"c":null}]}}', True), ("{'a':1}", False), ('{"a":01}', False), ('{"a":NaN}', False), ('{"a":1,}', False),
    ],
)
def test_json_ok(spark, text, ok):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(json_ok(F.col("t")).alias("ok")).head().ok is ok


def test_live_predicates_cover_streams():
    with pytest.raises(ValueError):
        snp.live_predicate("parties")
