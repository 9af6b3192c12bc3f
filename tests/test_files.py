import random

import pytest
from conftest import SF01
from pyspark.sql import functions as F

from tidemark.functions.names import common_start, common_stream, name_bucket, schema_name
from tidemark.operators import correction, files as fil
from tidemark.operators import checks
from tidemark.plans import views
from tidemark.sources import landing

RANGE = "file string, idx bigint, lo bigint, hi bigint"


@pytest.fixture
def rng(spark):
    def make(bounds):
        return spark.createDataFrame(
            [(f"/s/{i:03d}", i, lo, hi) for i, (lo, hi) in enumerate(bounds)], RANGE
        )

    return make


@pytest.fixture
def dup(spark):
    def make(lo, hi):
        return spark.createDataFrame([(lo, hi)], "min_duplicate bigint, max_duplicate bigint")

    return make


def test_known_overlaps(spark):
    pairs = fil.overlap_pairs(views.ranges(spark, SF01)).collect()
    got = sorted((int(r.earlier[-13:-8]), int(r.later[-13:-8]), r.width) for r in pairs)
    assert got == [
        (3, 4, 40), (6, 7, 1100), (6, 8, 600), (6, 9, 100), (10, 11, 40), (12, 13, 500),
        (15, 16, 500), (17, 18, 40),
    ]


def test_overlaps_behind_short_files(rng):
    """Every file that begins before an earlier one has ended has its row."""
    got = fil.overlap_pairs(rng([(1, 1000), (200, 300), (500, 600), (1001, 1002)])).collect()
    assert sorted((r.earlier, r.later, r.width) for r in got) == [
        ("/s/000", "/s/001", 801), ("/s/000", "/s/002", 501),
    ]


def test_recommendation_names_the_files_that_hold_the_duplicate(rng, dup):
    """The short file between the two ends before the duplicate begins."""
    rows = fil.overlap_recommendation(rng([(1, 1000), (200, 900), (850, 1100)]), dup(950, 990))
    got = {(r.earlier, r.later): r.holds_duplicate for r in rows.collect()}
    assert got == {("/s/000", "/s/001"): False, ("/s/000", "/s/002"): True}


@pytest.mark.parametrize("seed", range(4))
def test_overlaps_equal_all_pairs(spark, monkeypatch, seed):
    """Three streams, small buckets: each later file with the one that reaches furthest."""
    monkeypatch.setattr(fil, "_FILES", 3)
    r = random.Random(seed)
    rows = []
    for stream in ("a", "b", "c"):
        lo = 0
        for i in range(r.randrange(0, 25)):
            lo += r.randrange(1, 30)
            rows.append((f"/x/{stream}/{i:03d}", i, lo, lo + r.choice([3, 20, 90])))
    want = set()
    for f, i, lo, hi in rows:
        ahead = [(e_hi, e_i, e) for e, e_i, _, e_hi in rows if e[:4] == f[:4] and e_i < i and e_hi >= lo]
        if ahead:
            want.add((max(ahead)[2], f))
    got = fil.overlap_pairs(spark.createDataFrame(rows, RANGE)).collect()
    assert {(r.earlier, r.later) for r in got} == want and len(got) == len(want)


# before, earlier, later, after -> reason, is the later one kept
DECISIONS = {
    "later fills": ([(1, 10), (11, 25), (11, 20), (21, 30)], "later file fills the gap", True),
    "earlier fills": ([(1, 10), (11, 20), (15, 25), (21, 30)], "earlier file fills the gap", False),
    "re-capture": (
        [(1, 10), (12, 20), (15, 25), (30, 40)],
        "later file captures again what the earlier one holds",
        False,
    ),
}


@pytest.mark.parametrize("name", DECISIONS)
def test_recommendation(rng, dup, name):
    bounds, reason, keeps_later = DECISIONS[name]
    # The earlier file may also reach into the one after; rows come in any order.
    rows = {
        (r.earlier, r.later): r
        for r in fil.overlap_recommendation(rng(bounds), dup(15, 18)).collect()
    }
    row = rows["/s/001", "/s/002"]
    assert row.reason == reason
    assert row.keep == ("/s/002" if keeps_later else "/s/001")
    assert row["drop"] != row.keep
    (_, b_hi), (e_lo, e_hi), (l_lo, l_hi), (a_lo, _) = bounds
    assert (row.expected_lo, row.expected_hi) == (b_hi + 1, a_lo - 1)
    assert (row.gap_before, row.overlap_width, row.gap_after) == (
        e_lo - b_hi - 1, e_hi - l_lo + 1, a_lo - l_hi - 1,
    )
    assert row.holds_duplicate


def test_recommendation_at_the_ends(rng, dup):
    row = fil.overlap_recommendation(rng([(1, 10), (8, 20)]), dup(None, None)).head()
    assert (row.expected_lo, row.expected_hi, row.gap_before, row.gap_after) == (1, 20, None, None)
    assert not row.holds_duplicate


def test_overlap_at_a_timepoint_looks_past_short_files(rng):
    got = fil.overlap_pairs(rng([(1, 50), (10, 12), (20, 60), (61, 70)]), timepoint=30).collect()
    assert [(r.earlier, r.later, r.width) for r in got] == [("/s/000", "/s/002", 31)]


def test_flags(rng, dup):
    rows = {
        r.file: (r.overlaps_previous, r.contains_duplicate, r.exact_match)
        for r in fil.file_overlap_flags(rng([(1, 10), (11, 20), (20, 30)]), dup(11, 20)).collect()
    }
    assert rows == {
        "/s/000": (False, False, False),
        "/s/001": (False, True, True),
        "/s/002": (True, True, False),
    }


@pytest.mark.parametrize("seed", range(3))
def test_neighbours_across_buckets(spark, monkeypatch, seed):
    monkeypatch.setattr(fil, "_FILES", 4)
    r = random.Random(seed)
    bounds = [(i * 10, i * 10 + r.randrange(5, 20)) for i in range(r.randrange(1, 30))]
    rng = spark.createDataFrame(
        [(f"/s/{i:03d}", i, lo, hi) for i, (lo, hi) in enumerate(bounds)], RANGE
    )
    rows = sorted(fil.file_neighbours(rng).collect())
    for i, row in enumerate(rows):
        assert row.prev_hi == (bounds[i - 1][1] if i else None)
        assert row.next_lo == (bounds[i + 1][0] if i + 1 < len(bounds) else None)


def test_number_files_over_buckets(spark):
    names = [f"/s/{random.Random(i).randrange(16**12):012x}.json.gz" for i in range(200)]
    df = spark.createDataFrame([(n,) for n in names], "file string")
    got = {r.file: r.idx for r in fil.number_files(df).collect()}
    assert got == {n: i for i, n in enumerate(sorted(names))}


def test_number_files_with_like_names(spark):
    names = [f"/x/{s}/events-{i:08d}.json.gz" for s in ("officers", "charges") for i in range(300)]
    df = spark.createDataFrame([(n,) for n in names], "file string")
    got = {r.file: r.idx for r in fil.number_files(df).collect()}
    assert got == {n: int(n[-16:-8]) for n in names}
    bucket = name_bucket(F.col("file"), common_start(df))
    assert df.select(bucket).distinct().count() > 100


def test_files_of_other_streams_are_no_neighbours(spark):
    rows = [("/x/charges/a", 0, 1, 9), ("/x/charges/b", 1, 10, 20), ("/x/officers/a", 0, 5, 30),
            ("/x/officers/b", 1, 31, 40)]
    rng = spark.createDataFrame(rows, RANGE)
    got = {r.file: (r.prev_hi, r.next_lo) for r in fil.file_neighbours(rng).collect()}
    assert got == {"/x/charges/a": (None, 10), "/x/charges/b": (9, None),
                   "/x/officers/a": (None, 31), "/x/officers/b": (30, None)}
    assert {r.file: r.contiguous for r in fil.file_contiguity(rng).collect()} == {
        "/x/charges/a": None, "/x/charges/b": True, "/x/officers/a": None, "/x/officers/b": True}
    assert fil.overlap_pairs(rng).collect() == []


def test_contiguity_orders_by_content(spark, rng):
    rows = {r.file: r.contiguous for r in fil.file_contiguity(rng([(11, 20), (1, 10), (22, 30)])).collect()}
    assert rows == {"/s/000": True, "/s/001": None, "/s/002": False}


@pytest.fixture
def played(spark):
    rows = [("/x/charges/a", tp) for tp in range(1, 11)]
    rows += [("/x/charges/b", tp) for tp in range(8, 15)] + [("/x/filings/a", 3)]
    rows = [(*r, i) for i, r in enumerate(rows)]
    ev = spark.createDataFrame(rows, "file string, timepoint bigint, position bigint")
    empty = spark.createDataFrame([], "filename string, min bigint, max bigint, stream string")
    return ev, fil.update_file_index(empty, ev)


def test_replay(played):
    ev, index = played
    got = [r.timepoint for r in fil.replay_events(ev, index, "charges", 9).collect()]
    assert got == sorted([9, 10] + list(range(9, 15)))
    raw = [r.timepoint for r in fil.replay_events(ev, index, "charges", 9, raw=True).collect()]
    # Files one after another, each in its own order.
    assert raw == [9, 10, *range(8, 15)]
    assert [r.filename for r in fil.replay_files(index, "charges", 11).collect()] == ["/x/charges/b"]


def test_replay_checks_its_arguments(played):
    ev, index = played
    for bad in (0, 15):
        with pytest.raises(ValueError):
            fil.replay_events(ev, index, "charges", bad)
    with pytest.raises(ValueError):
        fil.replay_events(ev, index, "charges", "9")
    with pytest.raises(LookupError):
        fil.replay_events(ev, index, "officers", 3)
    with pytest.raises(ValueError, match="unknown stream"):
        fil.replay_events(ev, index, "parties", 3)


def test_replay_smoke(played):
    ev, index = played
    row = fil.replay_smoke(ev, index, "charges").head()
    assert (row.events, row.breaks) == (17, 3)
    assert fil.replay_smoke(ev, index, "charges", last=2).head().events == 3


def test_index_update_adds_only_new_files(spark, played):
    ev, index = played
    more = ev.unionByName(
        spark.createDataFrame([("/x/charges/c", None, 0), ("/x/charges/d", 20, 1)], ev.schema)
    )
    grown = fil.update_file_index(index, more)
    assert grown.count() == 5
    assert {(r.filename, r.min, r.stream) for r in grown.collect()} >= {
        ("/x/charges/c", None, "charges"), ("/x/charges/d", 20, "charges"),
    }
    assert fil.update_file_index(grown, more).count() == 5
    assert fil.update_file_index(index, more, limit=1).count() == 4
    listing = more.select("file").distinct()
    assert sorted(fil.update_file_index(index, more, listing).collect()) == sorted(grown.collect())
    first = fil.update_file_index(index, more, listing, limit=1)
    assert {r.filename for r in first.collect()} - {r.filename for r in index.collect()} == {
        "/x/charges/c"}
    assert {r.stream: r.file_count for r in fil.index_file_count(grown).collect()} == {
        "charges": 4, "filings": 1,
    }


def ledger_of(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "file string")


def test_confirm_double_load(spark, rng):
    once = [(f"/s/{tp // 10:03d}", tp) for tp in range(50)]
    twice = [r for r in once if 10 <= r[1] < 30]
    ev = spark.createDataFrame(once + twice, "file string, timepoint bigint")
    files = rng([(0, 9), (10, 19), (20, 29)]).where("idx > 0")
    ledger = ledger_of(spark, "/s/001", "/s/002")
    assert all(correction.confirm_double_load(ev, files, ledger).head())
    partial = correction.confirm_double_load(
        ev.where("not (timepoint = 15 and file = '/s/001')"), files, ledger_of(spark, "/s/001")
    ).head()
    assert partial.range_match and partial.contiguous
    assert not partial.all_duplicated and not partial.all_in_ledger
    gap = correction.confirm_double_load(ev, rng([(10, 18), (20, 29)]), ledger).head()
    assert not gap.contiguous
    healthy = spark.createDataFrame(once, ev.schema)
    none = correction.confirm_double_load(healthy, files, ledger).head()
    assert not none.range_match and not none.all_duplicated


def test_correction_leaves_a_clean_log(spark, dup):
    rows = [("/s/a", 1), ("/s/a", 2), ("/s/b", 3), ("/s/b", 3), ("/s/b", 4), ("/s/b", 4), ("/s/c", 5)]
    ev = spark.createDataFrame(rows, "file string, timepoint bigint")
    plan = correction.correction_plan(ev, dup(3, 4)).head()
    assert tuple(plan) == (4, 2, 2)
    wanted = spark.createDataFrame([("/s/b", 3, 4)], "file string, lo bigint, hi bigint")
    kept, ledger = correction.apply_correction(ev, ledger_of(spark, "/s/a", "/s/b"), wanted)
    assert sorted(r.timepoint for r in kept.collect()) == [1, 2, 5]
    assert [r.file for r in ledger.collect()] == ["/s/a"]


@pytest.mark.parametrize(
    "files, names",
    [([("/s/b", 3, 5)], "range_match"), ([("/s/z", 3, 4)], "all_in_ledger"), ([("/s/b", 3, 3)], "range")],
)
def test_unconfirmed_corrections_are_refused(spark, files, names):
    rows = [("/s/a", 1), ("/s/b", 3), ("/s/b", 3), ("/s/b", 4), ("/s/b", 4)]
    ev = spark.createDataFrame(rows, "file string, timepoint bigint")
    wanted = spark.createDataFrame(files, "file string, lo bigint, hi bigint")
    with pytest.raises(ValueError, match=names):
        correction.apply_correction(ev, ledger_of(spark, "/s/a", "/s/b"), wanted)


def test_ledger_with_null_hides_nothing(spark):
    files = ledger_of(spark, "/x/charges/a.json.gz", "/x/charges/b.json.gz", "/x/charges/c.json.gz")
    ledger = ledger_of(spark, None, "/x/charges/b.json.gz", "/x/filings/z.csv")
    assert [r.file[-9] for r in landing.unloaded_files(files, ledger).collect()] == ["a", "c"]
    assert landing.unloaded_files(files, ledger, limit=1).count() == 1
    assert landing.loaded_files(ledger, "charges").count() == 1
    only = ledger_of(spark, "/x/charges/b.json.gz")
    assert [r.file[-9] for r in landing.late_unloaded_files(files, only).collect()] == ["a"]


def test_file_age_from_uuid(spark):
    files = ledger_of(spark, "/s/0190163d-8694-739b-aea5-966c26f8ad91.json.gz", "/s/other.json.gz")
    rows = {r.file: r for r in checks.check_file_age(files, "2024-06-15T10:14:09").collect()}
    first = rows["/s/0190163d-8694-739b-aea5-966c26f8ad91.json.gz"]
    assert first.written_at == "2024-06-14 10:14:09.300"
    assert (first.age_s, first.too_old) == (86399, False)
    assert rows["/s/other.json.gz"].written_at is None
    later = checks.check_file_age(files, "2024-06-15T10:14:11").where("too_old").count()
    assert later == 1


def test_files_of_one_request():
    root = "s3://sink"
    assert common_stream(["s3://sink/charges/a.json.gz", "s3://sink/charges/b.json.gz"], root) == "charges"
    for bad in (
        [], ["s3://sink/charges/a.csv"], ["s3://other/charges/a.json.gz"],
        ["s3://sink/charges/a.json.gz", "s3://sink/filings/a.json.gz"],
    ):
        with pytest.raises(ValueError):
            common_stream(bad, root)
    assert schema_name("persons-with-significant-control") == "persons_with_significant_control"


def test_early_faults_of_a_stream_are_not_checked(make_log):
    log = make_log([(1, "/a", "changed"), (3205879, "/a", "changed"), (3205880, "/b", "changed")])
    ok = {r.check: r.ok for r in checks.verify_stream(log, "insolvency-cases", "2024-01-02T00:00:00").collect()}
    assert ok["contiguity"]
    ok = {r.check: r.ok for r in checks.verify_stream(log, "charges", "2024-01-02T00:00:00").collect()}
    assert not ok["contiguity"]


def test_verify_snapshot(make_log):
    log = make_log([(1, "/a", "changed"), (2, "/a", "changed")])
    ok = {r.check: r.ok for r in checks.verify_snapshot(log, "2024-01-02T00:00:00").collect()}
    assert ok == {"freshness": True, "unique_resources": False}


def test_verification_raises_on_failure(make_log):
    log = make_log([(1, "/a", "changed"), (3, "/a", "changed")])
    report = checks.verify_events(log, "2024-01-01T12:00:00")
    with pytest.raises(ValueError, match="contiguity"):
        checks.require(report)
    good = make_log([(1, "/a", "changed"), (2, "/a", "deleted")])
    checks.require(checks.verify_events(good, "2024-01-01T12:00:00"))
    stale = {r.check: r.ok for r in checks.verify_events(good, "2024-02-01T12:00:00").collect()}
    assert stale == {"contiguity": True, "freshness": False, "null_data": True}
