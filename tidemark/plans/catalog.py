"""Every registered query: an operator applied to views of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import (
    accounts as acc,
    checks,
    correction,
    digests,
    export,
    files as fil,
    lines as lin,
    overlap,
    ranges as rng,
    register as reg,
    publish,
    repair,
    requests,
    snapshot as snp,
    tables,
)
from tidemark.functions.names import stream_of
from tidemark.functions.order import with_position
from tidemark.operators.events import flatten, nest
from tidemark.plans import views as v
from tidemark.session import pin, prepare, scratch
from tidemark.sources import accounts as acc_src
from tidemark.sources import landing
from tidemark.sources import register as reg_src
from tidemark.streaming import index as idx
from tidemark.streaming import buckets, live, load, presence, samples, snapshot as stream

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    _QUERIES[fn.__name__] = run
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


_ROW = ("timepoint", "type", "published_at", "resource_uri", "data")


# --- Snapshots ---


@_query
def latest_snapshot(spark, sf):
    return snp.latest_snapshot(v.events(spark, sf)).select(*_ROW)


@_query
def live_snapshot(spark, sf):
    return snp.live_snapshot(v.events(spark, sf), "companies").select(*_ROW)


# How the fields of the log's data are called in the other streams.
_FIELD_NAMES = {
    "officers": ("date_of_cessation", "resigned_on"),
    "persons-with-significant-control": ("date_of_cessation", "ceased_on"),
    "charges": ("company_status", "status"),
    "persons-with-significant-control-statements": ("date_of_cessation", "ceased_on"),
    "filings": ("company_status", "category"),
}


@_query
def live_snapshot_streams(spark, sf):
    parts = []
    for stream_name, (old, new) in _FIELD_NAMES.items():
        data = F.replace("data", F.lit(old), F.lit(new))
        data = F.replace(data, F.lit('"status":"dissolved"'), F.lit('"status":"fully-satisfied"'))
        live = snp.live_snapshot(v.events(spark, sf).withColumn("data", data), stream_name)
        parts.append(live.select(F.lit(stream_name).alias("stream"), *_ROW))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _from_zero(spark, sf):
    return v.events(spark, sf).withColumn("timepoint", F.col("timepoint") - 1)


@_query
def latest_by_join(spark, sf):
    return snp.latest_by_join(v.events(spark, sf), watermark=500).select(*_ROW)


@_query
def latest_by_join_first(spark, sf):
    """The first batch, from an empty state, of a log that begins with timepoint 0."""
    ev = _from_zero(spark, sf)
    known = snp.watermark(ev.where("false"))
    return snp.latest_by_join(ev, watermark=known, limit=700).select(*_ROW)


def _late_first(spark, sf):
    """Four batches of the whole log, newest part first."""
    ev = v.events(spark, sf)
    turn = 3 - F.col("timepoint") % 4
    return [ev.where(turn == i) for i in range(4)]


@_query
def incremental_snapshot(spark, sf):
    state, *rest = _late_first(spark, sf)
    state = snp.newest_rows(state)
    for batch in rest:
        state = snp.incremental_snapshot(state, batch)
    return snp.live_view(state).select(*_ROW)


@_query
def upsert_snapshot(spark, sf):
    ev = v.log(spark, sf)
    old, batch = ev.where("file_no % 2 = 0"), ev.where("file_no % 2 = 1")
    return snp.upsert_snapshot(snp.newest_rows(old), batch).select(*_ROW)


@_query
def stream_snapshot(spark, sf):
    """Streaming upkeep of the state over the stored log, a few files a batch."""
    table, state, mark = (scratch(spark, n) for n in ("table", "state", "checkpoint"))
    nest(v.events(spark, sf)).repartition(6, "resource_uri").write.parquet(table)
    stream.maintain_snapshot(spark, table, state, mark, max_files=2)
    return stream.current_snapshot(spark, state).select(*_ROW)


def _bucketed(spark, sf):
    """The state in 16 buckets after four batches, newest part of the log first."""
    state = scratch(spark, "buckets")
    for n, batch in enumerate(_late_first(spark, sf)):
        buckets.apply_batch(spark, state, batch, n, buckets=16)
    return state


@_query
def bucketed_snapshot(spark, sf):
    return buckets.bucketed_snapshot(spark, _bucketed(spark, sf)).select(*_ROW)


@_query
def bucket_lookup(spark, sf):
    """Some keys of the state, a deleted and an unknown one among them maybe."""
    keys = [f"/resource/{n}" for n in (1, 7, 42, 99, 123_456_789)]
    return buckets.lookup(spark, _bucketed(spark, sf), keys).select(*_ROW)


@_query
def snapshot_counts(spark, sf):
    return snp.snapshot_counts(snp.latest_snapshot(v.events(spark, sf)))


@_query
def check_unique_resources(spark, sf):
    return snp.check_unique_resources(v.events(spark, sf))


@_query
def snapshot_manifest(spark, sf):
    return snp.snapshot_manifest(snp.latest_snapshot(v.events(spark, sf)), v.STREAM, v.NOW)


@_query
def compare_snapshots(spark, sf):
    ev = v.log(spark, sf)
    return snp.compare_snapshots(
        snp.latest_snapshot(ev),
        # The other product was made two days earlier.
        snp.latest_snapshot(ev.where("published_at < '2024-01-29'")),
        "resource_uri",
        ["timepoint", "published_at", "data"],
    )


@_query
def compare_by_digest(spark, sf):
    """The same by digests of hash ranges, joining only those that differ."""
    ev = v.log(spark, sf)
    a, b = (
        pin(df, name)
        for df, name in (
            (snp.latest_snapshot(ev), "snapshot"),
            (snp.latest_snapshot(ev.where("published_at < '2024-01-29'")), "older"),
        )
    )
    fields = ["timepoint", "published_at", "data"]
    return digests.compare_by_digest(a, b, "resource_uri", fields, join_rows=100)


@_query
def repeated_keys(spark, sf):
    return digests.repeated_keys(v.log(spark, sf), "resource_uri")


# --- Table checks ---


@_query
def check_contiguity(spark, sf):
    return checks.check_contiguity(v.damaged(spark, sf))


@_query
def check_freshness(spark, sf):
    return checks.check_freshness(v.events(spark, sf), v.NOW)


@_query
def check_null_data(spark, sf):
    return checks.check_null_data(v.events(spark, sf))


@_query
def verify_events(spark, sf):
    return checks.verify_events(v.damaged(spark, sf), v.NOW)


@_query
def verify_snapshot(spark, sf):
    return checks.verify_snapshot(snp.latest_snapshot(v.events(spark, sf)), v.NOW)


# --- Landing checks ---


@_query
def file_stats(spark, sf):
    return checks.file_stats(v.damaged(spark, sf))


@_query
def problem_files(spark, sf):
    return checks.problem_files(checks.file_stats(v.damaged(spark, sf)))


@_query
def file_range_total(spark, sf):
    return checks.file_range_total(checks.file_stats(v.damaged(spark, sf)))


@_query
def newest_files(spark, sf):
    return checks.newest_files(v.files(spark, sf))


@_query
def newest_file_stats(spark, sf):
    return checks.newest_file_stats(v.events(spark, sf), v.files(spark, sf))


@_query
def check_file_age(spark, sf):
    return checks.check_file_age(v.named_files(spark, sf), v.NOW)


@_query
def verify_landing(spark, sf):
    return checks.verify_landing(v.named_log(spark, sf), v.named_files(spark, sf), v.NOW)


@_query
def landing_extra_checks(spark, sf):
    return checks.landing_extra_checks(v.named_log(spark, sf), "company", max_drift_s=130000)


# --- Ranges ---


@_query
def missing_ranges(spark, sf):
    return rng.missing_ranges(v.damaged(spark, sf))


@_query
def duplicate_ranges(spark, sf):
    return rng.duplicate_ranges(v.damaged(spark, sf))


@_query
def timepoint_issues(spark, sf):
    return rng.timepoint_issues(v.damaged(spark, sf))


@_query
def duplicate_range(spark, sf):
    return rng.duplicate_range(v.damaged(spark, sf))


@_query
def order_breaks(spark, sf):
    lines = v.log(spark, sf).select(
        "file",
        F.col("timepoint").alias("line_no"),
        # Every hundredth pair of events arrived swapped.
        F.expr(
            "case when timepoint % 100 = 50 then timepoint + 1"
            " when timepoint % 100 = 51 then timepoint - 1 else timepoint end"
        ).alias("timepoint"),
    )
    return rng.order_breaks(lines, start=1)


@_query
def watch_order(spark, sf):
    """Breaks in the order of three streams, found as they land; the stream starts anew for each wave."""
    path, out, mark = (scratch(spark, n) for n in ("waves", "watched", "mark"))
    starts = {"companies": 1, "officers": 0}
    for _ in v.land_waves(spark, sf, path):
        query = live.watch_order(spark, path, out, mark, starts, pattern="*.gz", name=v.placed_name)
        query.awaitTermination()
    found = live.read_watch(spark, out)
    number = F.regexp_extract("file", r"(\d+)\.json\.gz$", 1).cast("bigint")
    return found.select("kind", "stream", number.alias("file_no"), "line_no", "prev_tp", "tp")


# --- File index, replay, overlaps ---


def _index(spark, sf):
    sink = v.sink(spark, sf)
    empty = spark.createDataFrame([], "filename string, min bigint, max bigint, stream string")
    return fil.update_file_index(empty, sink)


@_query
def update_file_index(spark, sf):
    """Files of two streams are new to the index; the listing tells which."""
    known = _index(spark, sf).where(F.col("stream") == "officers")
    sink = v.sink(spark, sf)
    return fil.update_file_index(known, sink, files=sink.select("file").distinct())


@_query
def index_file_count(spark, sf):
    return fil.index_file_count(_index(spark, sf))


@_query
def stream_range(spark, sf):
    return fil.stream_range(_index(spark, sf))


@_query
def replay_files(spark, sf):
    return fil.replay_files(_index(spark, sf), "officers", 500)


@_query
def replay_events(spark, sf):
    ev = v.sink(spark, sf)
    return fil.replay_events(ev, _index(spark, sf), "officers", 503).select("file", *_ROW)


@_query
def replay_events_raw(spark, sf):
    """Overlapping files played one after another, with the place of each event."""
    ev = v.overlapping_sink(spark, sf)
    empty = spark.createDataFrame([], "filename string, min bigint, max bigint, stream string")
    index = pin(fil.update_file_index(empty, ev), "index")
    played = fil.replay_events(ev, index, "officers", 503, raw=True)
    # The place in the output: rows of a partition follow those of the ones before.
    placed = pin(
        played.select(
            "file", *_ROW, F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("at"),
        ),
        "played",
    )
    return with_position(placed, F.col("part"), ["at"], "place").drop("part", "at")


@_query
def replay_smoke(spark, sf):
    ev = v.sink(spark, sf)
    return fil.replay_smoke(ev, _index(spark, sf), "officers")


@_query
def file_ranges(spark, sf):
    return fil.file_ranges(v.damaged(spark, sf))


def _sink_ranges(spark, sf):
    """Ranges of the files of three streams."""
    return fil.file_ranges(v.overlapping_sink(spark, sf))


@_query
def file_ranges_streams(spark, sf):
    return _sink_ranges(spark, sf)


@_query
def file_neighbours_streams(spark, sf):
    return fil.file_neighbours(_sink_ranges(spark, sf))


@_query
def overlap_pairs_streams(spark, sf):
    return fil.overlap_pairs(_sink_ranges(spark, sf))


@_query
def file_neighbours(spark, sf):
    return fil.file_neighbours(v.ranges(spark, sf))


@_query
def file_contiguity(spark, sf):
    return fil.file_contiguity(v.ranges(spark, sf))


@_query
def file_overlap_flags(spark, sf):
    dup = rng.duplicate_range(v.double_loaded(spark, sf))
    return fil.file_overlap_flags(v.ranges(spark, sf), dup)


@_query
def overlap_pairs(spark, sf):
    return fil.overlap_pairs(v.ranges(spark, sf))


@_query
def overlap_pairs_at(spark, sf):
    return fil.overlap_pairs(v.ranges(spark, sf), timepoint=2010)


@_query
def overlap_depth(spark, sf):
    return overlap.overlap_depth(v.ranges(spark, sf))


@_query
def overlap_depth_streams(spark, sf):
    """Where two files or more of a stream overlap."""
    rows = _sink_ranges(spark, sf).withColumn("stream", stream_of(F.col("file")))
    return overlap.overlap_depth(rows, ["stream"], least=2)


@_query
def files_at_timepoints(spark, sf):
    """The files that hold each tenth timepoint, from an index of blocks."""
    index = pin(overlap.stab_index(v.ranges(spark, sf)), "stab-index")
    wanted = v.log(spark, sf).select("timepoint").where("timepoint % 10 = 0")
    return overlap.files_at(index, wanted)


@_query
def overlap_recommendation(spark, sf):
    dup = rng.duplicate_range(v.double_loaded(spark, sf))
    return fil.overlap_recommendation(v.ranges(spark, sf), dup)


# --- Correction of a double load ---


@_query
def ledger_missing(spark, sf):
    return correction.ledger_missing(v.files(spark, sf), v.ledger(spark, sf))


def _doubled_ranges(spark, sf):
    ev = v.log(spark, sf).where("file_no between 1 and 2")
    return ev.groupBy("file").agg(F.min("timepoint").alias("lo"), F.max("timepoint").alias("hi"))


@_query
def confirm_double_load(spark, sf):
    """The two files, one too many, one of them with another one, and unloaded ones."""
    ev, ranges, ledger = (
        pin(f(spark, sf), n)
        for f, n in ((v.double_loaded, "doubled"), (v.ranges, "ranges"), (v.ledger, "ledger"))
    )
    twice = pin(rng.duplicate_timepoints(ev), "twice")
    cases = {"both": (1, 2), "one more": (1, 2, 3), "gap": (1, 4), "not loaded": (1, 5)}
    parts = [
        correction.confirm_double_load(ev, ranges.where(F.col("idx").isin(*files)), ledger, twice).select(
            F.lit(case).alias("case"), "*"
        )
        for case, files in cases.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@_query
def correction_plan(spark, sf):
    ev = v.double_loaded(spark, sf)
    return correction.correction_plan(ev, rng.duplicate_range(ev))


@_query
def apply_correction(spark, sf):
    ev = v.double_loaded(spark, sf)
    kept, ledger = correction.apply_correction(
        ev, v.ledger(spark, sf), pin(_doubled_ranges(spark, sf), "ranges")
    )
    return (
        kept.select(F.lit("event").alias("part"), "file", "timepoint")
        .unionByName(ledger.select(F.lit("ledger").alias("part"), "file", F.lit(None).cast("bigint").alias("timepoint")))
    )


@_query
def rewrite_without_range(spark, sf):
    """The same as a stored table: written as its next version and read back."""
    ev = v.double_loaded(spark, sf).drop("file_no")
    out = scratch(spark, "corrected")
    ranges = pin(_doubled_ranges(spark, sf), "ranges")
    correction.rewrite_without_range(nest(ev), ranges, out, v.ledger(spark, sf))
    return flatten(spark.read.parquet(f"{out}/rows")).select("file", *_ROW)


# --- Ledger and landing files ---


@_query
def loaded_files(spark, sf):
    return landing.loaded_files(v.ledger(spark, sf), v.STREAM)


@_query
def unloaded_files(spark, sf):
    return landing.unloaded_files(v.files(spark, sf), v.ledger(spark, sf))


@_query
def late_unloaded_files(spark, sf):
    return landing.late_unloaded_files(v.files(spark, sf), v.ledger(spark, sf))


def _numbered(df: DataFrame, file: Column | None = None) -> DataFrame:
    """Replace the run-dependent name of a derived file by its number."""
    name = F.col("file") if file is None else file
    return df.withColumn("file_no", v.number_of(name)).drop("file")


@_query
def scan_events(spark, sf):
    path = v.land_events(spark, sf)
    return _numbered(flatten(landing.scan_events(spark, f"{path}/*")))


@_query
def scan_events_tolerant(spark, sf):
    path = v.land_lines(spark, sf)
    scan = landing.scan_events_tolerant(spark, f"{path}/*")
    return _numbered(
        scan.select(
            "file", F.col("event.timepoint").alias("timepoint"), "resource_uri",
            F.col("_corrupt_record").alias("corrupt"),
        )
    )


@_query
def list_sink_files(spark, sf):
    path = v.land_events(spark, sf)
    listed = landing.list_sink_files(spark, f"{path}/*")
    # Bytes differ between hosts; rows read from the listed files do not.
    lines = spark.read.text([r.file for r in listed.select("file").collect()])
    counted = lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("lines"), F.max("_metadata.file_size").alias("size")
    )
    joined = listed.join(counted, "file", "full_outer")
    return _numbered(joined).select(
        "file_no", "lines", (F.col("length") == F.col("size")).alias("same_length"),
        (F.col("modified") > F.lit("2020-01-01").cast("timestamp")).alias("dated"),
    )


@_query
def load_events(spark, sf):
    """Load the landing files, load again (adds nothing), read the table back."""
    path, mark = v.land_events(spark, sf), scratch(spark, "mark")
    table = load.table_path(scratch(spark, "events"), v.STREAM)
    load.load_events(spark, path, table, mark)
    load.load_events(spark, path, table, mark)
    return _numbered(flatten(load.read_loaded(spark, table)).select("file", *_ROW))


@_query
def load_accounts(spark, sf):
    path, table, mark = v.land_accounts(spark, sf), scratch(spark, "acc"), scratch(spark, "mark")
    load.load_accounts(spark, path, table, mark)
    load.load_accounts(spark, path, table, mark)
    return load.read_loaded(spark, table).select(*_ACCOUNT)


@_query
def sort_events(spark, sf):
    """Sorted table, written and read back by the range of each file."""
    out = scratch(spark, "sorted")
    tables.sort_events(v.damaged(spark, sf), 8).write.parquet(out)
    path = F.col("_metadata.file_path")
    return rng_of_files(spark.read.parquet(out), path)


def rng_of_files(df: DataFrame, path: Column) -> DataFrame:
    """How many rows, and how many files begin before an earlier one has ended."""
    per_file = df.groupBy(path.alias("file")).agg(
        F.min("timepoint").alias("lo"), F.max("timepoint").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    placed = fil.number_files(per_file)
    overlaps = fil.overlap_pairs(placed.select("file", "idx", "lo", "hi"))
    # Rows of one timepoint may lie on both sides of a cut.
    return per_file.agg(F.sum("n").alias("row_count")).withColumn(
        "overlaps", overlaps.agg(F.count_if(F.col("width") > 1)).scalar()
    )


@_query
def compact_events(spark, sf):
    many, few = scratch(spark, "many"), scratch(spark, "few")
    nest(v.events(spark, sf)).repartition(40).write.parquet(many)
    done = tables.compact_events(spark, many, few, target_rows=1_000_000)
    return done.agg(
        F.sum("rows").alias("row_count"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )


@_query
def maintain_index(spark, sf):
    """Index of the landing files, read in batches as they are found."""
    path, index, mark = v.land_events(spark, sf), scratch(spark, "index"), scratch(spark, "mark")
    idx.maintain_index(spark, path, index, mark, max_files=100)
    return _numbered(idx.read_index(spark, index), F.col("filename")).select("file_no", "min", "max")


@_query
def correct_loaded(spark, sf):
    """Files loaded twice by mistake: taken out of the table again, and loaded once."""
    path, table, mark = v.land_events(spark, sf), scratch(spark, "events"), scratch(spark, "mark")
    load.load_events(spark, path, table, mark, max_files=60)
    twice = load.read_ledger(spark, table).where(v.number_of(F.col("file")).between(1, 2))
    names = [r.file for r in twice.collect()]
    # A load that read the two files again.
    load.store_load(spark, table, -1, names, load.scan_for_load, "event.timepoint")
    # These files each lie in a folder of their own, so that is what they have in common.
    load.correct_loaded(spark, table, twice, root=names[0].rsplit("/", 3)[0])
    load.load_pending(spark, f"{path}/*", table)
    return _numbered(flatten(load.read_loaded(spark, table)).select("file", *_ROW))


@_query
def compact_loaded(spark, sf):
    """Loaded, compacted, and read back as the next version of the table."""
    path = v.land_events(spark, sf)
    table, out, mark = (scratch(spark, n) for n in ("events", "compacted", "mark"))
    load.load_events(spark, path, table, mark, max_files=100)
    load.compact_loaded(spark, table, out)
    return _numbered(flatten(load.read_loaded(spark, out)).select("file", *_ROW))


def _loaded_table(spark, sf, ev):
    """Landing files of a log, and a table that has loaded them in several loads."""
    path = v.land_events(spark, sf, ev)
    table, mark = scratch(spark, "events"), scratch(spark, "mark")
    load.load_events(spark, path, table, mark, max_files=60)
    return path, table


def _load_twice(spark, table):
    """Load two files again by mistake; their ledger entries."""
    twice = load.read_ledger(spark, table).where(v.number_of(F.col("file")).between(1, 2))
    names = [r.file for r in twice.collect()]
    load.store_load(spark, table, -1, names, load.scan_for_load, "event.timepoint")
    return pin(twice, "twice"), names[0].rsplit("/", 3)[0]


@_query
def verify_loaded(spark, sf):
    """The table checks from presence kept per load: as a table is loaded, doubled, corrected, compacted."""
    path, table = _loaded_table(spark, sf, v.jumping(spark, sf))
    done = []

    def check(case, table):
        report = presence.verify_loaded(spark, table, v.NOW)
        done.append(pin(report.select(F.lit(case).alias("case"), "*"), "report"))

    check("loaded", table)
    twice, root = _load_twice(spark, table)
    check("doubled", table)
    load.correct_loaded(spark, table, twice, root=root)
    check("corrected", table)
    load.load_pending(spark, f"{path}/*", table)
    check("loaded again", table)
    out = scratch(spark, "compacted")
    load.compact_loaded(spark, table, out)
    presence.carry_presence(spark, table, out)
    check("compacted", out)
    return reduce(DataFrame.unionByName, done)


@_query
def loaded_issues(spark, sf):
    """Missing and duplicate ranges of a loaded table, from presence kept per load."""
    _, table = _loaded_table(spark, sf, v.gapped(spark, sf))
    presence.refresh_presence(spark, table)
    _load_twice(spark, table)
    return presence.loaded_issues(spark, table)


@_query
def sample_loaded(spark, sf):
    """A sample of a loaded table and one of its second half, from sketches kept per load."""
    _, table = _loaded_table(spark, sf, v.log(spark, sf))
    samples.refresh_samples(spark, table, n=300)
    _load_twice(spark, table)
    whole = samples.sample_loaded(spark, table, n=300).select(F.lit("all").alias("days"), *_ROW)
    late = samples.sample_loaded(spark, table, n=300, first_day="2024-01-15")
    return whole.unionByName(late.select(F.lit("late").alias("days"), *_ROW))


# --- Lines and repair ---


def _lines(spark, sf):
    return landing.read_lines(spark, f"{v.land_lines(spark, sf)}/*")


@_query
def number_lines(spark, sf):
    return _numbered(lin.number_lines(pin(_lines(spark, sf), "lines")))


@_query
def captures(spark, sf):
    path = v.land_captures(spark, sf)
    files = landing.list_sink_files(spark, f"{path}/*")
    lines = pin(landing.read_lines(spark, f"{path}/*"), "lines")
    return _numbered(requests.captures(files, lines))


@_query
def stream_names(spark, sf):
    return requests.stream_names(v.requested_files(spark, sf))


@_query
def check_requests(spark, sf):
    return requests.check_requests(v.requested_files(spark, sf), "/sink")


@_query
def clean_landing(spark, sf):
    return _numbered(lin.clean_landing(pin(_lines(spark, sf), "lines")))


@_query
def classify_files(spark, sf):
    return _numbered(lin.classify_files(_lines(spark, sf)))


@_query
def find_broken_files(spark, sf):
    lines = _lines(spark, sf).withColumn("file", v._file(v.STREAM, v.number_of(F.col("file"))))
    pending = landing.unloaded_files(v.files(spark, sf), v.ledger(spark, sf))
    return lin.find_broken_files(lines, pending)


@_query
def file_first_last(spark, sf):
    return _numbered(lin.file_first_last(_lines(spark, sf)))


def _sink_lines(spark, sf):
    """Lines of three streams, whose files are numbered alike."""
    # Read where they were written: a rename for each file is the driver's work.
    lines = landing.read_lines(spark, v.stage_streams(spark, sf))
    return pin(lines.withColumn("file", v.placed_name(F.col("file"))), "lines")


def _short(df: DataFrame) -> DataFrame:
    """Names without the folder that the run chose."""
    return df.withColumn("file", F.regexp_extract("file", "[^/]+/[^/]+$", 0))


@_query
def resume_offset_streams(spark, sf):
    return lin.resume_offset(lin.file_first_last(_sink_lines(spark, sf)))


@_query
def boundary_check_streams(spark, sf):
    ends = lin.file_first_last(_sink_lines(spark, sf))
    return _short(lin.boundary_check(pin(ends, "ends")))


@_query
def repair_landing(spark, sf):
    """Three streams repaired in one run, in place, then loaded; what the table holds."""
    path, out = v.land_streams(spark, sf), scratch(spark, "repair")
    table, mark = scratch(spark, "events"), scratch(spark, "mark")
    pending = landing.list_sink_files(spark, f"{path}/*/*.json.gz")
    outcomes = repair.repair_landing(spark, f"{path}/*/*.json.gz", pending, out, swap=True)
    fixed = outcomes.groupBy(F.element_at(F.split("file", "/"), -2).alias("stream")).agg(
        F.count_if(F.col("status") == "fixed").alias("fixed"), F.count(F.lit(1)).alias("broken")
    )
    load.load_events(spark, path, table, mark)
    loaded = flatten(load.read_loaded(spark, table)).groupBy("stream").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("timepoint").alias("timepoints"),
        F.min("timepoint").alias("lo"), F.max("timepoint").alias("hi"),
    )
    return loaded.join(fixed, "stream")


def _padded(df: DataFrame) -> DataFrame:
    """Names of equal length, so that name order is file order."""
    return df.withColumn("file", v._file(v.STREAM, v.number_of(F.col("file"))))


@_query
def resume_offset(spark, sf):
    return lin.resume_offset(_padded(lin.file_first_last(_lines(spark, sf))))


@_query
def boundary_check(spark, sf):
    return lin.boundary_check(pin(_padded(lin.file_first_last(_lines(spark, sf))), "ends"))


@_query
def valid_prefix(spark, sf):
    return _numbered(lin.valid_prefix(pin(_lines(spark, sf), "lines")))


def _repair(spark, sf):
    lines = pin(_padded(_lines(spark, sf)), "lines")
    return lines, repair.repair_files(lines, scratch(spark, "repaired"))


@_query
def repair_files(spark, sf):
    return _repair(spark, sf)[1]


@_query
def repair_outcomes(spark, sf):
    lines, repaired = _repair(spark, sf)
    ends = pin(lin.file_first_last(lines), "ends")
    return repair.repair_outcomes(lin.classify_files(lines), lin.boundary_check(ends), repaired)


# --- Accounts ---

_ACCOUNT = (
    "company_id", "date", "entity_current_legal_name", "company_dormant", "debtors",
    "shareholder_funds", "zip_url", "zip_start", "zip_end",
)


@_query
def scan_accounts(spark, sf):
    path = v.land_accounts(spark, sf)
    return acc_src.scan_accounts(spark, f"{path}/*").select(*_ACCOUNT)


@_query
def accounts_dedup(spark, sf):
    return acc.accounts_dedup(v.accounts(spark, sf))


@_query
def accounts_dedup_asof(spark, sf):
    return acc.accounts_dedup_asof(v.accounts(spark, sf))


@_query
def accounts_zip_counts(spark, sf):
    return acc.accounts_zip_counts(v.accounts(spark, sf), "1995-01-01", "1997-12-31")


@_query
def export_accounts(spark, sf):
    """Published window of the accounts, as written to CSV and read back."""
    rows = acc.accounts_window(acc.accounts_dedup(v.accounts(spark, sf)), "1998-06-15")
    out = scratch(spark, "accounts-out")
    export.export_snapshot(rows, out, "csv", "gzip", last_two_years=True)
    return spark.read.schema(rows.schema).option("header", True).csv(out)


# --- Register ---


def _filled(df: DataFrame) -> DataFrame:
    """A scan without the columns that the derived files leave empty."""
    given = [c for c in v._REGISTER if set(v._REGISTER[c]) <= set(df.columns)][0]
    rejected = F.to_json("_rejected").alias("rejected")
    return df.select(*v._REGISTER[given], rejected)


@_query
def scan_register(spark, sf):
    path = v.land_register(spark, sf)
    return _filled(reg_src.scan_register(spark, "charity", path))


@_query
def scan_register_trustee(spark, sf):
    path = v.land_register(spark, sf, "charity_trustee")
    return _filled(reg_src.scan_register(spark, "charity_trustee", path))


@_query
def scan_register_json(spark, sf):
    path = v.land_register(spark, sf, "charity_policy", json_array=True)
    return _filled(reg_src.scan_register(spark, "charity_policy", path, json_array=True))


@_query
def scan_register_split(spark, sf):
    """The same files in splits of 16 KiB, cut anywhere."""
    path = v.land_register(spark, sf)
    return _filled(reg_src.scan_register_split(spark, "charity", path, split_bytes=1 << 14))


@_query
def scan_register_json_split(spark, sf):
    path = v.land_register(spark, sf, "charity_policy", json_array=True)
    scan = reg_src.scan_register_split(spark, "charity_policy", path, True, split_bytes=1 << 14)
    return _filled(scan)


@_query
def register_rejects(spark, sf):
    """How many values of each column did not fit, over the tables."""
    return reg_src.rejected_rows(
        {n: reg_src.scan_register(spark, n, v.land_register(spark, sf, n)) for n in v._REGISTER}
    )


@_query
def register_counts(spark, sf):
    names = ("customer", "supplier", "nation")
    return reg.register_counts({n: v.table(spark, sf, n) for n in names})


@_query
def register_link(spark, sf):
    return reg.register_link(
        v.table(spark, sf, "customer").withColumnRenamed("c_nationkey", "nationkey"),
        v.table(spark, sf, "nation"),
        key="nationkey",
        link_key="n_nationkey",
    )


@_query
def register_consistency(spark, sf):
    return reg.register_consistency(v.filings(spark, sf))


@_query
def register_latest_filing(spark, sf):
    return reg.register_latest_filing(v.filings(spark, sf)).select(
        "organisation_number", "ar_cycle_reference", "fin_period_end_date"
    )


@_query
def register_filing_order(spark, sf):
    # Planted: every third filing claims to be the latest of its organisation.
    numbered = v.filings(spark, sf).withColumn(
        "fin_period_order_number", F.expr("if(ar_cycle_reference % 3 = 0, 1, 2)")
    )
    return reg.register_filing_order(numbered)


# --- Exports ---


@_query
def export_snapshot(spark, sf):
    """The snapshot as published JSON, read back."""
    out = scratch(spark, "json")
    rows = snp.latest_snapshot(v.events(spark, sf)).select(*_ROW)
    export.export_snapshot(rows, out, "json", "zstd")
    return spark.read.schema(rows.schema).json(out)


@_query
def export_split(spark, sf):
    """The log in parts of 64 KiB of parquet, read back."""
    out = scratch(spark, "split")
    rows = pin(v.events(spark, sf).select(*_ROW), "log")
    export.export_split(rows, out, file_bytes=64 * 1024)
    return spark.read.parquet(out)


def _part_sizes(spark, path):
    """Rows and bytes before the codec of each part that was written."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.groupBy("part").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.octet_length("value") + 1).alias("bytes")
    )


@_query
def export_split_json(spark, sf):
    """The log as JSON in parts of 100,000 bytes; how large they are."""
    out = scratch(spark, "split")
    rows = v.events(spark, sf).select(*_ROW)
    export.export_split_text(rows, out, "json", file_bytes=100_000, order=["timepoint"])
    return _part_sizes(spark, out)


@_query
def export_split_csv(spark, sf):
    """The same as CSV, whose parts have a header each."""
    out = scratch(spark, "split")
    rows = v.events(spark, sf).select(*_ROW)
    export.export_split_text(rows, out, "csv", file_bytes=100_000, order=["timepoint"])
    return _part_sizes(spark, out)


@_query
def export_sample(spark, sf):
    """A sample of the log as published JSON, read back."""
    out = scratch(spark, "sample")
    rows = v.events(spark, sf).select(*_ROW)
    export.export_sample(rows, out, key="timepoint")
    return spark.read.schema(rows.schema).json(out)


@_query
def export_manifest(spark, sf):
    """Both layouts of one export; the entries, and what the list of their files adds up to."""
    log = pin(v.events(spark, sf).repartition(3), "log")
    done = []
    for layout in ("single", "parts"):
        out = scratch(spark, layout)
        entry = export.export_snapshot(log, out, "csv", "zstd", "the log", layout, daily=True)
        listed = export.export_manifest(spark, out, "csv").agg(
            F.count(F.lit(1)).alias("listed"), F.sum("rows").alias("listed_rows"),
            F.sum("bytes").alias("listed_bytes"),
        )
        done.append(entry.withColumns({c: listed.select(c).scalar() for c in listed.columns}))
    return reduce(DataFrame.unionByName, done).select(
        "file_count",
        "listed",
        "count",
        "listed_rows",
        (F.col("total_size_bytes") == F.col("listed_bytes")).alias("same_bytes"),
        "format",
        "extension",
        "compression",
        F.array_join("labels", ",").alias("labels"),
    )


@_query
def publish_snapshot(spark, sf):
    """All exports and the manifest of a stream; the manifest as it was written."""
    out = scratch(spark, "published")
    publish.publish_snapshot(v.events(spark, sf), "companies", out, v.NOW)
    manifest = spark.read.json(f"{out}/companies-manifest.json")
    return manifest.select(
        "record_count",
        "min_timepoint",
        "max_timepoint",
        "max_published_at",
        F.size("downloads").cast("bigint").alias("downloads"),
        F.expr("aggregate(downloads, 0L, (n, d) -> n + d.count)").alias("rows_listed"),
    )


@_query
def publish_accounts(spark, sf):
    out = scratch(spark, "published")
    publish.publish_accounts(v.accounts(spark, sf), out, "1998-06-15T00:00:00")
    manifest = spark.read.json(f"{out}/accounts-manifest.json")
    return manifest.select(F.explode("downloads").alias("d")).select(
        F.col("d.description").alias("description"), F.col("d.count").alias("count")
    )


@_query
def publish_register(spark, sf):
    out = scratch(spark, "published")
    names = ("customer", "supplier", "nation")
    publish.publish_register({n: v.table(spark, sf, n) for n in names}, out, v.NOW)
    manifest = spark.read.json(f"{out}/register-manifest.json")
    return manifest.select(
        "table", "record_count", F.size("downloads").cast("bigint").alias("downloads")
    )
