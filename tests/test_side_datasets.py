"""Accounts, register, archives and exports."""

import datetime as dt
import random

import pytest
from conftest import SF01
from pyspark.sql import functions as F

from tidemark.operators import accounts as acc
from tidemark.operators import export, publish
from tidemark.operators import register as reg
from tidemark.plans import views
from tidemark.schemas import REGISTER_TABLES
from tidemark.session import pin
from tidemark.sources import accounts as acc_src
from tidemark.sources import register as reg_src
from tidemark.streaming import load

ACCOUNTS = "id int, zip_start date, zip_end date, zip_url string"


def direct_form(rows):
    longer = [r for r in rows if r[3] is not None and "Accounts_Bulk_Data-" not in r[3]]
    kept = set()
    for r in rows:
        covered = r[1] is not None and any(
            m[1] is not None and m[2] is not None and m[1] <= r[1] <= m[2] for m in longer
        )
        if r in longer or not covered:
            kept.add(r[0])
    return kept


@pytest.mark.parametrize("seed", range(4))
def test_dedup_equals_direct_form(spark, seed):
    r = random.Random(seed)
    first = dt.date(2020, 1, 1)
    rows = []
    for i in range(300):
        start = first + dt.timedelta(days=r.randrange(400))
        if r.random() < 0.05:
            rows.append((i, start, start + dt.timedelta(days=r.randrange(-2, 40)), "Accounts_Monthly_Data-1.zip"))
        else:
            # A third of the daily rows are of one day.
            day = dt.date(2020, 5, 5) if r.random() < 0.33 else start
            rows.append((i, day, day, "x/Accounts_Bulk_Data-1.zip"))
    rows += [(900, None, None, "Accounts_Bulk_Data-1.zip"), (901, first, first, None),
             (902, None, first, "Accounts_Monthly_Data-2.zip")]
    df = spark.createDataFrame(rows, ACCOUNTS)
    assert {x.id for x in acc.accounts_dedup(df).collect()} == direct_form(rows)


def test_dedup_known_answer(spark):
    kept = acc.accounts_dedup(views.accounts(spark, SF01))
    assert tuple(kept.agg(F.count("*"), F.sum("company_id")).head()) == (12376, 92913441)


@pytest.mark.parametrize(
    "today,start,end",
    [("2024-05-17", "2022-05-01", "2024-04-30"), ("2024-01-01", "2022-01-01", "2023-12-31")],
)
def test_window(spark, today, start, end):
    days = [dt.date.fromisoformat(d) for d in (start, end)]
    one = dt.timedelta(days=1)
    rows = [(1, days[0], days[1]), (2, days[0] - one, days[1]), (3, days[0], days[1] + one)]
    df = spark.createDataFrame(
        [(*r, "c") for r in rows], "id int, zip_start date, zip_end date, csv_name string"
    )
    window = acc.accounts_window(df, today)
    assert window.columns == ["id"] and [r.id for r in window.collect()] == [1]
    assert sorted(r.id for r in acc.accounts_window(df, today, True).collect()) == [1, 2]


def csv_file(spark, path, rows):
    names = [f.name for f in acc_src.accounts_schema(in_file=True)]
    lines = [",".join(names)]
    lines += [",".join(str(r.get(n, "")) for n in names) for r in rows]
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def test_accounts_scan_and_load(spark, tmp_path):
    rows = [
        {"company_id": "01", "debtors": 5, "company_dormant": "true", "date": "2024-01-05"},
        {"company_id": "02", "error": "boom"},
    ]
    name = tmp_path / "landing" / "xbrl" / "2024-01-01--2024-01-31.csv"
    csv_file(spark, name, rows)
    scan = acc_src.scan_accounts(spark, str(name))
    assert len(scan.columns) == 42
    row = scan.head()
    assert (row.company_id, row.debtors, row.company_dormant) == ("01", 5, True)
    assert (row.zip_start, row.zip_end) == (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert row.csv_name.endswith(name.name) and scan.count() == 1
    args = [str(tmp_path / n) for n in ("landing", "table", "mark")]
    first = load.load_accounts(spark, *args).collect()
    assert [r.rows for r in first] == [1]
    assert load.load_accounts(spark, *args).count() == 0
    assert load.read_loaded(spark, args[1]).head().company_id == "01"


def test_accounts_with_another_header_fail(spark, tmp_path):
    bad = tmp_path / "2024-01-01--2024-01-31.csv"
    names = [f.name for f in acc_src.accounts_schema(in_file=True)]
    names[0], names[1] = names[1], names[0]
    bad.write_text(",".join(names) + "\n" + "," * (len(names) - 1) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        acc_src.scan_accounts(spark, str(bad)).collect()


def register_file(path, table, rows, order=None):
    """A tab-separated file of a table; columns not given are empty."""
    names = [f.name for f in reg_src.register_schema(table)]
    lines = ["\t".join(order or names)]
    lines += ["\t".join(row.get(n, "") for n in names) for row in rows]
    path.write_text("\n".join(lines) + "\n")


def test_register_types(spark, tmp_path):
    row = {
        "date_of_extract": "2024-01-31", "organisation_number": "12", "charity_name": "Name",
        "charity_company_registration_number": "0012", "latest_income": "12.50",
        "charity_insolvent": "True", "charity_activities": '"tab\there\nand line"',
        "date_of_removal": "31/01/2024", "registered_charity_number": "12A",
    }
    register_file(tmp_path / "charity.txt", "charity", [row])
    df = reg_src.scan_register(spark, "charity", str(tmp_path))
    row = df.head()
    assert df.count() == 1
    assert row.charity_activities == "tab\there\nand line"
    assert (row.organisation_number, row.charity_insolvent) == (12, True)
    assert (row.charity_company_registration_number, row.date_of_removal) == ("0012", None)
    assert str(row.latest_income) == "12.50"
    # What does not fit is kept as it was written.
    assert row._rejected == {"date_of_removal": "31/01/2024", "registered_charity_number": "12A"}
    with pytest.raises(ValueError):
        reg_src.scan_register(spark, "parties", str(tmp_path))


def test_register_files_with_another_header_are_refused(spark, tmp_path):
    names = [f.name for f in reg_src.register_schema("charity_policy")]
    register_file(tmp_path / "a.txt", "charity_policy", [{"organisation_number": "1"}])
    register_file(tmp_path / "b.txt", "charity_policy", [{"organisation_number": "2"}],
                  order=[names[0], names[4], names[2], names[3], names[1]])
    assert reg_src.scan_register(spark, "charity_policy", str(tmp_path / "a.txt")).count() == 1
    with pytest.raises(Exception, match="(?i)header"):
        reg_src.scan_register(spark, "charity_policy", str(tmp_path)).collect()


@pytest.mark.parametrize("table", REGISTER_TABLES)
def test_register_schemas(table):
    schema = reg_src.register_schema(table)
    assert schema[0].name == "date_of_extract" and len({f.name for f in schema}) == len(schema)
    kinds = {f.name: f.dataType.simpleString() for f in schema}
    assert kinds["registered_charity_number"] == "int"
    assert set(kinds.values()) <= {
        "date", "int", "string", "boolean", "bigint", "tinyint", "decimal(18,2)"
    }


def test_register_schema_sizes():
    sizes = {t: len(reg_src.register_schema(t)) for t in REGISTER_TABLES}
    assert len(sizes) == 13 and sum(sizes.values()) == 217
    assert sizes["charity"] == 34 and sizes["charity_policy"] == 5


def test_register_json_array(spark, tmp_path):
    (tmp_path / "x.json").write_text(
        '[{"organisation_number": 1, "policy_name": "a"},\n'
        ' {"policy_name": null, "organisation_number": 2, "linked_charity_number": "x"}]'
    )
    df = reg_src.scan_register(spark, "charity_policy", str(tmp_path), json_array=True)
    rows = sorted(df.collect(), key=lambda r: r.organisation_number)
    assert [(r.organisation_number, r.policy_name, r._rejected) for r in rows] == [
        (1, "a", None), (2, None, {"linked_charity_number": "x"}),
    ]
    rejects = reg_src.rejected_rows({"charity_policy": df}).collect()
    assert rejects == [("charity_policy", "linked_charity_number", 1)]


def test_register_links_and_sums(spark):
    main = spark.createDataFrame([(1, "a", 0), (2, "b", 1)], "organisation_number int, name string, linked_charity_number int")
    reports = spark.createDataFrame([(1, "r1"), (1, "r2")], "charity_id int, report_name string")
    linked = reg.register_link(main, reports, link_key="charity_id")
    assert sorted((r.organisation_number, r.report_name or "") for r in linked.collect()) == [
        (1, "r1"), (1, "r2"), (2, ""),
    ]
    assert [r.name for r in reg.register_main(main).collect()] == ["a"]
    history = spark.createDataFrame([(1, 2, "merged")], "organisation_number int, assoc_organisation_number int, event_type string")
    other = reg.register_link(main, history, link_key="assoc_organisation_number")
    assert sorted((r.organisation_number, r.linked_organisation_number) for r in other.collect() if r.event_type) == [(2, 1)]
    columns = (
        "assets_own_use", "assets_total_fixed", "assets_long_term_investment",
        "assets_total_liabilities", "creditors_one_year_total_current",
        "creditors_falling_due_after_one_year", "funds_total",
        "assets_total_assets_and_liabilities",
    )
    rows = [(7, 10, 3, 5, 2, 3, 1, 1), (8, 10, 3, 5, 2, None, 1, 2)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in columns))
    df = df.select(*(F.col(c).cast("decimal(18,2)") for c in columns))
    got = {r.check: r.violations for r in reg.register_consistency(df).collect()}
    assert got == {"assets_own_use": 1, "assets_total_liabilities": 0, "funds_total": 1}


def test_export_formats(spark, make_log, tmp_path):
    log = make_log([(tp, f'/r"{tp}', "changed") for tp in range(1, 101)])
    for fmt, compression in (("json", "none"), ("json", "gzip"), ("json", "zstd"),
                             ("csv", "zstd"), ("parquet", "snappy"), ("parquet", "zstd")):
        out = str(tmp_path / f"{fmt}-{compression}")
        entry = export.export_snapshot(
            log, out, fmt, compression, "X (zstd)", "single", daily=True
        ).head()
        assert (entry["count"], entry.file_count, entry.labels) == (100, 1, ["daily", "single"])
        assert entry.total_size_bytes > 0
        if fmt == "csv":
            back = spark.read.schema(log.schema).option("header", True).option("escape", '"').csv(out)
        else:
            back = spark.read.schema(log.schema).format(fmt).load(out)
        assert back.exceptAll(log).count() == 0 and back.count() == 100
        assert entry.extension.startswith("." + fmt)
        assert entry.compression in (compression, "gzip")
        assert entry.description == f"X ({entry.compression if compression == 'zstd' else 'zstd'})"


@pytest.mark.parametrize("rows", [100, 5000])
def test_layout_is_the_callers_choice(spark, make_log, tmp_path, rows):
    """The same at any number of rows."""
    log = make_log([(tp, "/r", "changed") for tp in range(1, rows + 1)]).repartition(3)
    for layout, files in (("parts", 3), ("single", 1)):
        out = str(tmp_path / layout)
        entry = export.export_snapshot(log, out, "json", "none", layout=layout).head()
        assert (entry["count"], entry.file_count) == (rows, files)
        listed = export.export_manifest(spark, out, "json").collect()
        assert len(listed) == files and sum(r.rows for r in listed) == rows
    with pytest.raises(ValueError):
        export.export_snapshot(log, str(tmp_path / "x"), layout="both")


def test_export_split(spark, make_log, tmp_path):
    log = pin(make_log([(tp, f"/r{tp}", "changed") for tp in range(1, 2001)]).coalesce(1), "log")
    entry = export.export_split(log, str(tmp_path / "o"), file_bytes=4000).head()
    assert entry.file_count > 3 and entry["count"] == 2000 and entry.labels == ["split"]
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2000


def test_sample_is_stable_and_whole(make_log):
    log = make_log([(tp, f"/r{tp}", "changed") for tp in range(1, 301)])
    a = {r.timepoint for r in export.sample_rows(log, n=50).collect()}
    b = {r.timepoint for r in export.sample_rows(log.repartition(7), n=50).collect()}
    c = {r.timepoint for r in export.sample_rows(log, n=50, seed="other").collect()}
    assert a == b and len(a) == 50 and a != c
    assert export.sample_rows(log, n=1000).count() == 300


def test_publish_with_split(spark, make_log, tmp_path):
    log = make_log([(tp, f"/r{tp}", "changed") for tp in range(1, 31)])
    out = str(tmp_path / "pub")
    row = publish.publish_snapshot(log, "filings", out, "2024-01-31T00:00:00", split=True).head()
    assert (row.record_count, len(row.downloads)) == (30, 7)
    labels = sorted(tuple(d.labels) for d in row.downloads)
    assert labels.count(("split",)) == 4 and labels.count(("sample", "single")) == 2
    files = spark.read.parquet(f"{out}/filings-files").collect()
    assert {f.path for f in files} == {d.path for d in row.downloads}
    assert len(files) == sum(d.file_count for d in row.downloads)


@pytest.mark.parametrize("seed", range(4))
def test_covered_starts_are_looked_up(spark, seed):
    rnd = random.Random(seed)

    def day(n):
        return (dt.date(1000, 1, 1) + dt.timedelta(days=n)) if n is not None else None

    rows = []
    for i in range(150):
        lo = rnd.choice([None, *[rnd.randrange(300_000)] * 9])
        width = rnd.choice([-5, 0, 30, 40_000, 90_000]) if i % 10 == 0 else 0
        url = rnd.choice(["Accounts_Monthly_Data-x", None]) if i % 10 == 0 else "Accounts_Bulk_Data-x"
        hi = None if lo is None or rnd.random() < 0.02 else lo + width
        rows.append((i, url, day(lo), day(hi)))
    # Starts on the ends of a range, and one behind it.
    rows += [(900, "Accounts_Monthly_Data-x", day(310_000), day(310_030))]
    rows += [(901 + k, "Accounts_Bulk_Data-x", day(n), day(n)) for k, n in enumerate((309_999, 310_000, 310_030, 310_031))]
    df = spark.createDataFrame(rows, "id int, zip_url string, zip_start date, zip_end date")
    got = sorted(map(tuple, acc.accounts_dedup_asof(df, span_days=rnd.choice([7, 4096, 10**6])).collect()))
    assert got == sorted(map(tuple, acc.accounts_dedup(df).collect()))
    assert {r[0] for r in got} & {901, 902, 903, 904} == {901, 904}
