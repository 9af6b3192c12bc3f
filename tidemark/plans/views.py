"""The given tables seen as event log, files, accounts and register.

Each view reads its whole table.  Faults are planted by shifting or adding rows.
The SQL twins of these views are in ``oracles``.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.files import place_parts
from tidemark.session import scratch

EVENTS_PER_FILE = 500
NOW = "2024-01-31T00:00:00"
STREAM = "companies"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _file(stream: Column | str, number: Column) -> Column:
    stream = F.lit(stream) if isinstance(stream, str) else stream
    padded = F.lpad(number.cast("string"), 8, "0")
    return F.concat(F.lit("/sink/"), stream, F.lit("/"), padded, F.lit(".json.gz"))


_DATA = """
case when event_type = 'error' then null
     when event_id % 6 = 0 then '{"company_status":"active"}'
     when event_id % 6 = 1 then '{"company_status":"dissolved"}'
     when event_id % 6 = 2 then '{"company_status":null}'
     when event_id % 6 = 3 then '{}'
     when event_id % 6 = 4 then '{"company_status":"active","date_of_cessation":"2020-01-01"}'
     else '{"company_status":"active","date_of_cessation":null}' end
"""


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sound event log: dense timepoints from 1, errors as tombstones."""
    number = F.floor(F.col("event_id") / EVENTS_PER_FILE).cast("bigint")
    return table(spark, sf_dir, "events").select(
        (F.col("event_id") + 1).alias("timepoint"),
        F.expr("case when event_type = 'error' then 'deleted' else 'changed' end").alias("type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("published_at"),
        F.lit("company").alias("resource_kind"),
        F.col("user_id").cast("string").alias("resource_id"),
        F.concat(F.lit("/resource/"), F.col("user_id").cast("string")).alias("resource_uri"),
        F.expr(_DATA).alias("data"),
        _file(STREAM, number).alias("file"),
        number.alias("file_no"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log without the helper column."""
    return log(spark, sf_dir).drop("file_no")


def gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log with numbers left out."""
    skipped = F.expr("(timepoint - 1) div 96 + 221 * ((timepoint - 1) div 4000)")
    return log(spark, sf_dir).withColumn("timepoint", F.col("timepoint") + skipped)


def jumping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log with seven numbers left out after every third file."""
    return log(spark, sf_dir).withColumn(
        "timepoint", F.col("timepoint") + F.expr("7 * ((timepoint - 1) div 1500)")
    )


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log with numbers left out and every eighth file loaded twice."""
    ev = gapped(spark, sf_dir)
    return ev.unionByName(ev.where("file_no % 8 = 1"))


def double_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log with files 1 and 2 loaded twice."""
    ev = log(spark, sf_dir)
    return ev.unionByName(ev.where("file_no between 1 and 2"))


def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File ranges, some of which reach into others.

    Every seventh file reaches 40 timepoints into the next.  Of every sixty, one holds
    the next two whole, one holds the file before it as well, and one the file after.
    """
    return (
        log(spark, sf_dir)
        .groupBy("file", F.col("file_no").alias("idx"))
        .agg(F.min("timepoint").alias("lo"), F.max("timepoint").alias("hi"))
        .withColumns(
            {
                "lo": F.expr("lo - case when idx % 60 = 13 then 500 else 0 end"),
                "hi": F.expr(
                    "hi + case when idx % 60 = 6 then 1100 when idx % 60 = 15 then 500"
                    " when idx % 7 = 3 then 40 else 0 end"
                ),
            }
        )
    )


def sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log spread over three streams."""
    return log(spark, sf_dir).withColumn(
        "file",
        _file(
            F.expr("element_at(array('companies', 'officers', 'charges'), "
                   "cast(timepoint % 3 + 1 as int))"),
            F.col("file_no"),
        ),
    )


def overlapping_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sink, whose files begin with the last 30 events of the file before.

    ``position`` is the place of an event in its file.
    """
    ev = sink(spark, sf_dir)
    again = ev.where("timepoint % 500 > 470 or timepoint % 500 = 0").withColumn(
        "file_no", F.col("file_no") + 1
    )
    # Only into files that there are.
    last = ev.agg(F.max("file_no")).head()[0]
    again = again.where(F.col("file_no") <= last).withColumn(
        "file", _file(F.element_at(F.split("file", "/"), -2), F.col("file_no"))
    )
    return ev.unionByName(again).withColumn("position", F.col("timepoint") * 2)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log(spark, sf_dir).select("file", "file_no").distinct()


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first dozen files but number 5 are loaded."""
    return files(spark, sf_dir).where("file_no <= 11 and file_no <> 5").select("file")


def named_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per five hundred events, named by the UUIDv7 of its first event."""
    millis = F.unix_millis(F.min(F.col("ts").cast("timestamp")))
    number = F.floor(F.col("event_id") / EVENTS_PER_FILE).cast("bigint")
    stamped = (
        table(spark, sf_dir, "events")
        .groupBy(number.alias("file_no"))
        .agg(F.lower(F.lpad(F.hex(millis), 12, "0")).alias("stamp"))
    )
    return stamped.select(
        F.concat(
            F.lit("/sink/companies/"),
            F.substring("stamp", 1, 8),
            F.lit("-"),
            F.substring("stamp", 9, 4),
            F.lit("-7000-8000-"),
            F.lpad(F.col("file_no").cast("string"), 12, "0"),
            F.lit(".json.gz"),
        ).alias("file"),
        "file_no",
    )


def named_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with files named by UUIDv7."""
    return log(spark, sf_dir).drop("file").join(named_files(spark, sf_dir), "file_no")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as accounts: finished ones of a first quarter came in monthly archives."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("company_id"),
        F.col("o_totalprice").alias("shareholder_funds"),
        F.to_date("o_orderdate").alias("zip_start"),
        F.expr(
            "case when o_orderstatus = 'F' and month(o_orderdate) <= 3"
            " then last_day(o_orderdate) else to_date(o_orderdate) end"
        ).alias("zip_end"),
        F.expr(
            "case when o_orderstatus = 'F' and month(o_orderdate) <= 3"
            " then 'Accounts_Monthly_Data-x.zip' else 'Accounts_Bulk_Data-x.zip' end"
        ).alias("zip_url"),
        F.lit("x.csv").alias("csv_name"),
    )


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as part B filings of customers, some with sums that do not add up."""
    newest_first = Window.partitionBy("organisation_number").orderBy(
        F.col("fin_period_end_date").desc(), F.col("ar_cycle_reference").desc()
    )
    amount = "cast({} as decimal(18,2))".format
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.col("o_custkey").alias("organisation_number"),
            F.col("o_orderkey").alias("ar_cycle_reference"),
            F.to_date("o_orderdate").alias("fin_period_end_date"),
            F.expr(amount("o_totalprice")).alias("assets_total_fixed"),
            F.expr(amount("o_orderkey % 100")).alias("assets_long_term_investment"),
            F.expr(
                amount("o_totalprice")
                + " - "
                + amount("o_orderkey % 100")
                + " + case when o_orderpriority = '1-URGENT' then 1 else 0 end"
            ).alias("assets_own_use"),
            F.expr(amount("o_custkey")).alias("creditors_one_year_total_current"),
            F.expr(
                f"case when o_orderpriority = '5-LOW' then null else {amount('o_custkey % 7')} end"
            ).alias("creditors_falling_due_after_one_year"),
            F.expr(amount("o_custkey + o_custkey % 7 + case when o_orderstatus = 'P' then 2 else 0 end")).alias("assets_total_liabilities"),
            F.expr(amount("o_totalprice")).alias("funds_total"),
            F.expr(
                amount("o_totalprice") + " + case when o_orderstatus = 'O' then 0.5 else 0 end"
            ).alias("assets_total_assets_and_liabilities"),
        )
        .withColumn("fin_period_order_number", F.row_number().over(newest_first))
    )


# --- Files that Spark derives from the tables. ---


def number_of(file: Column) -> Column:
    """Number of a derived file, from its folder."""
    return F.regexp_extract(file, r"/file_no=(\d+)/", 1).cast("bigint")


def _by_file(df: DataFrame) -> DataFrame:
    return df.repartition("file_no").sortWithinPartitions("file_no", "pos")


def land_events(spark: SparkSession, sf_dir: str, ev: DataFrame | None = None) -> str:
    """The log (or ``ev``, with numbered files) as gzip NDJSON, one file per five hundred events."""
    path = scratch(spark, "landing")
    nested = (log(spark, sf_dir) if ev is None else ev).select(
        "file_no",
        F.col("timepoint").alias("pos"),
        "resource_kind",
        "resource_id",
        "resource_uri",
        F.parse_json("data").alias("data"),
        F.struct("timepoint", "published_at", "type").alias("event"),
    )
    (
        _by_file(nested)
        .drop("pos")
        .write.partitionBy("file_no")
        .option("compression", "gzip")
        .json(path)
    )
    return path


_LINE = (
    """concat('{"resource_kind":"company","resource_uri":"', resource_uri, '","data":', """
    """coalesce(data, 'null'), ',"event":{"timepoint":', timepoint, ',"published_at":"', """
    """published_at, '","type":"', type, '"}}')"""
)
_BROKEN = """
case when file_no % 10 = 6 and timepoint % 500 = 0 then left(line, 40)
     when file_no % 5 = 2 and timepoint % 500 = 250 then '{bad'
     when file_no % 5 = 4 and timepoint % 500 = 100 then concat(line, line)
     else line end
"""


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the log in files with planted faults: ``file_no, pos, line``.

    Of every ten files one ends in a cut extra line, one has its last event cut,
    two have a bad line inside, two have two events on one line, and two end in
    an error object.
    """
    ev = log(spark, sf_dir).withColumn("line", F.expr(_LINE))
    lines = ev.select(
        "file_no", (F.col("timepoint") * 2).alias("pos"), F.expr(_BROKEN).alias("line")
    )
    ends = ev.where("timepoint % 500 = 0").select(
        "file_no",
        (F.col("timepoint") * 2 + 1).alias("pos"),
        F.expr(
            """case when file_no % 10 = 1 then '{"event":{"timep'
                    when file_no % 5 = 3 then '{"error":"stream closed"}' end"""
        ).alias("line"),
    )
    return lines.unionByName(ends.where("line is not null"))


def land_lines(spark: SparkSession, sf_dir: str) -> str:
    """The damaged lines as gzip text with blank heartbeat lines between them."""
    path = scratch(spark, "lines")
    blank = F.when(F.col("pos") % 100 == 0, F.concat("line", F.lit("\n  "))).otherwise(
        F.col("line")
    )
    (
        _by_file(damaged_lines(spark, sf_dir))
        .select("file_no", blank.alias("line"))
        .write.partitionBy("file_no")
        .option("compression", "gzip")
        .text(path)
    )
    return path


def land_captures(spark: SparkSession, sf_dir: str) -> str:
    """The damaged lines as captured files, of every three of which one is blank."""
    path = scratch(spark, "captures")
    lines = damaged_lines(spark, sf_dir).withColumn("line", F.expr("if(file_no % 3 = 1, '  ', line)"))
    _by_file(lines).select("file_no", "line").write.partitionBy("file_no").option("compression", "gzip").text(path)
    return path


def requested_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of one customer each, for a file per order; some ask for what they may not."""
    stream = F.expr(
        "case when o_custkey % 5 = 0 and o_orderkey % 2 = 0 then 'filings' when o_custkey % 7 = 0 then 'parcels'"
        " else 'companies' end"
    )
    root = F.expr("case when o_custkey % 11 = 0 and o_orderkey % 3 = 0 then '/other/' else '/sink/' end")
    end = F.expr("if(o_custkey % 13 = 0 and o_orderstatus = 'F', '.csv', '.json.gz')")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("request"),
        F.concat(root, stream, F.lit("/"), F.col("o_orderkey").cast("string"), end).alias("file"),
    )


def land_accounts(spark: SparkSession, sf_dir: str) -> str:
    """Orders as accounts CSV, one folder of parts per month; pending ones report an error."""
    from tidemark.sources.accounts import accounts_schema

    path = scratch(spark, "accounts")
    given = {
        "run_code": F.lit("Prod223"),
        "company_id": F.col("o_orderkey").cast("string"),
        "date": F.to_date("o_orderdate"),
        "entity_current_legal_name": F.concat(
            F.lit('Quoted "name", '), F.col("o_orderpriority")
        ),
        "company_dormant": F.col("o_orderstatus") == "F",
        "debtors": F.col("o_custkey"),
        "shareholder_funds": F.col("o_totalprice"),
        "error": F.when(F.col("o_orderstatus") == "P", F.lit("not readable")),
        "zip_url": F.lit("Accounts_Monthly_Data-x.zip"),
    }
    columns = [
        given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in accounts_schema(in_file=True)
    ]
    month = F.concat(
        F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM-dd"),
        F.lit("--"),
        F.date_format(F.last_day("o_orderdate"), "yyyy-MM-dd"),
        F.lit(".csv"),
    )
    (
        table(spark, sf_dir, "orders")
        .select(*columns, month.alias("month"))
        .repartition("month")
        .write.partitionBy("month")
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )
    return path


def land_streams(spark: SparkSession, sf_dir: str) -> str:
    """Lines of the log as gzip files ``<stream>/<number>.json.gz`` of three streams."""
    path = scratch(spark, "streams")
    place_parts(spark, stage_streams(spark, sf_dir), path)
    return path


def placed_name(file: Column) -> Column:
    """The name that a file of ``stage_streams`` has in ``land_streams``."""
    return F.regexp_replace(file, "/stream=([^/]+)/name=([^/]+)/[^/]+$", "/$1/$2")


def stage_streams(spark: SparkSession, sf_dir: str) -> str:
    """The files of ``land_streams``, each in a folder that says its name.

    Each stream counts its own timepoints.  Of every ten files one ends in a cut extra line.
    """
    own = sink(spark, sf_dir).withColumn("timepoint", F.expr("timepoint div 3"))
    ev = own.withColumns(
        {
            "line": F.expr(_LINE),
            "pos": F.col("timepoint") * 2,
            "stream": F.element_at(F.split("file", "/"), -2),
            "name": F.element_at(F.split("file", "/"), -1),
        }
    )
    cut = ev.where("file_no % 10 = 1").groupBy("stream", "name").agg(
        (F.max("pos") + 1).alias("pos"), F.lit('{"event":{"timep').alias("line")
    )
    columns = ("stream", "name", "pos", "line")
    return _stage_lines(spark, ev.select(*columns).unionByName(cut.select(*columns)))


def _stage_lines(spark: SparkSession, lines: DataFrame, staged: str | None = None) -> str:
    """Lines as gzip files in folders ``stream=<stream>/name=<name>``, in the order of ``pos``."""
    staged = staged or scratch(spark, "staged")
    (
        lines.repartition("stream", "name")
        .sortWithinPartitions("stream", "name", "pos")
        .select("stream", "name", "line")
        .write.partitionBy("stream", "name")
        .option("compression", "gzip")
        .text(staged)
    )
    return staged


def land_waves(spark: SparkSession, sf_dir: str, path: str, waves: int = 3) -> Iterator[int]:
    """Three streams that land in several waves; of every hundred events two are swapped.

    Gives the number of each wave when its files are there.  They stay in the folders that
    they were written to; ``placed_name`` gives their names.
    """
    own = sink(spark, sf_dir).withColumns({"pos": F.expr("timepoint div 3")}).withColumn(
        "timepoint",
        F.expr("case when pos % 100 = 50 then pos + 1 when pos % 100 = 51 then pos - 1 else pos end"),
    )
    lines = own.withColumns(
        {
            "line": F.expr(_LINE),
            "stream": F.element_at(F.split("file", "/"), -2),
            "name": F.element_at(F.split("file", "/"), -1),
        }
    ).select("stream", "name", "pos", "line", "file_no")
    last = own.agg(F.max("file_no")).head()[0]
    for wave in range(waves):
        mine = F.floor(F.col("file_no") * waves / (last + 1)) == wave
        _stage_lines(spark, lines.where(mine), f"{path}/wave-{wave}")
        yield wave


_REGISTER = {
    "charity": {
        "date_of_extract": "'2024-01-31'",
        "organisation_number": "c_custkey",
        "registered_charity_number": "if(c_custkey % 50 = 7, 'none', cast(c_custkey + 1 as string))",
        "linked_charity_number": "c_nationkey",
        "charity_name": "c_name",
        "date_of_registration": "if(c_custkey % 40 = 3, '31/01/2024', '2001-02-03')",
        "latest_income": "c_acctbal",
        "charity_insolvent": "if(c_nationkey = 0, null, if(c_nationkey < 9, 'True', 'False'))",
        "charity_activities": "concat(c_mktsegment, '\tsays \"so\"\nand more')",
    },
    "charity_trustee": {
        "date_of_extract": "'2024-01-31'",
        "organisation_number": "c_custkey",
        "trustee_id": "c_custkey * 3",
        "trustee_name": "c_name",
        "trustee_is_chair": "if(c_custkey % 3 = 0, 'True', 'False')",
        "trustee_date_of_appointment": "if(c_custkey % 30 = 4, 'unknown', '2011-12-13')",
    },
    "charity_policy": {
        "date_of_extract": "'2024-01-31'",
        "organisation_number": "c_custkey",
        "linked_charity_number": "if(c_custkey % 20 = 5, 'x1', '0')",
        "policy_name": "c_mktsegment",
    },
}


#: Rows of one array, which one task puts together.
_ROWS_PER_ARRAY = 100_000


def land_register(
    spark: SparkSession, sf_dir: str, name: str = "charity", json_array: bool = False
) -> str:
    """Customers as a register table, as tab-separated text or as JSON arrays.

    Fields have tabs and line breaks in them, and some values do not fit their type.
    """
    from tidemark.sources.register import register_schema

    path = scratch(spark, "register")
    given = _REGISTER[name]
    columns = [
        F.expr(f"cast({given.get(f.name, 'null')} as string)").alias(f.name)
        for f in register_schema(name)
    ]
    rows = table(spark, sf_dir, "customer").select(*columns)
    if json_array:
        # One array for each of four files, or more of them when there are many rows.
        files = max(4, -(-rows.count() // _ROWS_PER_ARRAY))
        part = F.pmod(F.xxhash64("organisation_number"), F.lit(files))
        arrays = rows.groupBy(part.alias("part")).agg(
            F.to_json(F.collect_list(F.struct("*"))).alias("value")
        )
        # Whatever tasks the arrays come to, a file has one of them.
        arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
        return path
    (
        rows.repartition(4)
        .write.option("sep", "\t")
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )
    return path
