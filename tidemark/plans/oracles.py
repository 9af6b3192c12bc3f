"""SQL over the given tables that each registered query must agree with."""

from __future__ import annotations

_LOG = """
log as (
  select event_id + 1 as timepoint,
    case when event_type = 'error' then 'deleted' else 'changed' end as type,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') as published_at,
    'company' as resource_kind,
    cast(user_id as varchar) as resource_id,
    concat('/resource/', cast(user_id as varchar)) as resource_uri,
    case when event_type = 'error' then null
         when event_id % 6 = 0 then '{"company_status":"active"}'
         when event_id % 6 = 1 then '{"company_status":"dissolved"}'
         when event_id % 6 = 2 then '{"company_status":null}'
         when event_id % 6 = 3 then '{}'
         when event_id % 6 = 4 then '{"company_status":"active","date_of_cessation":"2020-01-01"}'
         else '{"company_status":"active","date_of_cessation":null}' end as data,
    concat('/sink/companies/', lpad(cast(event_id // 500 as varchar), 8, '0'), '.json.gz') as file,
    cast(event_id // 500 as bigint) as file_no
  from events)"""

_GAPPED = (
    _LOG
    + """,
gapped as (
  select * replace (
    timepoint + (timepoint - 1) // 96 + 221 * ((timepoint - 1) // 4000) as timepoint) from log)"""
)

_JUMPING = (
    _LOG
    + """,
jumping as (select * replace (timepoint + 7 * ((timepoint - 1) // 1500) as timepoint) from log)"""
)

_DAMAGED = (
    _GAPPED
    + """,
damaged as (select * from gapped union all select * from gapped where file_no % 8 = 1)"""
)

_DOUBLED = (
    _LOG
    + """,
doubled as (select * from log union all select * from log where file_no between 1 and 2)"""
)

_RANGES = (
    _DOUBLED
    + """,
rng as (
  select file, file_no as idx,
    min(timepoint) - case when file_no % 60 = 13 then 500 else 0 end as lo,
    max(timepoint) + case when file_no % 60 = 6 then 1100 when file_no % 60 = 15 then 500
                          when file_no % 7 = 3 then 40 else 0 end as hi
  from log group by file, file_no)"""
)

_SINK = (
    _LOG
    + """,
sink as (
  select * replace (concat('/sink/',
      case timepoint % 3 when 0 then 'companies' when 1 then 'officers' else 'charges' end,
      '/', lpad(cast(file_no as varchar), 8, '0'), '.json.gz') as file)
  from log),
idx as (
  select file as filename, min(timepoint) as min, max(timepoint) as max,
    split_part(file, '/', 3) as stream
  from sink group by file)"""
)

# Files of three streams that begin with the last 30 events of the file before.
_OVERLAPPING = (
    _SINK
    + """,
over as (
  select * from sink
  union all
  select * replace (file_no + 1 as file_no,
    concat('/sink/', split_part(file, '/', 3), '/',
      lpad(cast(file_no + 1 as varchar), 8, '0'), '.json.gz') as file)
  from sink where (timepoint % 500 > 470 or timepoint % 500 = 0)
    and file_no < (select max(file_no) from sink)),
orng as (
  select split_part(file, '/', 3) as stream, file, min(timepoint) as lo, max(timepoint) as hi,
    row_number() over (partition by split_part(file, '/', 3) order by file) - 1 as idx
  from over group by file)"""
)

_FILES = (
    _LOG
    + """,
files as (select distinct file, file_no from log),
ledger as (select file from files where file_no <= 11 and file_no <> 5)"""
)

_NAMED = (
    _LOG
    + """,
stamped as (
  select cast(event_id // 500 as bigint) as file_no, min(ts) as first_ts,
    lower(lpad(to_hex(epoch_us(min(ts)) // 1000), 12, '0')) as stamp
  from events group by 1),
named_files as (
  select concat('/sink/companies/', substr(stamp, 1, 8), '-', substr(stamp, 9, 4), '-7000-8000-',
    lpad(cast(file_no as varchar), 12, '0'), '.json.gz') as file, file_no,
    date_trunc('millisecond', first_ts) as first_ts
  from stamped)"""
)

_NOW = "timestamp '2024-01-31 00:00:00'"
_ROW = "timepoint, type, published_at, resource_uri, data"

_LATEST = (
    _LOG
    + """,
latest as (
  select * from log
  qualify row_number() over (partition by resource_uri order by timepoint desc) = 1
    and type is distinct from 'deleted')"""
)

_DUPLICATES = (
    _DAMAGED
    + """,
dups as (select timepoint from damaged group by timepoint having count(*) > 1),
dup_ranges as (
  select min(timepoint) as range_min, max(timepoint) as range_max
  from (select timepoint, timepoint - row_number() over (order by timepoint) as g from dups)
  group by g),
gaps as (
  select prev + 1 as range_min, timepoint - 1 as range_max
  from (select timepoint, lag(timepoint) over (order by timepoint) as prev
        from (select distinct timepoint from damaged))
  where timepoint - prev > 1)"""
)

_LINE = (
    """concat('{"resource_kind":"company","resource_uri":"', resource_uri, '","data":', """
    """coalesce(data, 'null'), ',"event":{"timepoint":', cast(timepoint as varchar), """
    """',"published_at":"', published_at, '","type":"', type, '"}}')"""
)

_LINES = (
    _FILES
    + f""",
raw as (select *, {_LINE} as whole from log),
placed as (
  select file_no, timepoint * 2 as pos,
    case when file_no % 10 = 6 and timepoint % 500 = 0 then left(whole, 40)
         when file_no % 5 = 2 and timepoint % 500 = 250 then '{{bad'
         when file_no % 5 = 4 and timepoint % 500 = 100 then concat(whole, whole)
         else whole end as line
  from raw
  union all
  select file_no, timepoint * 2 + 1,
    case when file_no % 10 = 1 then '{{"event":{{"timep'
         else '{{"error":"stream closed"}}' end
  from raw where timepoint % 500 = 0 and (file_no % 10 = 1 or file_no % 5 = 3)),
lines as (
  select file_no, row_number() over (partition by file_no order by pos) as line_no, line,
    json_valid(line) as ok
  from placed),
parsed as (
  select file_no, line_no, cast(json_extract(doc, '$.event.timepoint') as bigint) as tp,
    ok and json_extract(doc, '$.error') is null as whole
  from (select *, case when ok then try_cast(line as json) end as doc from lines)),
bad as (select file_no, min(line_no) as line_no from lines where not ok group by file_no),
classified as (
  select t.file_no,
    case when b.line_no is null then 'ok' when b.line_no = t.n then 'broken_at_end'
         else 'broken_mid_file' end as kind,
    b.line_no, l.line
  from (select file_no, count(*) as n from lines group by file_no) t
  left join bad b on b.file_no = t.file_no
  left join lines l on l.file_no = b.file_no and l.line_no = b.line_no),
first_last as (
  select file_no,
    max(case when line_no = 1 then tp end) as first_tp,
    arg_max(tp, line_no) filter (where whole) as last_tp
  from parsed group by file_no),
boundary as (
  select file_no, last_tp, lead(first_tp) over (order by file_no) as next_first_tp,
    case when lead(file_no) over (order by file_no) is not null
         then coalesce(lead(first_tp) over (order by file_no) = last_tp + 1, false) end as ok
  from first_last),
names as (select file, file_no from files)"""
)

_ACCOUNTS = """
accounts as (
  select o_orderkey as company_id, o_totalprice as shareholder_funds,
    cast(o_orderdate as date) as zip_start,
    case when o_orderstatus = 'F' and month(o_orderdate) <= 3
         then last_day(o_orderdate) else cast(o_orderdate as date) end as zip_end,
    case when o_orderstatus = 'F' and month(o_orderdate) <= 3
         then 'Accounts_Monthly_Data-x.zip' else 'Accounts_Bulk_Data-x.zip' end as zip_url,
    'x.csv' as csv_name
  from orders),
spans as (
  select zip_start as first_day, zip_end as last_day from accounts
  where not contains(zip_url, 'Accounts_Bulk_Data-')),
-- Spans open on a day: those begun by then less those that ended before.
open_on as (
  select day, (select count(*) from spans where first_day <= day)
    - (select count(*) from spans where last_day < day) as n
  from (select distinct zip_start as day from accounts)),
kept as (
  select a.* from accounts a join open_on o on o.day = a.zip_start
  where o.n = 0 or not contains(a.zip_url, 'Accounts_Bulk_Data-'))"""

_LANDED_ACCOUNTS = """
select cast(o_orderkey as varchar) as company_id, cast(o_orderdate as date) as date,
  concat('Quoted "name", ', o_orderpriority) as entity_current_legal_name,
  o_orderstatus = 'F' as company_dormant, o_custkey as debtors,
  o_totalprice as shareholder_funds, 'Accounts_Monthly_Data-x.zip' as zip_url,
  cast(date_trunc('month', o_orderdate) as date) as zip_start,
  last_day(o_orderdate) as zip_end
from orders where o_orderstatus <> 'P'"""

_FILINGS = """
filings as (
  select o_custkey as organisation_number, o_orderkey as ar_cycle_reference,
    cast(o_orderdate as date) as fin_period_end_date,
    row_number() over (
      partition by o_custkey
      order by cast(o_orderdate as date) desc, o_orderkey desc) as fin_period_order_number,
    o_orderpriority = '1-URGENT' as bad_own_use,
    o_orderstatus = 'P' and o_orderpriority <> '5-LOW' as bad_liabilities,
    o_orderstatus = 'O' as bad_funds
  from orders)"""


def _with(ctes: str, body: str) -> str:
    return f"with {ctes.strip()}\n{body}"


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # Snapshots
    latest = _with(_LATEST, f"select {_ROW} from latest")
    for name in (
        "latest_snapshot",
        "incremental_snapshot",
        "upsert_snapshot",
        "stream_snapshot",
        "export_snapshot",
    ):
        sql[name] = latest
    sql["live_snapshot"] = _with(
        _LATEST + ", typed as (select * replace (data::json as data) from latest)",
        "select timepoint, type, published_at, resource_uri, cast(data as varchar) as data "
        """from typed where data.date_of_cessation is null and data.company_status != '"dissolved"'""",
    )
    streams = {
        "officers": ("date_of_cessation", "resigned_on", "data.resigned_on is null"),
        "persons-with-significant-control": (
            "date_of_cessation", "ceased_on", "data.ceased_on is null",
        ),
        "charges": ("company_status", "status", """data.status != '"fully-satisfied"'"""),
        "persons-with-significant-control-statements": (
            "date_of_cessation", "ceased_on", "data.ceased_on is null",
        ),
        "filings": ("company_status", "category", "true"),
    }
    sql["live_snapshot_streams"] = _with(
        _LATEST,
        " union all ".join(
            f"select '{name}' as stream, timepoint, type, published_at, resource_uri, "
            "cast(data as varchar) as data from (select * replace (replace(replace("
            f"data, '{old}', '{new}'), '\"status\":\"dissolved\"', "
            "'\"status\":\"fully-satisfied\"')::json as data) from latest) where " + live
            for name, (old, new, live) in streams.items()
        ),
    )
    sql["bucketed_snapshot"] = sql["latest_snapshot"]
    sql["bucket_lookup"] = _with(
        _LOG,
        f"""select {_ROW} from log
        where resource_uri in ('/resource/1', '/resource/7', '/resource/42', '/resource/99')
        qualify row_number() over (partition by resource_uri order by timepoint desc) = 1""",
    )
    sql["latest_by_join"] = _with(
        _LOG,
        f"""select {_ROW} from (select * from log where timepoint > 500)
        qualify row_number() over (partition by resource_uri order by timepoint desc) = 1""",
    )
    sql["latest_by_join_first"] = _with(
        _LOG,
        f"""select {_ROW} from (select * replace (timepoint - 1 as timepoint) from log)
        where timepoint < 700
        qualify row_number() over (partition by resource_uri order by timepoint desc) = 1""",
    )
    sql["snapshot_counts"] = _with(
        _LATEST,
        "select count(*) as row_count, count(distinct timepoint) as distinct_timepoints from latest",
    )
    sql["check_unique_resources"] = _with(
        _LOG, "select resource_uri, count(*) as n from log group by 1 having count(*) > 1"
    )
    sql["snapshot_manifest"] = _with(
        _LATEST,
        """select 'companies' as stream, '2024-01-31T00:00:00' as snapshot_published_at,
        count(*) as record_count, min(timepoint) as min_timepoint, max(timepoint) as max_timepoint,
        min(published_at) as min_published_at, max(published_at) as max_published_at from latest""",
    )
    sql["compare_snapshots"] = _with(
        _LATEST
        + """, older as (
        select * from (select * from log where published_at < '2024-01-29')
        qualify row_number() over (partition by resource_uri order by timepoint desc) = 1
          and type is distinct from 'deleted')""",
        """select count(*) filter (where b.resource_uri is null) as only_a,
        count(*) filter (where a.resource_uri is null) as only_b,
        count(*) filter (where a.resource_uri = b.resource_uri) as both,
        count(*) filter (where a.resource_uri = b.resource_uri
          and a.timepoint is distinct from b.timepoint) as diff_timepoint,
        count(*) filter (where a.resource_uri = b.resource_uri
          and a.published_at is distinct from b.published_at) as diff_published_at,
        count(*) filter (where a.resource_uri = b.resource_uri
          and a.data is distinct from b.data) as diff_data
        from latest a full join older b on a.resource_uri = b.resource_uri""",
    )

    sql["compare_by_digest"] = sql["compare_snapshots"]
    sql["repeated_keys"] = sql["check_unique_resources"]

    # Table checks
    contiguity = """
      select count(*) as row_count, count(distinct timepoint) as distinct_timepoints,
        max(timepoint) - min(timepoint) + 1 as diff_timepoints,
        min(timepoint) as min_tp, max(timepoint) as max_tp,
        count(*) = count(distinct timepoint)
          and count(distinct timepoint) = max(timepoint) - min(timepoint) + 1 as ok
      from damaged"""
    sql["check_contiguity"] = _with(_DAMAGED, contiguity)
    freshness = f"""
      select min(published_at) as min_published_at, max(published_at) as max_published_at,
        cast(date_diff('second', cast(max(published_at) as timestamp), {_NOW}) as bigint) as age_s,
        date_diff('second', cast(max(published_at) as timestamp), {_NOW}) <= 48 * 3600 as ok """
    sql["check_freshness"] = _with(_LOG, freshness + "from log")
    null_data = "select count(*) as null_rows, count(*) = 0 as ok from {} where data is null and type != 'deleted'"
    sql["check_null_data"] = _with(_LOG, null_data.format("log"))
    sql["verify_events"] = _with(
        _DAMAGED,
        f"""select 'contiguity' as "check", ok,
          concat_ws(',', row_count, distinct_timepoints, diff_timepoints) as detail
        from ({contiguity})
        union all select 'freshness', ok, max_published_at from ({freshness} from damaged)
        union all select 'null_data', ok, cast(null_rows as varchar)
          from ({null_data.format('damaged')})""",
    )

    sql["verify_snapshot"] = _with(
        _LATEST,
        f"""select 'freshness' as "check", ok, max_published_at as detail from ({freshness} from latest)
        union all select 'unique_resources', count(*) = 0, cast(count(*) as varchar)
          from (select resource_uri from latest group by 1 having count(*) > 1)""",
    )

    cases = {
        "loaded": "jumping", "loaded again": "jumping", "compacted": "jumping",
        "doubled": "(select * from jumping union all select * from jumping where file_no between 1 and 2)",
        "corrected": "(select * from jumping where file_no not between 1 and 2)",
    }
    sql["verify_loaded"] = _with(
        _JUMPING,
        " union all ".join(
            f"""select '{case}' as "case", 'contiguity' as "check", count(*) = count(distinct timepoint)
              and count(distinct timepoint) = max(timepoint) - min(timepoint) + 1 as ok,
              concat_ws(',', count(*), count(distinct timepoint), max(timepoint) - min(timepoint) + 1) as detail
            from {rows}
            union all select '{case}', 'freshness',
              date_diff('second', cast(max(published_at) as timestamp), {_NOW}) <= 48 * 3600,
              max(published_at) from {rows}
            union all select '{case}', 'null_data', count(*) = 0, cast(count(*) as varchar)
            from {rows} where data is null and type != 'deleted'"""
            for case, rows in cases.items()
        ),
    )
    sql["sample_loaded"] = _with(
        _DOUBLED,
        " union all ".join(
            f"""select * from (select '{days}' as days, {_ROW} from doubled where published_at >= '{first}'
              order by md5('sample|' || timepoint), timepoint limit 300)"""
            for days, first in (("all", ""), ("late", "2024-01-15"))
        ),
    )
    sql["loaded_issues"] = _with(
        _GAPPED,
        """select 'missing' as kind, prev + 1 as range_min, timepoint - 1 as range_max
        from (select timepoint, lag(timepoint) over (order by timepoint) as prev from gapped)
        where timepoint - prev > 1
        union all
        select 'duplicate', min(timepoint), max(timepoint)
        from (select timepoint, timepoint - row_number() over (order by timepoint) as g
              from gapped where file_no between 1 and 2) group by g""",
    )

    # Landing checks
    stats = """select file, min(timepoint) as lo, max(timepoint) as hi, count(*) as row_count
      from damaged group by file"""
    sql["file_stats"] = _with(_DAMAGED, stats)
    problems = """select file, lo, hi, row_count as count_diff, hi - lo + 1 as diff,
      row_count - (hi - lo + 1) as extra from ({}) where row_count <> hi - lo + 1"""
    sql["problem_files"] = _with(_DAMAGED, problems.format(stats))
    total = """select min(lo) as tmin, max(hi) as tmax, cast(sum(row_count) as bigint) as tcount,
      max(hi) - min(lo) + 1 as diff, max(hi) - min(lo) + 1 = sum(row_count) as correct,
      cast(sum(row_count) - (max(hi) - min(lo) + 1) as bigint) as extra from ({})"""
    sql["file_range_total"] = _with(_DAMAGED, total.format(stats))
    sql["newest_files"] = _with(_FILES, "select file from files order by file desc limit 5")
    sql["newest_file_stats"] = _with(
        _LOG,
        """select min(timepoint) as min_timepoint, max(timepoint) as max_timepoint,
        min(published_at) as min_published_at, max(published_at) as max_published_at,
        count(*) as row_count from log where file = (select max(file) from log)""",
    )
    file_age = f"""select file, strftime(first_ts, '%Y-%m-%d %H:%M:%S.%g') as written_at,
      cast(floor((epoch_ms({_NOW}) - epoch_ms(first_ts)) / 1000) as bigint) as age_s,
      epoch_ms({_NOW}) - epoch_ms(first_ts) >= (24 * 3600 + 1) * 1000 as too_old
      from named_files"""
    sql["check_file_age"] = _with(_NAMED, file_age)
    sql["verify_landing"] = _with(
        _NAMED
        + f""",
        named_log as (select l.* replace (n.file as file) from log l join named_files n using (file_no)),
        newest as (select file from named_files order by file desc limit 5),
        recent as (select * from named_log where file in (select file from newest)),
        stats as (select file, min(timepoint) as lo, max(timepoint) as hi, count(*) as row_count
          from recent group by file)""",
        f"""select 'newest_file_age' as "check", not too_old as ok, written_at as detail
          from ({file_age}) where file = (select max(file) from newest)
        union all select 'newest_published_at',
          date_diff('second', cast(max(published_at) as timestamp), {_NOW}) <= 24 * 3600,
          max(published_at) from recent where file = (select max(file) from newest)
        union all select 'each_file_dense', count(*) = 0, cast(count(*) as varchar)
          from ({problems.format('select * from stats')})
        union all select 'files_dense', correct, concat_ws(',', tmin, tmax, tcount)
          from ({total.format('select * from stats')})""",
    )
    sql["landing_extra_checks"] = _with(
        _NAMED,
        """select file, other_kind, drift_s, other_kind = 0 and drift_s <= 130000 as ok
        from (
          select n.file, count(*) filter (where l.resource_kind is distinct from 'company') as other_kind,
            cast(abs(trunc((epoch_ms(cast(max(l.published_at) as timestamp))
              - epoch_ms(any_value(n.first_ts))) / 1000)) as bigint) as drift_s
          from log l join named_files n using (file_no) group by n.file)""",
    )

    # Ranges
    sql["missing_ranges"] = _with(_DUPLICATES, "select range_min, range_max from gaps")
    sql["duplicate_ranges"] = _with(_DUPLICATES, "select range_min, range_max from dup_ranges")
    sql["timepoint_issues"] = _with(
        _DUPLICATES,
        """select 'missing' as kind, range_min, range_max from gaps
        union all select 'duplicate', range_min, range_max from dup_ranges""",
    )
    sql["duplicate_range"] = _with(
        _DUPLICATES,
        "select min(timepoint) as min_duplicate, max(timepoint) as max_duplicate from dups",
    )
    sql["order_breaks"] = _with(
        _LOG,
        """select file, line_no, prev_tp, tp from (
          select file, line_no, tp, coalesce(lag(tp) over (order by line_no), 0) as prev_tp
          from (
            select file, timepoint as line_no,
              case when timepoint % 100 = 50 then timepoint + 1
                   when timepoint % 100 = 51 then timepoint - 1 else timepoint end as tp
            from log))
        where tp <> prev_tp + 1""",
    )

    depth = """select {by} place as lo, following - 1 as hi, cast(depth as bigint) as depth from (
        select *, sum(step) over ({part} order by place) as depth, lead(place) over ({part} order by place) as following
        from (select {by} place, sum(step) as step
              from (select {by} lo as place, 1 as step from {rows} union all select {by} hi + 1, -1 from {rows})
              group by {by} place having sum(step) <> 0)) where depth >= {least}"""
    sql["overlap_depth"] = _with(_RANGES, depth.format(by="", part="", rows="rng", least=1))
    sql["overlap_depth_streams"] = _with(
        _OVERLAPPING, depth.format(by="stream,", part="partition by stream", rows="orng", least=2)
    )
    sql["files_at_timepoints"] = _with(
        _RANGES,
        """select timepoint, rng.file from log join rng on timepoint between lo and hi
        where timepoint % 10 = 0""",
    )
    sql["watch_order"] = _with(
        _SINK,
        """select 'break' as kind, stream, file_no, line_no, prev_tp, tp from (
          select *, coalesce(lag(tp) over (partition by stream order by pos),
            case stream when 'companies' then 0 when 'officers' then -1 end) as prev_tp
          from (select *, case when pos % 100 = 50 then pos + 1
                when pos % 100 = 51 then pos - 1 else pos end as tp,
                row_number() over (partition by stream, file_no order by pos) as line_no
              from (select split_part(file, '/', 3) as stream, file_no, timepoint // 3 as pos
                    from sink)))
        where tp <> prev_tp + 1""",
    )

    # File index, replay, overlaps
    sql["update_file_index"] = _with(_SINK, "select filename, min, max, stream from idx")
    sql["index_file_count"] = _with(
        _SINK, "select stream, count(*) as file_count from idx group by stream"
    )
    sql["stream_range"] = _with(
        _SINK, "select stream, min(min) as min, max(max) as max from idx group by stream"
    )
    sql["replay_files"] = _with(
        _SINK,
        "select filename, min, max from idx where stream = 'officers' and max >= 500 order by min",
    )
    sql["replay_events"] = _with(
        _SINK,
        f"""select file, {_ROW} from sink
        where split_part(file, '/', 3) = 'officers' and timepoint >= 503""",
    )
    # Files by their least timepoint, each as it is; only the first one is trimmed.
    sql["replay_events_raw"] = _with(
        _OVERLAPPING,
        f"""select file, {_ROW}, row_number() over (order by lo, file, timepoint) - 1 as place
        from over join (select file, lo, rank() over (order by lo, file) as turn from orng
                        where stream = 'officers' and hi >= 503) using (file)
        where turn > 1 or timepoint >= 503""",
    )
    sql["replay_smoke"] = _with(
        _SINK,
        """select count(*) as events, count(*) filter (where timepoint <> prev + 1) as breaks
        from (select timepoint, coalesce(lag(timepoint) over (order by timepoint), timepoint - 1) as prev
              from sink where split_part(file, '/', 3) = 'officers'
                and timepoint >= (select greatest(max(max) - 1000000, min(min)) from idx
                                  where stream = 'officers'))""",
    )
    sql["file_ranges"] = _with(
        _DAMAGED,
        """select file, row_number() over (order by file) - 1 as idx, lo, hi from (
          select file, min(timepoint) as lo, max(timepoint) as hi from damaged group by file)""",
    )
    sql["file_ranges_streams"] = _with(_OVERLAPPING, "select file, idx, lo, hi from orng")
    sql["file_neighbours_streams"] = _with(
        _OVERLAPPING,
        """select file, lag(file) over w as prev_file, lag(hi) over w as prev_hi,
        lead(file) over w as next_file, lead(lo) over w as next_lo
        from orng window w as (partition by stream order by idx)""",
    )
    sql["overlap_pairs_streams"] = _with(
        _OVERLAPPING,
        """select earlier, later, width from (
          select e.file as earlier, l.file as later, e.hi - l.lo + 1 as width,
            row_number() over (partition by l.file order by e.hi desc, e.idx desc) as n
          from orng e join orng l on e.stream = l.stream and e.idx < l.idx and e.hi >= l.lo)
        where n = 1""",
    )
    sql["file_neighbours"] = _with(
        _RANGES,
        """select file, lag(file) over w as prev_file, lag(hi) over w as prev_hi,
        lead(file) over w as next_file, lead(lo) over w as next_lo
        from rng window w as (order by idx)""",
    )
    sql["file_contiguity"] = _with(
        _RANGES,
        """select file, lo, lag(hi) over w as prev_hi, lo = lag(hi) over w + 1 as contiguous
        from rng window w as (order by lo, hi, file)""",
    )
    dup = "(select min(timepoint) as d_lo, max(timepoint) as d_hi from (select timepoint from doubled group by 1 having count(*) > 1))"
    sql["file_overlap_flags"] = _with(
        _RANGES,
        f"""select file, coalesce(lag(hi) over (order by idx) >= lo, false) as overlaps_previous,
        lo <= d_hi and hi >= d_lo as contains_duplicate, lo = d_lo and hi = d_hi as exact_match
        from rng cross join {dup}""",
    )
    # Of all earlier files that reach into a later one, the one that reaches furthest.
    furthest = """
      select e.file as earlier, l.file as later, e.lo as e_lo, e.hi as e_hi, e.idx as e_idx,
        l.lo as l_lo, l.hi as l_hi, l.idx as l_idx, greatest(e.lo, l.lo) as both_lo,
        least(e.hi, l.hi) as both_hi
      from rng e join rng l on e.idx < l.idx and e.hi >= l.lo {}
      qualify row_number() over (partition by l.file order by e.hi desc, e.idx desc) = 1"""
    sql["overlap_pairs"] = _with(
        _RANGES,
        f"select earlier, later, e_hi - l_lo + 1 as width from ({furthest.format('')})",
    )
    holds = "and 2010 between e.lo and e.hi and 2010 between l.lo and l.hi"
    sql["overlap_pairs_at"] = _with(
        _RANGES,
        f"select earlier, later, e_hi - l_lo + 1 as width from ({furthest.format(holds)})",
    )
    sql["overlap_recommendation"] = _with(
        _RANGES
        + f""",
        pairs as (
          select p.*, b.hi as b_hi, a.lo as a_lo, coalesce(b.hi + 1, e_lo) as expected_lo,
            coalesce(a.lo - 1, l_hi) as expected_hi
          from ({furthest.format('')}) p
          left join rng b on b.idx = e_idx - 1 left join rng a on a.idx = l_idx + 1),
        judged as (
          select *, l_lo = expected_lo and l_hi = expected_hi as l_fits,
            e_lo = expected_lo and e_hi = expected_hi as e_fits from pairs)""",
        f"""select earlier, later, expected_lo, expected_hi,
          case when l_fits and not e_fits then later else earlier end as keep,
          case when l_fits and not e_fits then earlier else later end as drop,
          case when l_fits and not e_fits then 'later file fills the gap'
               when e_fits and not l_fits then 'earlier file fills the gap'
               else 'later file captures again what the earlier one holds' end as reason,
          e_lo - b_hi - 1 as gap_before, e_hi - l_lo + 1 as overlap_width,
          a_lo - l_hi - 1 as gap_after, d_lo between both_lo and both_hi as holds_duplicate
        from judged cross join {dup}""",
    )

    # Correction
    sql["ledger_missing"] = _with(
        _FILES, "select file from files where file not in (select file from ledger)"
    )
    sql["confirm_double_load"] = _with(
        _RANGES
        + """, files as (select distinct file, file_no from log),
        ledger as (select file from files where file_no <= 11 and file_no <> 5),
        dups as (select timepoint from doubled group by 1 having count(*) > 1),
        cases as (select * from (values ('both', [1, 2]), ('one more', [1, 2, 3]), ('gap', [1, 4]),
          ('not loaded', [1, 5])) c("case", members)),
        chosen as (
          select "case", r.*, lag(hi) over (partition by "case" order by lo, hi, file) as prev_hi
          from cases join rng r on list_contains(members, r.idx)),
        bounds as (
          select "case", min(lo) as lo, max(hi) as hi,
            bool_and(coalesce(lo = prev_hi + 1, prev_hi is null)) as contiguous,
            bool_and(file in (select file from ledger)) as all_in_ledger
          from chosen group by "case")""",
        """select "case", lo = (select min(timepoint) from dups) and hi = (select max(timepoint) from dups)
            as range_match, contiguous,
          (select count(*) from dups where timepoint between lo and hi) = hi - lo + 1 as all_duplicated,
          all_in_ledger
        from bounds""",
    )
    sql["correction_plan"] = _with(
        _RANGES,
        f"""select count(*) as rows_to_delete, count(distinct timepoint) as distinct_in_range,
        any_value(d_hi - d_lo + 1) as expected_after
        from doubled cross join {dup} where timepoint between d_lo and d_hi""",
    )
    sql["apply_correction"] = _with(
        _RANGES + ", files as (select distinct file, file_no from log)",
        f"""select 'event' as part, file, timepoint from doubled cross join {dup}
          where timepoint not between d_lo and d_hi
        union all select 'ledger', file, null from files
          where file_no <= 11 and file_no <> 5 and file_no not between 1 and 2""",
    )
    sql["rewrite_without_range"] = _with(
        _RANGES,
        f"""select file, {_ROW} from doubled cross join {dup}
          where timepoint not between d_lo and d_hi""",
    )

    # Ledger and landing files
    sql["loaded_files"] = _with(_FILES, "select file from ledger")
    sql["unloaded_files"] = sql["ledger_missing"]
    sql["late_unloaded_files"] = _with(
        _FILES,
        """select file from files where file not in (select file from ledger)
        and file < (select max(file) from ledger)""",
    )
    sql["scan_events"] = _with(
        _LOG,
        """select timepoint, type, published_at, resource_kind, resource_id, resource_uri, data,
        file_no from log""",
    )
    sql["scan_events_tolerant"] = _with(
        _LINES,
        """select file_no, tp as timepoint,
          case when l.ok then json_extract_string(try_cast(line as json), '$.resource_uri') end
            as resource_uri,
          case when not l.ok then line end as corrupt
        from lines l join parsed using (file_no, line_no)""",
    )
    sql["list_sink_files"] = _with(
        _LOG,
        """select file_no, count(*) as lines, count(*) > 0 as same_length, count(*) > 0 as dated
        from log group by file_no""",
    )
    sql["load_events"] = _with(_LOG, f"select file_no, {_ROW} from log")
    sql["compact_loaded"] = sql["load_events"]
    sql["correct_loaded"] = sql["load_events"]
    sql["maintain_index"] = _with(
        _LOG, "select file_no, min(timepoint) as min, max(timepoint) as max from log group by file_no"
    )
    sql["load_accounts"] = _LANDED_ACCOUNTS
    sql["sort_events"] = _with(
        _DAMAGED, "select count(*) as row_count, cast(0 as bigint) as overlaps from damaged"
    )
    sql["compact_events"] = _with(
        _LOG,
        "select count(*) as row_count, min(timepoint) as lo, max(timepoint) as hi from log",
    )
    # Lines and repair
    sql["number_lines"] = _with(_LINES, "select file_no, line_no, line, ok from lines")
    sql["captures"] = _with(
        _LINES,
        """select file_no, case when file_no % 3 = 1 then 0 else n end as lines, file_no % 3 <> 1 as upload
        from (select file_no, count(*) filter (where ok or line_no < last) as n
              from (select *, max(line_no) over (partition by file_no) as last from lines) group by file_no)""",
    )
    asked = """(select o_custkey as request,
        case when o_custkey % 11 = 0 and o_orderkey % 3 = 0 then 'other' else 'sink' end as root,
        case when o_custkey % 5 = 0 and o_orderkey % 2 = 0 then 'filings' when o_custkey % 7 = 0 then 'parcels'
          else 'companies' end as stream,
        o_custkey % 13 = 0 and o_orderstatus = 'F' as csv from orders)"""
    sql["stream_names"] = f"""select distinct stream, stream in ('companies', 'filings') as known, stream as "table" from {asked}"""
    sql["check_requests"] = f"""select request, files, case when problem is null then stream end as stream, problem from (
        select request, count(*) as files, min(stream) as stream,
          case when bool_or(root = 'other') then 'outside the root' when bool_or(csv) then 'not an event file'
               when min(stream) <> max(stream) then 'several streams'
               when min(stream) = 'parcels' then 'unknown stream' end as problem
        from {asked} group by request)"""
    sql["clean_landing"] = _with(
        _LINES,
        """select file_no, line from lines
        where ok or line_no < (select max(line_no) from lines l where l.file_no = lines.file_no)""",
    )
    sql["classify_files"] = _with(_LINES, "select file_no, kind, line_no, line from classified")
    sql["find_broken_files"] = _with(
        _LINES,
        """select file, kind, line_no, line from classified join names using (file_no)
        where kind <> 'ok' and file not in (select file from ledger)""",
    )
    sql["file_first_last"] = _with(_LINES, "select file_no, first_tp, last_tp from first_last")
    sql["resume_offset"] = _with(
        _LINES,
        """select 'companies' as stream, arg_max(last_tp, file_no) + 1 as next_timepoint
        from first_last""",
    )
    streams = _SINK + """,
      own as (select * replace (timepoint // 3 as timepoint),
          split_part(file, '/', 3) as stream, split_part(file, '/', 4) as name from sink),
      ends as (select stream, concat(stream, '/', name) as file, min(timepoint) as min,
          max(timepoint) as max from own group by stream, name)"""
    sql["resume_offset_streams"] = _with(
        streams, "select stream, arg_max(max, file) + 1 as next_timepoint from ends group by stream"
    )
    sql["boundary_check_streams"] = _with(
        streams,
        """select file, max as last_tp, lead(min) over w as next_first_tp,
          lead(min) over w = max + 1 as ok
        from ends window w as (partition by stream order by file)""",
    )
    sql["boundary_check"] = _with(
        _LINES, "select file, last_tp, next_first_tp, ok from boundary join names using (file_no)"
    )
    sql["valid_prefix"] = _with(
        _LINES,
        """select l.file_no, l.line_no, l.line from lines l left join bad b using (file_no)
        where b.line_no is null or l.line_no < b.line_no""",
    )
    sql["repair_files"] = _with(
        _LINES,
        """select file, c.line_no - 1 as kept_lines,
          (select count(*) from lines l where l.ok and l.file_no = c.file_no
             and l.line_no < c.line_no) = c.line_no - 1 as verified
        from classified c join names using (file_no) where kind = 'broken_at_end'""",
    )
    # A cut extra line takes nothing from the events, so all broken files can be repaired.
    sql["repair_landing"] = _with(
        streams,
        """select stream, count(*) as rows, count(distinct timepoint) as timepoints,
          min(timepoint) as lo, max(timepoint) as hi,
          count(distinct file_no) filter (where file_no % 10 = 1) as fixed,
          count(distinct file_no) filter (where file_no % 10 = 1) as broken
        from own group by stream""",
    )
    sql["repair_outcomes"] = _with(
        _LINES,
        """select file,
          case when kind = 'broken_mid_file' then 'skipped_mid_file'
               when not coalesce(b.ok, true) then 'failed' else 'fixed' end as status,
          case when kind = 'broken_mid_file' then concat('bad line ', cast(c.line_no as varchar))
               when not coalesce(b.ok, true) then 'next file does not continue' end as reason
        from classified c join names using (file_no) join boundary b using (file_no)
        where kind <> 'ok'""",
    )

    # Accounts
    sql["scan_accounts"] = _LANDED_ACCOUNTS
    sql["accounts_dedup"] = _with(_ACCOUNTS, "select * from kept")
    sql["accounts_dedup_asof"] = sql["accounts_dedup"]
    sql["accounts_zip_counts"] = _with(
        _ACCOUNTS,
        """select zip_url, zip_start, zip_end, count(*) as n from accounts
        where zip_start between date '1995-01-01' and date '1997-12-31'
        group by zip_url, zip_start, zip_end""",
    )
    sql["export_accounts"] = _with(
        _ACCOUNTS,
        """select * exclude (zip_start, zip_end, csv_name) from kept
        where zip_start >= date '1996-06-01' and zip_end <= date '1998-05-31'""",
    )

    # Register
    def register(columns: dict[str, str], misfits: dict[str, str]) -> str:
        """Columns of a scan, and the values that did not fit as JSON."""
        found = ", ".join(
            f"""case when {test} then '"{c}":"' || ({text}) || '"' end"""
            for c, (test, text) in misfits.items()
        )
        listed = ", ".join(f"{e} as {c}" for c, e in columns.items())
        return (
            f"select {listed}, '{{' || nullif(concat_ws(',', {found}), '') || '}}' as rejected "
            "from customer"
        )

    extract, organisation = "date '2024-01-31'", "cast(c_custkey as integer)"
    sql["scan_register"] = register(
        {
            "date_of_extract": extract,
            "organisation_number": organisation,
            "registered_charity_number":
                "case when c_custkey % 50 <> 7 then cast(c_custkey + 1 as integer) end",
            "linked_charity_number": "c_nationkey",
            "charity_name": "c_name",
            "date_of_registration": "case when c_custkey % 40 <> 3 then date '2001-02-03' end",
            "latest_income": "cast(c_acctbal as decimal(18, 2))",
            "charity_insolvent": "case when c_nationkey = 0 then null else c_nationkey < 9 end",
            "charity_activities":
                "concat(c_mktsegment, chr(9), 'says \"so\"', chr(10), 'and more')",
        },
        {
            "registered_charity_number": ("c_custkey % 50 = 7", "'none'"),
            "date_of_registration": ("c_custkey % 40 = 3", "'31/01/2024'"),
        },
    )
    sql["scan_register_trustee"] = register(
        {
            "date_of_extract": extract,
            "organisation_number": organisation,
            "trustee_id": "cast(c_custkey * 3 as integer)",
            "trustee_name": "c_name",
            "trustee_is_chair": "c_custkey % 3 = 0",
            "trustee_date_of_appointment":
                "case when c_custkey % 30 <> 4 then date '2011-12-13' end",
        },
        {"trustee_date_of_appointment": ("c_custkey % 30 = 4", "'unknown'")},
    )
    sql["scan_register_json"] = register(
        {
            "date_of_extract": extract,
            "organisation_number": organisation,
            "linked_charity_number": "case when c_custkey % 20 <> 5 then 0 end",
            "policy_name": "c_mktsegment",
        },
        {"linked_charity_number": ("c_custkey % 20 = 5", "'x1'")},
    )
    rejects = (
        ("charity", "registered_charity_number", "c_custkey % 50 = 7"),
        ("charity", "date_of_registration", "c_custkey % 40 = 3"),
        ("charity_trustee", "trustee_date_of_appointment", "c_custkey % 30 = 4"),
        ("charity_policy", "linked_charity_number", "c_custkey % 20 = 5"),
    )
    sql["scan_register_split"] = sql["scan_register"]
    sql["scan_register_json_split"] = sql["scan_register_json"]
    sql["register_rejects"] = " union all ".join(
        f"""select '{t}' as "table", '{c}' as "column", count(*) as rows from customer where {test}"""
        for t, c, test in rejects
    )
    sql["register_counts"] = " union all ".join(
        f"select '{t}' as \"table\", count(*) as record_count from {t}"
        for t in ("customer", "supplier", "nation")
    )
    sql["register_link"] = """
      select c.c_nationkey as nationkey, c.* exclude (c_nationkey), n.* exclude (n_nationkey)
      from customer c left join nation n on c.c_nationkey = n.n_nationkey"""
    sql["register_consistency"] = _with(
        _FILINGS,
        """select 'assets_own_use' as "check", count(*) filter (where bad_own_use) as violations
          from filings
        union all select 'assets_total_liabilities', count(*) filter (where bad_liabilities)
          from filings
        union all select 'funds_total', count(*) filter (where bad_funds) from filings""",
    )
    sql["register_latest_filing"] = _with(
        _FILINGS,
        """select organisation_number, ar_cycle_reference, fin_period_end_date from filings
        where fin_period_order_number = 1""",
    )

    sql["register_filing_order"] = """
      select organisation_number, numbered_first, newest from (
        select o_custkey as organisation_number,
          max(case when o_orderkey % 3 = 0 then cast(o_orderdate as date) end) as numbered_first,
          max(cast(o_orderdate as date)) as newest
        from orders group by o_custkey)
      where numbered_first is distinct from newest"""

    # Exports
    sql["export_split"] = _with(_LOG, f"select {_ROW} from log")
    quoted = """'"' || replace({}, '"', '{}') || '"'"""
    as_json = f"""'{{"timepoint":' || timepoint || ',"type":"' || type || '","published_at":"' || published_at
        || '","resource_uri":"' || resource_uri || '","data":' || coalesce({quoted.format("data", chr(92) + '"')}, 'null') || '}}'"""
    as_csv = f"""timepoint || ',' || type || ',' || published_at || ',' || resource_uri || ','
        || coalesce(case when data = '{{}}' then data else {quoted.format("data", '""')} end, '')"""
    for fmt, line, head in (("json", as_json, 0), ("csv", as_csv, len(_ROW.replace(" ", "")) + 1)):
        sql[f"export_split_{fmt}"] = _with(
            _LOG,
            f"""select cast(part as integer) as part, count(*) + {min(head, 1)} as lines,
              cast(sum(bytes) + {head} as bigint) as bytes
            from (select bytes, (sum(bytes) over (order by timepoint) - bytes) // {100_000 - head} as part
                  from (select timepoint, strlen({line}) + 1 as bytes from log)) group by part""",
        )
    sql["export_sample"] = _with(
        _LOG,
        f"""select {_ROW} from log
        order by md5(concat('sample|', cast(timepoint as varchar))), timepoint limit 1000""",
    )
    sql["export_manifest"] = _with(
        _LOG,
        """select cast(files as bigint) as file_count, cast(files as bigint) as listed,
          count(*) as count, count(*) as listed_rows, true as same_bytes, 'csv' as format,
          '.csv.gz' as extension, 'gzip' as compression, labels
        from log, (values (1, 'daily,single'), (3, 'daily')) layouts(files, labels)
        group by files, labels""",
    )
    sql["publish_snapshot"] = _with(
        _LATEST
        + """, live as (
        select * from (select * replace (data::json as data) from latest)
        where data.date_of_cessation is null and data.company_status != '"dissolved"')""",
        """select count(*) as record_count, min(timepoint) as min_timepoint,
        max(timepoint) as max_timepoint, max(published_at) as max_published_at,
        cast(3 as bigint) as downloads,
        cast(count(*) + 2 * least(count(*), 1000) as bigint) as rows_listed from live""",
    )
    sql["publish_accounts"] = _with(
        _ACCOUNTS,
        """select d.description, count(k.company_id) as count
        from (values ('Last two years (CSV gzip)', date '1996-06-01'),
                     ('Last two years (Parquet)', date '1996-06-01'),
                     ('Full history (Parquet)', date '2008-01-01')) d(description, since)
        left join kept k on k.zip_start >= d.since and k.zip_end <= date '1998-05-31'
        group by d.description""",
    )
    sql["publish_register"] = " union all ".join(
        f"select '{t}' as \"table\", count(*) as record_count, cast(3 as bigint) as downloads from {t}"
        for t in ("customer", "supplier", "nation")
    )
    return sql
