"""The same results as plain SQL on the flat tables, for DuckDB."""

from __future__ import annotations

# Line items placed on legs, pages and positions, as in ``nested_orders``.
_ORDERS = """
orders_ as (
  select o_orderkey, cast(o_orderkey as varchar) as itinerary_id, o_totalprice, o_orderdate,
         cast(year(o_orderdate) as varchar) || '-01-01' as fetch_date,
         '\u20b9\u00a0' || cast(cast(floor(o_totalprice) as bigint) as varchar) as "formattedPrice"
  from orders
)"""

_SEGMENTS = _ORDERS + """,
placed as (
  select *, line_no // 4 as leg_no
  from (select *, row_number() over (partition by l_orderkey order by
               l_linenumber nulls first, l_partkey nulls first, l_suppkey nulls first,
               l_extendedprice nulls first, l_quantity nulls first, l_linestatus nulls first,
               l_shipdate nulls first) - 1 as line_no
        from lineitem)
),
segs as (
  select fetch_date, itinerary_id, "formattedPrice", o_totalprice, l_orderkey, leg_no,
         cast(l_orderkey as varchar) || '-' || cast(leg_no as varchar) as leg_id,
         leg_no // 8 as page,
         cast(leg_no % 8 as integer) as leg_pos,
         cast(line_no % 4 as integer) as seg_pos,
         strftime(o_orderdate + to_days(cast(leg_no as integer)), '%Y-%m-%dT%H:%M:%S')
           as departure,
         strftime(o_orderdate + to_days(cast(leg_no as integer) + 1), '%Y-%m-%dT%H:%M:%S')
           as arrival,
         count(*) over (partition by l_orderkey, leg_no) * 90 as duration,
         cast(l_partkey as varchar) as "flightNumber",
         'Supplier#' || lpad(cast(l_suppkey as varchar), 9, '0') as "marketingCarrier",
         'Operator ' || l_linestatus as "operatingCarrier",
         'N' || cast(l_suppkey % 25 as varchar) as "originCode",
         'N' || cast(l_partkey % 25 as varchar) as "destinationCode",
         l_shipdate + to_hours(l_linenumber) as leaves,
         l_shipdate + to_hours(l_linenumber) + to_minutes(cast(l_quantity as integer)) as lands
  from placed join orders_ on l_orderkey = o_orderkey
)"""

_TEN = """fetch_date, "formattedPrice", departure, arrival, duration, "flightNumber",
  "marketingCarrier", "operatingCarrier", "originCode", "destinationCode\""""

_RECORDS = _SEGMENTS + """,
pages as (
  select distinct fetch_date, l_orderkey, page from segs
  union all
  select fetch_date, o_orderkey, 0 from orders_
  where o_orderkey not in (select l_orderkey from lineitem)
),
records as (
  select fetch_date,
         cast(l_orderkey // 64 as varchar) || '-' || cast(page as varchar) as record_id,
         count(*) as total_results
  from pages group by all
)"""


def _summary_ctes(source: str, keys: str, position: str) -> str:
    """End points and the stops in between, per group of ``keys``."""
    on = " and ".join(f"g.{k} is not distinct from e.{k}" for k in keys.split(", "))
    return f"""
numbered as (
  select *, row_number() over (partition by {keys} order by {position}) as pos from {source}
),
ends_ as (
  select {keys}, min_by("originCode", pos) as origin,
         max_by("destinationCode", pos) as destination, min(pos) as head
  from numbered group by {keys}
),
codes as (
  select g.*, row_number() over () as code_row from (
    select {', '.join('n.' + k for k in keys.split(', '))}, "destinationCode" as stop,
           min(pos) as at_
    from numbered n group by all
  ) g join ends_ e on {on}
  where stop <> origin and stop <> destination
),
stops as (
  select {keys}, string_agg(stop, ', ' order by at_) as layover, count(*) as n
  from codes group by {keys}
),
summary as (
  select {', '.join('n.' + k for k in keys.split(', '))}, n.* exclude ({keys}),
         e.origin, e.destination, coalesce(g.layover, '') as layover,
         cast(coalesce(g.n, 0) as integer) as "numStops"
  from ends_ e
  join numbered n on {on.replace('g.', 'n.')} and n.pos = e.head
  left join stops g on {on}
)"""


_ELEVEN = """fetch_date, "flightNumber", "formattedPrice", departure, duration,
  "marketingCarrier", "operatingCarrier", origin, destination, layover, "numStops\""""

_BY_LEG = f"with {_SEGMENTS},{_summary_ctes('segs', 'l_orderkey, leg_no', 'seg_pos')}"
_LEG_SUMMARY = f"{_BY_LEG} select itinerary_id, leg_id, {_ELEVEN} from summary"

_LINES = _ORDERS + """,
lines as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         l_orderkey as itinerary_id, fetch_date, "formattedPrice",
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as departure,
         cast(l_quantity as bigint) as duration,
         cast(l_partkey as varchar) as "flightNumber",
         'Supplier#' || lpad(cast(l_suppkey as varchar), 9, '0') as "marketingCarrier",
         'Operator ' || l_linestatus as "operatingCarrier",
         'N' || cast(l_suppkey % 25 as varchar) as "originCode",
         'N' || cast(l_partkey % 25 as varchar) as "destinationCode"
  from lineitem join orders_ on l_orderkey = o_orderkey
)"""
_LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice"

_VISITED = f"""with {_SEGMENTS},
visited as (
  select itinerary_id, leg_id, cast(count(*) as integer) as n,
         string_agg("destinationCode", ', ' order by seg_pos) as visited
  from segs group by itinerary_id, leg_id
)"""

_CONNECTIONS = f"""with {_SEGMENTS},
ahead as (
  select *, lead(leaves) over (partition by l_orderkey, leg_no order by seg_pos) as next_leaves
  from segs
)
select fetch_date, itinerary_id, leg_id, seg_pos, "destinationCode" as airport,
       cast(trunc((epoch(next_leaves) - epoch(lands)) / 60) as bigint) as minutes
from ahead where next_leaves is not null"""

_JSON_SCAN = f"""with {_RECORDS}
select fetch_date, record_id, true as status, total_results,
       cast(total_results as integer) as itineraries
from records"""

# Types of the nested store, from the innermost level out.
_SEGMENT_TYPE = (
    "struct<flightNumber:string,departure:string,arrival:string,"
    "marketingCarrier:struct<name:string>,operatingCarrier:struct<name:string>,"
    "origin:struct<displayCode:string>,destination:struct<displayCode:string>>")
_LEG_TYPE = (
    "struct<id:string,departure:string,arrival:string,durationInMinutes:bigint,"
    f"stopCount:bigint,segments:array<{_SEGMENT_TYPE}>>")
_ITINERARY_TYPE = (
    f"struct<id:string,price:struct<raw:double,formatted:string>,legs:array<{_LEG_TYPE}>>")
_CONTEXT_TYPE = "struct<status:string,sessionId:string,totalResults:bigint>"

# Path, type and the table whose rows hold one value each.
_PATHS = [
    ("status", "boolean", "records"),
    ("message", "string", "records"),
    ("data", f"struct<context:{_CONTEXT_TYPE},itineraries:array<{_ITINERARY_TYPE}>>", "records"),
    ("data.context", _CONTEXT_TYPE, "records"),
    ("data.context.status", "string", "records"),
    ("data.context.sessionId", "string", "records"),
    ("data.context.totalResults", "bigint", "records"),
    ("data.itineraries", f"array<{_ITINERARY_TYPE}>", "records"),
    ("data.itineraries.id", "string", "pages"),
    ("data.itineraries.price", "struct<raw:double,formatted:string>", "pages"),
    ("data.itineraries.price.raw", "double", "pages"),
    ("data.itineraries.price.formatted", "string", "pages"),
    ("data.itineraries.legs", f"array<{_LEG_TYPE}>", "pages"),
    ("data.itineraries.legs.id", "string", "legs"),
    ("data.itineraries.legs.departure", "string", "legs"),
    ("data.itineraries.legs.arrival", "string", "legs"),
    ("data.itineraries.legs.durationInMinutes", "bigint", "legs"),
    ("data.itineraries.legs.stopCount", "bigint", "legs"),
    ("data.itineraries.legs.segments", f"array<{_SEGMENT_TYPE}>", "legs"),
    ("data.itineraries.legs.segments.flightNumber", "string", "segs"),
    ("data.itineraries.legs.segments.departure", "string", "segs"),
    ("data.itineraries.legs.segments.arrival", "string", "segs"),
    ("data.itineraries.legs.segments.marketingCarrier", "struct<name:string>", "segs"),
    ("data.itineraries.legs.segments.marketingCarrier.name", "string", "segs"),
    ("data.itineraries.legs.segments.operatingCarrier", "struct<name:string>", "segs"),
    ("data.itineraries.legs.segments.operatingCarrier.name", "string", "segs"),
    ("data.itineraries.legs.segments.origin", "struct<displayCode:string>", "segs"),
    ("data.itineraries.legs.segments.origin.displayCode", "string", "segs"),
    ("data.itineraries.legs.segments.destination", "struct<displayCode:string>", "segs"),
    ("data.itineraries.legs.segments.destination.displayCode", "string", "segs"),
]

_INTROSPECTION = f"""with {_RECORDS},
legs as (select distinct l_orderkey, leg_no from segs)
""" + "\nunion all ".join(
    f"select '{path}' as path, '{kind}' as type, count(*) as present from {source}"
    for path, kind, source in _PATHS)

ORACLE = {
    "snapshot_discovery": f"with {_ORDERS} select distinct fetch_date from orders_",
    "json_scan": _JSON_SCAN,
    "multiline_json_scan": _JSON_SCAN,
    "snapshot_lineage": f"""with {_RECORDS}
select p.fetch_date, itinerary_id, "formattedPrice"
from pages p join orders_ on l_orderkey = o_orderkey""",
    "empty_snapshot_guard": f"""with {_RECORDS},
years as (select distinct year(o_orderdate) as y from orders)
select fetch_date, cast(sum(total_results) as bigint) as itineraries, 'complete' as status,
       'full' as state
from records group by fetch_date
union all select y || '-01-02', 0, 'failure', 'empty' from years
union all select y || '-01-03', 0, '', 'missing' from years""",
    "fault_isolated_read": f"""with {_RECORDS}
select fetch_date, 'accepted' as outcome, count(*) as records from records group by fetch_date
union all
select fetch_date, 'malformed record', count(*) from records group by fetch_date
union all
select 'none', 'folder is not a date', count(*) from records
union all
select year || day, 'file cannot be read', 1
from (select distinct cast(year(o_orderdate) as varchar) as year from orders),
     (select unnest(['-01-04', '-01-05']) as day)""",
    "batch_landing": f"""with {_RECORDS}
select fetch_date, 'accepted' as outcome, count(*) as records,
       cast(sum(total_results) as bigint) as itineraries
from records group by fetch_date
union all
select distinct cast(year(o_orderdate) as varchar) || '-01-02', 'accepted', 1, 0 from orders""",
    "batch_log": f"""with {_RECORDS}
select fetch_date, 'read' as state, count(*) as records from records group by fetch_date
union all
select distinct cast(year(o_orderdate) as varchar) || '-01-02', 'read', 1 from orders
union all
select year || day, 'unreadable', null
from (select distinct cast(year(o_orderdate) as varchar) as year from orders),
     (select unnest(['-01-04', '-01-05']) as day)""",
    "schema_align": f"""with {_SEGMENTS}
select fetch_date, itinerary_id, leg_id, count(*) - 1 as stop_count, true as operating_is_null,
       false as path_before, true as path_after
from segs group by fetch_date, itinerary_id, leg_id""",
    "union_by_name": """
select c_name as name, c_nationkey as nation, c_acctbal as balance, c_mktsegment as segment
from customer
union all select s_name, s_nationkey, s_acctbal, null from supplier
union all select n_name, n_nationkey, null, null from nation""",
    "empty_input_result": f"""with {_RECORDS}
select 'kept' as measure, cast(0 as bigint) as value
union all select 'rejected', count(*) from records
union all select 'summary rows', 0""",
    "schema_introspection": _INTROSPECTION,
    "id_list_scan": """
select cast(row_number() over (partition by doc_id // 500 order by doc_id) - 1 as integer) as rank,
       doc_id as id
from (select distinct doc_id from documents)""",
    "json_sink_roundtrip": _LEG_SUMMARY,
    "csv_sink_roundtrip": _LEG_SUMMARY,
    "parquet_sink_roundtrip": _LEG_SUMMARY,
    "partitioned_parquet_sink": f"""{_BY_LEG}
select itinerary_id, leg_id, {_ELEVEN.replace('fetch_date', 'fetch_date as search_date')}
from summary""",
    "incremental_ingest": """
select event_id, ts, user_id, value, strftime(ts, '%Y-%m-%d') as fetch_date from events""",
    "snapshot_replace": """
select event_id, user_id, case when day(ts) > 15 then value else -1.0 end as value,
       strftime(ts, '%Y-%m-%d') as fetch_date
from events""",
    "replaced_files": """
select event_id, user_id,
       case when day(ts) > 15 or day(ts) % 5 = 0 then value else -1.0 end as value,
       strftime(ts, '%Y-%m-%d') as fetch_date
from events where day(ts) % 7 <> 0""",
    "manifest_discovery": """
select strftime(ts, '%Y-%m-%d') as fetch_date, count(distinct event_id % 4) as files,
       case when any_value(day(ts)) % 2 = 0 or any_value(day(ts)) >= 19 then 2 else 1 end as listed_in
from events group by 1""",
    "schema_drift": """
with days as (select *, strftime(ts, '%Y-%m-%d') as fetch_date, day(ts) as d from events),
fields as (
  select 'event_id' as path, 'bigint' as type, 'read' as state, fetch_date from days
  where event_id is not null
  union all select 'user_id', 'bigint', 'read', fetch_date from days
  where d % 4 <> 0 and user_id is not null
  union all select 'event_type', 'string', 'read', fetch_date from days
  where event_type is not null
  union all select 'value', 'double', 'read', fetch_date from days
  where d <= 20 and value is not null
  union all select 'value', 'string', 'other type', fetch_date from days
  where d > 20 and value is not null
  union all select 'tags', 'array', 'not read', fetch_date from days where event_id % 3 = 0
  union all select path, type, 'not read', fetch_date from days, (values
      ('device', 'object'), ('device.kind', 'string'), ('device.users', 'array')) f(path, type)
  where d > 10
  union all select 'device.users.user_id', 'bigint', 'not read', fetch_date from days
  where d > 10 and user_id is not null
)
select path, type, state, min(fetch_date) as first_day, max(fetch_date) as last_day,
       count(*) as records
from fields group by all
union all
select 'ts', 'string', 'never found', null, null, 0""",
    "changed_files": """
with days as (
  select strftime(ts, '%Y-%m-%d') as fetch_date, day(ts) as d, count(distinct event_id % 4) as files
  from events group by all
)
select 1 as run, fetch_date, 'new' as change, files from days where d % 5 <> 0
union all
select 2, fetch_date, 'vanished', files from days where d % 5 <> 0 and d % 7 = 0
union all
select 2, fetch_date, 'changed', files from days where d % 5 <> 0 and d % 7 <> 0 and d > 15
union all
select 2, fetch_date, 'new', files from days where d % 5 = 0 and d % 7 <> 0""",
    "project_columns": """
select l_shipdate as departure, l_orderkey as itinerary, l_linenumber as segment,
       cast(l_partkey as varchar) as flight_number, l_extendedprice as price
from lineitem""",
    "nested_field_access": f"""with {_SEGMENTS}
select cast(l_orderkey // 64 as varchar) || '-' || cast(page as varchar) as record_id,
       itinerary_id, o_totalprice as price_raw, leg_id, seg_pos, "marketingCarrier" as marketing,
       "originCode" as origin
from segs""",
    "literal_column": """
select o_orderkey, '2025-03-06' as fetch_date, 'unknown' as operating, 0 as layover
from orders""",
    "derived_column": """
select l_orderkey, l_linenumber - 1 as l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       l_discount, round(l_extendedprice * (1 - l_discount), 4) as net
from lineitem""",
    "rename_column": """
select o_orderkey, o_totalprice as price, o_orderdate as departure from orders""",
    "conditional": f"""{_BY_LEG}
select itinerary_id, leg_id, layover, "numStops" as stops,
       origin is not distinct from destination as is_round
from summary""",
    "explode_level1": f"""with {_RECORDS},
legs as (select l_orderkey, page, count(distinct leg_no) as n from segs group by all)
select p.fetch_date, itinerary_id, "formattedPrice", cast(coalesce(n, 0) as integer) as legs
from pages p join orders_ on p.l_orderkey = o_orderkey
left join legs g on g.l_orderkey = p.l_orderkey and g.page = p.page""",
    "explode_level2": f"""with {_SEGMENTS}
select fetch_date, itinerary_id, "formattedPrice", leg_id, leg_pos, departure, arrival, duration,
       cast(count(*) as integer) as segments
from segs group by all""",
    "explode_level3": f"""with {_SEGMENTS}
select fetch_date, itinerary_id, leg_id, leg_pos, seg_pos, departure, duration, "flightNumber"
from segs""",
    "flatten_segments": f"""with {_SEGMENTS}
select itinerary_id, leg_id, leg_pos, seg_pos, {_TEN},
       strftime(leaves, '%Y-%m-%dT%H:%M:%S') as seg_departure,
       strftime(lands, '%Y-%m-%dT%H:%M:%S') as seg_arrival
from segs""",
    "explode_drops_empty": f"""with {_SEGMENTS}
select o.itinerary_id, coalesce(leg_id, 'none') as leg_id, leg_id is null as dropped
from orders_ o
left join (select distinct l_orderkey, leg_id from segs) on l_orderkey = o_orderkey""",
    "format_message": """
select c_name as name, n_name as craft,
       c_name || ' is currently in space flying on the ' || n_name || '! Hello! :)' as message
from customer join nation on c_nationkey = n_nationkey""",
    "record_count": """
select response, part, count(*) as number, cast(count(*) as integer) as listed
from (select c_custkey // 500 as response, (row_number() over (
          partition by c_custkey // 500 order by c_custkey, c_name, n_name) - 1) // 500 as part
      from customer join nation on c_nationkey = n_nationkey)
group by 1, 2""",
    "itinerary_summary": f"""with {_LINES},{_summary_ctes('lines', 'l_orderkey', _LINE_ORDER)}
select itinerary_id, {_ELEVEN} from summary""",
    "itinerary_summary_nested": _LEG_SUMMARY,
    "itinerary_summary_by_leg": _LEG_SUMMARY,
    "itinerary_summary_by_price": f"""with {_SEGMENTS},{_summary_ctes(
        'segs', 'fetch_date, "formattedPrice", departure', 'itinerary_id, leg_id, seg_pos')}
select {_ELEVEN} from summary""",
    "dedupe_segments": f"""with {_SEGMENTS}
select distinct {_TEN}, 0 as layover from (select * from segs union all select * from segs)""",
    "first_by_position": f"""
select l_orderkey, 'N' || cast(l_suppkey % 25 as varchar) as origin from (
  select *, row_number() over (partition by l_orderkey order by {_LINE_ORDER}) as pos
  from lineitem)
where pos = 1""",
    "last_by_position": f"""
select l_orderkey, 'N' || cast(l_partkey % 25 as varchar) as destination from (
  select *, row_number() over (partition by l_orderkey order by {_LINE_ORDER}) as pos,
         count(*) over (partition by l_orderkey) as n
  from lineitem)
where pos = n""",
    "ordered_collect": f"""{_VISITED}
select itinerary_id, leg_id, n, visited as layovers from visited""",
    "lead_next": """
select event_id, user_id, ts, value, lead(ts) over w as next_ts, lead(value) over w as next_value
from events window w as (partition by user_id order by ts, event_id)""",
    "gap_minutes_as_written": f"""with {_SEGMENTS},
ahead as (
  select *, lead(departure) over w as next_departure, lead(arrival) over w as next_arrival
  from segs
  window w as (partition by "flightNumber"
               order by departure, arrival, itinerary_id, leg_id, seg_pos)
)
select "flightNumber", itinerary_id, leg_id, seg_pos, next_departure, next_arrival,
       round((epoch(cast(next_departure as timestamp)) - epoch(cast(arrival as timestamp))) / 60.0,
             6) as layover_duration
from ahead""",
    "connection_minutes": _CONNECTIONS,
    "connection_minutes_flat": _CONNECTIONS,
    "order_by_snapshot": f"{_LEG_SUMMARY} order by fetch_date, itinerary_id, leg_id",
    "preview_limit": f"{_LEG_SUMMARY} order by fetch_date, itinerary_id, leg_id limit 1000",
    "array_except": f"""{_BY_LEG}
select itinerary_id, leg_id, replace(layover, ', ', '|') as stops, "numStops" as n from summary""",
    "array_join": f"{_VISITED} select itinerary_id, leg_id, visited from visited",
    "split_size": f"""{_BY_LEG}
select itinerary_id, leg_id, layover, greatest("numStops", 1) as parts from summary""",
    "timestamp_parse": """
select o_orderkey, o_orderdate as departure,
       try_cast(o_orderpriority as timestamp) is null as priority_is_no_time
from orders""",
    "date_partition_key": """
select strftime(o_orderdate, '%Y-%m-%d') as search_date, count(*) as orders
from orders group by 1""",
    "path_part": """
select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as fetch_date,
       cast(o_orderkey as varchar) || '.json' as file
from orders""",
}

ORACLE["merged_json_roundtrip"] = ORACLE["flatten_segments"]
