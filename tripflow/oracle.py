"""The same results as plain SQL over the test tables, for DuckDB.

Written from the definitions, not from the operators: rows are deduplicated by
a window, zones are found by an inequality join, and each step of the quality
funnel is its own count. Aggregates are rounded as in ``queries.rounded``.
"""

from __future__ import annotations

EVENT_COLUMNS = {
    "trip_id": "trip_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "trip_distance": "trip_distance_km",
    "fare_amount": "fare_amount",
    "payment_type": "payment_type",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
    "pickup_longitude": "pickup_longitude",
    "pickup_latitude": "pickup_latitude",
    "dropoff_longitude": "dropoff_longitude",
    "dropoff_latitude": "dropoff_latitude",
    "passenger_count": "passenger_count",
}
VOLUME_COLUMNS = dict(list(EVENT_COLUMNS.items())[:10])

RAW_EVENTS = """
copies as (
  select event_id, ts, user_id, value from events
  union all
  select event_id, ts, user_id, value from events where event_id % 50 = 0
  union all
  select event_id, ts, user_id, value + 7 from events where event_id % 53 = 0
),
raw as (
  select
    event_id as trip_id,
    case when event_id % 97 = 0 then null else cast(date_trunc('second', ts) as timestamp) end
      as tpep_pickup_datetime,
    case when event_id % 103 = 0 then null
         else cast(date_trunc('second', ts) as timestamp) + to_seconds((event_id * 7919) % 12000) end
      as tpep_dropoff_datetime,
    case when event_id % 101 = 0 then cast('nan' as double)
         when event_id % 211 = 0 then cast(500 as double)
         when event_id % 227 = 0 then cast(0 as double)
         else value / cast(10 as double) end as trip_distance,
    case when event_id % 223 = 0 then cast(1500 as double)
         else value * cast(1.5 as double) - cast(5 as double) end as fare_amount,
    case when event_id % 89 = 0 then null else cast(event_id % 8 as int) end as payment_type,
    cast(user_id % 30 as int) as "PULocationID",
    cast((user_id * 7 + event_id) % 30 as int) as "DOLocationID",
    cast(-74.25 as double) + cast((event_id * 31) % 500 as double) / cast(1000 as double)
      as pickup_longitude,
    cast(40.5 as double) + cast((event_id * 17) % 450 as double) / cast(1000 as double)
      as pickup_latitude,
    cast(-74.25 as double) + cast((event_id * 37) % 500 as double) / cast(1000 as double)
      as dropoff_longitude,
    cast(40.5 as double) + cast((event_id * 23) % 450 as double) / cast(1000 as double)
      as dropoff_latitude,
    cast(1 + event_id % 5 as int) as passenger_count
  from copies
)"""

RAW_VOLUME = """
lines as (
  select l.*, s_nationkey, c_nationkey,
         l_shipdate + to_seconds((l_orderkey * 7919 + l_linenumber * 104729) % 86400) as p
  from lineitem l
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join supplier on l_suppkey = s_suppkey
),
raw as (
  select l_orderkey * 10 + l_linenumber as trip_id,
         p as tpep_pickup_datetime,
         p + to_seconds((l_orderkey * 31 + l_linenumber * 977) % 12000) as tpep_dropoff_datetime,
         l_quantity as trip_distance,
         l_extendedprice / cast(100 as double) as fare_amount,
         cast((l_orderkey + l_linenumber) % 8 as int) as payment_type,
         s_nationkey as "PULocationID",
         c_nationkey as "DOLocationID",
         cast(-74.25 as double) + cast((l_orderkey * 31 + l_linenumber * 7) % 500 as double) / cast(1000 as double) as pickup_longitude,
         cast(40.5 as double) + cast((l_orderkey * 17 + l_linenumber * 3) % 450 as double) / cast(1000 as double) as pickup_latitude
  from lines
)"""


def _standard(columns: dict[str, str]) -> str:
    names = ", ".join(f'"{old}" as {new}' for old, new in columns.items())
    return f"standard as (select {names} from raw)"


CLEAN_KEYS = """
nonnull as (
  select * from standard
  where pickup_datetime is not null and dropoff_datetime is not null
    and trip_distance_km is not null and fare_amount is not null
),
clean_keys as (
  select * from nonnull where not isnan(trip_distance_km) and not isnan(fare_amount)
)"""


def _ranked(source: str, keys: list[str], columns: list[str]) -> str:
    rest = [c for c in columns if c not in keys]
    order = ", ".join(f"{c} asc nulls first" for c in rest)
    return (
        f"select {', '.join(columns)} from (select *, row_number() over "
        f"(partition by {', '.join(keys)} order by {order}) as rn from {source}) where rn = 1"
    )


def _order(columns: dict[str, str]) -> list[str]:
    first = ["trip_id", "fare_amount", "trip_distance_km"]
    return first + [c for c in columns.values() if c not in first]


def _deduped(columns: dict[str, str]) -> str:
    keys = ["pickup_datetime", "dropoff_datetime"]
    return f"cleaned as ({_ranked('clean_keys', keys, _order(columns))})"


DAY_NAME = """coalesce(case dayofweek(pickup_datetime)
    when 0 then 'Sunday' when 1 then 'Monday' when 2 then 'Tuesday' when 3 then 'Wednesday'
    when 4 then 'Thursday' when 5 then 'Friday' when 6 then 'Saturday' end, 'Unknown')"""


def _with_times(name: str, source: str) -> str:
    return f"""{name} as (
  select *,
    round(date_diff('second', pickup_datetime, dropoff_datetime) / cast(60 as double), 2)
      as trip_duration_min,
    cast(hour(pickup_datetime) as int) as hour_of_day,
    cast(dayofweek(pickup_datetime) + 1 as int) as day_of_week,
    {DAY_NAME} as day_name
  from {source}
)"""


DURATION_OK = "trip_duration_min between 1 and 180"
DISTANCE_OK = "trip_distance_km between 0.1 and 200"
FARE_OK = "fare_amount between 0 and 1000"
IDLE_OK = "not (trip_distance_km = 0 and trip_duration_min > 30)"
ALL_OK = f"{DISTANCE_OK} and {FARE_OK} and {IDLE_OK}"

LOOKUP = """lookup as (
  select n_nationkey as location_id, r_name as borough, n_name as zone_name,
         'Zone ' || cast(n_nationkey % 3 as varchar) as service_zone
  from nation join region on n_regionkey = r_regionkey
)"""


def _enriched() -> str:
    ends = "".join(
        f""", c.{end}_location_id as {end}_zone_id, {end[0]}.zone_name as {end}_zone_name,
    {end[0]}.borough as {end}_borough, {end[0]}.service_zone as {end}_service_zone"""
        for end in ("pickup", "dropoff")
    )
    return f"""{LOOKUP},
enriched as (
  select c.*{ends}
  from curated c
  left join lookup p on c.pickup_location_id = p.location_id
  left join lookup d on c.dropoff_location_id = d.location_id
)"""


def _prelude(raw: str, columns: dict[str, str]) -> str:
    parts = [
        raw.strip(),
        _standard(columns),
        CLEAN_KEYS.strip(),
        _deduped(columns),
        _with_times("timed", "standard"),
        _with_times("derived", "cleaned"),
        f"curated as (select * from derived where {DURATION_OK} and {ALL_OK})",
        _enriched(),
    ]
    return "with " + ",\n".join(parts) + "\n"


EVENTS = _prelude(RAW_EVENTS, EVENT_COLUMNS)
VOLUME = _prelude(RAW_VOLUME, VOLUME_COLUMNS)

DEMAND = """count(*) as total_trips,
  cast(round(cast(avg(trip_duration_min) as decimal(38, 9)), 6) as double) as avg_duration_min,
  cast(round(cast(avg(trip_distance_km) as decimal(38, 9)), 6) as double) as avg_distance_km,
  cast(round(cast(sum(fare_amount) as decimal(38, 9)), 6) as double) as total_revenue,
  cast(round(cast(avg(fare_amount) as decimal(38, 9)), 6) as double) as avg_fare_amount"""

BY_HOUR = f"select hour_of_day, {DEMAND} from curated group by hour_of_day"
BY_DAY = f"""select day_of_week, day_name, {DEMAND},
  case when day_of_week in (1, 7) then 'Weekend' else 'Weekday' end as is_weekend
from curated group by day_of_week, day_name"""

CLOSED_HOURS = f"""select hour_start, hour_start + interval 1 hour as hour_end, * exclude (hour_start)
from (select cast(date_trunc('hour', pickup_datetime) as timestamp) as hour_start, {DEMAND}
      from curated group by 1)
where hour_start + interval 1 hour
      <= (select max(pickup_datetime) - interval 2 hour from curated)"""

# Trips that arrive twelve days late belong to hours that are closed by then; only they are missing.
CLOSED_HOURS_ON_TIME = CLOSED_HOURS.replace("from curated group by 1", "from curated where trip_id % 61 <> 0 group by 1")

CLOSED_TRIPS = """select * from cleaned
where pickup_datetime <= (select max(pickup_datetime) - interval 2 hour from clean_keys)"""

ARRIVED = """arrived as (
  select *, (cast(pickup_datetime + to_seconds(abs(trip_id * 7919 + cast(floor(fare_amount) as bigint) * 131) % 6600)
             as date) - date '1970-01-01') // 5 as arrival_batch
  from curated
)"""
ZONE_VERSIONS = """select trip_id, pickup_location_id as pickup_zone_id,
  case when batch <= 3 then zone_name else zone_name || ' (2)' end as pickup_zone_name, borough as pickup_borough
from (select *, dense_rank() over (order by arrival_batch) as batch from arrived)
left join lookup on pickup_location_id = location_id"""

ENDS = """(select pickup_zone_id as zone_id, pickup_zone_name as zone_name, fare_amount from enriched
  union all
  select dropoff_zone_id, dropoff_zone_name, fare_amount from enriched)"""
BY_ZONE = f"""select zone_id, zone_name, count(*) as total_activity,
  cast(round(cast(sum(fare_amount) as decimal(38, 9)), 6) as double) as total_revenue, cast(round(cast(avg(fare_amount) as decimal(38, 9)), 6) as double) as avg_fare
from {ENDS} group by zone_id, zone_name"""

PAYMENT_NAME = """case
  when payment_type is null or payment_type = 0 then 'Unknown/Not Specified'
  when payment_type = 1 then 'Credit Card'
  when payment_type = 2 then 'Cash'
  when payment_type = 3 then 'No Charge'
  when payment_type = 4 then 'Dispute'
  when payment_type = 5 then 'Unknown'
  when payment_type = 6 then 'Voided Trip'
  else 'Other (' || cast(payment_type as varchar) || ')' end"""

BY_PAYMENT = f"""select payment_type, {PAYMENT_NAME} as payment_type_name,
  count(*) as total_trips, cast(round(cast(sum(fare_amount) as decimal(38, 9)), 6) as double) as total_revenue,
  cast(round(cast(avg(fare_amount) as decimal(38, 9)), 6) as double) as avg_revenue_per_trip
from curated group by payment_type"""


def _top_end(end: str, label: str) -> str:
    return f"""select {end}_zone_id, {end}_zone_name, count(*) as total_trips_{label},
  cast(round(cast(sum(fare_amount) as decimal(38, 9)), 6) as double) as total_revenue_{label}, cast(round(cast(avg(fare_amount) as decimal(38, 9)), 6) as double) as avg_fare_{label}
from enriched group by {end}_zone_id, {end}_zone_name
order by total_trips_{label} desc, {end}_zone_id, {end}_zone_name nulls last limit 10"""


def _spans() -> str:
    return ", ".join(
        f"cast(round(cast({f}(trip_{c}) as decimal(38, 9)), 6) as double) as {f}_{c}"
        for c in ("duration_min", "distance_km")
        for f in ("avg", "min", "max")
    )


FUNNEL_STEPS = {
    # step: (rows that arrive, rule that good rows meet, rows the rule is judged on)
    "not_null pickup_datetime": "pickup_datetime is not null",
    "not_null dropoff_datetime": "dropoff_datetime is not null",
    "not_null trip_distance_km": "trip_distance_km is not null",
    "not_nan trip_distance_km": "not coalesce(isnan(trip_distance_km), false)",
    "not_null fare_amount": "fare_amount is not null",
    "not_nan fare_amount": "not coalesce(isnan(fare_amount), false)",
}
RANGE_STEPS = {
    "duration": DURATION_OK,
    "distance": DISTANCE_OK,
    "fare": FARE_OK,
    "zero_distance": IDLE_OK,
}


def _funnel() -> str:
    steps = [("raw", "(select count(*) from standard)", "cast(0 as bigint)")]
    met: list[str] = []
    for step, rule in FUNNEL_STEPS.items():
        met.append(rule)
        steps.append(
            (
                step,
                f"(select count(*) from standard where {' and '.join(met)})",
                f"(select count(*) from standard where not ({rule}))",
            )
        )
    steps.append(
        (
            "dedupe",
            "(select count(*) from cleaned)",
            "(select count(*) from clean_keys) - (select count(*) from cleaned)",
        )
    )
    met = []
    for step, rule in RANGE_STEPS.items():
        met.append(rule)
        steps.append(
            (
                step,
                f"(select count(*) from derived where {' and '.join(met)})",
                f"(select count(*) from derived) - (select count(*) from derived where {rule})",
            )
        )
    rows = " union all ".join(
        f"select cast({i} as int) as step_no, '{step}' as step, {after} as rows_after, {bad} as rows_failing"
        for i, (step, after, bad) in enumerate(steps)
    )
    return f"""select step_no, step, rows_before, rows_after,
  rows_before - rows_after as rows_removed, rows_failing
from (select *, coalesce(lag(rows_after) over (order by step_no), rows_after) as rows_before
      from ({rows}))"""


def _boxes(table: str, key: str, name: str, west: str, south: str, width: int, height: int) -> str:
    def edge(steps: str) -> str:
        return f"cast({steps} as double) / cast(1000 as double)"

    return f"""boxes as (
  select cast({key} + 1 as int) as zone_id, {name} as zone_name,
    {edge(west)} as min_longitude, {edge(f'{west} + {width}')} as max_longitude,
    {edge(south)} as min_latitude, {edge(f'{south} + {height}')} as max_latitude
  from {table}
)"""


NATION_BOXES = _boxes(
    "nation", "n_nationkey", "n_name", "(-74250 + n_nationkey % 5 * 100)",
    "(40500 + n_nationkey // 5 * 90)", 120, 70,
)
CUSTOMER_BOXES = _boxes(
    "customer", "c_custkey", "c_name", "(-74250 + c_custkey * 7919 % 500)",
    "(40500 + c_custkey * 104729 % 450)", 9, 6,
)
GRID = """bounds as (
  select min(pickup_longitude) as x0, max(pickup_longitude) as x1,
         min(pickup_latitude) as y0, max(pickup_latitude) as y1 from curated
),
boxes as (
  select cast(i + 1 as int) as zone_id, 'Zone_' || cast(i + 1 as varchar) as zone_name,
    x0 + (i % 4) * ((x1 - x0) / 4.0::double) as min_longitude,
    x0 + (i % 4 + 1) * ((x1 - x0) / 4.0::double) as max_longitude,
    y0 + (i // 4) * ((y1 - y0) / 4.0::double) as min_latitude,
    y0 + (i // 4 + 1) * ((y1 - y0) / 4.0::double) as max_latitude
  from bounds, range(16) t(i)
)"""


def _matched(end: str, source: str, target: str, join: str) -> str:
    """Lowest box per trip; trips of ``source`` are told apart by their times."""
    return f"""{target} as (
  select * exclude (rn) from (
    select t.*, z.zone_id as {end}_zone_id, z.zone_name as {end}_zone_name,
      row_number() over (partition by pickup_datetime, dropoff_datetime order by z.zone_id) as rn
    from {source} t {join} join boxes z
      on t.{end}_longitude between z.min_longitude and z.max_longitude
     and t.{end}_latitude between z.min_latitude and z.max_latitude
  ) where rn = 1
)"""


def _zone_of(boxes: str, end: str, join: str = "inner", trips: str | None = None) -> str:
    return (
        (trips or EVENTS).rstrip()
        + f",\n{boxes},\n{_matched(end, 'curated', 'matched', join)}\n"
        + f"select trip_id, {end}_longitude, {end}_latitude, {end}_zone_id, {end}_zone_name from matched"
    )


def _summary() -> str:
    return f"""select total_trips, peak_hour, peak_hour_trips, busiest_day, busiest_day_trips,
  most_active_zone_id, most_active_zone, most_active_zone_trips, total_revenue
from (select count(*) as total_trips, cast(round(cast(sum(fare_amount) as decimal(38, 9)), 6) as double) as total_revenue from enriched),
  (select hour_of_day as peak_hour, count(*) as peak_hour_trips from enriched
   group by hour_of_day order by 2 desc, 1 limit 1),
  (select day_name as busiest_day, count(*) as busiest_day_trips from enriched
   group by day_of_week, day_name order by 2 desc, day_of_week limit 1),
  (select zone_id as most_active_zone_id, zone_name as most_active_zone,
          total_activity as most_active_zone_trips
   from ({BY_ZONE}) order by total_activity desc, zone_id, zone_name nulls last limit 1)"""


GROUPINGS = {
    "hour": ["hour_of_day"],
    "day": ["day_of_week", "day_name"],
    "origin": ["pickup_zone_id", "pickup_zone_name"],
    "destination": ["dropoff_zone_id", "dropoff_zone_name"],
    "zone_name": ["pickup_zone_name"],
    "payment": ["payment_type"],
    "all": [],
}


def _report_groups() -> str:
    every = list(dict.fromkeys(c for keys in GROUPINGS.values() for c in keys))
    parts = []
    for name, keys in GROUPINGS.items():
        kept = ", ".join(c if c in keys else f"null as {c}" for c in every)
        tail = f" group by {', '.join(keys)}" if keys else ""
        parts.append(
            f"select '{name}' as \"grouping\", {kept}, count(*) as total_trips, "
            "cast(round(cast(sum(fare_amount) as decimal(38, 9)), 6) as double) as total_revenue, count(fare_amount) as priced_trips, "
            f"cast(round(cast(avg(fare_amount) as decimal(38, 9)), 6) as double) as avg_fare_amount, {_spans()} from enriched{tail}"
        )
    return " union all ".join(parts)


OVERVIEW_TYPES = {
    "trip_id": "bigint",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "trip_distance": "double",
    "fare_amount": "double",
    "payment_type": "int",
    "PULocationID": "int",
    "DOLocationID": "int",
    "pickup_longitude": "double",
    "pickup_latitude": "double",
    "dropoff_longitude": "double",
    "dropoff_latitude": "double",
    "passenger_count": "int",
}


def _overview() -> str:
    rows = ", ".join(
        f"({i}, '{name}', '{kind}')" for i, (name, kind) in enumerate(OVERVIEW_TYPES.items(), 1)
    )
    return f"""select cast(position as int) as position, column_name, data_type,
  (select count(*) from raw) as total_records, cast({len(OVERVIEW_TYPES)} as int) as total_columns
from (values {rows}) v(position, column_name, data_type)"""


def _null_profile() -> str:
    def missing(name: str, kind: str) -> str:
        nan = f' or isnan("{name}")' if kind == "double" else ""
        return f"""select '{name}' as column_name,
  (select count(*) from raw where "{name}" is null{nan}) as missing"""

    return " union all ".join(missing(n, k) for n, k in OVERVIEW_TYPES.items())


TEXT_TIMES = """texts as (
  select trip_id,
    case when trip_id % 41 = 0 then 'n/a' else cast(tpep_pickup_datetime as varchar) end as p,
    case when trip_id % 43 = 0 then cast(tpep_dropoff_datetime as varchar) || '.5'
         else cast(tpep_dropoff_datetime as varchar) end as d
  from raw
)"""

BY_TRIP_ID = [
    "trip_id", "pickup_datetime", "payment_type", "pickup_location_id", "dropoff_location_id",
    "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
    "passenger_count",
]


PREVIEWS = {
    "curated": [
        "pickup_datetime", "dropoff_datetime", "trip_duration_min", "hour_of_day", "day_of_week",
        "day_name", "trip_distance_km", "fare_amount", "passenger_count",
    ],
    "enriched": [
        "pickup_datetime", "hour_of_day", "day_name", "pickup_zone_name", "dropoff_zone_name",
        "trip_duration_min", "trip_distance_km", "fare_amount",
    ],
}


def _preview(table: str) -> str:
    columns = PREVIEWS[table]
    order = ", ".join(f"{c} asc nulls first" for c in columns)
    return f"select {', '.join(columns)} from {table} order by {order} limit 10"


def all_oracles() -> dict[str, str]:
    def events(select: str) -> str:
        return EVENTS + select

    def volume(select: str) -> str:
        return VOLUME + select

    both = "pickup_zone_id, pickup_zone_name, dropoff_zone_id, dropoff_zone_name"
    every = ", ".join(EVENT_COLUMNS.values())
    lookup_end = {
        end: f"""select c.*, c.{end}_location_id as {end}_zone_id, l.zone_name as {end}_zone_name,
  l.borough as {end}_borough, l.service_zone as {end}_service_zone
from curated c left join lookup l on c.{end}_location_id = l.location_id"""
        for end in ("pickup", "dropoff")
    }
    activity = f"{BY_ZONE} order by total_activity desc, zone_id, zone_name nulls last"
    return {
        "scan_trips": "select * from lineitem",
        "trips_raw": events("select * from raw"),
        "zone_lookup": f"with {LOOKUP} select * from lookup",
        "dataset_overview": events(_overview()),
        "dataset_preview": events(
            "select * from raw order by "
            + ", ".join(f'"{c}" asc nulls first' for c in EVENT_COLUMNS)
            + " limit 5"
        ),
        "standardize_columns": events("select * from standard"),
        "drop_null_keys": events("select * from nonnull"),
        "drop_nan_keys": events(
            "select * from standard where not isnan(trip_distance_km) and not isnan(fare_amount)"
        ),
        "dedupe_trips": events("select * from cleaned"),
        "clean_trips": events("select * from cleaned"),
        "dedupe_by_trip_id": events(_ranked("standard", ["trip_id"], BY_TRIP_ID)),
        "dedupe_by_text_id": events(
            "select coalesce('t-' || cast(trip_id as varchar), null) as trip_id, * exclude (trip_id) from ("
            + _ranked("standard", ["trip_id"], BY_TRIP_ID)
            + ")"
        ),
        "parse_timestamps": EVENTS.rstrip()
        + f",\n{TEXT_TIMES}\n"
        + """select trip_id,
  try_strptime(p, '%Y-%m-%d %H:%M:%S') as pickup_datetime,
  try_strptime(d, '%Y-%m-%d %H:%M:%S') as dropoff_datetime
from texts""",
        "trip_duration": events(
            "select trip_id, pickup_datetime, dropoff_datetime, trip_duration_min from timed"
        ),
        "hour_of_day": events("select trip_id, hour_of_day from timed"),
        "day_of_week": events("select trip_id, day_of_week from timed"),
        "day_name": events("select trip_id, day_name from timed"),
        "derive_trips": events(f"select * from timed where {DURATION_OK}"),
        "filter_duration": events(f"select trip_id, trip_duration_min from timed where {DURATION_OK}"),
        "filter_duration_keep_null": events(
            "select trip_id, trip_duration_min from timed "
            f"where trip_duration_min is null or {DURATION_OK}"
        ),
        "filter_distance": events(f"select trip_id, trip_distance_km from timed where {DISTANCE_OK}"),
        "filter_fare": events(f"select trip_id, fare_amount from timed where {FARE_OK}"),
        "filter_zero_distance": events(
            f"select trip_id, trip_distance_km, trip_duration_min from timed where {IDLE_OK}"
        ),
        "filter_outliers": events(
            "select trip_id, trip_distance_km, trip_duration_min, fare_amount from timed "
            f"where {ALL_OK}"
        ),
        "null_profile": events(_null_profile()),
        "quality_funnel": events(_funnel()),
        "data_quality_rate": events(
            """select initial_records, cleaned_records, final_records,
  cast(round(cast(final_records / cast(initial_records as double) as decimal(38, 9)), 6) as double) as quality_rate
from (select count(*) as initial_records from raw),
     (select count(*) as cleaned_records from cleaned),
     (select count(*) as final_records from curated)"""
        ),
        "curated_trips": events("select * from curated"),
        "curated_preview": events(_preview("curated")),
        "enriched_preview": events(_preview("enriched")),
        "enrich_pickup_lookup": events(lookup_end["pickup"]),
        "enrich_dropoff_lookup": events(lookup_end["dropoff"]),
        "enriched_trips": events("select * from enriched"),
        "zone_name_fallback": events(
            """select trip_id, pickup_location_id as pickup_zone_id,
  'Zone_' || cast(pickup_location_id as varchar) as pickup_zone_name,
  dropoff_location_id as dropoff_zone_id,
  'Zone_' || cast(dropoff_location_id as varchar) as dropoff_zone_name
from curated"""
        ),
        "zone_of_pickup_point": _zone_of(NATION_BOXES, "pickup"),
        "zone_of_dropoff_point": _zone_of(NATION_BOXES, "dropoff"),
        "zone_first_match": _zone_of(NATION_BOXES, "pickup", "left"),
        "zone_of_point_many_boxes": _zone_of(CUSTOMER_BOXES, "pickup", "left"),
        "zone_of_point_shuffled": _zone_of(CUSTOMER_BOXES, "pickup"),
        "enriched_by_box": EVENTS.rstrip()
        + f",\n{NATION_BOXES},\n{_matched('pickup', 'curated', 'at_pickup', 'inner')},\n"
        + f"{_matched('dropoff', 'at_pickup', 'matched', 'inner')}\n"
        + f"select {every}, trip_duration_min, hour_of_day, day_of_week, day_name, {both} from matched",
        "coordinate_bounds": events(
            """select min(pickup_longitude) as min_longitude, max(pickup_longitude) as max_longitude,
  min(pickup_latitude) as min_latitude, max(pickup_latitude) as max_latitude from curated"""
        ),
        "grid_zones": EVENTS.rstrip()
        + f",\n{GRID}\nselect zone_id, zone_name, round(min_longitude, 9) as min_longitude, "
        "round(max_longitude, 9) as max_longitude, round(min_latitude, 9) as min_latitude, "
        "round(max_latitude, 9) as max_latitude from boxes",
        "enriched_by_grid": _zone_of(GRID, "pickup", "left"),
        "enriched_by_box_volume": _zone_of(CUSTOMER_BOXES, "pickup", "left", VOLUME),
        "enriched_by_grid_volume": _zone_of(GRID, "pickup", "left", VOLUME),
        "total_amount_fare": events("select trip_id, fare_amount from standard"),
        "zone_coverage": events(
            """select count(*) as total_trips, count(pickup_zone_name) as with_pickup_zone,
  count(dropoff_zone_name) as with_dropoff_zone from enriched"""
        ),
        "demand_by_hour": events(BY_HOUR),
        "demand_by_day": events(BY_DAY),
        "weekday_weekend": events(
            """select case when day_of_week in (1, 7) then 'Weekend' else 'Weekday' end as is_weekend,
  count(*) as total_trips, cast(round(cast(sum(fare_amount) as decimal(38, 9)), 6) as double) as total_revenue from curated group by 1"""
        ),
        "peak_hour": events(f"{BY_HOUR} order by total_trips desc, hour_of_day limit 1"),
        "busiest_day": events(f"{BY_DAY} order by total_trips desc, day_of_week limit 1"),
        "quietest_day": events(f"{BY_DAY} order by total_trips, day_of_week limit 1"),
        "hour_extremes": events(
            f"""select h.hour_of_day as peak_hour, h.total_trips as peak_trips,
  l.hour_of_day as lowest_hour, l.total_trips as lowest_trips, avg_trips_per_hour
from (select hour_of_day, total_trips from ({BY_HOUR}) order by 2 desc, 1 limit 1) h,
     (select hour_of_day, total_trips from ({BY_HOUR}) order by 2, 1 limit 1) l,
     (select cast(round(cast(avg(total_trips) as decimal(38, 9)), 6) as double) as avg_trips_per_hour from ({BY_HOUR}))"""
        ),
        "duration_distance_by_hour": events(
            f"select hour_of_day, {_spans()} from curated group by hour_of_day"
        ),
        "duration_distance_by_zone": events(
            """select pickup_zone_name, cast(round(cast(avg(trip_duration_min) as decimal(38, 9)), 6) as double) as avg_duration_min,
  cast(round(cast(avg(trip_distance_km) as decimal(38, 9)), 6) as double) as avg_distance_km, count(*) as trip_count
from enriched group by pickup_zone_name"""
        ),
        "top_origin_zones": events(_top_end("pickup", "origin")),
        "top_destination_zones": events(_top_end("dropoff", "destination")),
        "zone_activity": events(f"{activity} limit 20"),
        "most_active_zone": events(f"{activity} limit 1"),
        "revenue_by_zone": events(BY_ZONE),
        "payment_distribution": events(
            'select payment_type, count(*) as "count" from curated group by payment_type'
        ),
        "payment_names": events(
            f"select trip_id, payment_type, {PAYMENT_NAME} as payment_type_name from curated"
        ),
        "revenue_by_payment": events(BY_PAYMENT),
        "total_revenue": events("select cast(round(cast(sum(fare_amount) as decimal(38, 9)), 6) as double) as total_revenue from curated"),
        "revenue_per_trip": events(
            """select count(*) as total_trips, cast(round(cast(sum(fare_amount) as decimal(38, 9)), 6) as double) as total_revenue,
  cast(round(cast(avg(fare_amount) as decimal(38, 9)), 6) as double) as avg_revenue_per_trip from curated"""
        ),
        "revenue_split": events(
            """select case when payment_type = 1 then 'Credit Card' when payment_type = 2 then 'Cash'
    else 'Other' end as payment_group,
  count(*) as total_trips, cast(round(cast(sum(fare_amount) as decimal(38, 9)), 6) as double) as total_revenue,
  cast(round(cast(avg(fare_amount) as decimal(38, 9)), 6) as double) as avg_revenue_per_trip
from curated group by 1"""
        ),
        "total_trips": events("select count(*) as total_trips from enriched"),
        "summary": events(_summary()),
        "report_groups": events(_report_groups()),
        "closed_hours": events(CLOSED_HOURS),
        "stream_hourly_demand": events(CLOSED_HOURS),
        "stream_hourly_batches": events(CLOSED_HOURS_ON_TIME),
        "stream_dedupe_trips": events(CLOSED_TRIPS),
        "stream_zone_names": EVENTS.rstrip() + f",\n{ARRIVED}\n{ZONE_VERSIONS}",
        "scan_unlike_files": events(
            "select trip_id, pickup_location_id, fare_amount, passenger_count, "
            "case when trip_id % 3 = 2 then 'text' end as note from standard"
        ),
        "zone_lookup_checked": events("select * from lookup where location_id % 7 not in (0, 1, 2)"),
        "incremental_curation": events("select * from curated"),
        "stored_table": events("select trip_id, payment_type, fare_amount from curated"),
        "json_array_export": events(BY_PAYMENT),
        "curated_trips_volume": volume("select * from curated"),
        "quality_funnel_volume": volume(_funnel()),
        "demand_by_hour_volume": volume(BY_HOUR),
        "demand_by_day_volume": volume(BY_DAY),
        "zone_activity_volume": volume(f"{activity} limit 20"),
        "revenue_by_payment_volume": volume(BY_PAYMENT),
        "summary_volume": volume(_summary()),
        "report_groups_volume": volume(_report_groups()),
    }
