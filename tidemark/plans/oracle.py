"""DuckDB statements that give the same rows as the registered queries."""

from __future__ import annotations

TRIPS = """
  select event_id as trip_id,
         cast(user_id as int) as pickup_zip,
         cast((user_id * 7 + event_id * 13) % 97 as int) as dropoff_zip,
         ts as pickup_ts,
         ts + to_minutes(cast(5 + event_id % 56 as int)) as dropoff_ts,
         cast(event_id % 200 as double) / 10 as trip_distance,
         value as fare_amount
  from events
"""

WEEKEND = "cast(isodow(({0} at time zone 'UTC') at time zone 'America/New_York') >= 6 as int)"


def pickup_sql(where: str = "true") -> str:
    return f"""
      select zip, ts,
             cast(avg(fare_amount) as float) as mean_fare_window_1h_pickup_zip,
             cast(count(*) as int) as count_trips_window_1h_pickup_zip
      from (
        select pickup_zip as zip, fare_amount,
               time_bucket(interval '15 minutes', pickup_ts, timestamp '1970-01-01')
                 - k * interval '15 minutes' + interval '1 hour' as ts
        from trips, generate_series(0, 3) g(k)
        where {where}
      ) x group by zip, ts
    """


DROPOFF = f"""
  select zip, ts, count_trips_window_30m_dropoff_zip, {WEEKEND.format("ts")} as dropoff_is_weekend
  from (
    select dropoff_zip as zip,
           time_bucket(interval '30 minutes', dropoff_ts, timestamp '1970-01-01')
             + interval '30 minutes' as ts,
           cast(count(*) as int) as count_trips_window_30m_dropoff_zip
    from trips group by 1, 2
  ) x
"""

PICKUP_NAMES = "mean_fare_window_1h_pickup_zip, count_trips_window_1h_pickup_zip"
DROPOFF_NAMES = "count_trips_window_30m_dropoff_zip, dropoff_is_weekend"


def with_(**parts: str) -> str:
    body = ", ".join(f"{name} as ({sql})" for name, sql in parts.items())
    return f"with trips as ({TRIPS}){', ' + body if body else ''} "


def pit_sql(op: str) -> str:
    return (
        with_(p=pickup_sql())
        + f"select t.*, {PICKUP_NAMES}, p.ts as feature_ts from trips t asof left join p "
        f"on t.pickup_zip = p.zip and t.pickup_ts {op} p.ts"
    )


def ties_sql(op: str) -> str:
    return (
        with_(
            p=pickup_sql(),
            t="select trip_id, pickup_zip, time_bucket(interval '15 minutes', pickup_ts, "
            "timestamp '1970-01-01') as lookup_ts from trips",
        )
        + f"select t.*, {PICKUP_NAMES}, p.ts as feature_ts from t asof left join p "
        f"on t.pickup_zip = p.zip and t.lookup_ts {op} p.ts"
    )


MAX_AGE = with_(p=pickup_sql()) + """
  select t.*,
         case when p.ts >= t.pickup_ts - interval '6 hours' then mean_fare_window_1h_pickup_zip end
           as mean_fare_window_1h_pickup_zip,
         case when p.ts >= t.pickup_ts - interval '6 hours' then count_trips_window_1h_pickup_zip end
           as count_trips_window_1h_pickup_zip,
         case when p.ts >= t.pickup_ts - interval '6 hours' then p.ts end as feature_ts
  from trips t asof left join p on t.pickup_zip = p.zip and t.pickup_ts > p.ts
"""

JOINED = (
    "trips t asof left join p on t.pickup_zip = p.zip and t.pickup_ts > p.ts "
    "asof left join d on t.dropoff_zip = d.zip and t.dropoff_ts > d.ts"
)
TRAINING = (
    with_(p=pickup_sql(), d=DROPOFF)
    + f"select trip_id, pickup_zip, dropoff_zip, trip_distance, fare_amount, {PICKUP_NAMES}, "
    f"{DROPOFF_NAMES} from {JOINED}"
)


def bucket_sql(seed: int, key: str = "trip_id") -> str:
    return f"(cast('0x' || substr(md5('{seed}:' || {key}), 1, 8) as bigint) % 10000)"


SPLIT = f"case when {bucket_sql(123)} < 7500 then 'train' else 'test' end"

MATRIX_COLUMNS = [
    "pickup_zip",
    "dropoff_zip",
    "trip_distance",
    *PICKUP_NAMES.split(", "),
    *DROPOFF_NAMES.split(", "),
]
MATRIX = (
    with_(p=pickup_sql(), d=DROPOFF)
    + f"select trip_id, fare_amount, {SPLIT} as split, "
    + ", ".join(f"coalesce(cast({c} as double), 0.0) as {c}" for c in MATRIX_COLUMNS)
    + ", "
    + ", ".join(f"cast({c} is null as int) as {c}_missing" for c in MATRIX_COLUMNS)
    + f" from {JOINED}"
)

FIRST_CUT = (
    "(select date_trunc('day', min(pickup_ts) + interval 1 day) "
    "+ to_microseconds(microsecond(min(pickup_ts)) % 1000000) from trips)"
)


def next_cut(high: str) -> str:
    return (
        f"(date_trunc('day', {high} + interval 2 day) "
        f"+ to_microseconds(microsecond({high}) % 1000000))"
    )


STEP = (
    with_(h=f"select max(pickup_ts) as hi from trips where pickup_ts <= {FIRST_CUT}")
    + f"select trips.* from trips, h where pickup_ts > hi and pickup_ts <= {next_cut('hi')}"
)

DRAIN = f"""
  with recursive trips as ({TRIPS}),
  rounds as (
    select 0 as number, (select max(pickup_ts) from trips where pickup_ts <= {FIRST_CUT}) as hi
    union all
    select number + 1,
           (select max(t.pickup_ts) from trips t
            where t.pickup_ts > rounds.hi and t.pickup_ts <= {next_cut("rounds.hi")})
    from rounds where hi is not null
  )
  select cast(pickup_ts as date) as day, count(*) as n_rows,
         min(pickup_ts) as min_ts, max(pickup_ts) as max_ts,
         (select count(*) from rounds where hi is not null) as n_rounds
  from trips where pickup_ts <= (select max(hi) from rounds)
  group by 1
"""

BY_DAY = with_() + """
  select cast(pickup_ts as date) as day, count(*) as n_rows,
         min(pickup_ts) as min_ts, max(pickup_ts) as max_ts
  from trips group by 1
"""

OLD_HALF = pickup_sql("pickup_ts < timestamp '2024-01-16'")
NEW_HALF = pickup_sql("pickup_ts >= timestamp '2024-01-11'")

MERGE = with_(o=OLD_HALF, n=NEW_HALF) + """
  select * from n
  union all
  select o.* from o where not exists (select 1 from n where n.zip = o.zip and n.ts = o.ts)
"""

CHANGES = (
    with_(
        o=pickup_sql("pickup_ts < timestamp '2024-01-21 10:07:00'"),
        n=pickup_sql("pickup_ts >= timestamp '2024-01-11 10:07:00'"),
        pairs=f"""
          select o.* , n.mean_fare_window_1h_pickup_zip as n_mean,
                 n.count_trips_window_1h_pickup_zip as n_count
          from o join n using (zip, ts)
          where o.mean_fare_window_1h_pickup_zip is distinct from n.mean_fare_window_1h_pickup_zip
             or o.count_trips_window_1h_pickup_zip is distinct from n.count_trips_window_1h_pickup_zip
        """,
    )
    + f"""
  select zip, ts, {PICKUP_NAMES}, 'delete' as change_type from o anti join n using (zip, ts)
  union all
  select zip, ts, {PICKUP_NAMES}, 'insert' from n anti join o using (zip, ts)
  union all
  select zip, ts, {PICKUP_NAMES}, 'update_preimage' from pairs
  union all
  select zip, ts, n_mean, n_count, 'update_postimage' from pairs
"""
)

VIOLATIONS = with_() + """
  select zip, ts, n_rows, case when zip is null then 'null key' else 'duplicate key' end as reason
  from (
    select nullif(pickup_zip, dropoff_zip) as zip,
           time_bucket(interval '1 hour', pickup_ts, timestamp '1970-01-01') as ts,
           count(*) as n_rows
    from trips group by 1, 2
  ) x where zip is null or n_rows > 1
"""


def newest_sql(source: str) -> str:
    return f"""
      select zip, max(ts) as ts,
             arg_max_null(mean_fare_window_1h_pickup_zip, ts) as mean_fare_window_1h_pickup_zip,
             arg_max_null(count_trips_window_1h_pickup_zip, ts) as count_trips_window_1h_pickup_zip
      from ({source}) x group by zip
    """


# Both published batches together: a key keeps its newest row over the two.
PUBLISHED = (
    with_(
        o=OLD_HALF,
        n=pickup_sql("pickup_ts >= timestamp '2024-01-16'"),
        versions="select 0 as batch, * from o union all select 1 as batch, * from n",
    )
    + f"""
  select zip, ts, {PICKUP_NAMES} from versions
  qualify row_number() over (partition by zip order by ts desc, batch desc) = 1
"""
)

DESCRIBE = (
    with_(p=pickup_sql())
    + "select 'zip' as column_name, 'int' as data_type, 'key' as role, count(*) as n_rows, "
    "count(*) - count(zip) as n_null from p "
    "union all select 'ts', 'timestamp_ntz', 'time key', count(*), count(*) - count(ts) from p "
    "union all select 'mean_fare_window_1h_pickup_zip', 'float', 'feature', count(*), "
    "count(*) - count(mean_fare_window_1h_pickup_zip) from p "
    "union all select 'count_trips_window_1h_pickup_zip', 'int', 'feature', count(*), "
    "count(*) - count(count_trips_window_1h_pickup_zip) from p"
)

ORDERS = """
  select custkey, ts, cast(count(*) as int) as n_orders,
         cast(avg(o_totalprice) as float) as mean_price,
         min(o_totalprice) as min_price, max(o_totalprice) as max_price,
         cast(sum(o_totalprice) as float) as sum_price
  from (
    select o_custkey as custkey, o_totalprice,
           time_bucket(interval '10 days', o_orderdate, timestamp '1970-01-01')
             - k * interval '10 days' + interval '30 days' as ts
    from orders, generate_series(0, 2) g(k)
  ) x group by custkey, ts
"""

REGIONS = """
  with points as (
    select event_id, cast(40.0 as double) + cast(event_id % 1000 as double) / 1000 as lat,
           cast(-74.0 as double) + cast(event_id * 7 % 1000 as double) / 1000 as lon
    from events),
  zips as (
    select cast(i as int) as zip,
           cast(40.0 as double) + cast(i // 10 as double) / 10 as lat_lo,
           cast(40.0 as double) + cast(i // 10 + 1 as double) / 10 as lat_hi,
           cast(-74.0 as double) + cast(i % 10 as double) / 10 as lon_lo,
           cast(-74.0 as double) + cast(i % 10 + 1 as double) / 10 as lon_hi
    from range(100) r(i))
  select event_id, zip from points left join zips
    on lat >= lat_lo and lat < lat_hi and lon >= lon_lo and lon < lon_hi
"""

ARROW = [(0.01, 0.01), (0.19, 0.02), (0.12, 0.1), (0.18, 0.19), (0.02, 0.17), (0.07, 0.09)]
_EDGES = ", ".join(
    f"({a[0]}::double, {a[1]}::double, {b[0]}::double, {b[1]}::double)" for a, b in zip(ARROW, ARROW[1:] + ARROW[:1])
)
POLYGONS = f"""
  with points as (
    select event_id, cast(40.0 as double) + cast(event_id % 1000 as double) / 1000 as lat,
           cast(-74.0 as double) + cast(event_id * 7 % 997 as double) / 997 as lon
    from events),
  placed as (
    select n_nationkey as nation, -74.0::double + (n_nationkey % 5)::double * 0.2::double as x,
           40.0::double + (n_nationkey // 5)::double * 0.2::double as y from nation),
  edges as (
    select nation, x + a as x1, y + b as y1, x + c as x2, y + d as y2 from placed, (values {_EDGES}) v(a, b, c, d)),
  hit as (
    select event_id, nation from points, edges
    where (y1 > lat) <> (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1
    group by event_id, nation having count(*) % 2 = 1)
  select event_id, nation from points left join hit using (event_id)
"""

BASELINE = (
    with_(
        s=f"select trips.*, {SPLIT} as split from trips",
        m="select pickup_zip, avg(fare_amount) as p from s where split = 'train' group by 1",
        a="select avg(fare_amount) as p from s where split = 'train'",
    )
    + """
  select round(sqrt(avg((fare_amount - coalesce(m.p, a.p)) * (fare_amount - coalesce(m.p, a.p)))), 6)
           as rmse, count(*) as n_rows
  from (select * from s where split = 'test') t left join m using (pickup_zip), a
"""
)


ORDERS_DECIMAL = """
  select form, custkey, ts, count(*) as n_orders, round(avg(price), 4) as mean_price,
         cast(min(price) as double) as min_price, cast(max(price) as double) as max_price,
         round(cast(sum(price) as double), 4) as sum_price
  from (
    select o_custkey as custkey, cast(o_totalprice as decimal(12,2)) as price,
           time_bucket(interval '10 days', o_orderdate, timestamp '1970-01-01')
             - k * interval '10 days' + interval '30 days' as ts
    from orders, generate_series(0, 2) g(k)
  ) x, (values ('rows'), ('slots')) f(form) group by form, custkey, ts
"""

NEWEST = (
    with_(p=newest_sql(pickup_sql()))
    + f"select t.*, {PICKUP_NAMES} from trips t left join p on t.pickup_zip = p.zip"
)

NEWEST_DROPOFF = with_(d=DROPOFF) + f"""
  select zip, ts, {DROPOFF_NAMES} from d
  qualify row_number() over (partition by zip order by ts desc) = 1
"""

# A line through the trip count of the last hour, fitted and scored on all trips.
LINE = with_(
    p=pickup_sql(),
    x="select t.*, coalesce(cast(count_trips_window_1h_pickup_zip as double), 0.0) as n from trips t "
    "asof left join p on t.pickup_zip = p.zip and t.pickup_ts > p.ts",
    fit="select regr_slope(fare_amount, n) as a, regr_intercept(fare_amount, n) as b from x",
    scored="select trip_id, pickup_ts, b + a * n as prediction from x, fit",
)

# States of a table after three merges and an overwrite, and the change rows between them.
VERSIONS = {
    "s1": OLD_HALF,
    "b2": NEW_HALF,
    "b3": pickup_sql("pickup_ts >= timestamp '2024-01-21 10:07:00'"),
    "s2": "select * from b2 union all select * from s1 anti join b2 using (zip, ts)",
    "s3": "select * from b3 union all select * from s2 anti join b3 using (zip, ts)",
    "s4": pickup_sql("pickup_ts >= timestamp '2024-01-13 10:07:00'"),
}
SAME = (
    "o.mean_fare_window_1h_pickup_zip is not distinct from n.mean_fare_window_1h_pickup_zip "
    "and o.count_trips_window_1h_pickup_zip is not distinct from n.count_trips_window_1h_pickup_zip"
)


def changes_sql(old: str, new: str, version: int) -> str:
    def images(side: str, kind: str, source: str) -> str:
        return (
            f"select {side}.zip, {side}.ts, {side}.mean_fare_window_1h_pickup_zip, "
            f"{side}.count_trips_window_1h_pickup_zip, '{kind}' as change_type, cast({version} as bigint) as version {source}"
        )

    both = f"from {old} o join {new} n on o.zip = n.zip and o.ts = n.ts where not ({SAME})"
    return " union all ".join(
        [
            images("o", "delete", f"from {old} o anti join {new} n on o.zip = n.zip and o.ts = n.ts"),
            images("n", "insert", f"from {new} n anti join {old} o on o.zip = n.zip and o.ts = n.ts"),
            images("o", "update_preimage", both),
            images("n", "update_postimage", both),
        ]
    )


CHANGES_BY_VERSION = with_(**VERSIONS) + " union all ".join(
    changes_sql(f"s{v - 1}", f"s{v}", v) for v in (2, 3, 4)
)
READ_BY_VERSION = (
    with_(**VERSIONS)
    + "select *, cast(1 as bigint) as version from s1 union all select *, 2 from s4 union all "
    "select *, 3 from (select * from b3 union all select * from s4 anti join b3 using (zip, ts))"
)
PUBLISHED_SINCE = (
    with_(p=pickup_sql())
    + f"select zip, ts, {PICKUP_NAMES} from p where not (zip % 3 = 0 and ts >= timestamp '2024-01-25') "
    "qualify row_number() over (partition by zip order by ts desc) = 1"
)

# Every split of three inputs at every midpoint of two neighbouring values; the one that explains most.
STUMP_SPLIT = with_(
    x="select trip_id, fare_amount as y, pickup_zip % 16 as zip_group, dropoff_zip % 8 as dropoff_group, "
    "cast(floor(trip_distance) as int) as whole_miles from trips",
    long="select trip_id, y, 'zip_group' as feature, zip_group as v from x union all "
    "select trip_id, y, 'dropoff_group', dropoff_group from x union all select trip_id, y, 'whole_miles', whole_miles from x",
    sums="select feature, v, count(*) as n, sum(y) as s, (v + lead(v) over (partition by feature order by v)) / 2.0::double "
    "as threshold from long group by feature, v",
    sides="select feature, threshold, sum(n) over below as nl, sum(s) over below as sl, "
    "sum(n) over every - sum(n) over below as nh, sum(s) over every - sum(s) over below as sh from sums "
    "window below as (partition by feature order by v), every as (partition by feature)",
    best="select feature, threshold, round(sl / nl, 6) as low, round(sh / nh, 6) as high from sides "
    "where threshold is not null order by sl * sl / nl + sh * sh / nh desc limit 1",
)
STUMP_SCORE = (
    STUMP_SPLIT
    + "select trip_id, case when case feature when 'zip_group' then zip_group when 'dropoff_group' then dropoff_group "
    "else whole_miles end <= threshold then low else high end as prediction from x, best"
)


def statements() -> dict[str, str]:
    pickup = with_() + pickup_sql()
    dropoff = with_() + DROPOFF
    by_weekend = with_(d=DROPOFF) + (
        "select dropoff_is_weekend, cast(sum(count_trips_window_30m_dropoff_zip) as bigint) "
        "as num_rides from d where dropoff_is_weekend is not null group by 1"
    )
    return {
        "training_set": TRAINING,
        "training_set_split": TRAINING,
        "ts_range_filter": with_()
        + "select * from trips where pickup_ts >= timestamp '2024-01-05' "
        "and pickup_ts < timestamp '2024-01-20 12:00:00'",
        "ts_range_filter_open_end": with_()
        + "select * from trips where pickup_ts >= timestamp '2024-01-16'",
        "hash_sample": with_()
        + "select * from trips where pickup_ts >= timestamp '2024-01-02' "
        f"and pickup_ts < timestamp '2024-01-30' and {bucket_sql(0)} < 1000",
        "weekend_flag": f"select event_id, ts, {WEEKEND.format('ts')} as is_weekend from events",
        "ts_bounds": "select min(ts) as min_ts, max(ts) as max_ts from events",
        "initial_load": with_() + f"select * from trips where pickup_ts <= {FIRST_CUT}",
        "incremental_load_step": STEP,
        "incremental_load_drain": DRAIN,
        "incremental_load_manifest": DRAIN,
        "pickup_features": pickup,
        "pickup_features_preaggregated": pickup,
        "pickup_features_range": with_()
        + pickup_sql("pickup_ts >= timestamp '2024-01-01' and pickup_ts < timestamp '2024-01-16'"),
        "dropoff_features": dropoff,
        "rides_by_weekend": by_weekend,
        "rides_by_weekend_sql": by_weekend,
        "order_features_30d": ORDERS,
        "pit_lookup": pit_sql(">"),
        "pit_lookup_inclusive": pit_sql(">="),
        "pit_lookup_bucketed": pit_sql(">"),
        "pit_lookup_split": pit_sql(">"),
        "pit_lookup_max_age": MAX_AGE,
        "pit_lookup_ties_strict": ties_sql(">"),
        "pit_lookup_ties_inclusive": ties_sql(">="),
        "pit_lookup_ties_split": ties_sql(">="),
        "key_lookup": "select c_custkey, c_nationkey, n_name, n_regionkey from customer "
        "left join nation on c_nationkey = n_nationkey",
        "region_join": REGIONS,
        "region_join_polygons": POLYGONS,
        "train_test_split": with_() + f"select trip_id, {SPLIT} as split from trips",
        "training_matrix": MATRIX,
        "feature_table_describe": DESCRIBE,
        "feature_overwrite": with_() + NEW_HALF,
        "feature_merge": MERGE,
        "pk_violations": VIOLATIONS,
        "change_feed": CHANGES,
        "latest_snapshot": with_() + newest_sql(pickup_sql()),
        "latest_snapshot_merge": PUBLISHED,
        "feature_incremental_refresh": pickup,
        "stream_pickup_features": pickup,
        "stream_dropoff_features": dropoff,
        "stream_ingest": BY_DAY,
        "stream_pit_enrich": TRAINING,
        "baseline_rmse": BASELINE,
        "feature_merge_zoned": MERGE,
        "pit_lookup_stored_zoned": pit_sql(">"),
        "pit_lookup_stored": pit_sql(">") + " where t.pickup_ts >= timestamp '2024-01-28'",
        "key_lookup_latest": NEWEST,
        "order_features_decimal": ORDERS_DECIMAL,
        "feature_promote": MERGE,
        "dropoff_merge": dropoff,
        "dropoff_refresh": dropoff,
        "dropoff_publish": NEWEST_DROPOFF,
        "stream_late_reconcile": pickup,
        "stream_late_windows": pickup,
        "pit_lookup_carry": pit_sql(">") + " where t.pickup_ts >= timestamp '2024-01-28'",
        "feature_merge_delta": f"select m.*, form from ({MERGE}) m, (values ('changes'), ('base')) f(form)",
        "change_feed_versions": CHANGES_BY_VERSION,
        "feature_overwrite_versioned": READ_BY_VERSION,
        "latest_snapshot_since_version": PUBLISHED_SINCE,
        "stream_features_delta": pickup,
        "boosted_stump": STUMP_SPLIT + "select * from best",
        "sql_function_score": STUMP_SCORE,
        "linear_score_batch": LINE + "select trip_id, round(prediction, 6) as prediction from scored",
        "linear_score_struct": LINE + "select trip_id, round(prediction, 6) as prediction from scored",
        "linear_inference_log": LINE
        + "select cast(pickup_ts as date) as day, '1' as model_version, count(*) as n_requests, "
        "round(avg(prediction), 6) as mean_response from scored group by 1",
    }
