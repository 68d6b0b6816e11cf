"""The registered queries in plain SQL, for a second engine to check the results."""

import re
from math import prod

from wayfare.models import pipelines
from wayfare.plans import features

# Shared table expressions; each oracle pulls in the ones it names.
CTES = {
    "base": """
        SELECT *, o_orderdate + to_minutes(CAST((l_partkey * 7 + l_linenumber * 131) % 1440 AS INTEGER)) AS start_ts
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey""",
    "once": """
        SELECT start_ts AS tpep_pickup_datetime,
          start_ts + to_seconds(CAST(floor(l_quantity * 240) AS INTEGER) + CAST(l_partkey % 600 - 300 AS INTEGER))
            AS tpep_dropoff_datetime,
          CAST(s_nationkey * 11 AS INTEGER) AS PULocationID,
          CAST(c_nationkey * 11 AS INTEGER) AS DOLocationID,
          round(l_quantity * l_discount * 25, 2) AS trip_distance,
          l_extendedprice / 1000 - 1.5 AS fare_amount,
          l_extendedprice / 1000 AS total_amount,
          CASE WHEN l_linenumber <> 7 THEN CAST(l_partkey % 10 AS DOUBLE) END AS passenger_count,
          CASE WHEN l_suppkey % 17 <> 0 THEN CAST(l_partkey % 4 + 1 AS DOUBLE) END AS payment_type,
          CASE WHEN l_suppkey % 19 <> 0 THEN CAST(l_suppkey % 6 + 1 AS DOUBLE) END AS RatecodeID,
          CASE WHEN l_linenumber <> 6 THEN CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END END AS store_and_fwd_flag,
          l_orderkey
        FROM base""",
    "trips": """
        SELECT * EXCLUDE (l_orderkey) FROM once
        UNION ALL SELECT * EXCLUDE (l_orderkey) FROM once WHERE l_orderkey % 50 = 0""",
    "raw": """
        SELECT *, date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / 6e7 AS trip_duration_minutes,
          date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS duration_s
        FROM trips""",
    "passing": """
        SELECT * FROM raw
        WHERE trip_duration_minutes > 0 AND trip_duration_minutes BETWEEN 1 AND 180
          AND trip_distance > 0 AND trip_distance BETWEEN 0.1 AND 100
          AND PULocationID BETWEEN 1 AND 265 AND DOLocationID BETWEEN 1 AND 265
          AND (passenger_count IS NULL OR passenger_count BETWEEN 1 AND 8)
          AND fare_amount >= 0""",
    "unfilled": "SELECT DISTINCT * FROM passing",
    "fit": """
        SELECT
          (SELECT quantile_cont(passenger_count, 0.5) FROM unfilled WHERE tpep_pickup_datetime < TIMESTAMP '2000-01-01') AS pax,
          (SELECT RatecodeID FROM unfilled WHERE tpep_pickup_datetime < TIMESTAMP '2000-01-01' AND RatecodeID IS NOT NULL
             GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS rate,
          (SELECT payment_type FROM unfilled WHERE tpep_pickup_datetime < TIMESTAMP '2000-01-01' AND payment_type IS NOT NULL
             GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS pay""",
    "clean": """
        SELECT tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID, trip_distance, fare_amount, total_amount,
          coalesce(passenger_count, pax) AS passenger_count, coalesce(payment_type, pay) AS payment_type,
          coalesce(RatecodeID, rate) AS RatecodeID, coalesce(store_and_fwd_flag, 'N') AS store_and_fwd_flag,
          trip_duration_minutes, duration_s
        FROM unfilled, fit""",
    "train": "SELECT * FROM clean WHERE tpep_pickup_datetime < TIMESTAMP '2000-01-01'",
    "test": "SELECT * FROM clean WHERE tpep_pickup_datetime >= TIMESTAMP '2000-01-01'",
    "zones": """
        SELECT CAST(n_nationkey * 11 AS INTEGER) AS LocationID, r_name AS Borough, n_name AS Zone,
          'Test Zone' AS service_zone,
          CASE r_name WHEN 'AFRICA' THEN 1 WHEN 'AMERICA' THEN 2 WHEN 'ASIA' THEN 3 WHEN 'EUROPE' THEN 4 ELSE 0 END AS code
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 24""",
    "all_routes": """
        SELECT PULocationID, DOLocationID, sum(duration_s) / (60.0::DOUBLE * count(*)) AS route_mean_duration,
          quantile_cont(duration_s, 0.5) / 60.0::DOUBLE AS route_median_duration,
          stddev_samp(duration_s) / 60.0::DOUBLE AS route_std_duration, count(*) AS trips
        FROM train GROUP BY 1, 2""",
    "routes": "SELECT * FROM all_routes WHERE trips >= 50",
    "pu_counts": "SELECT PULocationID, count(*) AS pickups FROM train GROUP BY 1",
    "do_counts": "SELECT DOLocationID, count(*) AS dropoffs FROM train GROUP BY 1",
    "scalars": """
        SELECT sum(duration_s) / (60.0::DOUBLE * count(*)) AS global_mean,
          (SELECT avg(mph) FROM (SELECT trip_distance / trip_duration_minutes * 60 AS mph FROM train)
             WHERE mph > 0 AND mph <= 80) AS avg_speed
        FROM train""",
    "typed_requests": """
        SELECT event_id, CAST(user_id AS INTEGER) AS pickup_location_id, CAST(event_id % 270 AS INTEGER) AS dropoff_location_id,
          CASE WHEN event_id % 101 = 0 THEN 0.0::DOUBLE ELSE value / 10 END AS trip_distance,
          CASE WHEN event_id % 97 = 0 THEN 'soon' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS pickup_datetime,
          CASE WHEN event_id % 97 = 0 THEN NULL ELSE date_trunc('second', ts) END AS pickup_ts,
          CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 11 AS INTEGER) ELSE 1 END AS passenger_count,
          CASE WHEN event_id % 7 <> 0 THEN CAST(event_id % 6 + 1 AS INTEGER) ELSE 1 END AS rate_code_id,
          CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 6 + 1 AS INTEGER) ELSE 1 END AS payment_type,
          CASE WHEN event_id % 4 <> 0 THEN round(value - 1, 2) END AS given_fare
        FROM events""",
    "filled_requests": "SELECT * EXCLUDE (given_fare), coalesce(given_fare, 10.0::DOUBLE) AS fare_amount FROM typed_requests",
    "checked": """
        SELECT *, CASE WHEN NOT coalesce(pickup_location_id BETWEEN 1 AND 265, false) THEN 'pickup_location_id'
          WHEN NOT coalesce(dropoff_location_id BETWEEN 1 AND 265, false) THEN 'dropoff_location_id'
          WHEN NOT coalesce(trip_distance > 0, false) THEN 'trip_distance'
          WHEN pickup_ts IS NULL THEN 'pickup_datetime'
          WHEN NOT coalesce(passenger_count BETWEEN 1 AND 8, false) THEN 'passenger_count'
          WHEN NOT coalesce(rate_code_id BETWEEN 1 AND 6, false) THEN 'rate_code_id'
          WHEN NOT coalesce(payment_type BETWEEN 1 AND 6, false) THEN 'payment_type'
          WHEN NOT coalesce(fare_amount >= 0, false) THEN 'fare_amount' END AS reject_reason
        FROM filled_requests""",
    "valid_trips": """
        SELECT event_id, pickup_ts AS tpep_pickup_datetime, pickup_datetime, pickup_location_id AS PULocationID,
          dropoff_location_id AS DOLocationID, trip_distance, fare_amount,
          CAST(passenger_count AS DOUBLE) AS passenger_count, CAST(rate_code_id AS DOUBLE) AS RatecodeID,
          CAST(payment_type AS DOUBLE) AS payment_type
        FROM checked WHERE reject_reason IS NULL""",
    "scored": """
        SELECT event_id, round(greatest(least(coalesce(route_mean_duration, global_mean), 300.0), 1.0), 2)
            AS predicted_duration_minutes,
          round(trip_distance / avg_speed * 60, 2) AS baseline_duration_minutes,
          'route_mean' AS model_used, pickup_datetime
        FROM valid_trips LEFT JOIN routes USING (PULocationID, DOLocationID), scalars""",
}


def feature_cte(source: str) -> str:
    """Every model input for the rows of a table expression."""
    hour, day, month = (
        f"{part}(tpep_pickup_datetime)" for part in ("hour", "isodow", "month")
    )
    day = f"({day} - 1)"
    rush = f"CAST({hour} BETWEEN 7 AND 9 OR {hour} BETWEEN 16 AND 19 AS INTEGER)"
    weekend = f"CAST({day} >= 5 AS INTEGER)"
    return f"""
        SELECT t.*, ln(1 + trip_distance) AS log_distance, trip_distance / avg_speed * 60 AS baseline_duration,
          CAST(PULocationID = DOLocationID AS INTEGER) AS same_zone_flag,
          coalesce(pz.code, 0) AS pu_borough, coalesce(dz.code, 0) AS do_borough,
          CAST(coalesce(pz.code, 0) <> coalesce(dz.code, 0) AS INTEGER) AS cross_borough_flag,
          coalesce(pickups, 0) AS pu_zone_rank, coalesce(dropoffs, 0) AS do_zone_rank,
          {hour} AS hour, {day} AS day_of_week, {month} AS month, {weekend} AS is_weekend, {rush} AS is_rush_hour,
          CAST({hour} >= 22 OR {hour} <= 5 AS INTEGER) AS is_night,
          sin(2 * pi() * {hour} / 24) AS hour_sin, cos(2 * pi() * {hour} / 24) AS hour_cos,
          sin(2 * pi() * {day} / 7) AS dow_sin, cos(2 * pi() * {day} / 7) AS dow_cos,
          sin(2 * pi() * {month} / 12) AS month_sin, cos(2 * pi() * {month} / 12) AS month_cos,
          coalesce(route_mean_duration, global_mean) AS route_mean_duration,
          coalesce(route_median_duration, global_mean) AS route_median_duration,
          trip_distance * {rush} AS distance_x_rush, trip_distance * {weekend} AS distance_x_weekend,
          trip_distance * {hour} AS distance_x_hour
        FROM {source} t
        LEFT JOIN zones pz ON PULocationID = pz.LocationID
        LEFT JOIN zones dz ON DOLocationID = dz.LocationID
        LEFT JOIN pu_counts USING (PULocationID)
        LEFT JOIN do_counts USING (DOLocationID)
        LEFT JOIN routes USING (PULocationID, DOLocationID),
        scalars"""


CTES["train_features"] = feature_cte("train")
CTES["test_features"] = feature_cte("test")
CTES["clean_features"] = feature_cte("clean")
CTES["request_features"] = feature_cte("valid_trips")
CTES["distance_quartiles"] = "SELECT quantile_cont(trip_distance, 0.25) AS q1, quantile_cont(trip_distance, 0.75) AS q3 FROM train"
CTES["distance_bounds"] = "SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM distance_quartiles"
CTES["errors"] = """
        SELECT *, route_mean_duration - trip_duration_minutes AS error_minutes,
          abs(route_mean_duration - trip_duration_minutes) AS abs_error
        FROM test_features"""
CTES["long_predictions"] = """
        SELECT 'baseline' AS model, trip_duration_minutes AS y, greatest(baseline_duration, 0) AS p FROM test_features
        UNION ALL SELECT 'route_mean', trip_duration_minutes, greatest(route_mean_duration, 0) FROM test_features
        UNION ALL SELECT 'route_median', trip_duration_minutes, greatest(route_median_duration, 0) FROM test_features"""
CTES["measured"] = """
        SELECT model, count(*) AS rows, round(sqrt(avg((y - p) * (y - p))), 4) AS RMSE, round(avg(abs(y - p)), 4) AS MAE,
          round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 4) AS R2,
          round(avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100, 4) AS MAPE
        FROM long_predictions GROUP BY model"""
CTES["board"] = """
        SELECT m.*, round((b.RMSE - m.RMSE) / b.RMSE * 100, 4) AS rmse_gain_pct,
          round((b.MAE - m.MAE) / b.MAE * 100, 4) AS mae_gain_pct, round(m.R2 - b.R2, 4) AS r2_gain,
          m.model = (SELECT model FROM measured WHERE model <> 'baseline' ORDER BY RMSE, model LIMIT 1) AS is_best
        FROM measured m, (SELECT * FROM measured WHERE model = 'baseline') b"""
CTES["blocks"] = """
        SELECT *, CAST(CASE WHEN idx < n - 5 * t THEN 0 ELSE 1 + (idx - (n - 5 * t)) // t END AS INTEGER) AS block
        FROM (SELECT *, row_number() OVER (ORDER BY tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID,
                trip_distance, fare_amount, total_amount, passenger_count, RatecodeID, payment_type,
                store_and_fwd_flag) - 1 AS idx, count(*) OVER () AS n, count(*) OVER () // 6 AS t FROM train)"""


def blocks_cte(total: str) -> str:
    """Time blocks of the training trips in the order of every column, nulls first; ``total`` stands for the total."""
    numbers = ", ".join(f"{c} NULLS FIRST" for c in ("fare_amount", "total", "passenger_count", "RatecodeID", "payment_type", "store_and_fwd_flag"))
    return f"""
        SELECT *, CAST(CASE WHEN idx < n - 5 * t THEN 0 ELSE 1 + (idx - (n - 5 * t)) // t END AS INTEGER) AS block
        FROM (SELECT *, row_number() OVER (ORDER BY tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID,
                trip_distance, {numbers}) - 1 AS idx, count(*) OVER () AS n, count(*) OVER () // 6 AS t
              FROM (SELECT *, {total} AS total FROM train))"""


CTES["short_blocks"] = blocks_cte("0")
CTES["drifted_blocks"] = blocks_cte("CASE WHEN year(tpep_pickup_datetime) >= 1998 THEN total_amount END")
CTES["line"] = """
        SELECT count(*) AS n, avg(trip_distance) AS xbar, avg(trip_duration_minutes) AS ybar,
          regr_slope(trip_duration_minutes, trip_distance) AS slope FROM train"""
CTES["line_predictions"] = """
        SELECT 'baseline' AS model, trip_duration_minutes AS y, greatest(baseline_duration, 0) AS p FROM test_features
        UNION ALL SELECT 'linear_regression', trip_duration_minutes, greatest(ybar + slope * (trip_distance - xbar), 0) FROM test_features, line
        UNION ALL SELECT 'ridge_regression', trip_duration_minutes,
          greatest(ybar + slope * n / (n + 10.0::DOUBLE) * (trip_distance - xbar), 0) FROM test_features, line"""
CTES["line_measured"] = CTES["measured"].replace("long_predictions", "line_predictions")
CTES["line_board"] = re.sub(r"\bmeasured\b", "line_measured", CTES["board"])
CTES["line_scored"] = """
        SELECT event_id, round(greatest(least(ybar + slope * (trip_distance - xbar), 300.0), 1.0), 2) AS predicted_duration_minutes,
          round(trip_distance / avg_speed * 60, 2) AS baseline_duration_minutes, 'linear_regression' AS model_used, pickup_datetime
        FROM valid_trips, line, scalars"""
CTES["fold_lines"] = """
        SELECT h.block, count(*) AS n, avg(t.trip_distance) AS xbar, avg(t.trip_duration_minutes) AS ybar,
          regr_slope(t.trip_duration_minutes, t.trip_distance) AS slope
        FROM blocks t JOIN (SELECT DISTINCT block FROM blocks WHERE block > 0) h ON t.block < h.block GROUP BY h.block"""
CTES["hours"] = """
        SELECT hour(tpep_pickup_datetime) AS h, count(*) AS k, sum(trip_duration_minutes) AS y FROM train GROUP BY 1"""
CTES["keyed"] = """
        SELECT *, md5(concat_ws('|', date_diff('second', TIMESTAMP '1970-01-01', tpep_pickup_datetime), duration_s, PULocationID,
          DOLocationID, CAST(round(trip_distance * 100) AS BIGINT), CAST(round(total_amount * 100000) AS BIGINT),
          CAST(passenger_count AS BIGINT), CAST(RatecodeID AS BIGINT), CAST(payment_type AS BIGINT), store_and_fwd_flag, '42')) AS h
        FROM """

KEY = "tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID"
TRIP = f"{KEY}, trip_distance, fare_amount, total_amount, passenger_count, payment_type, RatecodeID, store_and_fwd_flag"


def build(body: str) -> str:
    """The body under a WITH clause holding the table expressions it needs, in order."""
    needed: set[str] = set()

    def visit(text):
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(body)
    ordered: list[str] = []

    def place(name):
        for other in CTES:
            if other != name and other in needed and other not in ordered and re.search(rf"\b{other}\b", CTES[name]):
                place(other)
        if name not in ordered:
            ordered.append(name)

    for name in CTES:
        if name in needed:
            place(name)
    clauses = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in ordered)
    return f"WITH {clauses}\n{body}" if clauses else body


def matrix_select(columns: list[str], source: str, *extra: str) -> str:
    inputs = ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in columns)
    return f"SELECT {', '.join([inputs, *extra])} FROM {source}"


def histogram(values: str, bins: int = 100) -> str:
    return f"""
      , vals AS MATERIALIZED ({values}),
      lims AS MATERIALIZED (SELECT CAST(min(x) AS DOUBLE) AS lo, CAST(max(x) AS DOUBLE) AS hi,
        (CAST(max(x) AS DOUBLE) - CAST(min(x) AS DOUBLE)) / {bins} AS w FROM vals),
      filled AS (SELECT CAST(least(floor((x - lo) / w), {bins - 1}) AS INTEGER) AS bin, count(*) AS n FROM vals, lims GROUP BY 1)
      SELECT CAST(g.i AS INTEGER) AS bin, round(lo + g.i * w, 9) AS bin_low, round(lo + (g.i + 1) * w, 9) AS bin_high,
        coalesce(n, 0) AS n
      FROM generate_series(0, {bins - 1}) AS g(i) LEFT JOIN filled ON bin = g.i, lims"""


def hist_query(values: str) -> str:
    prefix = build(values)
    head = prefix[: len(prefix) - len(values)].rstrip()
    return head + histogram(values)


def mean_by(key: str, expression: str, extra: str = "") -> str:
    return f"""SELECT CAST({expression} AS INTEGER) AS {key}, count(*) AS trips,
      round(sum(duration_s) / (60.0::DOUBLE * count(*)), 6) AS mean_minutes{extra} FROM train GROUP BY 1"""


BOX = """round(q1 / 60.0::DOUBLE, 6) AS q1, round(q2 / 60.0::DOUBLE, 6) AS median, round(q3 / 60.0::DOUBLE, 6) AS q3,
      round(least(min(CASE WHEN duration_s >= q1 - 1.5 * (q3 - q1) THEN duration_s END), q1) / 60.0::DOUBLE, 6) AS whisker_low,
      round(greatest(max(CASE WHEN duration_s <= q3 + 1.5 * (q3 - q1) THEN duration_s END), q3) / 60.0::DOUBLE, 6) AS whisker_high"""
DAY = "isodow(tpep_pickup_datetime) - 1"
DAY_LABEL = "['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][isodow(tpep_pickup_datetime)]"
MONTH_LABEL = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'][month(tpep_pickup_datetime)]"
RUSH = "(hour(tpep_pickup_datetime) BETWEEN 7 AND 9 OR hour(tpep_pickup_datetime) BETWEEN 16 AND 19)"
RATE_LABEL = """CASE CAST(RatecodeID AS INTEGER) WHEN 1 THEN 'Standard' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'
      WHEN 4 THEN 'Nassau/Westchester' WHEN 5 THEN 'Negotiated' WHEN 6 THEN 'Group' END"""

FULL_AUDIT = [
    ("positive_duration", "trip_duration_minutes > 0"),
    ("duration_range", "trip_duration_minutes BETWEEN 1 AND 180"),
    ("positive_distance", "trip_distance > 0"),
    ("distance_range", "trip_distance BETWEEN 0.1 AND 100"),
    ("valid_zones", "PULocationID BETWEEN 1 AND 265 AND DOLocationID BETWEEN 1 AND 265"),
    ("passenger_count", "(passenger_count IS NULL OR passenger_count BETWEEN 1 AND 8)"),
    ("non_negative_fare", "fare_amount >= 0"),
]
SHORT_AUDIT = [
    ("duration_range", "trip_duration_minutes BETWEEN 1 AND 180"),
    ("distance_range", "trip_distance BETWEEN 0.1 AND 100"),
    ("valid_pickup_zone", "PULocationID BETWEEN 1 AND 265"),
    ("valid_dropoff_zone", "DOLocationID BETWEEN 1 AND 265"),
    ("non_negative_fare", "fare_amount >= 0"),
    ("passenger_count", "(passenger_count IS NULL OR passenger_count BETWEEN 1 AND 8)"),
]


def audit(steps: list[tuple[str, str]], dedup: bool) -> str:
    """The rules as a chain of filters, one count per step."""
    counts = ["SELECT 0 AS step, 'input' AS rule, count(*) AS remaining FROM raw"]
    conditions: list[str] = []
    for i, (name, condition) in enumerate(steps, 1):
        conditions.append(condition)
        counts.append(f"SELECT {i}, '{name}', count(*) FROM raw WHERE {' AND '.join(conditions)}")
    if dedup:
        distinct = f"SELECT DISTINCT * FROM raw WHERE {' AND '.join(conditions)}"
        counts.append(f"SELECT {len(steps) + 1}, 'duplicate_rows', count(*) FROM ({distinct})")
    return f"""SELECT CAST(step AS INTEGER) AS step, rule, CAST(before - remaining AS BIGINT) AS removed,
      round((before - remaining) * 100.0::DOUBLE / total, 3) AS removed_pct, remaining
      FROM (SELECT *, lag(remaining) OVER (ORDER BY step) AS before, first(remaining) OVER (ORDER BY step) AS total
            FROM ({' UNION ALL '.join(counts)})) WHERE step > 0"""


TRIP_NAMES = [c.strip() for c in TRIP.split(",")]


def missing(source: str, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, "
        f"round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS missing_pct, count(*) AS total_rows{extra} FROM {source}"
        for c in TRIP_NAMES
    )


def outliers(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, round(lo, 6) AS lower_bound, round(hi, 6) AS upper_bound,
      count(*) FILTER (WHERE {column} < lo OR {column} > hi) AS outliers
      FROM train, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
        (SELECT quantile_cont(CAST({column} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({column} AS DOUBLE), 0.75) AS q3 FROM train))
      GROUP BY lo, hi"""


CORRELATED = ["trip_duration_minutes", "trip_distance", "fare_amount", "total_amount", "passenger_count"]
CORRELATION = " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM train"
    for i, a in enumerate(CORRELATED)
    for b in CORRELATED[:i]
)
BAND = """CASE WHEN trip_distance > 0 AND trip_distance <= 1 THEN {0} WHEN trip_distance > 1 AND trip_distance <= 2 THEN {1}
      WHEN trip_distance > 2 AND trip_distance <= 5 THEN {2} WHEN trip_distance > 5 AND trip_distance <= 10 THEN {3}
      WHEN trip_distance > 10 AND trip_distance <= 20 THEN {4} WHEN trip_distance > 20 AND trip_distance <= 100 THEN {5} END"""


def error_by(keys: str) -> str:
    return f"SELECT {keys}, count(*) AS rows, round(avg(abs_error), 6) AS mae FROM errors"


SQL = {
    "scan_trips": f"""SELECT {KEY}, trip_distance, fare_amount FROM raw""",
    "scan_months": """SELECT CAST(year(tpep_dropoff_datetime) AS INTEGER) AS source_year,
      CAST(month(tpep_dropoff_datetime) AS INTEGER) AS source_month, count(*) AS trips, count(passenger_count) AS with_passengers
      FROM raw GROUP BY 1, 2""",
    "scan_source_month": """SELECT CAST(year(tpep_dropoff_datetime) AS INTEGER) AS source_year,
      CAST(month(tpep_dropoff_datetime) AS INTEGER) AS source_month, count(*) AS trips FROM raw GROUP BY 1, 2""",
    "union_months": f"""SELECT {TRIP.replace('total_amount', 'CASE WHEN year(tpep_dropoff_datetime) >= 1998 THEN total_amount END AS total_amount')}
      FROM raw""",
    "zone_volumes": """SELECT t.LocationID, trips, Borough, Zone, service_zone FROM
      (SELECT PULocationID AS LocationID, count(*) AS trips FROM clean GROUP BY 1) t LEFT JOIN zones USING (LocationID)""",
    "roundtrip_parquet": f"""SELECT {TRIP}, CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
      CAST(month(tpep_pickup_datetime) AS INTEGER) AS month FROM unfilled""",
    "typed_trips": """SELECT tpep_pickup_datetime, tpep_dropoff_datetime, CAST(PULocationID AS SMALLINT) AS PULocationID,
      CAST(DOLocationID AS SMALLINT) AS DOLocationID, CAST(trip_distance AS FLOAT) AS trip_distance,
      CAST(fare_amount AS FLOAT) AS fare_amount, CAST(total_amount AS FLOAT) AS total_amount,
      CAST(passenger_count AS FLOAT) AS passenger_count, CAST(payment_type AS FLOAT) AS payment_type,
      CAST(RatecodeID AS FLOAT) AS RatecodeID, store_and_fwd_flag,
      CAST(trip_duration_minutes AS FLOAT) AS trip_duration_minutes FROM clean""",
    "duration": f"SELECT {KEY}, round(trip_duration_minutes, 6) AS trip_duration_minutes, duration_s FROM raw",
    "clean_trips": f"SELECT {TRIP} FROM passing",
    "clean_trips_short": f"""SELECT {KEY}, trip_distance, fare_amount, total_amount, coalesce(passenger_count, 0) AS passenger_count,
      coalesce(payment_type, 0) AS payment_type, coalesce(RatecodeID, 0) AS RatecodeID, store_and_fwd_flag FROM passing""",
    "dedup": f"SELECT DISTINCT {TRIP} FROM passing",
    "filter_audit": audit(FULL_AUDIT, True),
    "filter_audit_short": audit(SHORT_AUDIT, False),
    "wrong_year": f"""SELECT {KEY}, CAST(year(tpep_dropoff_datetime) AS INTEGER) AS source_year,
      CAST(month(tpep_dropoff_datetime) AS INTEGER) AS source_month FROM raw
      WHERE year(tpep_pickup_datetime) <> year(tpep_dropoff_datetime)""",
    "profile": f"SELECT *, 11 AS total_columns FROM ({missing('raw')}) WHERE missing > 0",
    "null_counts": missing("unfilled", ", 'before' AS stage") + " UNION ALL " + missing("clean", ", 'after' AS stage"),
    "impute": f"SELECT {KEY}, passenger_count, RatecodeID, payment_type, store_and_fwd_flag FROM clean",
    "time_split": """SELECT CASE WHEN tpep_pickup_datetime < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS part,
      count(*) AS trips, min(tpep_pickup_datetime) AS first_pickup, max(tpep_pickup_datetime) AS last_pickup,
      CAST(sum(duration_s) AS BIGINT) AS total_seconds FROM clean GROUP BY 1""",
    "iqr_bounds": " UNION ALL ".join(outliers(c) for c in ("duration_s", "trip_distance", "fare_amount")),
    "iqr_outliers": f"""SELECT {KEY}, trip_distance FROM raw, distance_bounds WHERE trip_distance < low OR trip_distance > high""",
    "time_features": f"""SELECT {KEY}, CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour, CAST({DAY} AS INTEGER) AS day_of_week,
      CAST(day(tpep_pickup_datetime) AS INTEGER) AS day_of_month, CAST(month(tpep_pickup_datetime) AS INTEGER) AS month,
      CAST(year(tpep_pickup_datetime) AS INTEGER) AS year, CAST(quarter(tpep_pickup_datetime) AS INTEGER) AS quarter,
      CAST(week(tpep_pickup_datetime) AS INTEGER) AS week_of_year, CAST({DAY} >= 5 AS INTEGER) AS is_weekend,
      CAST({RUSH} AS INTEGER) AS is_rush_hour,
      CAST(hour(tpep_pickup_datetime) >= 22 OR hour(tpep_pickup_datetime) <= 5 AS INTEGER) AS is_night,
      {DAY_LABEL} AS day_label, {MONTH_LABEL} AS month_label FROM clean""",
    "cyclic": f"""SELECT {KEY}, """
    + ", ".join(
        f"round({f}(2 * pi() * ({e}) / {p}), 9) AS {n}_{f}"
        for n, e, p in [("hour", "hour(tpep_pickup_datetime)", 24), ("dow", DAY, 7), ("month", "month(tpep_pickup_datetime)", 12)]
        for f in ("sin", "cos")
    )
    + " FROM clean",
    "distance_features": f"""SELECT {KEY}, trip_distance, round(ln(1 + trip_distance), 9) AS log_distance,
      round(trip_distance / 12.5 * 60, 9) AS baseline_duration FROM clean""",
    "location_features": f"""SELECT {KEY}, same_zone_flag, CAST(pu_borough AS INTEGER) AS pu_borough,
      CAST(do_borough AS INTEGER) AS do_borough, cross_borough_flag, pu_zone_rank, do_zone_rank FROM clean_features""",
    "zone_popularity": """SELECT coalesce(PULocationID, DOLocationID) AS LocationID, CAST(coalesce(pickups, 0) AS BIGINT) AS pickups,
      CAST(coalesce(dropoffs, 0) AS BIGINT) AS dropoffs FROM pu_counts FULL JOIN do_counts ON PULocationID = DOLocationID""",
    "route_stats": """SELECT PULocationID, DOLocationID, round(route_mean_duration, 6) AS route_mean_duration,
      round(route_median_duration, 6) AS route_median_duration, round(route_std_duration, 6) AS route_std_duration, trips FROM routes""",
    "route_stats_short": """SELECT PULocationID, DOLocationID, round(route_mean_duration, 6) AS route_mean_duration,
      round(route_median_duration, 6) AS route_median_duration, round(route_std_duration, 6) AS route_std_duration, trips
      FROM all_routes WHERE trips >= 30""",
    "global_mean": "SELECT round(global_mean, 9) AS global_mean FROM scalars",
    "route_features": f"""SELECT {KEY}, round(route_mean_duration, 6) AS route_mean_duration,
      round(route_median_duration, 6) AS route_median_duration FROM clean_features""",
    "route_coverage": " UNION ALL ".join(
        f"""SELECT '{part}' AS part, count(*) AS trips, count(route_mean_duration) AS matched,
      round(count(route_mean_duration) * 100.0::DOUBLE / count(*), 4) AS coverage_pct
      FROM {part} LEFT JOIN routes USING (PULocationID, DOLocationID)"""
        for part in ("train", "test")
    ),
    "interactions": f"""SELECT {KEY}, round(trip_distance * CAST({RUSH} AS INTEGER), 6) AS distance_x_rush,
      round(trip_distance * CAST({DAY} >= 5 AS INTEGER), 6) AS distance_x_weekend,
      round(trip_distance * hour(tpep_pickup_datetime), 6) AS distance_x_hour FROM clean""",
    "feature_matrix": " UNION ALL ".join(
        matrix_select(
            features.FULL_FEATURES,
            f"{part}_features",
            "round(trip_duration_minutes, 6) AS trip_duration_minutes",
            f"'{part}' AS part",
        )
        for part in ("train", "test")
    ),
    "feature_matrix_short": matrix_select(
        features.SHORT_FEATURES, "clean_features", "round(trip_duration_minutes, 6) AS trip_duration_minutes"
    ),
    "duration_summary": """SELECT count(duration_s) AS trips, round(min(duration_s) / 60.0::DOUBLE, 6) AS min_minutes,
      round(max(duration_s) / 60.0::DOUBLE, 6) AS max_minutes, round(sum(duration_s) / (60.0::DOUBLE * count(*)), 6) AS mean_minutes,
      round(quantile_cont(duration_s, 0.5) / 60.0::DOUBLE, 6) AS median_minutes FROM raw""",
    "describe_duration": """SELECT count(*) AS count, round(sum(duration_s) / (60.0::DOUBLE * count(*)), 6) AS mean,
      round(stddev_samp(duration_s) / 60, 6) AS std, round(min(duration_s) / 60.0::DOUBLE, 6) AS min, """
    + ", ".join(
        f"round(quantile_cont(duration_s, {p}) / 60.0::DOUBLE, 6) AS p{round(p * 100)}" for p in (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
    )
    + ", round(max(duration_s) / 60.0::DOUBLE, 6) AS max FROM train",
    "avg_by_hour": mean_by("hour", "hour(tpep_pickup_datetime)"),
    "avg_by_dow": mean_by("day_of_week", DAY, f", any_value({DAY_LABEL}) AS day_label"),
    "avg_by_month": mean_by("month", "month(tpep_pickup_datetime)", f", any_value({MONTH_LABEL}) AS month_label"),
    "heatmap_hour_dow": "SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour, "
    + ", ".join(
        f"round(sum(duration_s) FILTER (WHERE {DAY} = {i}) / (60.0::DOUBLE * count(*) FILTER (WHERE {DAY} = {i})), 6) AS {name}"
        for i, name in enumerate(["mon", "tue", "wed", "thu", "fri", "sat", "sun"])
    )
    + " FROM train GROUP BY 1",
    "heatmap_hour_dow_count": "SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour, "
    + ", ".join(
        f"nullif(count(*) FILTER (WHERE {DAY} = {i}), 0) AS {name}"
        for i, name in enumerate(["mon", "tue", "wed", "thu", "fri", "sat", "sun"])
    )
    + " FROM train GROUP BY 1",
    "peak_hours": f"""SELECT (SELECT hour FROM h ORDER BY mean_minutes DESC, hour LIMIT 1) AS max_hour,
      (SELECT max(mean_minutes) FROM h) AS max_mean_minutes, (SELECT hour FROM h ORDER BY mean_minutes, hour LIMIT 1) AS min_hour,
      (SELECT min(mean_minutes) FROM h) AS min_mean_minutes FROM (SELECT 1)""",
    "corr_matrix": CORRELATION,
    "corr_pair": "SELECT round(corr(trip_distance, trip_duration_minutes), 6) AS correlation FROM train",
    "box_duration": f"""SELECT count(*) AS trips, {BOX} FROM train, (SELECT quantile_cont(duration_s, 0.25) AS q1,
      quantile_cont(duration_s, 0.5) AS q2, quantile_cont(duration_s, 0.75) AS q3 FROM train) GROUP BY q1, q2, q3""",
    "box_by_ratecode": f"""SELECT RatecodeID, {RATE_LABEL} AS rate_label, count(*) AS trips, {BOX}
      FROM train JOIN (SELECT RatecodeID, quantile_cont(duration_s, 0.25) AS q1, quantile_cont(duration_s, 0.5) AS q2,
        quantile_cont(duration_s, 0.75) AS q3 FROM train GROUP BY 1) USING (RatecodeID)
      WHERE RatecodeID IN (1, 2, 3, 4, 5, 6) GROUP BY RatecodeID, q1, q2, q3""",
    "avg_speed": """SELECT count(*) AS trips, round(avg(mph), 6) AS mean_mph, round(quantile_cont(mph, 0.5), 6) AS median_mph
      FROM (SELECT trip_distance / trip_duration_minutes * 60 AS mph FROM train) WHERE mph > 0 AND mph <= 80""",
    "top_pickup_zones": """SELECT t.LocationID, coalesce(Zone, CAST(t.LocationID AS VARCHAR)) AS zone_label, Borough, trips FROM
      (SELECT PULocationID AS LocationID, count(*) AS trips FROM train GROUP BY 1 ORDER BY trips DESC, LocationID LIMIT 20) t
      LEFT JOIN zones USING (LocationID)""",
    "top_dropoff_zones": """SELECT t.LocationID, coalesce(Zone, CAST(t.LocationID AS VARCHAR)) AS zone_label, Borough, trips FROM
      (SELECT DOLocationID AS LocationID, count(*) AS trips FROM train GROUP BY 1 ORDER BY trips DESC, LocationID LIMIT 20) t
      LEFT JOIN zones USING (LocationID)""",
    "sample_trips": f"""SELECT {KEY}, trip_distance, round(trip_duration_minutes, 6) AS trip_duration_minutes
      FROM ({CTES['keyed']} train) ORDER BY h LIMIT 10000""",
    "ts_split": f"""SELECT {KEY}, trip_distance, total_amount, passenger_count, RatecodeID, payment_type, store_and_fwd_flag, block
      FROM blocks""",
    "ts_split_short": f"""SELECT {KEY}, trip_distance, fare_amount, passenger_count, RatecodeID, payment_type, store_and_fwd_flag, block
      FROM short_blocks""",
    "ts_split_drifted": f"""SELECT {KEY}, trip_distance, total AS total_amount, passenger_count, RatecodeID, payment_type, store_and_fwd_flag, block
      FROM drifted_blocks""",
    "clip": f"""SELECT {KEY}, round(greatest(trip_distance / 12.5 * 60 - 60, 0), 6) AS evaluated,
      round(least(greatest(trip_distance / 12.5 * 60 - 60, 1), 300), 6) AS served FROM clean""",
    "error_columns": f"""SELECT {KEY}, round(error_minutes, 6) AS error_minutes, round(abs_error, 6) AS abs_error,
      round(abs_error / trip_duration_minutes * 100, 6) AS pct_error FROM errors""",
    "baseline_metrics": "SELECT * FROM measured",
    "leaderboard": "SELECT * FROM board",
    "success_criteria": """SELECT 'RMSE' AS criterion, 5.0::DOUBLE AS target, RMSE AS achieved,
        CASE WHEN RMSE < 5 THEN 'PASS' ELSE 'FAIL' END AS status FROM board WHERE is_best
      UNION ALL SELECT 'MAE', 3.0, MAE, CASE WHEN MAE < 3 THEN 'PASS' ELSE 'FAIL' END FROM board WHERE is_best
      UNION ALL SELECT 'R2', 0.8, R2, CASE WHEN R2 > 0.8 THEN 'PASS' ELSE 'FAIL' END FROM board WHERE is_best
      UNION ALL SELECT 'beats_baseline', b.RMSE, m.RMSE, CASE WHEN m.RMSE < b.RMSE THEN 'PASS' ELSE 'FAIL' END
        FROM board m, measured b WHERE m.is_best AND b.model = 'baseline'""",
    "cv_baseline": """SELECT 'baseline' AS model, count(*) AS folds, """
    + ", ".join(
        f"round({f}({m}), 4) AS {m}_{s}" for m in ("RMSE", "MAE", "R2") for f, s in (("avg", "mean"), ("stddev_pop", "std"))
    )
    + """ FROM (SELECT block, sqrt(avg((y - p) * (y - p))) AS RMSE, avg(abs(y - p)) AS MAE,
        1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS R2
      FROM (SELECT block, trip_duration_minutes AS y, trip_distance / 12.5 * 60 AS p FROM blocks WHERE block > 0) GROUP BY block)""",
    "residual_summary": """SELECT count(*) AS rows, round(avg(error_minutes), 6) AS mean_error,
      round(stddev_pop(error_minutes), 6) AS std_error, round(avg(CAST(abs_error <= 5 AS INTEGER)) * 100, 4) AS within_5_pct,
      round(avg(CAST(abs_error <= 3 AS INTEGER)) * 100, 4) AS within_3_pct FROM errors""",
    "err_by_hour": error_by("CAST(hour AS INTEGER) AS hour") + " GROUP BY 1",
    "err_by_dow": error_by("CAST(day_of_week AS INTEGER) AS day_of_week") + " GROUP BY 1",
    "err_by_distance": error_by(
        BAND.format("'<1mi'", "'1-2mi'", "'2-5mi'", "'5-10mi'", "'10-20mi'", "'>20mi'")
        + " AS band, CAST("
        + BAND.format(*range(6))
        + " AS INTEGER) AS band_order"
    )
    + " GROUP BY 1, 2 HAVING band IS NOT NULL",
    "err_extremes": """SELECT (SELECT hour FROM e ORDER BY mae DESC, hour LIMIT 1) AS max_hour, (SELECT max(mae) FROM e) AS max_mae,
      (SELECT hour FROM e ORDER BY mae, hour LIMIT 1) AS min_hour, (SELECT min(mae) FROM e) AS min_mae FROM (SELECT 1)""",
    "err_sample": f"""SELECT {KEY}, round(trip_duration_minutes, 6) AS trip_duration_minutes,
      round(route_mean_duration, 6) AS route_mean_duration, round(abs_error, 6) AS abs_error
      FROM ({CTES['keyed']} errors) ORDER BY h LIMIT 5000""",
    "prediction_export": matrix_select(
        features.SHORT_FEATURES,
        f"({CTES['keyed']} errors ORDER BY h LIMIT 100000)",
        "round(trip_duration_minutes, 6) AS actual_duration",
        "round(route_mean_duration, 6) AS predicted_duration",
        "round(baseline_duration, 6) AS baseline_pred",
        "round(error_minutes, 6) AS error_minutes",
        "round(abs_error, 6) AS abs_error",
    ),
    "prediction_export_5k": matrix_select(
        features.SHORT_FEATURES,
        f"({CTES['keyed']} errors ORDER BY h LIMIT 5000)",
        "round(trip_duration_minutes, 6) AS actual_duration",
        "round(route_mean_duration, 6) AS predicted_duration",
        "round(baseline_duration, 6) AS baseline_pred",
        "round(error_minutes, 6) AS error_minutes",
        "round(abs_error, 6) AS abs_error",
    ),
    "score_validate": """SELECT event_id, pickup_location_id, dropoff_location_id, trip_distance, passenger_count, rate_code_id,
      payment_type, fare_amount, pickup_ts, reject_reason FROM checked""",
    "score_validate_form": """SELECT event_id, trip_distance, fare_amount, CASE
        WHEN NOT coalesce(pickup_location_id BETWEEN 1 AND 265, false) THEN 'pickup_location_id'
        WHEN NOT coalesce(dropoff_location_id BETWEEN 1 AND 265, false) THEN 'dropoff_location_id'
        WHEN NOT coalesce(trip_distance > 0, false) THEN 'trip_distance'
        WHEN pickup_ts IS NULL THEN 'pickup_datetime'
        WHEN NOT coalesce(passenger_count BETWEEN 1 AND 8, false) THEN 'passenger_count'
        WHEN NOT coalesce(rate_code_id BETWEEN 1 AND 6, false) THEN 'rate_code_id'
        WHEN NOT coalesce(payment_type BETWEEN 1 AND 6, false) THEN 'payment_type'
        WHEN NOT coalesce(fare_amount >= 0, false) THEN 'fare_amount' END AS reject_reason
      FROM (SELECT *, coalesce(given_fare, CAST(round(CAST(trip_distance AS DECIMAL(18,6)) * 3.5, 2) AS DOUBLE)) AS fare_amount FROM typed_requests)""",
    "score_features": matrix_select(features.FULL_FEATURES, "request_features", "event_id"),
    "score_baseline": "SELECT * FROM scored",
    "eta": f"""SELECT * EXCLUDE (p), strftime(p + to_seconds(CAST(round(predicted_duration_minutes * 60) AS INTEGER)), '%H:%M') AS arrival,
      round(predicted_duration_minutes - baseline_duration_minutes, 2) AS delta_minutes,
      CASE WHEN predicted_duration_minutes < 20 THEN 'short' WHEN predicted_duration_minutes < 45 THEN 'medium'
        WHEN predicted_duration_minutes <= 120 THEN 'long' END AS band,
      CASE WHEN hour(p) BETWEEN 7 AND 9 OR hour(p) BETWEEN 16 AND 19 THEN 'rush' ELSE 'off-peak' END AS traffic,
      CASE WHEN isodow(p) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_kind
      FROM (SELECT *, CAST(pickup_datetime AS TIMESTAMP) AS p FROM scored)""",
    "stream_score_baseline": """SELECT event_id, predicted_duration_minutes, baseline_duration_minutes, model_used, pickup_datetime,
      NULL AS reject_reason FROM scored
      UNION ALL SELECT event_id, NULL, NULL, NULL, pickup_datetime, reject_reason FROM checked WHERE reject_reason IS NOT NULL""",
}
SQL["model_report"] = f"""SELECT unnest(['# Model evaluation', '', '', '', '| Model | RMSE | MAE | R2 | MAPE % |', '|---|---|---|---|---|',
        '| Criterion | Target | Achieved | Status |', '|---|---|---|---|']) AS value
      UNION ALL SELECT printf('Best model: **%s**. RMSE %.4f min (%.1f%% below the baseline), MAE %.4f min (%.1f%% below), R2 %.4f (%+.4f).',
        model, RMSE, rmse_gain_pct, MAE, mae_gain_pct, R2, r2_gain) FROM board WHERE is_best
      UNION ALL SELECT printf('| %s | %.4f | %.4f | %.4f | %.2f |', CASE WHEN is_best THEN model || ' (best)' ELSE model END, RMSE, MAE, R2, MAPE) FROM board
      UNION ALL SELECT printf('| %s | %.2f | %.2f | %s |', criterion, target, achieved, status) FROM ({SQL["success_criteria"]})"""
SQL["scaled_features"] = " UNION ALL ".join(
    f"""SELECT {i} AS position, 0.0::DOUBLE AS abs_mean,
      CASE WHEN stddev_samp({c}) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS std FROM train_features"""
    for i, c in enumerate(features.FULL_FEATURES)
)
SQL["ols_1d"] = """SELECT count(*) AS rows, round(regr_slope(trip_duration_minutes, trip_distance), 9) AS slope,
      round(regr_intercept(trip_duration_minutes, trip_distance), 9) AS intercept FROM train"""
SQL["model_leaderboard_1d"] = "SELECT * FROM line_board"
SQL["score_batch_1d"] = "SELECT * FROM line_scored"
SQL["stream_score_1d"] = re.sub(r"\bscored\b", "line_scored", SQL["stream_score_baseline"])
SQL["gbt_stump"] = """SELECT CAST(h AS DOUBLE) AS hour, k AS trips,
      round(CASE WHEN h <= cut THEN left_y / left_k ELSE (all_y - left_y) / (all_k - left_k) END, 6) AS predicted
      FROM hours, (SELECT * FROM (SELECT h AS cut, sum(y) OVER w AS left_y, sum(k) OVER w AS left_k, sum(y) OVER () AS all_y,
          sum(k) OVER () AS all_k FROM hours WINDOW w AS (ORDER BY h))
        WHERE left_k < all_k
        ORDER BY left_y * left_y / left_k + (all_y - left_y) * (all_y - left_y) / (all_k - left_k) DESC LIMIT 1)"""
def grown_stumps(source: str, rate: float, rounds: int, l1: float, l2: float, least: int = 50) -> str:
    """Stumps on h by rounds over ``source`` (h; n, s: fitted rows and their sum; vn, vs, vq: held-out rows, sum, sum of squares):
    columns r (rounds so far), h, f (prediction so far) and the source's own."""
    split = f"CASE WHEN ln >= {least} AND tn - ln >= {least} THEN ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) ELSE -1 END"

    def leaf(total: str, rows: str) -> str:
        return f"sign({total}) * greatest(abs({total}) - {l1}, 0) / ({rows} + {l2})"

    return f"""(WITH RECURSIVE grown AS (
        SELECT 0 AS r, s0.*, (SELECT sum(s) / sum(n) FROM ({source})) AS f FROM ({source}) s0
        UNION ALL
        SELECT r + 1, h, n, s, vn, vs, vq, f + {rate} * CASE WHEN h <= cut THEN {leaf("cs", "cn")} ELSE {leaf("(ts - cs)", "(tn - cn)")} END
        FROM (SELECT *, first_value(h) OVER best AS cut, first_value(ls) OVER best AS cs, first_value(ln) OVER best AS cn
          FROM (SELECT *, sum(n) OVER up AS ln, sum(s - n * f) OVER up AS ls, sum(n) OVER () AS tn, sum(s - n * f) OVER () AS ts
            FROM grown WHERE r < {rounds} WINDOW up AS (ORDER BY h ROWS UNBOUNDED PRECEDING))
          WINDOW best AS (ORDER BY {split} DESC, h ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)))
      SELECT * FROM grown)"""


HELD_HOURS = """SELECT hour(tpep_pickup_datetime) AS h, count(*) FILTER (block < 5) AS n, sum(trip_duration_minutes) FILTER (block < 5) AS s,
      count(*) FILTER (block = 5) AS vn, coalesce(sum(trip_duration_minutes) FILTER (block = 5), 0) AS vs,
      coalesce(sum(trip_duration_minutes * trip_duration_minutes) FILTER (block = 5), 0) AS vq FROM blocks GROUP BY 1"""
CTES["progress"] = f"""
        SELECT r, e, arg_min(r, e) OVER (ORDER BY r) AS best FROM (
          SELECT r, sum(vq - 2 * f * vs + vn * f * f) / sum(vn) AS e FROM {grown_stumps(HELD_HOURS, 0.3, 24, 0, 0)} WHERE r > 0 GROUP BY r)"""
SQL["boosting_patience"] = """SELECT CAST(r AS INTEGER) AS round, round(sqrt(e), 6) AS RMSE,
      r <= (SELECT best FROM progress p, ends WHERE p.r = last_round) AS kept FROM progress, ends WHERE r <= last_round"""
CTES["ends"] = "SELECT coalesce(min(r) FILTER (r - best >= 3), max(r)) AS last_round FROM progress"
ALL_HOURS = "SELECT h, k AS n, y AS s, 0 AS vn, 0 AS vs, 0 AS vq FROM hours"
SQL["boosting_penalties"] = f"""SELECT CAST(h AS DOUBLE) AS hour, n AS trips, round(f, 6) AS predicted
      FROM {grown_stumps(ALL_HOURS, 0.5, 4, 40.0, 25.0)} WHERE r = 4"""


def best_splits(source: str, keys: str) -> str:
    """The best split of every group of ``source`` (keys, feature, x, y): keys, feature, cut, gain, sum and rows on the left and in all."""
    by = f"PARTITION BY {keys}, feature ORDER BY x"
    return f"""SELECT {keys}, feature, x AS cut, gain, ls, ln, ts, tn FROM (
        SELECT *, ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) - ts * ts / tn AS gain FROM (
          SELECT {keys}, feature, x, sum(n) OVER (PARTITION BY {keys}, feature) AS tn, sum(s) OVER (PARTITION BY {keys}, feature) AS ts,
            sum(n) OVER ({by}) AS ln, sum(s) OVER ({by}) AS ls
          FROM (SELECT {keys}, feature, x, count(*) AS n, sum(y) AS s FROM ({source}) GROUP BY ALL))
        WHERE ln >= 50 AND tn - ln >= 50)
      QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY gain DESC, feature, x) = 1 AND gain > 0"""


CTES["three_inputs"] = """
        SELECT row, y, unnest(['hour', 'day_of_week', 'passenger_count']) AS feature, unnest([a, b, c]) AS x
        FROM (SELECT row_number() OVER () AS row, trip_duration_minutes - avg(trip_duration_minutes) OVER () AS y,
          CAST(hour(tpep_pickup_datetime) AS DOUBLE) AS a, CAST(isodow(tpep_pickup_datetime) - 1 AS DOUBLE) AS b, passenger_count AS c FROM train)"""
CTES["top_split"] = best_splits("SELECT 0 AS side, * FROM three_inputs", "side")
CTES["sides"] = """
        SELECT t.*, CAST(s.x <= cut AS INTEGER) AS side FROM three_inputs t
        JOIN (SELECT row, x, cut FROM three_inputs JOIN top_split USING (feature)) s USING (row)"""
SQL["tree_importance"] = f"""SELECT feature, round(sum(gain), 4) AS gain, count(*) AS splits, round(sum(gain) / sum(sum(gain)) OVER (), 4) AS importance
      FROM (SELECT feature, gain FROM top_split UNION ALL SELECT feature, gain FROM ({best_splits("SELECT * FROM sides", "side")})) GROUP BY feature"""
SQL["stump_importance"] = f"""SELECT feature, round(gain, 4) AS gain, 1::BIGINT AS splits, 1.0::DOUBLE AS importance
      FROM ({best_splits("SELECT 0 AS side, * FROM three_inputs WHERE feature = 'hour'", "side")})"""


def drawn_points(space: dict[str, list], n: int, seed: int = 42) -> str:
    """n points of a grid by the lowest md5 of "seed:number"; the digits of a number are its places on the axes."""
    total = prod(len(axis) for axis in space.values())
    columns, step = [], total
    for name, axis in space.items():
        step //= len(axis)
        kind = "DOUBLE" if any(isinstance(v, float) for v in axis) else "INTEGER"
        columns.append(f"([{', '.join(f'{v}::{kind}' for v in axis)}])[1 + number // {step} % {len(axis)}] AS {name}")
    return f"""SELECT CAST(place - 1 AS INTEGER) AS draw, number, {", ".join(columns)}
      FROM (SELECT range AS number, row_number() OVER (ORDER BY md5('{seed}:' || range)) AS place FROM range({total})) WHERE place <= {n}"""


SQL["search_plan"] = f"""SELECT p.*, f.block, rows_fitted, rows_held,
      CASE subsample WHEN 0.7 THEN a WHEN 0.8 THEN b WHEN 0.9 THEN c ELSE d END AS rows_sampled
      FROM ({drawn_points(pipelines.BOOSTING_SPACE, pipelines.SEARCH_DRAWS)}) p,
        (SELECT h.block, rows_held, count(*) AS rows_fitted, count(*) FILTER (place < 7000) AS a, count(*) FILTER (place < 8000) AS b,
           count(*) FILTER (place < 9000) AS c, count(*) FILTER (place < 10000) AS d
         FROM (SELECT block, ('0x' || substr(h, 1, 8))::BIGINT % 10000 AS place FROM ({CTES["keyed"]} blocks)) t
         JOIN (SELECT block, count(*) AS rows_held FROM blocks WHERE block > 0 GROUP BY 1) h ON t.block < h.block GROUP BY ALL) f"""
SQL["model_inputs"] = "SELECT unnest([" + ", ".join(
    f"{{'position': {i}, 'feature': '{c}', 'mean': round(avg({c}), 6), 'std': round(stddev_samp({c}), 6)}}" for i, c in enumerate(features.FULL_FEATURES)
) + "], recursive := true) FROM train_features"
SQL["cv_ols_1d"] = """SELECT block, count(*) AS rows, round(sqrt(avg((y - p) * (y - p))), 6) AS RMSE,
      round(avg(abs(y - p)), 6) AS MAE, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS R2
      FROM (SELECT b.block, trip_duration_minutes AS y, greatest(intercept + slope * trip_distance, 0) AS p
        FROM blocks b JOIN (SELECT h.block, regr_slope(t.trip_duration_minutes, t.trip_distance) AS slope,
            regr_intercept(t.trip_duration_minutes, t.trip_distance) AS intercept
          FROM blocks t JOIN (SELECT DISTINCT block FROM blocks WHERE block > 0) h ON t.block < h.block GROUP BY h.block) f
        ON b.block = f.block) GROUP BY block"""
SQL["ridge_grid_1d"] = """SELECT alpha, round(m, 6) AS RMSE_mean, m = min(m) OVER () AS is_best
      FROM (SELECT alpha, avg(rmse) AS m FROM (SELECT alpha, block, sqrt(avg((y - p) * (y - p))) AS rmse
        FROM (SELECT alpha, b.block, trip_duration_minutes AS y,
            ybar + slope * f.n / (f.n + alpha) * (trip_distance - xbar) AS p
          FROM blocks b JOIN (SELECT h.block, count(*) AS n, avg(t.trip_distance) AS xbar, avg(t.trip_duration_minutes) AS ybar,
              regr_slope(t.trip_duration_minutes, t.trip_distance) AS slope
            FROM blocks t JOIN (SELECT DISTINCT block FROM blocks WHERE block > 0) h ON t.block < h.block GROUP BY h.block) f
          ON b.block = f.block, (SELECT unnest([0.01::DOUBLE, 0.1, 1.0, 10.0, 100.0, 1000.0]) AS alpha))
        GROUP BY alpha, block) GROUP BY alpha)"""
SQL["ridge_grid_short_1d"] = SQL["ridge_grid_1d"].replace("[0.01::DOUBLE, 0.1, 1.0,", "[0.1::DOUBLE, 1.0,")
SQL["cv_scores_1d"] = f"""SELECT model, count(*) AS folds, round(avg(RMSE), 4) AS RMSE_mean, round(stddev_pop(RMSE), 4) AS RMSE_std,
      round(avg(MAE), 4) AS MAE_mean, round(stddev_pop(MAE), 4) AS MAE_std, round(avg(R2), 4) AS R2_mean, round(stddev_pop(R2), 4) AS R2_std,
      CASE WHEN model = 'ridge_regression' THEN any_value(alpha) END AS best_alpha
      FROM (SELECT model, block, any_value(alpha) AS alpha, sqrt(avg((y - p) * (y - p))) AS RMSE, avg(abs(y - p)) AS MAE,
          1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS R2
        FROM (SELECT model, block, alpha, trip_duration_minutes AS y, CASE model WHEN 'baseline' THEN trip_distance / 12.5 * 60
            WHEN 'linear_regression' THEN greatest(ybar + slope * (trip_distance - xbar), 0)
            ELSE greatest(ybar + slope * f.n / (f.n + alpha) * (trip_distance - xbar), 0) END AS p
          FROM blocks JOIN fold_lines f USING (block), (SELECT alpha FROM ({SQL["ridge_grid_1d"]}) WHERE is_best) best,
            (SELECT unnest(['baseline', 'linear_regression', 'ridge_regression']) AS model) models)
        GROUP BY model, block) GROUP BY model"""
CTES["fold_stumps"] = best_splits("""SELECT h.block AS held, 'hour' AS feature, hour(tpep_pickup_datetime) AS x, trip_duration_minutes AS y
        FROM blocks t JOIN (SELECT DISTINCT block FROM blocks WHERE block > 0) h ON t.block < h.block""", "held")
SQL["cv_document_1d"] = f"""SELECT *, NULL::VARCHAR AS best_params FROM ({SQL["cv_scores_1d"]})
      UNION ALL
      SELECT 'boosted_trees', count(*), round(avg(RMSE), 4), round(stddev_pop(RMSE), 4), round(avg(MAE), 4), round(stddev_pop(MAE), 4),
        round(avg(R2), 4), round(stddev_pop(R2), 4), NULL, '{{"depth":"1","n_estimators":"1"}}'
      FROM (SELECT sqrt(avg((y - p) * (y - p))) AS RMSE, avg(abs(y - p)) AS MAE, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS R2
        FROM (SELECT block, trip_duration_minutes AS y, greatest(0, ts / tn + 0.2::DOUBLE * (CASE WHEN hour(tpep_pickup_datetime) <= cut THEN ls / ln
            ELSE (ts - ls) / (tn - ln) END - ts / tn)) AS p
          FROM blocks JOIN fold_stumps ON held = block) GROUP BY block)"""
SQL["peak_hours"] = f"WITH_H({mean_by('hour', 'hour(tpep_pickup_datetime)')})" + SQL["peak_hours"]
SQL["err_extremes"] = "WITH_E(" + error_by("CAST(hour AS INTEGER) AS hour") + " GROUP BY 1)" + SQL["err_extremes"]


def oracle(name: str) -> str:
    body = SQL[name]
    local = re.match(r"WITH_([HE])\((.*?GROUP BY 1)\)(.*)", body, re.S)
    if local:
        alias, source, rest = local.groups()
        prefix = build(source)
        return prefix[: len(prefix) - len(source)].rstrip() + f",\n{alias.lower()} AS MATERIALIZED ({source})\n{rest}"
    return build(body)


HISTOGRAMS = {
    "hist_duration": "SELECT duration_s AS x FROM train",
    "hist_speed": "SELECT mph AS x FROM (SELECT trip_distance / trip_duration_minutes * 60 AS mph FROM train) WHERE mph > 0 AND mph <= 80",
    "hist_residual": "SELECT round(error_minutes, 6) AS x FROM errors",
}


def oracles() -> dict[str, str]:
    result = {name: oracle(name) for name in SQL}
    result.update({name: hist_query(values) for name, values in HISTOGRAMS.items()})
    return result
