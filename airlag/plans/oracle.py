"""SQL twins of the registered queries, for an independent engine."""

from __future__ import annotations

FLIGHTS = """
flights AS (
  SELECT CAST(l_shipdate AS DATE) AS FlightDate,
         CAST(year(l_shipdate) AS BIGINT) AS Year,
         CAST(month(l_shipdate) AS BIGINT) AS Month,
         CAST(isodow(l_shipdate) AS BIGINT) AS DayOfWeek,
         CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS Cancelled,
         CAST(CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS BIGINT) AS Diverted,
         concat('  ', lower(substr(o_orderpriority, 3)), ' ') AS IATA_Code_Marketing_Airline,
         l_suppkey % 10 AS Flight_Number_Marketing_Airline,
         lower(sn.n_name) AS Origin,
         concat(cn.n_name, ' ') AS Dest,
         (l_partkey % 24) * 100 + l_suppkey % 60 AS CRSDepTime,
         CASE WHEN l_tax = 0 THEN NULL ELSE l_quantity - 25 END AS DepDelay,
         ((l_partkey + 2) % 24) * 100 + l_suppkey % 60 AS CRSArrTime,
         CASE WHEN l_discount = 0 THEN NULL ELSE
           CAST(((date_diff('day', o_orderdate, l_shipdate) % 480) + 480) % 480 - 90 AS DOUBLE)
         END AS ArrDelay,
         CAST(floor(l_extendedprice / 10) AS DOUBLE) AS Distance,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey
)"""

FLOWN = """
flown AS (
  SELECT * FROM flights
  WHERE Cancelled = 0 AND Diverted = 0 AND ArrDelay IS NOT NULL
    AND ArrDelay BETWEEN -60 AND 360
)"""

SILVER_COLUMNS = (
    "flight_date, year, month, day_of_week, airline, flight_number, origin, dest, "
    "crs_dep_time, dep_delay, crs_arr_time, arr_delay, distance, hour, season, route"
)


def cleaned(date: str = "CAST(FlightDate AS VARCHAR)", source: str = "flown") -> str:
    return f"""
cleaned AS (
  SELECT *, concat(origin, '-', dest) AS route FROM (
    SELECT {date} AS flight_date, Year AS year, Month AS month, DayOfWeek AS day_of_week,
           upper(trim(IATA_Code_Marketing_Airline)) AS airline,
           Flight_Number_Marketing_Airline AS flight_number,
           upper(trim(Origin)) AS origin, upper(trim(Dest)) AS dest,
           CRSDepTime AS crs_dep_time, DepDelay AS dep_delay, CRSArrTime AS crs_arr_time,
           ArrDelay AS arr_delay, Distance AS distance,
           CAST(floor(CRSDepTime / 100) AS TINYINT) AS hour,
           CASE WHEN Month IN (12, 1, 2) THEN 'Winter' WHEN Month IN (3, 4, 5) THEN 'Spring'
                WHEN Month IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
           l_orderkey, l_linenumber, l_partkey, l_suppkey
    FROM {source}
  )
)"""


SILVER = f"""
silver AS (
  SELECT {SILVER_COLUMNS} FROM cleaned
  QUALIFY row_number() OVER (
    PARTITION BY flight_date, airline, flight_number, origin, dest
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, arr_delay, distance,
             dep_delay NULLS LAST, crs_dep_time) = 1
)"""

P95 = (
    "list_sort(list(arr_delay))"
    "[CAST(round((count(*) - 1) * 0.95::DOUBLE) AS BIGINT) + 1]"
)
RATE = "avg(CASE WHEN arr_delay > 15 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"


def over_flights(body: str) -> str:
    return f"WITH {FLIGHTS} {body}"


def over_flown(body: str) -> str:
    return f"WITH {FLIGHTS}, {FLOWN} {body}"


def over_cleaned(body: str, date: str = "CAST(FlightDate AS VARCHAR)") -> str:
    return f"WITH {FLIGHTS}, {FLOWN}, {cleaned(date)} {body}"


def over_silver(body: str, *ctes: str) -> str:
    return "WITH " + ", ".join([FLIGHTS, FLOWN, cleaned(), SILVER, *ctes]) + " " + body


AIRLINE = f"""
airline_mart AS (
  SELECT year, month, airline, count(*) AS flight_count, avg(arr_delay) AS avg_arr_delay,
         median(arr_delay) AS median_arr_delay, {P95} AS p95_arr_delay, {RATE} AS delay_rate,
         avg(dep_delay) AS avg_dep_delay, avg(distance) AS avg_distance
  FROM silver GROUP BY year, month, airline
)"""

ROUTE = f"""
route_mart AS (
  SELECT year, month, origin, dest, route, count(*) AS flight_count,
         avg(arr_delay) AS avg_arr_delay, median(arr_delay) AS median_arr_delay,
         {P95} AS p95_arr_delay, {RATE} AS delay_rate, avg(distance) AS avg_distance
  FROM silver GROUP BY year, month, origin, dest, route
)"""

TIME = f"""
time_mart AS (
  SELECT year, month, day_of_week, hour, season, count(*) AS flight_count,
         avg(arr_delay) AS avg_arr_delay, median(arr_delay) AS median_arr_delay,
         {RATE} AS delay_rate, avg(dep_delay) AS avg_dep_delay
  FROM silver GROUP BY year, month, day_of_week, hour, season
)"""

AIRPORT = f"""
airport_mart AS (
  SELECT year, month, origin AS airport, count(*) AS flight_count,
         avg(dep_delay) AS avg_dep_delay, avg(arr_delay) AS avg_arr_delay,
         {RATE} AS delay_rate, 'origin' AS airport_role
  FROM silver GROUP BY year, month, origin
  UNION ALL
  SELECT year, month, dest, count(*), CAST(NULL AS DOUBLE), avg(arr_delay), {RATE}, 'destination'
  FROM silver GROUP BY year, month, dest
)"""

FEATURES = """
features AS (
  SELECT flight_date, year, month, airline, origin, dest, route, distance, hour, day_of_week,
         season, dep_delay, arr_delay,
         CAST(CASE WHEN arr_delay > 15 THEN 1 ELSE 0 END AS TINYINT) AS is_delayed,
         CAST(count(*) OVER (PARTITION BY flight_date, origin) AS INTEGER) AS origin_day_flights,
         CAST(count(*) OVER (PARTITION BY flight_date, dest) AS INTEGER) AS dest_day_flights,
         CAST(count(*) OVER (PARTITION BY flight_date, airline) AS INTEGER) AS airline_day_flights,
         CAST(count(*) OVER (PARTITION BY flight_date, route) AS INTEGER) AS route_day_flights,
         CAST(count(*) OVER (PARTITION BY flight_date, origin, hour) AS INTEGER) AS origin_hour_flights,
         CAST(count(*) OVER (PARTITION BY flight_date, route, hour) AS INTEGER) AS route_hour_flights
  FROM silver
)"""

BUCKET = """CASE WHEN arr_delay < -15 THEN '< -15' WHEN arr_delay < 0 THEN '-15..0'
  WHEN arr_delay <= 15 THEN '0..15' WHEN arr_delay <= 60 THEN '16..60'
  WHEN arr_delay <= 180 THEN '61..180' ELSE '> 180' END"""

CORE = {
    "silver_clean": over_cleaned(f"SELECT {SILVER_COLUMNS} FROM cleaned"),
    "silver_dedup": over_silver("SELECT * FROM silver"),
    "silver_filter": over_flown(
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, Cancelled AS cancelled, "
        "Diverted AS diverted, ArrDelay AS arr_delay FROM flown"
    ),
    "silver_hour": over_cleaned(
        "SELECT l_orderkey, l_linenumber, crs_dep_time, hour FROM cleaned"
    ),
    "silver_season": over_cleaned(
        "SELECT l_orderkey, l_linenumber, month, season FROM cleaned"
    ),
    "silver_route": over_cleaned(
        "SELECT l_orderkey, l_linenumber, origin, dest, route FROM cleaned"
    ),
    "normalize_codes": over_flights(
        "SELECT l_orderkey, l_linenumber, upper(trim(IATA_Code_Marketing_Airline)) AS airline, "
        "upper(trim(Origin)) AS origin, upper(trim(Dest)) AS dest FROM flights"
    ),
    "resolve_columns": over_flights(
        "SELECT concat(CAST(Year AS VARCHAR), '-', CAST(Month AS VARCHAR), '-', "
        "CAST(day(FlightDate) AS VARCHAR)) AS flight_date, Year AS year, Month AS month, "
        "DayOfWeek AS day_of_week, Cancelled AS cancelled, Diverted AS diverted, "
        "IATA_Code_Marketing_Airline AS airline, "
        "Flight_Number_Marketing_Airline AS flight_number, Origin AS origin, Dest AS dest, "
        "CRSDepTime AS crs_dep_time, DepDelay AS dep_delay, CRSArrTime AS crs_arr_time, "
        "ArrDelay AS arr_delay, Distance AS distance FROM flights"
    ),
    "flight_date_iso": over_cleaned(
        "SELECT l_orderkey, l_linenumber, flight_date FROM cleaned"
    ),
    "flight_date_ymd": over_cleaned(
        "SELECT l_orderkey, l_linenumber, flight_date FROM cleaned",
        "concat(CAST(Year AS VARCHAR), '-', CAST(Month AS VARCHAR), '-', "
        "CAST(day(FlightDate) AS VARCHAR))",
    ),
    "flight_date_ym": over_cleaned(
        "SELECT l_orderkey, l_linenumber, flight_date FROM cleaned",
        "concat(CAST(Year AS VARCHAR), '-', CAST(Month AS VARCHAR))",
    ),
    "airline_delay": over_silver("SELECT * FROM airline_mart", AIRLINE),
    "p95_nearest": over_silver(
        "SELECT year, month, airline, p95_arr_delay FROM airline_mart", AIRLINE
    ),
    "airport_delay": over_silver("SELECT * FROM airport_mart", AIRPORT),
    "route_delay": over_silver("SELECT * FROM route_mart", ROUTE),
    "time_delay": over_silver("SELECT * FROM time_mart", TIME),
    "silver_overview": over_silver(
        "SELECT count(*) AS rows, min(flight_date) AS min_flight_date, "
        "max(flight_date) AS max_flight_date, "
        "count(DISTINCT airline) + max(CASE WHEN airline IS NULL THEN 1 ELSE 0 END) AS airlines, "
        "count(DISTINCT origin) + max(CASE WHEN origin IS NULL THEN 1 ELSE 0 END) AS origins, "
        "count(DISTINCT dest) + max(CASE WHEN dest IS NULL THEN 1 ELSE 0 END) AS destinations, "
        "count(DISTINCT route) + max(CASE WHEN route IS NULL THEN 1 ELSE 0 END) AS routes, "
        "avg(arr_delay) AS mean_arr_delay, median(arr_delay) AS median_arr_delay, "
        f"{P95} AS p95_arr_delay, {RATE} AS delay_rate FROM silver"
    ),
    "delay_histogram": over_silver(
        f"SELECT {BUCKET} AS delay_bucket, count(*) AS flights FROM silver GROUP BY 1 ORDER BY 1"
    ),
    "partition_pruned_mean": over_silver(
        "SELECT airline, origin, hour, avg(arr_delay) AS avg_arr_delay FROM silver "
        "WHERE year = 1995 AND month = 1 GROUP BY airline, origin, hour"
    ),
    "airline_origin_hour": over_silver(
        "SELECT airline, origin, hour, avg(arr_delay) AS avg_arr_delay FROM silver "
        "WHERE arr_delay > 15 GROUP BY airline, origin, hour"
    ),
    "top_airlines": over_silver(
        "SELECT * FROM airline_mart ORDER BY avg_arr_delay DESC NULLS FIRST, "
        "year, month, airline LIMIT 10",
        AIRLINE,
    ),
    "top_routes": over_silver(
        "SELECT * FROM route_mart ORDER BY avg_arr_delay DESC NULLS FIRST, "
        "year, month, origin, dest LIMIT 10",
        ROUTE,
    ),
    "time_head": over_silver(
        "SELECT * FROM time_mart ORDER BY day_of_week, hour, year, month, season LIMIT 24",
        TIME,
    ),
    "ml_features": over_silver("SELECT * FROM features", FEATURES),
}

EARLY = f"""
early AS (
  SELECT * REPLACE (greatest(arr_delay - 5, -60.0::DOUBLE) AS arr_delay)
  FROM silver WHERE year <= 1996
), fresh AS (
  SELECT * FROM silver WHERE year >= 1995
), merged AS (
  SELECT {SILVER_COLUMNS} FROM fresh
  UNION ALL
  SELECT {SILVER_COLUMNS} FROM early e WHERE NOT EXISTS (
    SELECT 1 FROM fresh f
    WHERE f.flight_date = e.flight_date AND f.airline = e.airline
      AND f.flight_number = e.flight_number AND f.origin = e.origin AND f.dest = e.dest)
)"""

LAYOUT_A = (
    "FlightDate, Year, Month, DayOfWeek, Cancelled, Diverted, IATA_Code_Marketing_Airline, "
    "Flight_Number_Marketing_Airline, Origin, Dest, CRSDepTime, DepDelay, CRSArrTime, "
    "ArrDelay, Distance, l_orderkey, l_linenumber, l_partkey, l_suppkey"
)
# CSV holds no 32-bit numbers: whole ones come back as 64-bit.
FROM_CSV = over_flights(
    f"SELECT * REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber) "
    f"FROM (SELECT {LAYOUT_A} FROM flights)"
)

TABLES = {
    "table_scan": over_silver("SELECT * FROM merged", EARLY),
    "silver_partitioned": over_silver("SELECT * FROM silver"),
    "gold_write": over_silver("SELECT * FROM airline_mart", AIRLINE),
    "append_schema_merge": over_flights(
        "SELECT *, CAST(0 AS BIGINT) AS batch_id FROM "
        "(SELECT * EXCLUDE (Diverted) FROM flights WHERE Year <= 1995) "
        "UNION ALL BY NAME "
        "SELECT *, CAST(1 AS BIGINT) AS batch_id FROM flights WHERE Year > 1995"
    ),
    "merge_upsert": over_silver("SELECT * FROM merged", EARLY),
    "time_travel": over_silver("SELECT * FROM early", EARLY),
    "time_travel_sample": over_silver(
        "SELECT * FROM early ORDER BY flight_date, airline, flight_number, origin, dest LIMIT 5",
        EARLY,
    ),
    "compact": over_silver("SELECT * FROM silver"),
    "zorder_layout": over_silver("SELECT * FROM silver"),
    "expired_versions": over_flights(
        ", log AS (SELECT 'silver' AS \"table\", Year * 12 + Month AS version, "
        "count(*) AS rows, CAST(max(FlightDate) AS TIMESTAMP) AS committed_at "
        "FROM flights GROUP BY Year, Month) "
        "SELECT * FROM log WHERE version < (SELECT max(version) FROM log) "
        "AND committed_at < (SELECT max(committed_at) FROM log) - INTERVAL 168 HOUR"
    ),
    "table_summary": over_silver(
        "SELECT 'bronze' AS \"table\", TRUE AS \"exists\", count(*) AS rows, "
        "CAST(0 AS BIGINT) AS version FROM flights "
        "UNION ALL SELECT 'silver', TRUE, count(*), 1 FROM merged "
        "UNION ALL SELECT 'gold_ml_features', FALSE, 0, NULL",
        EARLY,
    ),
}

FILES = {
    "bronze_scan": FROM_CSV,
    "bronze_stream": FROM_CSV,
    "bronze_files": over_flights(
        "SELECT Year, count(*) AS rows, TRUE AS named FROM flights GROUP BY Year"
    ),
    "bronze_provenance": over_flights(
        "SELECT Year, count(*) AS rows, TRUE AS named, TRUE AS loaded_once "
        "FROM flights GROUP BY Year"
    ),
    "bronze_skip_empty": over_flights(
        "SELECT Year, count(*) AS rows FROM flights GROUP BY Year"
    ),
    "csv_sink": CORE["top_airlines"],
}

FEATURE_NAMES = (
    "flight_date, year, month, airline, origin, dest, route, distance, hour, day_of_week, "
    "season, dep_delay, arr_delay, is_delayed, origin_day_flights, dest_day_flights, "
    "airline_day_flights, route_day_flights, origin_hour_flights, route_hour_flights"
).split(", ")
TEXT = ", ".join(f"CAST({c} AS VARCHAR)" for c in FEATURE_NAMES)
HASH = f"md5(concat_ws('|', '42', {TEXT}))"
ALL = ", ".join(FEATURE_NAMES)


def split_of(source: str) -> str:
    """Class-wise test rows: the smallest hashes of each class."""
    return f"""
class_rows AS (
  SELECT is_delayed, count(*) AS n, sum(count(*)) OVER () AS total FROM {source}
  GROUP BY is_delayed
), class_share AS (
  SELECT *, total - (total + 4) // 5 AS train,
         (total - (total + 4) // 5)::HUGEINT * n // total AS share,
         (total - (total + 4) // 5)::HUGEINT * n % total AS remainder
  FROM class_rows
), class_take AS (
  SELECT is_delayed,
         n - share - CASE WHEN row_number() OVER (ORDER BY remainder DESC, is_delayed)
                               <= train - sum(share) OVER () THEN 1 ELSE 0 END AS take
  FROM class_share
), parts AS (
  SELECT {', '.join('r.' + c for c in FEATURE_NAMES)}, turn <= take AS is_test
  FROM (SELECT *, row_number() OVER (PARTITION BY is_delayed ORDER BY {HASH}, {ALL}) AS turn
        FROM {source}) r
  JOIN class_take t ON r.is_delayed = t.is_delayed
)"""


PARTS = f"{FEATURES}, {split_of('features')}"
NUMERIC = (
    "distance, hour, day_of_week, origin_day_flights, dest_day_flights, "
    "airline_day_flights, route_day_flights, origin_hour_flights, route_hour_flights"
).split(", ")
CATEGORICAL = "airline, origin, dest, season, route".split(", ")
GAPS = """
gaps AS (
  SELECT * REPLACE (
    CASE WHEN dep_delay IS NOT NULL THEN distance END AS distance,
    CASE WHEN dep_delay IS NOT NULL THEN hour END AS hour,
    CASE WHEN dep_delay IS NOT NULL THEN airline END AS airline,
    CASE WHEN dep_delay IS NOT NULL THEN season END AS season)
  FROM parts
)"""


def median_fill(name: str) -> str:
    middle = f"(SELECT median(CAST({name} AS DOUBLE)) FROM gaps WHERE NOT is_test)"
    return f"coalesce(CAST({name} AS DOUBLE), {middle}) AS {name}"


def mode_fill(name: str) -> str:
    top = (
        f"(SELECT {name} FROM gaps WHERE NOT is_test AND {name} IS NOT NULL "
        f"GROUP BY {name} ORDER BY count(*) DESC, {name} LIMIT 1)"
    )
    return f"coalesce({name}, {top}) AS {name}"


SLOTS = " UNION ALL ".join(
    f"SELECT concat('cat__{c}_', k.v) AS feature, "
    f"CAST(count(p.{c}) AS DOUBLE) AS total "
    f"FROM (SELECT DISTINCT {c} AS v FROM parts WHERE NOT is_test) k "
    f"LEFT JOIN parts p ON p.is_test AND p.{c} = k.v GROUP BY k.v"
    for c in CATEGORICAL
)
SUMS = " UNION ALL ".join(
    f"SELECT 'num__{c}', CAST(sum({c}) AS DOUBLE) FROM parts WHERE is_test" for c in NUMERIC
)
PREDICTED = "flight_date, airline, route, hour, arr_delay, is_delayed"
GUESS = """
guesses AS (
  SELECT arr_delay, is_delayed, coalesce(dep_delay, 0.0::DOUBLE) AS guess,
         CASE WHEN coalesce(dep_delay, 0.0::DOUBLE) > 15 THEN 1 ELSE 0 END AS guess_late
  FROM features
)"""
CONFUSION = """
confusion AS (
  SELECT count(*) FILTER (is_delayed = 0 AND guess_late = 0) AS tn,
         count(*) FILTER (is_delayed = 0 AND guess_late = 1) AS fp,
         count(*) FILTER (is_delayed = 1 AND guess_late = 0) AS fn,
         count(*) FILTER (is_delayed = 1 AND guess_late = 1) AS tp
  FROM guesses
)"""
FITTED = f"""
fitted AS (SELECT * FROM parts WHERE NOT is_test ORDER BY {HASH}, {ALL} LIMIT 50000)"""
BASELINES = """
sizes AS (
  SELECT count(*) FILTER (NOT is_test) AS train, count(*) FILTER (is_test) AS test FROM parts
), guess_mean AS (
  SELECT avg(abs(arr_delay - m)) AS mae, sqrt(avg((arr_delay - m) * (arr_delay - m))) AS rmse
  FROM parts, (SELECT avg(arr_delay) AS m FROM parts WHERE NOT is_test) WHERE is_test
), guess_mode AS (
  SELECT avg(CASE WHEN is_delayed = m THEN 1.0::DOUBLE ELSE 0 END) AS accuracy,
         CASE WHEN any_value(m) = 1
              THEN 2 * sum(is_delayed) / (sum(is_delayed) + count(*))::DOUBLE ELSE 0 END AS f1
  FROM parts, (SELECT is_delayed AS m FROM parts WHERE NOT is_test
               GROUP BY is_delayed ORDER BY count(*) DESC, is_delayed LIMIT 1)
  WHERE is_test
)"""
# The seven models.
RUNS = """
runs(task, model_type) AS (VALUES
  ('regression', 'DummyMeanRegressor'), ('regression', 'LinearRegression'),
  ('regression', 'RidgeRegression'), ('regression', 'RandomForestRegressor'),
  ('classification', 'DummyMostFrequentClassifier'), ('classification', 'LogisticRegression'),
  ('classification', 'RandomForestClassifier'))"""




def stump(rows: str, label: str, gain: str, prediction: str) -> str:
    """The best split of ``rows`` by one slot: every value of hour and weekday
    may end the low side, and every category is a slot of zeros and ones."""
    numbers = " UNION ALL ".join(
        f"SELECT 'num__{c}' AS slot, CAST({c} AS DOUBLE) AS v, {label} AS y FROM {rows}" for c in ("hour", "day_of_week")
    )
    slots = " UNION ALL ".join(
        f"SELECT 'cat__{c}_' || k.v, CASE WHEN r.{c} = k.v THEN 1.0::DOUBLE ELSE 0 END, {label} "
        f"FROM {rows} r, (SELECT DISTINCT {c} AS v FROM parts WHERE NOT is_test) k"
        for c in CATEGORICAL
    )
    return f"""
cell AS (
  SELECT slot, v, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS s
  FROM ({numbers} UNION ALL {slots}) GROUP BY slot, v
), side AS (
  SELECT slot, v, sum(n) OVER up AS n1, sum(s) OVER up AS s1,
         sum(n) OVER (PARTITION BY slot) - sum(n) OVER up AS n2,
         sum(s) OVER (PARTITION BY slot) - sum(s) OVER up AS s2,
         min(v) OVER (PARTITION BY slot) AS lowest, max(v) OVER (PARTITION BY slot) AS highest,
         lead(v) OVER (PARTITION BY slot ORDER BY v) AS next
  FROM cell WINDOW up AS (PARTITION BY slot ORDER BY v)
), best AS (
  SELECT * FROM side WHERE n2 > 0 ORDER BY {gain.format(n="n1", s="s1")} + {gain.format(n="n2", s="s2")} DESC, slot LIMIT 1
)
SELECT slot, 'low' AS side, lowest AS least, v AS most, n1::BIGINT AS rows, round({prediction.format(n="n1", s="s1")}, 6) AS prediction FROM best
UNION ALL
SELECT slot, 'high', next, highest, n2::BIGINT, round({prediction.format(n="n2", s="s2")}, 6) FROM best"""


def baseline(value: str, name: str) -> str:
    return f"CASE WHEN model_type = '{name}' THEN round({value}, 6) END"


# Each class weighs as many rows as the other one has.
LATE = "({s} * (SELECT count(*) - sum(is_delayed) FROM fitted))"
EARLY = "(({n} - {s}) * (SELECT sum(is_delayed) FROM fitted))"
MEAN, MODE = "DummyMeanRegressor", "DummyMostFrequentClassifier"
# Equal keys lie in one file, so only the row columns order equal keys.
STAGED = f"""
silver AS (
  SELECT {SILVER_COLUMNS} FROM cleaned
  QUALIFY row_number() OVER (
    PARTITION BY flight_date, airline, flight_number, origin, dest
    ORDER BY crs_dep_time, dep_delay NULLS FIRST, crs_arr_time, arr_delay, distance) = 1
)"""

LEARN = {
    "sample_exact": over_silver(
        f"SELECT * FROM features ORDER BY {HASH}, {ALL} LIMIT 5000", FEATURES
    ),
    "stratified_split": over_silver("SELECT * FROM parts", FEATURES, split_of("features")),
    "impute_median": over_silver(
        "SELECT flight_date, route, is_test, "
        + ", ".join(median_fill(c) for c in NUMERIC)
        + " FROM gaps",
        PARTS,
        GAPS,
    ),
    "impute_mode": over_silver(
        "SELECT flight_date, is_test, "
        + ", ".join(mode_fill(c) for c in CATEGORICAL)
        + " FROM gaps",
        PARTS,
        GAPS,
    ),
    "one_hot": over_silver(SLOTS, PARTS),
    "ml_matrix": over_silver(f"{SLOTS} UNION ALL {SUMS}", PARTS),
    "baseline_mean": over_silver(
        f"SELECT {PREDICTED}, (SELECT avg(arr_delay) FROM parts WHERE NOT is_test) "
        "AS prediction FROM parts WHERE is_test",
        PARTS,
    ),
    "baseline_mode": over_silver(
        f"SELECT {PREDICTED}, CAST(m AS DOUBLE) AS prediction, CAST(m AS DOUBLE) AS score "
        "FROM parts, (SELECT is_delayed AS m FROM parts WHERE NOT is_test "
        "GROUP BY is_delayed ORDER BY count(*) DESC, is_delayed LIMIT 1) WHERE is_test",
        PARTS,
    ),
    "linear_regression": over_silver(
        "SELECT airline, count(*) AS rows, sum(arr_delay) AS label_total, "
        "0.0::DOUBLE AS mean_residual FROM parts WHERE NOT is_test GROUP BY airline",
        PARTS,
    ),
    "ridge_regression": over_silver(
        "SELECT count(*) AS rows, sum(arr_delay) AS label_total, "
        "0.0::DOUBLE AS mean_residual FROM parts WHERE NOT is_test",
        PARTS,
    ),
    "logistic_regression": over_silver(
        "SELECT count(*) AS rows, CAST(sum(is_delayed) AS BIGINT) AS late, "
        "0.0::DOUBLE AS mean_residual FROM fitted",
        PARTS,
        FITTED,
    ),
    "forest_regression": over_silver(
        f"SELECT {PREDICTED}, TRUE AS in_range FROM parts WHERE is_test", PARTS
    ),
    "forest_classification": over_silver(
        f"SELECT {PREDICTED}, TRUE AS in_range FROM parts WHERE is_test", PARTS
    ),
    "regression_stump": over_silver(
        ", " + stump("(SELECT * FROM parts WHERE NOT is_test)", "arr_delay", "{s} * {s} / {n}", "{s} / {n}").lstrip(),
        PARTS,
    ),
    "classification_stump": over_silver(
        ", " + stump("fitted", "is_delayed", f"({LATE} * {LATE} + {EARLY} * {EARLY}) / ({LATE} + {EARLY})",
                     f"{LATE} / ({LATE} + {EARLY})").lstrip(),
        PARTS,
        FITTED,
    ),
    "classification_scores": over_silver(
        f"SELECT {PREDICTED}, TRUE AS in_range, TRUE AS decides FROM parts WHERE is_test", PARTS
    ),
    "feature_importance": over_silver(
        "SELECT task, feature, TRUE AS in_range, 1.0::DOUBLE AS total "
        f"FROM (SELECT feature FROM ({SLOTS} UNION ALL {SUMS})), "
        "(VALUES ('regression'), ('classification')) t(task)",
        PARTS,
    ),
    "model_runs": over_silver(
        "SELECT task, model_type, train AS train_rows, test AS test_rows, "
        "train + test AS training_rows, 0::BIGINT AS gold_table_version, "
        "CASE WHEN task = 'classification' THEN test::DOUBLE END AS confusion_total, "
        f"{baseline('mae', MEAN)} AS mae, {baseline('accuracy', MODE)} AS accuracy, "
        f"{baseline('f1', MODE)} AS f1, {baseline('0.5::DOUBLE', MODE)} AS roc_auc "
        "FROM runs, sizes, guess_mean, guess_mode",
        PARTS,
        BASELINES,
        RUNS,
    ),
    "regression_leaderboard": over_silver(
        f"SELECT model_type AS model, TRUE AS in_order, TRUE AS as_predicted, {baseline('mae', MEAN)} AS mae, "
        f"{baseline('rmse', MEAN)} AS rmse FROM runs, guess_mean "
        "WHERE task = 'regression' AND model_type <> 'LinearRegression'",
        PARTS,
        BASELINES,
        RUNS,
    ),
    "classification_leaderboard": over_silver(
        f"SELECT model_type AS model, TRUE AS in_order, TRUE AS as_predicted, {baseline('accuracy', MODE)} AS accuracy, "
        f"{baseline('f1', MODE)} AS f1, {baseline('0.5::DOUBLE', MODE)} AS roc_auc "
        "FROM runs, guess_mode WHERE task = 'classification'",
        PARTS,
        BASELINES,
        RUNS,
    ),
    "regression_metrics": over_silver(
        "SELECT avg(abs(arr_delay - guess)) AS mae, "
        "avg((arr_delay - guess) * (arr_delay - guess)) AS mse, "
        "sqrt(avg((arr_delay - guess) * (arr_delay - guess))) AS rmse, "
        "round(1 - avg((arr_delay - guess) * (arr_delay - guess)) / var_pop(arr_delay), 6) AS r2, "
        "count(*) AS rows FROM guesses",
        FEATURES,
        GUESS,
    ),
    "classification_metrics": over_silver(
        "SELECT coalesce((tn + tp) / nullif(tn + fp + fn + tp, 0), 0) AS accuracy, "
        "coalesce(tp / nullif(tp + fp, 0), 0) AS precision, "
        "coalesce(tp / nullif(tp + fn, 0), 0) AS recall, "
        "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, "
        "tn AS confusion_tn, fp AS confusion_fp, fn AS confusion_fn, tp AS confusion_tp "
        "FROM confusion",
        FEATURES,
        GUESS,
        CONFUSION,
    ),
    "roc_auc": over_silver(
        ", ranked AS (SELECT is_delayed, "
        "rank() OVER (ORDER BY guess) + (count(*) OVER (PARTITION BY guess) - 1) / 2 AS mid "
        "FROM guesses), sides AS (SELECT sum(mid) FILTER (is_delayed = 1) AS above, "
        "CAST(count(*) FILTER (is_delayed = 1) AS DOUBLE) AS pos, "
        "CAST(count(*) FILTER (is_delayed = 0) AS DOUBLE) AS neg FROM ranked) "
        "SELECT coalesce((above - pos * (pos + 1) / 2) / nullif(pos * neg, 0), 0.5) AS roc_auc "
        "FROM sides",
        FEATURES,
        GUESS,
    ),
    "stages_end_to_end": "WITH "
    + ", ".join([FLIGHTS, FLOWN, cleaned(), STAGED, AIRLINE])
    + " SELECT * FROM airline_mart",
    "incremental_run": "WITH "
    + ", ".join([FLIGHTS, FLOWN, cleaned(), STAGED, AIRLINE])
    + " SELECT * FROM airline_mart",
    "pipeline_end_to_end": "WITH "
    + ", ".join([FLIGHTS, FLOWN, cleaned(), STAGED, AIRLINE, AIRPORT, ROUTE, TIME, FEATURES])
    + "".join(
        f" SELECT '{name}_delay' AS \"table\", year, month, count(*) AS rows, "
        "CAST(sum(flight_count) AS BIGINT) AS flights, "
        "round(sum(avg_arr_delay), 4) AS delays, round(sum(delay_rate), 4) AS rates "
        f"FROM {name}_mart GROUP BY year, month UNION ALL"
        for name in ("airline", "airport", "route", "time")
    )
    + " SELECT 'ml_features', year, month, count(*), CAST(sum(origin_day_flights + "
    "dest_day_flights + airline_day_flights + route_day_flights + origin_hour_flights + "
    "route_hour_flights) AS BIGINT), round(sum(arr_delay), 4), CAST(sum(is_delayed) AS DOUBLE) "
    "FROM features GROUP BY year, month "
    "UNION ALL SELECT 'model_runs', NULL, NULL, 7, count(*), NULL, NULL FROM features",
}

ORACLE: dict[str, str] = {**CORE, **TABLES, **FILES, **LEARN}
