
from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from strata.plans import registered  # noqa: E402
from strata.session import REQUIRED_CONF, ensure_checkpoint_dir  # noqa: E402

try:  # the training-data operators are an optional part
    import corpus_pipeline
    from strata.llm.oracles import ORACLES as _LLM_ORACLES
    from strata.llm.queries import QUERIES as _LLM_QUERIES
except ImportError as e:
    # only their own absence is no error; a package that they need is
    if e.name is not None and e.name != "corpus_pipeline" and not e.name.startswith("strata.llm"):
        raise
    _LLM, _LLM_ORACLES = {}, {}
else:
    _LLM = {**_LLM_QUERIES, "pipeline": corpus_pipeline.run}

SMOKE_DIR = "/root/testdata/sf0.001"


def _prepare(spark: SparkSession) -> None:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: trips -> silver fact -> gold daily mart on sf0.001."""
    _prepare(spark)
    return registered.daily_mart(spark, SMOKE_DIR)


def _wrap(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _prepare(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _wrap(fn) for name, fn in {**registered.QUERIES, **_LLM}.items()}


# ----------------------------------------------------------------- oracle SQL
_HASH_COLS = ("VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, RatecodeID, "
              "store_and_fwd_flag, PULocationID, DOLocationID, payment_type, fare_amount, extra, mta_tax, tip_amount, "
              "tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, airport_fee, cbd_congestion_fee")

_TRIPS = """
trips AS (
  SELECT CAST(l_linenumber AS BIGINT) AS VendorID,
         o_orderdate AS tpep_pickup_datetime,
         l_shipdate AS tpep_dropoff_datetime,
         CAST(l_quantity AS INTEGER) AS passenger_count,
         l_quantity AS trip_distance,
         CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS RatecodeID,
         CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE l_returnflag END AS store_and_fwd_flag,
         CAST(c_nationkey AS BIGINT) AS PULocationID,
         CAST(s_nationkey AS BIGINT) AS DOLocationID,
         CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS BIGINT) AS payment_type,
         l_extendedprice AS fare_amount,
         CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_discount END AS extra,
         l_tax AS mta_tax,
         l_tax AS tip_amount,
         c_acctbal AS tolls_amount,
         s_acctbal AS improvement_surcharge,
         o_totalprice AS total_amount,
         l_discount AS congestion_surcharge,
         CAST(NULL AS DOUBLE) AS airport_fee,
         CAST(NULL AS DOUBLE) AS cbd_congestion_fee
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

_DIMS = """
dim_vendor AS (
  SELECT CAST(row_number() OVER (ORDER BY vendor_id) AS INTEGER) AS vendor_sk, vendor_id, description
  FROM (VALUES (1, 'Vendor One'), (2, 'Vendor Two'), (3, 'Vendor Three'), (6, 'Vendor Six')) v(vendor_id, description)
),
dim_rate_code AS (
  SELECT CAST(row_number() OVER (ORDER BY rate_code_id) AS INTEGER) AS rate_code_sk, rate_code_id, description
  FROM (VALUES (1, 'Standard rate'), (2, 'Airport'), (4, 'Suburban'), (99, 'Unknown')) v(rate_code_id, description)
),
dim_payment_method AS (
  SELECT CAST(row_number() OVER (ORDER BY payment_method_id) AS INTEGER) AS payment_method_sk, payment_method_id,
         description
  FROM (VALUES (1, 'Card'), (2, 'Cash'), (3, 'No charge')) v(payment_method_id, description)
),
dim_location AS (
  SELECT CAST(row_number() OVER (ORDER BY n_nationkey) AS INTEGER) AS location_sk,
         CAST(n_nationkey AS INTEGER) AS location_id, r_name AS borough, n_name AS zone, r_name AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_FACT = f"""
raw AS (SELECT * FROM trips UNION ALL SELECT * FROM trips WHERE VendorID = 3),
valid AS (
  SELECT * FROM raw
  WHERE CAST(tpep_pickup_datetime AS DATE) >= DATE '1996-01-01'
    AND CAST(tpep_pickup_datetime AS DATE) <= current_date
),
hashed AS (SELECT DISTINCT *, sha256(concat_ws('||', {_HASH_COLS})) AS trip_id FROM valid),
fact AS (
  SELECT h.trip_id, v.vendor_sk, h.tpep_pickup_datetime AS pickup_datetime,
         h.tpep_dropoff_datetime AS dropoff_datetime, h.passenger_count, h.trip_distance, r.rate_code_sk,
         h.store_and_fwd_flag, pu.location_sk AS pu_location_sk, dl.location_sk AS do_location_sk,
         p.payment_method_sk, h.fare_amount, h.extra, h.mta_tax, h.tip_amount, h.tolls_amount,
         h.improvement_surcharge, h.total_amount, h.congestion_surcharge, h.airport_fee,
         CAST(year(h.tpep_pickup_datetime) AS INTEGER) AS year,
         CAST(month(h.tpep_pickup_datetime) AS INTEGER) AS month,
         CAST(day(h.tpep_pickup_datetime) AS INTEGER) AS day,
         CAST(h.tpep_pickup_datetime AS DATE) AS partition_day
  FROM hashed h
  LEFT JOIN dim_vendor v ON h.VendorID = v.vendor_id
  LEFT JOIN dim_rate_code r ON h.RatecodeID = r.rate_code_id
  LEFT JOIN dim_payment_method p ON h.payment_type = p.payment_method_id
  LEFT JOIN dim_location pu ON h.PULocationID = pu.location_id
  LEFT JOIN dim_location dl ON h.DOLocationID = dl.location_id
)"""

_STAR = f"WITH {_TRIPS},{_DIMS},{_FACT}"

_EVENTS_LOG = """
log AS (
  SELECT event_id AS id, event_type || '_file' AS file_name, 'dest/' || CAST(user_id AS VARCHAR) AS destination,
         CASE WHEN event_type <> 'error' THEN 'SUCCESS' ELSE 'FAILED' END AS status, ts AS processed_at
  FROM events
)"""

_ORACLES = {
    "daily_mart": f"""{_STAR}
SELECT f.partition_day AS activity_date, pu.borough AS pickup_borough, dl.borough AS dropoff_borough,
       v.description AS vendor, r.description AS rate_code, p.description AS payment_method,
       CAST(SUM(date_sub('second', f.pickup_datetime, f.dropoff_datetime)) AS BIGINT) AS total_trip_duration_in_seconds,
       COUNT(f.trip_id) AS total_trips,
       ROUND(SUM(f.trip_distance), 2) AS total_distance,
       ROUND(SUM(f.fare_amount), 2) AS total_fare_amount,
       ROUND(SUM(f.tip_amount), 2) AS total_tip_amount,
       ROUND(SUM(f.total_amount), 2) AS total_amount,
       CAST(SUM(f.passenger_count) AS BIGINT) AS total_passenger
FROM fact f
LEFT JOIN dim_vendor v ON f.vendor_sk = v.vendor_sk
LEFT JOIN dim_rate_code r ON f.rate_code_sk = r.rate_code_sk
LEFT JOIN dim_payment_method p ON f.payment_method_sk = p.payment_method_sk
LEFT JOIN dim_location pu ON f.pu_location_sk = pu.location_sk
LEFT JOIN dim_location dl ON f.do_location_sk = dl.location_sk
GROUP BY 1, 2, 3, 4, 5, 6""",
    "fact_build": f"{_STAR}\nSELECT * FROM fact",
    "key_lookup": f"""WITH {_TRIPS},{_DIMS}
SELECT t.VendorID, v.vendor_sk, t.RatecodeID, r.rate_code_sk, t.payment_type, p.payment_method_sk,
       COUNT(*) AS trips
FROM trips t
LEFT JOIN dim_vendor v ON t.VendorID = v.vendor_id
LEFT JOIN dim_rate_code r ON t.RatecodeID = r.rate_code_id
LEFT JOIN dim_payment_method p ON t.payment_type = p.payment_method_id
GROUP BY 1, 2, 3, 4, 5, 6""",
    "role_playing_lookup": f"""WITH {_TRIPS},{_DIMS}
SELECT t.PULocationID, pu.location_sk AS pu_location_sk, t.DOLocationID, dl.location_sk AS do_location_sk,
       COUNT(*) AS trips
FROM trips t
LEFT JOIN dim_location pu ON t.PULocationID = pu.location_id
LEFT JOIN dim_location dl ON t.DOLocationID = dl.location_id
GROUP BY 1, 2, 3, 4""",
    "row_hash": f"""WITH {_TRIPS}
SELECT sha256(concat_ws('||', {_HASH_COLS})) AS trip_id, VendorID, tpep_pickup_datetime, store_and_fwd_flag, extra
FROM trips""",
    "dedup_rows": f"""WITH {_TRIPS},
raw AS (SELECT * FROM trips UNION ALL SELECT * FROM trips WHERE VendorID = 3)
SELECT DISTINCT * FROM raw""",
    "valid_date_range": """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '1996-01-01' AND CAST(o_orderdate AS DATE) <= DATE '2000-12-31'""",
    "recent_window": """SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= date_trunc('month', DATE '2001-07-15' - INTERVAL 2 MONTH)""",
    "date_parts": """SELECT o_orderkey, o_orderdate AS pickup_datetime,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day, CAST(o_orderdate AS DATE) AS partition_day
FROM orders""",
    "conform_schema": """SELECT event_id, ts, CAST(user_id AS INTEGER) AS user_id, event_type,
       CAST(trunc(value) AS INTEGER) AS value, props, CAST(NULL AS DOUBLE) AS session_fee
FROM events""",
    "cast_failures": """SELECT
  COUNT(*) FILTER (WHERE value IS NOT NULL AND TRY_CAST(trunc(value) AS INTEGER) IS NULL) AS value,
  COUNT(*) FILTER (WHERE props IS NOT NULL AND TRY_CAST(props AS INTEGER) IS NULL) AS props,
  COUNT(*) FILTER (WHERE event_type IS NOT NULL AND TRY_CAST(event_type AS BIGINT) IS NULL) AS event_type,
  COUNT(*) FILTER (WHERE user_id IS NOT NULL AND TRY_CAST(user_id AS INTEGER) IS NULL) AS user_id
FROM events""",
    "dense_key": """SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS INTEGER) AS order_sk,
       o_orderkey, o_custkey, o_orderdate
FROM orders""",
    "extend_dimension": """WITH c AS (SELECT c_custkey, c_name, c_nationkey FROM customer),
dim AS (
  SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS INTEGER) AS customer_sk, c_custkey, c_name, c_nationkey
  FROM c WHERE c_custkey % 2 = 0
),
mx AS (SELECT COALESCE(MAX(customer_sk), 0) AS m FROM dim),
fresh AS (SELECT * FROM c WHERE c_custkey NOT IN (SELECT c_custkey FROM dim))
SELECT * FROM dim
UNION ALL
SELECT CAST(row_number() OVER (ORDER BY c_custkey) + (SELECT m FROM mx) AS INTEGER) AS customer_sk,
       c_custkey, c_name, c_nationkey
FROM fresh""",
    "date_dimension": """WITH b AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi
                     FROM orders),
d AS (SELECT CAST(g AS DATE) AS d FROM b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) t(g))
SELECT d AS date, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
       CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
       CAST(weekofyear(d) AS INTEGER) AS week_of_year, dayofweek(d) IN (0, 6) AS is_weekend
FROM d""",
    "dimensions": f"""WITH {_DIMS}
SELECT 'dim_vendor' AS dimension, vendor_sk AS sk, vendor_id AS natural_key, description AS label FROM dim_vendor
UNION ALL
SELECT 'dim_rate_code', rate_code_sk, rate_code_id, description FROM dim_rate_code
UNION ALL
SELECT 'dim_payment_method', payment_method_sk, payment_method_id, description FROM dim_payment_method
UNION ALL
SELECT 'dim_location', location_sk, location_id, zone FROM dim_location
UNION ALL
SELECT 'dim_date', NULL, CAST(strftime(CAST(g AS DATE), '%Y%m%d') AS INTEGER), strftime(CAST(g AS DATE), '%Y-%m-%d')
FROM (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders) b,
     generate_series(b.lo, b.hi, INTERVAL 1 DAY) t(g)""",
    "upsert": """WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders),
t AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '1999-01-01'),
s AS (
  SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, o_orderdate,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority, 'update' AS o_source
  FROM o WHERE o_orderdate >= TIMESTAMP '1998-07-01'
)
SELECT t.o_orderkey, t.o_custkey, t.o_totalprice, t.o_orderdate, t.o_orderpriority,
       CAST(NULL AS VARCHAR) AS o_source
FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL
SELECT s.o_orderkey, t.o_custkey, s.o_totalprice, s.o_orderdate, s.o_orderpriority, s.o_source
FROM s LEFT JOIN t ON s.o_orderkey = t.o_orderkey""",
    "incremental_fact": f"{_STAR}\nSELECT * FROM fact WHERE partition_day <= DATE '2001-07-15'",
    "partition_overwrite": """SELECT *, CAST(ts AS DATE) AS day FROM events
WHERE NOT (CAST(ts AS DATE) >= DATE '2024-01-25' AND event_type = 'error')""",
    "partition_list": """SELECT DISTINCT 'day=' || strftime(CAST(ts AS DATE), '%Y-%m-%d') AS partition,
       strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day
FROM events""",
    "dataset_dependencies": """SELECT 'lineitem' AS dataset, COUNT(*) AS row_count FROM lineitem
UNION ALL SELECT 'orders', COUNT(*) FROM orders
UNION ALL SELECT 'customer', COUNT(*) FROM customer
UNION ALL SELECT 'supplier', COUNT(*) FROM supplier""",
    "seed_scan": """SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, n_name,
       CAST(n_regionkey AS INTEGER) AS n_regionkey
FROM nation""",
    "month_range": """WITH b AS (SELECT date_trunc('month', MIN(o_orderdate)) AS s, date_trunc('month', MAX(o_orderdate)) AS e
                     FROM orders),
m AS (SELECT strftime(r, '%Y-%m') AS year_month FROM b, range(b.s, b.e, INTERVAL 1 MONTH) t(r))
SELECT year_month, 'yellow_tripdata_' || year_month || '.parquet' AS file_name,
       'https://example.invalid/trip-data/yellow_tripdata_' || year_month || '.parquet' AS source,
       'bronze/yellow_trip/year=' || substr(year_month, 1, 4) || '/month=' || substr(year_month, 6, 2) || '/'
         AS destination,
       CAST(substr(year_month, 1, 4) AS INTEGER) AS year, CAST(substr(year_month, 6, 2) AS INTEGER) AS month
FROM m""",
    "pending_files": """WITH b AS (
  SELECT date_trunc('month', MIN(o_orderdate)) AS s,
         date_trunc('month', MAX(o_orderdate) + INTERVAL 6 MONTH) AS e
  FROM orders
),
m AS (SELECT strftime(r, '%Y-%m') AS year_month FROM b, range(b.s, b.e, INTERVAL 1 MONTH) t(r)),
ok AS (SELECT DISTINCT 'yellow_tripdata_' || strftime(o_orderdate, '%Y-%m') || '.parquet' AS file_name
       FROM orders WHERE o_orderstatus = 'F')
SELECT year_month, 'yellow_tripdata_' || year_month || '.parquet' AS file_name FROM m
WHERE 'yellow_tripdata_' || year_month || '.parquet' NOT IN (SELECT file_name FROM ok)""",
    "load_log": """SELECT event_id AS id, event_type || '_file' AS file_name, 'events' AS source,
       'dest/' || CAST(user_id AS VARCHAR) AS destination,
       CASE WHEN event_type <> 'error' THEN 'SUCCESS' ELSE 'FAILED' END AS status, 'append' AS load_type,
       ts AS processed_at, 'None' AS error,
       CASE event_type WHEN 'click' THEN 'bronze' WHEN 'view' THEN 'silver' WHEN 'purchase' THEN 'gold'
            ELSE 'faulty' END AS layer
FROM events""",
    "latest_destinations": f"""WITH {_EVENTS_LOG},
top_n AS (
  SELECT *, row_number() OVER (ORDER BY processed_at DESC, id DESC) AS rn
  FROM log WHERE status = 'SUCCESS' AND contains(file_name, 'i')
)
SELECT DISTINCT destination FROM top_n WHERE rn <= 50""",
    "successful_destinations": f"""WITH {_EVENTS_LOG}
SELECT DISTINCT destination FROM log WHERE status = 'SUCCESS' AND contains(file_name, 'ur')""",
    "bronze_ingest": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN year(o_orderdate) = 1999 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders""",
    "stream_ingest": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders""",
    "ingest_log": """WITH m AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS ym, CAST(year(o_orderdate) AS VARCHAR) AS y, CAST(month(o_orderdate) AS VARCHAR) AS mo,
         row_number() OVER (ORDER BY strftime(o_orderdate, '%Y-%m') DESC) <= 3 AS latest
  FROM orders GROUP BY 1, 2, 3
)
SELECT 'orders_' || ym || '.parquet' AS file_name, 'landing/year_month=' || ym AS source,
       'bronze/year=' || y || '/month=' || mo || '/' AS destination, status, 'overwrite' AS load_type, 'None' AS error,
       'bronze' AS layer, latest
FROM m, (VALUES ('UPLOADING'), ('SUCCESS')) s(status)""",
    "ingest_rejects": """SELECT o_orderkey, CASE WHEN bad THEN NULL ELSE CAST(o_custkey AS BIGINT) END AS o_custkey,
       CASE WHEN bad THEN NULL ELSE o_totalprice END AS o_totalprice,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CASE WHEN bad THEN concat_ws(';', CASE WHEN o_orderkey % 89 = 0 THEN 'o_custkey=x' END,
                                    CASE WHEN o_orderkey % 97 = 0 THEN 'o_totalprice=n/a ' || o_orderkey END) END AS lost,
       CASE WHEN bad THEN strftime(o_orderdate, '%Y-%m') END AS source_month
FROM (SELECT *, o_orderkey % 89 = 0 OR o_orderkey % 97 = 0 AS bad FROM orders)""",
    "ingest_counts": """WITH m AS (
  SELECT 'orders_' || strftime(o_orderdate, '%Y-%m') || '.parquet' AS item, COUNT(*) AS n,
         COUNT(*) FILTER (o_orderkey % 89 = 0 OR o_orderkey % 97 = 0) AS bad
  FROM orders GROUP BY 1
)
SELECT item, metric, CAST(CASE metric WHEN 'rows_in' THEN n WHEN 'rejected' THEN bad ELSE n - bad END AS BIGINT) AS rows
FROM m, (VALUES ('rows_in'), ('rows_out'), ('rejected')) t(metric)
UNION ALL
SELECT c.item, 'cast_failed', CAST(CASE c.item WHEN 'o_custkey' THEN a.custkey WHEN 'o_totalprice' THEN a.price ELSE 0 END AS BIGINT)
FROM (VALUES ('o_orderkey'), ('o_custkey'), ('o_orderstatus'), ('o_totalprice'), ('o_orderdate'), ('o_orderpriority')) c(item),
     (SELECT COUNT(*) FILTER (o_orderkey % 89 = 0) AS custkey, COUNT(*) FILTER (o_orderkey % 97 = 0) AS price FROM orders) a""",
    "leaf_scan": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
    "full_refresh_shrinks": f"{_STAR}\nSELECT * FROM fact WHERE partition_day < DATE '2000-01-01'",
    "upsert_moves_partition": """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
FROM orders""",
    "dedup_by_month": f"""{_STAR}
SELECT fact.* FROM fact, (VALUES (1), (2)) landed(n)""",
    "row_count_check": f"""{_STAR}
SELECT 'fact_yellow_trip' AS check_name, (SELECT COUNT(*) FROM raw) AS source_rows,
       (SELECT COUNT(*) FROM fact) AS target_rows,
       (SELECT COUNT(*) FROM raw) >= (SELECT COUNT(*) FROM fact) AS passed""",
}

_STEPS = "(VALUES ('staged'), ('switched'), ('moved')) s(step)"
_ORACLES["overwrite_cut_off"] = f"""SELECT step, seen, o_orderkey, CASE WHEN step = 'staged' THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice, o_orderstatus
FROM orders, {_STEPS}, (VALUES ('read'), ('recovered')) r(seen)
WHERE step = 'staged' OR o_orderstatus <> 'F'"""
_ORACLES["dimension_cut_off"] = f"""SELECT e.*, step FROM ({_ORACLES["extend_dimension"]}) e, {_STEPS}"""
_ORACLES["log_snapshots"] = _ORACLES["load_log"]
_ORACLES["mart_incremental"] = _ORACLES["daily_mart"].replace("GROUP BY 1, 2", "WHERE f.partition_day <= DATE '2001-07-15'\nGROUP BY 1, 2")
_ORACLES["reconcile_days"] = r"""WITH src AS (
  SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
),
tgt AS (
  SELECT day, o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 83 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
  FROM src, (VALUES (1), (2)) c(n) WHERE o_orderkey % 97 <> 0 AND (n = 1 OR o_orderkey % 89 = 0)
),
rows AS (SELECT *, 1 AS side FROM src UNION ALL SELECT *, 2 FROM tgt),
sums AS (
  SELECT day, side, count(*) AS n,
         sum(('0x' || substr(sha256(concat_ws('||', coalesce(CAST(o_orderkey AS VARCHAR), '\N'), coalesce(CAST(o_custkey AS VARCHAR), '\N'),
             coalesce(o_orderstatus, '\N'), coalesce(CAST(o_totalprice AS VARCHAR), '\N'))), 1, 15))::BIGINT::HUGEINT) AS checksum
  FROM rows GROUP BY day, side
),
days AS (
  SELECT day, coalesce(sum(n) FILTER (WHERE side = 1), 0)::BIGINT AS s, coalesce(sum(n) FILTER (WHERE side = 2), 0)::BIGINT AS t,
         coalesce(sum(checksum) FILTER (WHERE side = 1), 0) AS cs, coalesce(sum(checksum) FILTER (WHERE side = 2), 0) AS ct
  FROM sums GROUP BY day
)
SELECT day, s AS source_rows, t AS target_rows, CASE WHEN t < s THEN 'lost' WHEN t > s THEN 'extra' WHEN cs = ct THEN 'same' ELSE 'changed' END AS status
FROM days"""
_ORACLES["footer_scan"] = """SELECT strftime(o_orderdate, '%Y-%m') AS year_month, COUNT(*) AS n_rows, bool_and(year(o_orderdate) = 1999) AS narrow_key,
       bool_and(year(o_orderdate) <> 1999) AS has_priority
FROM orders GROUP BY 1"""
_ORACLES["lake_end_to_end"] = _ORACLES["daily_mart"]  # same mart, built through written tables


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query over the pre-registered test-table views."""
    return {**{k: v for k, v in _ORACLES.items() if k in registered.QUERIES}, **_LLM_ORACLES}
