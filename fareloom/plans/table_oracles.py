"""ANSI SQL for DuckDB with the same results as the queries in ``table_queries``."""

from __future__ import annotations

_CUSTOMER_REGIONS = """
customer_regions AS (
  SELECT c_custkey, c_name, r_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

_ORDER_LINES = """
order_lines AS (
  SELECT l.*, o_orderdate, o_orderdate + to_seconds(l_partkey % 86400) AS pickup
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey
)"""

_GREEN_TRIPS = f"""{_ORDER_LINES},
trips AS (
  SELECT CAST(l_linenumber AS VARCHAR) AS platform, pickup AS requested, pickup, l_shipdate AS dropoff,
         l_suppkey AS pu, l_partkey AS dropoff_place, l_quantity AS miles,
         floor(epoch(l_shipdate)) - floor(epoch(pickup)) AS seconds,
         l_extendedprice AS base_passenger_fare, l_extendedprice * l_discount AS tolls, CAST(0 AS DOUBLE) AS bcf,
         l_extendedprice * l_tax AS sales_tax, l_discount AS congestion_surcharge, CAST(0 AS DOUBLE) AS airport_fee,
         l_tax AS tips, l_extendedprice * (1 - l_discount) AS total_fare, CAST(NULL AS DOUBLE) AS driver_pay,
         false AS shared_request_flag, false AS shared_match_flag, false AS wav_request_flag,
         false AS wav_match_flag
  FROM order_lines
)"""

# The monthly job's trips: no negative durations and small totals, so that its quality checks pass.
_JOB_TRIPS = _GREEN_TRIPS.replace("l_shipdate AS dropoff,", "greatest(l_shipdate, pickup) AS dropoff,").replace(
    "floor(epoch(l_shipdate))", "floor(epoch(greatest(l_shipdate, pickup)))"
).replace("l_extendedprice * (1 - l_discount) AS total_fare", "l_extendedprice * l_tax AS total_fare")

_HVFHV_TRIPS = f"""{_ORDER_LINES},
parts AS (
  SELECT *, l_extendedprice * l_discount AS tolls, l_extendedprice * l_tax AS sales_tax,
         nullif(l_tax, 0) AS congestion_surcharge, CAST(2.5 AS DOUBLE) AS airport_fee
  FROM order_lines
),
trips AS (
  SELECT 'HV000' || l_linenumber AS platform, o_orderdate AS requested, pickup, l_shipdate AS dropoff,
         l_suppkey AS pu, l_partkey AS dropoff_place, l_quantity AS miles, CAST(l_partkey AS DOUBLE) AS seconds,
         l_extendedprice AS base_passenger_fare, tolls, l_discount AS bcf, sales_tax, congestion_surcharge,
         airport_fee, l_tax AS tips,
         l_extendedprice + tolls + l_discount + sales_tax + congestion_surcharge + airport_fee + l_tax AS total_fare,
         l_extendedprice * (1 - l_discount) AS driver_pay,
         CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS shared_request_flag,
         CASE l_returnflag WHEN 'N' THEN true WHEN 'R' THEN false END AS shared_match_flag,
         CASE l_linestatus WHEN 'O' THEN true WHEN 'F' THEN false END AS wav_request_flag,
         CASE l_linestatus WHEN 'F' THEN true END AS wav_match_flag
  FROM parts
)"""

_JOB_HVFHV_TRIPS = (
    _HVFHV_TRIPS.replace("l_extendedprice * l_discount AS tolls", "l_extendedprice * l_discount / 100 AS tolls")
    .replace("l_extendedprice * l_tax AS sales_tax", "l_extendedprice * l_tax / 100 AS sales_tax")
    .replace("l_extendedprice AS base_passenger_fare", "l_extendedprice / 100 AS base_passenger_fare")
    .replace("l_extendedprice + tolls", "l_extendedprice / 100 + tolls")
    .replace("l_shipdate AS dropoff,", "greatest(l_shipdate, pickup) AS dropoff,")
)

RATES = """
rates AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS rate_day,
         CAST(0.7 AS DOUBLE) + CAST(day(o_orderdate) AS DOUBLE) / CAST(1000 AS DOUBLE) AS gbp_rate,
         CAST(0.9 AS DOUBLE) + CAST(month(o_orderdate) AS DOUBLE) / CAST(100 AS DOUBLE) AS eur_rate
  FROM orders
  WHERE isodow(o_orderdate) <= 5
)"""


def _facts(trips: str) -> str:
    return f"""{trips},{RATES},
facts AS (
  SELECT CAST(strftime(requested, '%Y%m%d') AS INTEGER) AS booking_date_key,
         CAST(strftime(pickup, '%Y%m%d') AS INTEGER) AS pu_date_key,
         CAST(strftime(pickup, '%Y%m%d%H') AS INTEGER) AS pu_hour_key,
         CAST(strftime(dropoff, '%Y%m%d') AS INTEGER) AS do_date_key,
         CAST(strftime(dropoff, '%Y%m%d%H') AS INTEGER) AS do_hour_key,
         CAST(pu AS INTEGER) AS pu_location_key,
         CAST(dropoff_place AS INTEGER) AS do_location_key,
         platform AS platform_key,
         'USD' AS source_currency,
         CAST(requested AS VARCHAR) AS request_datetime,
         CAST(pickup AS VARCHAR) AS pickup_datetime,
         CAST(dropoff AS VARCHAR) AS dropoff_datetime,
         miles AS trip_miles,
         seconds / CAST(60 AS DOUBLE) AS trip_mins,
         CASE WHEN seconds > 120 AND miles > 1 THEN miles / (seconds / CAST(60 AS DOUBLE)) END AS trip_efficiency,
         miles / nullif(seconds / CAST(3600 AS DOUBLE), 0) AS speed_mile_per_hour,
         base_passenger_fare, tolls, bcf, sales_tax, congestion_surcharge, airport_fee, tips, total_fare,
         total_fare * gbp_rate AS total_fare_gbp,
         total_fare * eur_rate AS total_fare_eur,
         driver_pay,
         driver_pay * gbp_rate AS driver_pay_gbp,
         driver_pay * eur_rate AS driver_pay_eur,
         gbp_rate, eur_rate,
         shared_request_flag, shared_match_flag, wav_request_flag, wav_match_flag,
         strftime(requested, '%Y') AS year,
         strftime(requested, '%m') AS month,
         strftime(requested, '%d') AS day
  FROM trips LEFT JOIN rates ON CAST(requested AS DATE) = rate_day
)"""


_REVENUE = f"""
WITH {_CUSTOMER_REGIONS}
SELECT r_name AS region, count(*) AS total_trips,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
FROM orders JOIN customer_regions ON o_custkey = c_custkey
WHERE o_orderdate BETWEEN '1996-01-01' AND '1997-12-31' AND o_totalprice > 0
GROUP BY r_name
ORDER BY total_revenue DESC
"""

_TOP_HOURLY = f"""
WITH {_CUSTOMER_REGIONS},
top AS (
  SELECT c_name AS zone, count(*) AS trip_count
  FROM events JOIN customer_regions ON user_id = c_custkey
  GROUP BY c_name ORDER BY trip_count DESC, zone LIMIT 5
)
SELECT top.zone, CAST(hour(ts) AS INTEGER) AS pickup_hour, count(*) AS trips_during_hour
FROM events JOIN customer_regions ON user_id = c_custkey JOIN top ON c_name = top.zone
GROUP BY top.zone, hour(ts)
"""

_RATIO = """
SELECT r_name AS region, round(avg(l_extendedprice * l_tax / l_extendedprice * 100), 6) AS avg_fee_percentage
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE l_quantity > 2 AND l_extendedprice > 0 AND l_extendedprice * l_tax >= 0
GROUP BY r_name
"""

_BY_LABEL = """
SELECT label, count(1) AS bookings
FROM orders LEFT JOIN (
  VALUES ('1-URGENT', 'urgent'), ('2-HIGH', 'high'), ('3-MEDIUM', 'medium'), ('5-LOW', 'low')
) AS labels_of_priorities(priority, label) ON o_orderpriority = priority
GROUP BY 1
"""

_DURATIONS = f"""
WITH {_ORDER_LINES},
timed AS (
  SELECT l_orderkey, l_linenumber, l_quantity AS miles,
         floor(epoch(l_shipdate)) - floor(epoch(pickup)) AS seconds
  FROM order_lines
)
SELECT l_orderkey, l_linenumber, seconds, seconds / CAST(60 AS DOUBLE) AS mins,
       miles / nullif(seconds / CAST(3600 AS DOUBLE), 0) AS speed,
       CASE WHEN seconds > 120 AND miles > 1 THEN miles / (seconds / CAST(60 AS DOUBLE)) END AS efficiency
FROM timed
"""

_IP_TOKENS = """
found AS (
  SELECT doc_id, regexp_extract_all(text, '[0-9]+(?:\\.[0-9]+)+') AS tokens FROM documents
),
tokens AS (
  SELECT doc_id, CAST(place - 1 AS INTEGER) AS pos, tokens[place] AS token
  FROM (SELECT doc_id, tokens, unnest(range(1, len(tokens) + 1)) AS place FROM found)
),
addresses AS (
  SELECT doc_id, pos, 0 AS variant, token AS ip_address FROM tokens
  UNION ALL
  SELECT doc_id, pos, 1, '9' || token FROM tokens
  UNION ALL
  SELECT -1, pos, 0, ip_address
  FROM (VALUES (0, '8.8.4.4'), (1, '203.0.113.255'), (2, '203.0.113.256'), (3, '0000000000.0.0.07'),
               (4, '\u0661\u0662.3.4.5'), (5, '7.7.7.7.'), (6, '7..7.7'), (7, '172.31.0.1' || chr(10)),
               (8, 'host.example.org')) AS samples(pos, ip_address)
),
checked AS (
  SELECT *, coalesce(regexp_full_match(translate(ip_address, '\u0660\u0661\u0662', '012'),
    '0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})([.]0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}'), false
  ) AS is_valid
  FROM addresses
)"""

_IP = f"WITH {_IP_TOKENS} SELECT doc_id, pos, variant, ip_address, is_valid FROM checked"

_FX = f"""
WITH {RATES}
SELECT o_orderkey, gbp_rate, eur_rate, o_totalprice * gbp_rate AS total_gbp, o_totalprice * eur_rate AS total_eur
FROM orders LEFT JOIN rates ON CAST(o_orderdate AS DATE) = rate_day
"""

_LOOKUP = """
SELECT o_custkey, o_orderkey, o_orderstatus, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
"""

# Field, type and nullability as the contract declares them.
_CONTRACT = """
booking_date_key int no, pu_date_key int no, pu_hour_key int no, do_date_key int no, do_hour_key int no,
pu_location_key int no, do_location_key int no, platform_key string no, source_currency string no,
request_datetime timestamp no, pickup_datetime timestamp no, dropoff_datetime timestamp no,
trip_miles double yes, trip_mins double yes, trip_efficiency double yes, speed_mile_per_hour double yes,
base_passenger_fare double yes, tolls double yes, bcf double yes, sales_tax double yes,
congestion_surcharge double yes, airport_fee double yes, tips double yes, total_fare double yes,
total_fare_gbp double yes, total_fare_eur double yes, driver_pay double yes, driver_pay_gbp double yes,
driver_pay_eur double yes, gbp_rate double yes, eur_rate double yes, shared_request_flag boolean yes,
shared_match_flag boolean yes, wav_request_flag boolean yes, wav_match_flag boolean yes,
year string no, month string no, day string no
"""


def _contract_oracle() -> str:
    trips = _GREEN_TRIPS.replace("CAST(l_linenumber AS VARCHAR)", "CAST(nullif(l_linenumber, 1) AS VARCHAR)")
    rows = []
    for line in _CONTRACT.replace("\n", " ").split(","):
        name, kind, nullable = line.split()
        nulls = f"count(*) FILTER ({name} IS NULL)"
        status = "'ok'" if nullable == "yes" else f"CASE WHEN {nulls} > 0 THEN 'nulls found' ELSE 'ok' END"
        rows.append(
            f"SELECT '{name}' AS field, '{kind}' AS expected_type, '{kind}' AS actual_type, "
            f"{str(nullable == 'yes').lower()} AS nullable, {nulls} AS null_count, {status} AS status FROM facts"
        )
    return f"WITH {_facts(trips)}\n" + "\nUNION ALL\n".join(rows)


_PLATFORM_DAY = f"""
WITH {_facts(_JOB_HVFHV_TRIPS)}
SELECT platform_name, count(*) AS bookings
FROM facts LEFT JOIN (VALUES ('HV0001', 'first'), ('HV0002', 'second'), ('HV0004', 'fourth'))
  AS platforms(platform_key, platform_name) USING (platform_key)
WHERE year = '1997' AND month = '06' AND day = '30'
GROUP BY platform_name
"""

MONTH = "strftime(o_orderdate, '%Y-%m') = '1997-06'"

_CSV_COLUMNS = "c_custkey AS {0}, c_name || ', \"' || c_mktsegment || '\"' AS {1}, c_acctbal AS {2}"

ORACLES: dict[str, str] = {
    "revenue_by_region": _REVENUE,
    "revenue_by_region_sql": _REVENUE,
    "top_users_hourly": _TOP_HOURLY,
    "top_users_hourly_sql": _TOP_HOURLY,
    "top_users": """
        SELECT c_name, count(*) AS trip_count FROM events JOIN customer ON user_id = c_custkey
        GROUP BY c_name ORDER BY trip_count DESC, c_name LIMIT 5
        """,
    "avg_ratio_by_region": _RATIO,
    "avg_ratio_by_region_sql": _RATIO,
    "orders_by_priority_label": _BY_LABEL,
    "orders_by_priority_label_sql": _BY_LABEL,
    "time_keys": """
        SELECT event_id, strftime(ts, '%Y-%m-%d') AS date_text, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key,
               CAST(strftime(ts, '%Y%m%d%H') AS INTEGER) AS hour_key, CAST(hour(ts) AS INTEGER) AS hour_of_day,
               strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
        FROM events
        """,
    "duration_metrics": _DURATIONS,
    "duration_metrics_udf": _DURATIONS,
    "fare_total": """
        SELECT l_orderkey, l_linenumber,
               l_extendedprice + l_extendedprice * l_discount + l_discount + nullif(l_extendedprice * l_tax, 0)
               + CAST(2.75 AS DOUBLE) + CAST(2.5 AS DOUBLE) + l_tax AS total_fare
        FROM lineitem
        """,
    "flag_cast": """
        SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS flag,
               CAST(l_quantity AS INTEGER) AS whole_quantity, CAST(l_linenumber AS VARCHAR) AS line_text
        FROM lineitem
        """,
    "ip_validity": _IP,
    "ip_validity_udf": _IP,
    "ip_validity_counts": f"""
        WITH {_IP_TOKENS}
        SELECT variant, count(*) FILTER (is_valid) AS valid, count(*) FILTER (NOT is_valid) AS invalid
        FROM checked GROUP BY variant
        """,
    "dimension_lookup": _LOOKUP,
    "dimension_lookup_shuffled": _LOOKUP,
    "dimension_lookup_text_key": """
        SELECT c_custkey, lower(c_mktsegment) AS segment,
               CASE upper(c_mktsegment) WHEN 'BUILDING' THEN 'Ada' WHEN 'MACHINERY' THEN 'Ben'
                                        WHEN 'AUTOMOBILE' THEN 'Cyd' WHEN 'FURNITURE' THEN 'Dov' END AS manager
        FROM customer
        """,
    "fx_enrich": _FX,
    "fx_enrich_two_joins": _FX,
    "fact_green": f"WITH {_facts(_GREEN_TRIPS)} SELECT * FROM facts",
    "fact_hvfhv": f"WITH {_facts(_HVFHV_TRIPS)} SELECT * FROM facts",
    "dqc_report": f"""
        WITH {_facts(_GREEN_TRIPS)}
        SELECT 'null_check' AS check_name,
               count(*) FILTER (source_currency IS NULL OR request_datetime IS NULL) AS violations FROM facts
        UNION ALL
        SELECT 'large_values_check', count(*) FILTER (total_fare > 10000) FROM facts
        UNION ALL
        SELECT 'date_consistency_check', count(*) FILTER (dropoff < pickup) FROM trips
        """,
    "contract_report": _contract_oracle(),
    "period_scan": f"""
        SELECT o_orderkey, o_orderstatus, o_totalprice AS amount FROM orders WHERE {MONTH}
        """,
    "partition_publish": f"""
        WITH published AS (
          SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders WHERE NOT {MONTH}
          UNION ALL
          SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 2 AS DECIMAL(18,2)) AS amount
          FROM orders WHERE {MONTH} AND o_orderstatus = 'F'
        )
        SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, count(*) AS orders,
               count(*) FILTER (o_orderstatus <> 'F') AS unfinished, CAST(sum(amount) AS DOUBLE) AS amount
        FROM published GROUP BY 1, 2
        """,
    "csv_dim_scan": f"SELECT {_CSV_COLUMNS.format('c_custkey', 'label', 'c_acctbal')} FROM customer",
    "csv_inferred_scan": f"SELECT CAST(c_custkey AS INTEGER) AS c_custkey, "
    f"{_CSV_COLUMNS.format('other', 'label', 'c_acctbal').split(', ', 1)[1]} FROM customer",
    "csv_table_listing": f"SELECT {_CSV_COLUMNS.format('customer_id', 'customer_label', 'balance')} FROM customer",
    "catalog_partition_query": f"""
        SELECT o_orderkey, o_orderstatus, o_totalprice AS amount, '1997' AS year, '06' AS month
        FROM orders WHERE {MONTH} ORDER BY o_orderkey LIMIT 100
        """,
    "single_file_export": """
        SELECT o_orderpriority, o_orderstatus, count(*) AS orders,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
        FROM orders GROUP BY o_orderpriority, o_orderstatus
        """,
    "monthly_fact_job": f"""
        WITH {_facts(_JOB_TRIPS)} SELECT * FROM facts WHERE year = '1997' AND month = '06'
        """,
    "monthly_fact_job_hvfhv": f"""
        WITH {_facts(_JOB_HVFHV_TRIPS)} SELECT * FROM facts WHERE year = '1997' AND month IN ('05', '06') AND day <> '01'
        """,
    "monthly_job_rejects": f"""
        WITH {_facts(_JOB_HVFHV_TRIPS)} SELECT * FROM facts WHERE year = '1997' AND month IN ('06', '07') AND day = '01'
        """,
    "bookings_by_platform_day": _PLATFORM_DAY,
    "bookings_by_platform_day_sql": _PLATFORM_DAY,
    "quality_gate_report": f"""
        WITH {_facts(_JOB_TRIPS)},
        kept AS (SELECT year, month, count(*) AS published_rows FROM facts
                 WHERE year = '1997' AND month = '05' GROUP BY 1, 2)
        SELECT kept.*, 'null_check' AS check_name, 0 AS violations FROM kept
        UNION ALL
        SELECT kept.*, 'large_values_check',
               (SELECT count(*) FROM facts WHERE year = '1997' AND month = '06' AND base_passenger_fare > 10000) FROM kept
        UNION ALL
        SELECT kept.*, 'date_consistency_check', 0 FROM kept
        """,
    "staged_partition_listing": """
        SELECT DISTINCT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month FROM orders
        """,
}
