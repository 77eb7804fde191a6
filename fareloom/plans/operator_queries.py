"""Queries of the operators on time, releases and subtotals over the test tables, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.operators.asof import asof_join
from fareloom.operators.intervals import overlap_join
from fareloom.operators.rates import attach_last_rates
from fareloom.operators.sessions import sessions
from fareloom.operators.subtotals import cube_sets, rollup_sets, subtotals, top_rows
from fareloom.plans.fact_bookings import CURRENCIES
from fareloom.plans.table_oracles import MONTH, RATES
from fareloom.plans.table_queries import (
    MONTH_PARTITIONS,
    PERIOD,
    Query,
    customer_regions,
    dated_orders,
    new_table_name,
    order_day_rates,
    table,
)
from fareloom.session import scratch_path
from fareloom.sources.releases import Releases

HOUR = 3_600_000_000
SECONDS_NEAR = 900
SESSION_HOURS = 12


def partition_release(spark: SparkSession, folder: str) -> DataFrame:
    """All orders as a first release; finished orders of all months restated, one month of them in a second one."""
    orders = dated_orders(spark, folder)
    base = scratch_path(spark, "releases")
    releases = Releases(new_table_name(base), base, orders.schema, MONTH_PARTITIONS)
    releases.publish(spark, releases.stage(orders))
    doubled = (F.col("amount") * 2).cast("decimal(18,2)")
    restated = releases.stage(orders.where("o_orderstatus = 'F'").withColumn("amount", doubled))
    releases.publish(spark, restated, PERIOD)
    return (
        spark.table(releases.name)
        .groupBy("year", "month")
        .agg(
            F.count("*").alias("orders"),
            F.count_if(F.col("o_orderstatus") != "F").alias("unfinished"),
            F.sum("amount").cast("double").alias("amount"),
        )
    )


def release_rollback(spark: SparkSession, folder: str) -> DataFrame:
    """Two releases, and the name pointed back to the first: rows by month as if the second had never been."""
    orders = dated_orders(spark, folder)
    base = scratch_path(spark, "releases")
    releases = Releases(new_table_name(base), base, orders.schema, MONTH_PARTITIONS)
    releases.publish(spark, releases.stage(orders))
    releases.publish(spark, releases.stage(orders.where("o_orderstatus = 'O'")))
    return releases.point(spark, 1).groupBy("year", "month").agg(F.count("*").alias("orders"))


def fx_last_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in two currencies at the last known rate; weekends have none of their own."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    priced = attach_last_rates(
        orders.withColumn("currency", F.lit("USD")),
        order_day_rates(spark, folder),
        CURRENCIES,
        currency="currency",
        day=F.to_date("o_orderdate"),
    )
    return priced.select(
        "o_orderkey",
        "gbp_rate",
        "eur_rate",
        (F.col("o_totalprice") * F.col("gbp_rate")).alias("total_gbp"),
        (F.col("o_totalprice") * F.col("eur_rate")).alias("total_eur"),
    )


def last_purchase(spark: SparkSession, folder: str) -> DataFrame:
    """Every event that is no purchase, with the value and age of the user's last purchase within two days."""
    events = table(spark, folder, "events")
    bought = events.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("bought"), F.col("value").alias("spent"))
    others = events.where("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    joined = asof_join(
        others, bought, ["user_id"], fact_time="ts", known_time="bought", values=["spent"], within=48 * HOUR, at_column="at"
    )
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("ts").cast("timestamp_ntz"))
    return joined.select("event_id", "spent", (micros - F.col("at")).alias("age_micros"))


def events_near_errors(spark: SparkSession, folder: str) -> DataFrame:
    """For every error, the other events within a quarter of an hour after it."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    span = F.make_dt_interval(secs=F.lit(SECONDS_NEAR).cast("decimal(18,6)"))
    errors = events.where("event_type = 'error'").select(
        F.col("event_id").alias("error_id"), F.col("ts").alias("since"), (F.col("ts") + span).alias("until")
    )
    others = events.where("event_type <> 'error'").select("event_id", "ts")
    pairs = overlap_join(errors, others, left_interval=("since", "until"), right_interval=("ts", "ts"))
    return pairs.groupBy("error_id").agg(F.count("*").alias("events"), F.max("event_id").alias("last_event"))


def overlapping_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of a customer's orders that were open at the same time."""
    shipped = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("closed"))
    orders = table(spark, folder, "orders").join(shipped, F.col("o_orderkey") == F.col("l_orderkey"))
    opened = orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("opened"), "closed")
    other = opened.toDF("o_custkey", "other_orderkey", "other_opened", "other_closed")
    pairs = overlap_join(
        opened, other, left_interval=("opened", "closed"), right_interval=("other_opened", "other_closed"), on=["o_custkey"]
    )
    return pairs.where("o_orderkey < other_orderkey").select("o_custkey", "o_orderkey", "other_orderkey")


def event_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of every user: no pause of more than twelve hours."""
    events = table(spark, folder, "events")
    found = sessions(
        events, "user_id", "ts", SESSION_HOURS * HOUR, {"amount": F.col("value").cast("decimal(18,2)")}
    )
    lasted = F.timestamp_diff("MICROSECOND", F.col("start"), F.col("end"))
    return found.select(
        "user_id", "session", F.col("rows").alias("events"), F.col("amount").cast("double").alias("amount"), lasted.alias("micros")
    )


def _order_measures():
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return {"orders": ("count", F.lit(1)), "amount": ("sum", price), "mean_amount": ("mean", price), "largest": ("max", price)}


def _plain_amounts(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in ("amount", "largest")}).withColumn(
        "mean_amount", F.round(F.col("amount") / F.col("orders"), 4)
    )


def _regional_orders(spark: SparkSession, folder: str) -> DataFrame:
    customers = customer_regions(spark, folder)
    orders = table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return orders.select(F.col("r_name").alias("region"), "o_orderpriority", "o_orderstatus", "o_totalprice")


def revenue_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by region, priority and status with subtotals from the right."""
    by = ["region", "o_orderpriority", "o_orderstatus"]
    return _plain_amounts(subtotals(_regional_orders(spark, folder), by, rollup_sets(by), _order_measures()))


def revenue_cube(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by every choice of region, priority and status."""
    by = ["region", "o_orderpriority", "o_orderstatus"]
    return _plain_amounts(subtotals(_regional_orders(spark, folder), by, cube_sets(by), _order_measures()))


def largest_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Each supplier's three largest quantities, with all lines that tie."""
    lines = table(spark, folder, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")
    return top_rows(lines, ["l_suppkey"], [F.desc("l_quantity")], 3).withColumn("rank", F.col("rank").cast("long"))


QUERIES: dict[str, Query] = {
    "partition_release": partition_release,
    "release_rollback": release_rollback,
    "fx_last_rate": fx_last_rate,
    "last_purchase": last_purchase,
    "events_near_errors": events_near_errors,
    "overlapping_orders": overlapping_orders,
    "event_sessions": event_sessions,
    "revenue_rollup": revenue_rollup,
    "revenue_cube": revenue_cube,
    "largest_lines": largest_lines,
}


def _levels(sets: str) -> str:
    return f"""
        SELECT region, o_orderpriority, o_orderstatus, grouping(region, o_orderpriority, o_orderstatus) AS level,
               count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount,
               round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS mean_amount,
               CAST(max(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS largest
        FROM (SELECT r_name AS region, o_orderpriority, o_orderstatus, o_totalprice
              FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey)
        GROUP BY {sets}(region, o_orderpriority, o_orderstatus)
        """


ORACLES: dict[str, str] = {
    "partition_release": f"""
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
    "release_rollback": """
        SELECT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, count(*) AS orders
        FROM orders GROUP BY 1, 2
        """,
    "fx_last_rate": f"""
        WITH {RATES}
        SELECT o_orderkey, gbp_rate, eur_rate, o_totalprice * gbp_rate AS total_gbp, o_totalprice * eur_rate AS total_eur
        FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders) ASOF LEFT JOIN rates ON d >= rate_day
        """,
    "last_purchase": """
        WITH bought AS (
          SELECT user_id, ts AS bought, max(value) AS spent FROM events WHERE event_type = 'purchase' GROUP BY 1, 2
        ), joined AS (
          SELECT event_id, ts, bought, spent
          FROM (SELECT * FROM events WHERE event_type <> 'purchase') e
          ASOF LEFT JOIN bought b ON e.user_id = b.user_id AND e.ts >= b.bought
        )
        SELECT event_id, CASE WHEN bought >= ts - INTERVAL 48 HOUR THEN spent END AS spent,
               CASE WHEN bought >= ts - INTERVAL 48 HOUR THEN epoch_us(ts) - epoch_us(bought) END AS age_micros
        FROM joined
        """,
    "events_near_errors": """
        SELECT x.event_id AS error_id, count(*) AS events, max(e.event_id) AS last_event
        FROM events x JOIN events e ON e.ts BETWEEN x.ts AND x.ts + INTERVAL 900 SECOND
        WHERE x.event_type = 'error' AND e.event_type <> 'error' GROUP BY x.event_id
        """,
    "overlapping_orders": """
        WITH opened AS (
          SELECT o_custkey, o_orderkey, o_orderdate AS opened, max(l_shipdate) AS closed
          FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL
        )
        SELECT a.o_custkey, a.o_orderkey, b.o_orderkey AS other_orderkey
        FROM opened a JOIN opened b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey
            AND a.opened <= a.closed AND b.opened <= b.closed AND a.opened <= b.closed AND b.opened <= a.closed
        """,
    "event_sessions": """
        WITH flagged AS (
          SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER u) <= 12 * 3600000000 THEN 0 ELSE 1 END AS opens
          FROM events WINDOW u AS (PARTITION BY user_id ORDER BY ts)
        ), numbered AS (
          SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM flagged
        )
        SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS events,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount, epoch_us(max(ts)) - epoch_us(min(ts)) AS micros
        FROM numbered GROUP BY 1, 2
        """,
    "revenue_rollup": _levels("ROLLUP"),
    "revenue_cube": _levels("CUBE"),
    "largest_lines": """
        SELECT * FROM (
          SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity,
                 rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS rank
          FROM lineitem
        ) WHERE rank <= 3
        """,
}
