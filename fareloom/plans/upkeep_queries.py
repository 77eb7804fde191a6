"""Queries of sketches, reconciliation, membership, incremental staging and JSON columns, with their DuckDB SQL."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from fareloom.functions.semistructured import items, with_fields
from fareloom.functions.temporal import partition_values
from fareloom.operators.membership import rows_by_existence, with_membership
from fareloom.operators.reconcile import surplus_rows
from fareloom.operators.sketches import ACCURACY, distinct_counts, quantiles, sketched, store, stored
from fareloom.plans.table_oracles import MONTH
from fareloom.plans.table_queries import EARLIER_PERIOD, MONTH_PARTITIONS, PERIOD, Query, dated_orders, table
from fareloom.session import discard_at_exit, scratch_path
from fareloom.sources.publishing import stage, staged_table
from fareloom.streaming.incoming import take_new_files

GROWTH = (1 + ACCURACY) / (1 - ACCURACY)


def _monthly_orders(spark: SparkSession, folder: str) -> DataFrame:
    parts = partition_values("o_orderdate")
    return table(spark, folder, "orders").withColumns({"year": parts["year"], "month": parts["month"]})


def sketched_years(spark: SparkSession, folder: str) -> DataFrame:
    """Price quantiles of each year from the sketches of its months, one of them restated at twice the price; and
    whether the number of customers is within 5 % of an exact count."""
    path = scratch_path(spark, "sketches")
    orders = _monthly_orders(spark, folder)
    customers = {"customers": F.col("o_custkey")}
    store(sketched(orders, MONTH_PARTITIONS, customers, {"price": F.col("o_totalprice")}), path, MONTH_PARTITIONS)
    discard_at_exit(spark, path)
    restated = sketched(orders.where(PERIOD.contains()), MONTH_PARTITIONS, customers, {"price": F.col("o_totalprice") * 2})
    store(restated, path, MONTH_PARTITIONS)
    by = StructType().add("year", StringType()).add("month", StringType())
    sketches = stored(spark, path, by)
    price = quantiles(sketches, ["year"], "price", {"p50": 0.5, "p95": 0.95})
    exact = orders.groupBy("year").agg(F.count_distinct("o_custkey").alias("exactly"))
    return (
        price.join(distinct_counts(sketches, ["year"], ["customers"]), "year")
        .join(exact, "year")
        .select(
            "year",
            F.round("p50", 4).alias("p50"),
            F.round("p95", 4).alias("p95"),
            (F.abs(F.col("customers") - F.col("exactly")) <= 0.05 * F.col("exactly")).alias("customers_in_bound"),
        )
    )


def reconciled_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Published months against a staging that restates one, misses unfinished orders of the one before, and holds the
    cheap orders of a year twice."""
    orders = dated_orders(spark, folder)
    doubled = F.when(PERIOD.contains(), F.col("amount") * 2).otherwise(F.col("amount")).cast("decimal(18,2)")
    kept = ~(EARLIER_PERIOD.contains() & (F.col("o_orderstatus") != "F"))
    twice = orders.where("year = '1995' AND amount < 50000")
    paths = {"published": orders, "staged": orders.where(kept).withColumn("amount", doubled).unionByName(twice)}
    tables = {}
    for label, rows in paths.items():
        path = scratch_path(spark, label)
        stage(rows, path, MONTH_PARTITIONS)
        discard_at_exit(spark, path)
        tables[label] = staged_table(spark, path, orders.schema)
    found = surplus_rows(tables["staged"], tables["published"], MONTH_PARTITIONS)
    return found.withColumn("amount", F.col("amount").cast("double"))


def order_code_in_lines(spark: SparkSession, folder: str) -> DataFrame:
    """For every order, whether its code is among those of its returned lines; both sides hold nulls."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.expr("nullif(o_custkey % 7, 0)").alias("code"))
    lines = table(spark, folder, "lineitem").where("l_returnflag = 'R'")
    lines = lines.select("l_orderkey", F.expr("nullif(l_suppkey % 7, 0)").alias("line_code"))
    return with_membership(orders, lines, "code", "line_code", {"o_orderkey": "l_orderkey"})


def suppliers_in_nations(spark: SparkSession, folder: str) -> DataFrame:
    """For every supplier, whether its nation is among those of customers far in debt, and among all known ones of
    customers with one of them unknown."""
    suppliers = table(spark, folder, "supplier").select("s_suppkey", F.expr("nullif(s_nationkey, 3)").alias("nation"))
    customers = table(spark, folder, "customer")
    some = customers.where("c_acctbal < -990").select("c_nationkey")
    more = customers.where("c_acctbal < -900").select(F.expr("nullif(c_nationkey, 5)").alias("nation_known"))
    found = with_membership(suppliers, some, "nation", "c_nationkey", name="in_debt")
    return with_membership(found, more, "nation", "nation_known", name="in_known")


def customers_without_open_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with an order, none of them open."""
    customers, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    some = rows_by_existence(customers, orders, {"c_custkey": "o_custkey"})
    none = rows_by_existence(some, orders.where("o_orderstatus = 'O'"), {"c_custkey": "o_custkey"}, exists=False)
    return none.select("c_custkey", "c_name")


def incremental_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events that came in two drops, the second with late ones and with many of the first again, by day."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    landing, target, checkpoint = (scratch_path(spark, label) for label in ("landing", "events", "checkpoint"))
    for drop in ("event_type <> 'purchase'", "event_type IN ('purchase', 'click')"):
        events.where(drop).write.mode("append").parquet(landing)
        take_new_files(
            spark,
            landing,
            events.schema,
            target,
            checkpoint,
            ["event_id"],
            partition_by=["day"],
            prepare=lambda records: records.withColumn("day", F.date_format("ts", "yyyy-MM-dd")),
        )
    for path in (landing, target, checkpoint):
        discard_at_exit(spark, path)
    schema = StructType(list(events.schema.fields)).add("day", StringType())
    amount = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    return spark.read.schema(schema).parquet(target).groupBy("day").agg(F.count("*").alias("events"), amount.alias("amount"))


def _raw_props() -> str:
    """Properties as they might come: cut off for errors, a word instead of a number for purchases."""
    return (
        "CASE WHEN event_type = 'error' THEN substr(props, 1, length(props) - 1) "
        "WHEN event_type = 'purchase' THEN replace(replace(props, ': ', ': \"n'), '}', '\"}') ELSE props END"
    )


def event_properties(spark: SparkSession, folder: str) -> DataFrame:
    """The number among the properties of every event, or what is wrong with them."""
    events = table(spark, folder, "events").select("event_id", F.expr(_raw_props()).alias("raw"))
    return with_fields(events, "raw", {"k": ("$.k", "bigint"), "unit": ("$.unit", "string")}).drop("raw")


def event_property_items(spark: SparkSession, folder: str) -> DataFrame:
    """Properties one by one, with the number of events and of different values."""
    found = items(table(spark, folder, "events").select("event_id", F.expr(_raw_props()).alias("raw")), "raw")
    return found.groupBy("item_place", "item_key").agg(
        F.count("*").alias("events"), F.count_distinct("item_value").alias("different")
    )


QUERIES: dict[str, Query] = {
    "sketched_years": sketched_years,
    "reconciled_orders": reconciled_orders,
    "order_code_in_lines": order_code_in_lines,
    "suppliers_in_nations": suppliers_in_nations,
    "customers_without_open_orders": customers_without_open_orders,
    "incremental_events": incremental_events,
    "event_properties": event_properties,
    "event_property_items": event_property_items,
}

_RAW_EVENTS = f"(SELECT *, {_raw_props()} AS raw FROM events)"

ORACLES: dict[str, str] = {
    "sketched_years": f"""
        WITH buckets AS (
          SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS orders,
                 CAST(ceil(ln(o_totalprice * CASE WHEN {MONTH} THEN 2 ELSE 1 END) / {math.log(GROWTH)!r}) AS BIGINT) AS bucket
          FROM orders GROUP BY ALL
        ), placed AS (
          SELECT *, sum(orders) OVER (PARTITION BY year ORDER BY bucket) AS upto, sum(orders) OVER (PARTITION BY year) AS n
          FROM buckets
        )
        SELECT year,
               round(2 * pow(CAST({GROWTH!r} AS DOUBLE), min(bucket) FILTER (upto >= ceil(CAST(0.5 AS DOUBLE) * n)))
                     / ({GROWTH + 1!r}), 4) AS p50,
               round(2 * pow(CAST({GROWTH!r} AS DOUBLE), min(bucket) FILTER (upto >= ceil(CAST(0.95 AS DOUBLE) * n)))
                     / ({GROWTH + 1!r}), 4) AS p95,
               true AS customers_in_bound
        FROM placed GROUP BY year
        """,
    "reconciled_orders": f"""
        WITH published AS (
          SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderdate FROM orders
        ), staged AS (
          SELECT o_orderkey, o_orderstatus, CAST(CASE WHEN {MONTH} THEN 2 ELSE 1 END * amount AS DECIMAL(18,2)) AS amount,
                 o_orderdate
          FROM published WHERE o_orderstatus = 'F' OR strftime(o_orderdate, '%Y-%m') <> '1997-05'
          UNION ALL
          SELECT * FROM published WHERE year(o_orderdate) = 1995 AND amount < 50000
        ), differing AS (
          SELECT *, 1 AS copies FROM (SELECT * FROM staged EXCEPT ALL SELECT * FROM published)
          UNION ALL
          SELECT *, -1 FROM (SELECT * FROM published EXCEPT ALL SELECT * FROM staged)
        )
        SELECT o_orderkey, o_orderstatus, CAST(amount AS DOUBLE) AS amount, strftime(o_orderdate, '%Y') AS year,
               strftime(o_orderdate, '%m') AS month, CAST(sum(copies) AS BIGINT) AS surplus
        FROM differing GROUP BY ALL
        """,
    "order_code_in_lines": """
        SELECT o_orderkey, nullif(o_custkey % 7, 0) AS code,
               nullif(o_custkey % 7, 0) IN (
                 SELECT nullif(l_suppkey % 7, 0) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R'
               ) AS found
        FROM orders
        """,
    "suppliers_in_nations": """
        SELECT s_suppkey, nullif(s_nationkey, 3) AS nation,
               nullif(s_nationkey, 3) IN (SELECT c_nationkey FROM customer WHERE c_acctbal < -990) AS in_debt,
               nullif(s_nationkey, 3) IN (SELECT nullif(c_nationkey, 5) FROM customer WHERE c_acctbal < -900) AS in_known
        FROM supplier
        """,
    "customers_without_open_orders": """
        SELECT c_custkey, c_name FROM customer
        WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
          AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O')
        """,
    "incremental_events": """
        SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS events,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount
        FROM events GROUP BY 1
        """,
    "event_properties": f"""
        SELECT event_id, CASE WHEN json_valid(raw) THEN TRY_CAST(json_extract_string(raw, '$.k') AS BIGINT) END AS k,
               CAST(NULL AS VARCHAR) AS unit,
               CASE WHEN NOT json_valid(raw) THEN 'not JSON'
                    WHEN TRY_CAST(json_extract_string(raw, '$.k') AS BIGINT) IS NULL THEN 'k is no bigint' END AS problem
        FROM {_RAW_EVENTS}
        """,
    "event_property_items": f"""
        SELECT CAST(0 AS INTEGER) AS item_place, 'k' AS item_key, count(*) AS events,
               count(DISTINCT json_extract(raw, '$.k')) AS different
        FROM {_RAW_EVENTS} WHERE json_valid(raw)
        """,
}
