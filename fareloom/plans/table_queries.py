"""Every operator and report run over the star-schema test tables.

Each query is a function of the session and the folder with ``<table>.parquet``. The tables have no trips, so order
lines play trips: an order is the booking, the line's ship date the drop-off, and a time of day comes from the part
number because all dates lie at midnight.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareloom.functions.measures import miles_per_hour, miles_per_minute, strict_total, yes_no_flag
from fareloom.functions.network import is_ipv4
from fareloom.functions.python_udfs import is_ipv4_udf, miles_per_minute_udf
from fareloom.functions.temporal import (
    date_key,
    date_text,
    elapsed_seconds,
    hour_key,
    hour_of_day,
    minutes,
    partition_values,
)
from fareloom.operators.contracts import contract_report
from fareloom.operators.lookups import attach_dimension
from fareloom.operators.quality import Check, QualityError, quality_report, require_quality
from fareloom.operators.rates import attach_rates
from fareloom.operators.topgroups import top_groups
from fareloom.plans import monthly_job
from fareloom.plans import reports
from fareloom.plans.dialects import GREEN, HVFHV
from fareloom.plans.fact_bookings import BLOCKING_CHECKS, CURRENCIES, fact_bookings
from fareloom.plans.reports import Star
from fareloom.plans.tables import FACT_BOOKINGS
from fareloom.session import discard_at_exit, materialise, scratch_path
from fareloom.sources import catalog
from fareloom.sources.periods import Period, period_scan
from fareloom.sources.publishing import compact_export, publish, stage, staged_partitions, staged_table
from fareloom.sources.tables import csv_table, parquet_table, rows_table

Query = Callable[[SparkSession, str], DataFrame]

PERIOD = Period.parse("1997-06")
EARLIER_PERIOD = Period.parse("1997-05")
MONTH_PARTITIONS = ("year", "month")

# Addresses with both answers among them: leading zeros, digits of another script, stray dots, a final newline.
IP_SAMPLES = [
    "8.8.4.4",
    "203.0.113.255",
    "203.0.113.256",
    "0000000000.0.0.07",
    "\u0661\u0662.3.4.5",
    "7.7.7.7.",
    "7..7.7",
    "172.31.0.1\n",
    "host.example.org",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return parquet_table(spark, f"{folder}/{name}.parquet")


# --- carriers -------------------------------------------------------------------------------------------------------


def customer_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as a dimension with the region they live in."""
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return customers.select("c_custkey", "c_name", "r_name")


def supplier_regions(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    suppliers = table(spark, folder, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return suppliers.select("s_suppkey", "r_name")


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with their order, and the booking's time of day as ``pickup``."""
    lines = table(spark, folder, "lineitem").join(
        table(spark, folder, "orders").select("o_orderkey", "o_orderdate"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    time_of_day = F.make_dt_interval(secs=(F.col("l_partkey") % 86400).cast("decimal(18,6)"))
    return lines.withColumn("pickup", F.col("o_orderdate") + time_of_day)


def green_trips(spark: SparkSession, folder: str) -> DataFrame:
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return order_lines(spark, folder).select(
        F.col("l_linenumber").alias("VendorID"),
        F.col("pickup").alias("lpep_pickup_datetime"),
        F.col("l_shipdate").alias("lpep_dropoff_datetime"),
        F.col("l_suppkey").alias("PULocationID"),
        F.col("l_partkey").alias("DOLocationID"),
        F.col("l_quantity").alias("trip_distance"),
        price.alias("fare_amount"),
        (price * discount).alias("tolls_amount"),
        (price * tax).alias("mta_tax"),
        discount.alias("congestion_surcharge"),
        tax.alias("tip_amount"),
        (price * (1 - discount)).alias("total_amount"),
    )


def hvfhv_trips(spark: SparkSession, folder: str) -> DataFrame:
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return order_lines(spark, folder).select(
        F.concat(F.lit("HV000"), F.col("l_linenumber").cast("string")).alias("hvfhs_license_num"),
        F.col("o_orderdate").alias("request_datetime"),
        F.col("pickup").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.col("l_suppkey").alias("PULocationID"),
        F.col("l_partkey").alias("DOLocationID"),
        F.col("l_quantity").alias("trip_miles"),
        F.col("l_partkey").alias("trip_time"),
        price.alias("base_passenger_fare"),
        (price * discount).alias("tolls"),
        discount.alias("bcf"),
        (price * tax).alias("sales_tax"),
        F.nullif(tax, F.lit(0.0)).alias("congestion_surcharge"),
        F.lit(2.5).alias("airport_fee"),
        tax.alias("tips"),
        (price * (1 - discount)).alias("driver_pay"),
        _flag("l_returnflag", "R", "A").alias("shared_request_flag"),
        _flag("l_returnflag", "N", "R").alias("shared_match_flag"),
        _flag("l_linestatus", "O", "F").alias("wav_request_flag"),
        _flag("l_linestatus", "F", "-").alias("wav_match_flag"),
    )


def _flag(column: str, yes: str, no: str) -> Column:
    return F.when(F.col(column) == yes, "Y").when(F.col(column) == no, "N").otherwise(" ")


def order_day_rates(spark: SparkSession, folder: str) -> DataFrame:
    """GBP and EUR rates for every weekday with an order; weekends have no quotes."""
    days = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    quotes = F.inline(
        F.array(
            F.struct(F.lit("GBP").alias("to_currency"), (0.7 + F.dayofmonth("day") / 1000.0).alias("rate")),
            F.struct(F.lit("EUR").alias("to_currency"), (0.9 + F.month("day") / 100.0).alias("rate")),
        )
    )
    rates = (
        days.where(F.weekday("day") < 5)
        .select("day", quotes)
        .select(
            F.lit("USD").alias("from_currency"),
            "to_currency",
            F.col("day").cast("string").alias("exchange_rate_date"),
            "rate",
        )
    )
    return materialise(rates, "rates")


def _plain_times(facts: DataFrame) -> DataFrame:
    """Timestamps as text, so that results compare without time zones."""
    return facts.withColumns(
        {name: F.col(name).cast("string") for name in ("request_datetime", "pickup_datetime", "dropoff_datetime")}
    )


# --- reports --------------------------------------------------------------------------------------------------------

ORDER_REGION = Star("o_custkey", "c_custkey", "r_name", "region")
EVENT_CUSTOMER = Star("user_id", "c_custkey", "c_name", "zone")
LINE_REGION = Star("l_suppkey", "s_suppkey", "r_name", "region")
ORDER_PRIORITY = Star("o_orderpriority", "priority", "label")

_REVENUE = dict(
    timestamp="o_orderdate",
    first="1996-01-01",
    last="1997-12-31",
    amount="o_totalprice",
    amount_type="decimal(18,2)",
)
_RATIO = dict(distance="l_quantity", part="fee", whole="l_extendedprice", result="avg_fee_percentage")


def revenue_by_region(spark: SparkSession, folder: str) -> DataFrame:
    return reports.revenue_by_group(
        table(spark, folder, "orders"), customer_regions(spark, folder), ORDER_REGION, **_REVENUE
    )


def revenue_by_region_sql(spark: SparkSession, folder: str) -> DataFrame:
    return reports.revenue_by_group_sql(
        spark, table(spark, folder, "orders"), customer_regions(spark, folder), ORDER_REGION, **_REVENUE
    )


def top_users_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return reports.hourly_trend_of_top_groups(
        table(spark, folder, "events"), customer_regions(spark, folder), EVENT_CUSTOMER, timestamp="ts"
    )


def top_users_hourly_sql(spark: SparkSession, folder: str) -> DataFrame:
    return reports.hourly_trend_of_top_groups_sql(
        spark, table(spark, folder, "events"), customer_regions(spark, folder), EVENT_CUSTOMER, timestamp="ts"
    )


def top_users(spark: SparkSession, folder: str) -> DataFrame:
    return top_groups(
        table(spark, folder, "events"),
        table(spark, folder, "customer"),
        fact_key="user_id",
        dimension_key="c_custkey",
        group="c_name",
        k=5,
        count="trip_count",
    )


def _line_fees(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").withColumn("fee", F.col("l_extendedprice") * F.col("l_tax"))


def _rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, 6))


def avg_ratio_by_region(spark: SparkSession, folder: str) -> DataFrame:
    result = reports.mean_percent_by_group(
        _line_fees(spark, folder), supplier_regions(spark, folder), LINE_REGION, **_RATIO
    )
    return _rounded(result, "avg_fee_percentage")


def avg_ratio_by_region_sql(spark: SparkSession, folder: str) -> DataFrame:
    result = reports.mean_percent_by_group_sql(
        spark, _line_fees(spark, folder), supplier_regions(spark, folder), LINE_REGION, **_RATIO
    )
    return _rounded(result, "avg_fee_percentage")


def _priority_labels(spark: SparkSession) -> DataFrame:
    """Labels of four of the five priorities; the fifth must come out under a null label."""
    return rows_table(
        spark,
        [("1-URGENT", "urgent"), ("2-HIGH", "high"), ("3-MEDIUM", "medium"), ("5-LOW", "low")],
        "priority string, label string",
    )


def orders_by_priority_label(spark: SparkSession, folder: str) -> DataFrame:
    return reports.counts_by_label(table(spark, folder, "orders"), _priority_labels(spark), ORDER_PRIORITY)


def orders_by_priority_label_sql(spark: SparkSession, folder: str) -> DataFrame:
    return reports.counts_by_label_sql(
        spark, table(spark, folder, "orders"), _priority_labels(spark), ORDER_PRIORITY
    )


# --- expressions ----------------------------------------------------------------------------------------------------


def time_keys(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id",
        date_text("ts").alias("date_text"),
        date_key("ts").alias("date_key"),
        hour_key("ts").alias("hour_key"),
        hour_of_day("ts").alias("hour_of_day"),
        *[column.alias(name) for name, column in partition_values("ts").items()],
    )


def _durations(spark: SparkSession, folder: str) -> DataFrame:
    return order_lines(spark, folder).select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("miles"),
        elapsed_seconds("pickup", "l_shipdate").alias("seconds"),
    )


def _with_speeds(durations: DataFrame, efficiency: Column) -> DataFrame:
    return durations.select(
        "l_orderkey",
        "l_linenumber",
        "seconds",
        minutes("seconds").alias("mins"),
        miles_per_hour("miles", "seconds").alias("speed"),
        efficiency.alias("efficiency"),
    )


def duration_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _with_speeds(_durations(spark, folder), miles_per_minute("miles", "seconds"))


def duration_metrics_udf(spark: SparkSession, folder: str) -> DataFrame:
    return _with_speeds(_durations(spark, folder), miles_per_minute_udf()("miles", "seconds"))


def fare_total(spark: SparkSession, folder: str) -> DataFrame:
    """Seven parts; a tax of zero counts as unknown and makes the total null."""
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        strict_total(
            price, price * discount, discount, F.nullif(price * tax, F.lit(0.0)), F.lit(2.75), F.lit(2.5), tax
        ).alias("total_fare"),
    )


def flag_cast(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        yes_no_flag(_flag("l_returnflag", "R", "A")).alias("flag"),
        F.col("l_quantity").try_cast("int").alias("whole_quantity"),
        F.col("l_linenumber").cast("string").alias("line_text"),
    )


def _ip_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Dotted digit runs of all documents, each also with a 9 put in front, and the samples."""
    found = table(spark, folder, "documents").select(
        "doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(r"([0-9]+(?:\.[0-9]+)+)"))).alias("pos", "token")
    )
    variants = found.select(
        "doc_id",
        "pos",
        F.posexplode(F.array(F.col("token"), F.concat(F.lit("9"), F.col("token")))).alias("variant", "ip_address"),
    )
    samples = rows_table(
        spark,
        [(-1, i, 0, text) for i, text in enumerate(IP_SAMPLES)],
        "doc_id long, pos int, variant int, ip_address string",
    )
    return variants.unionByName(samples)


def ip_validity(spark: SparkSession, folder: str) -> DataFrame:
    return _ip_tokens(spark, folder).withColumn("is_valid", is_ipv4("ip_address"))


def ip_validity_udf(spark: SparkSession, folder: str) -> DataFrame:
    return _ip_tokens(spark, folder).withColumn("is_valid", is_ipv4_udf()("ip_address"))


def ip_validity_counts(spark: SparkSession, folder: str) -> DataFrame:
    return (
        ip_validity(spark, folder)
        .groupBy("variant")
        .agg(F.count_if("is_valid").alias("valid"), F.count_if(~F.col("is_valid")).alias("invalid"))
    )


# --- lookups --------------------------------------------------------------------------------------------------------


def dimension_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Order rows with their customer's segment."""
    return attach_dimension(
        table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"),
        table(spark, folder, "customer"),
        fact_key="o_custkey",
        dimension_key="c_custkey",
        attributes=["c_mktsegment"],
    )


def dimension_lookup_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the dimension taken as too large to broadcast."""
    return attach_dimension(
        table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"),
        table(spark, folder, "customer"),
        fact_key="o_custkey",
        dimension_key="c_custkey",
        attributes=["c_mktsegment"],
        spread_by=["o_orderkey"],
        broadcast_bytes=-1,
    )


def dimension_lookup_text_key(spark: SparkSession, folder: str) -> DataFrame:
    """Customers per segment and manager through a large lookup whose text key ignores case, as the facts' key does."""
    any_case = F.collate(F.lower("c_mktsegment"), "UTF8_LCASE")
    customers = table(spark, folder, "customer").select("c_custkey", any_case.alias("segment"))
    managers = rows_table(
        spark,
        [("BUILDING", "Ada"), ("Machinery", "Ben"), ("AUTOMOBILE", "Cyd"), ("FURNITURE", "Dov")],
        "name string, manager string",
    ).select(F.collate("name", "UTF8_LCASE").alias("name"), "manager")
    joined = attach_dimension(
        customers,
        managers,
        fact_key="segment",
        dimension_key="name",
        attributes=["manager"],
        how="left",
        broadcast_bytes=-1,
        rows_per_piece=10,
    )
    return joined.select("c_custkey", F.collate("segment", "UTF8_BINARY").alias("segment"), "manager")


def _priced_orders(spark: SparkSession, folder: str, **options) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    priced = attach_rates(
        orders.withColumn("currency", F.lit("USD")),
        order_day_rates(spark, folder),
        CURRENCIES,
        currency="currency",
        day=F.to_date("o_orderdate"),
        spread_by=["o_orderkey"],
        **options,
    )
    return priced.select(
        "o_orderkey",
        "gbp_rate",
        "eur_rate",
        (F.col("o_totalprice") * F.col("gbp_rate")).alias("total_gbp"),
        (F.col("o_totalprice") * F.col("eur_rate")).alias("total_eur"),
    )


def fx_enrich(spark: SparkSession, folder: str) -> DataFrame:
    return _priced_orders(spark, folder)


def fx_enrich_two_joins(spark: SparkSession, folder: str) -> DataFrame:
    return _priced_orders(spark, folder, on_duplicate="expand")


# --- facts, contract, quality ---------------------------------------------------------------------------------------


def fact_green(spark: SparkSession, folder: str) -> DataFrame:
    return _plain_times(fact_bookings(green_trips(spark, folder), order_day_rates(spark, folder), GREEN))


def fact_hvfhv(spark: SparkSession, folder: str) -> DataFrame:
    return _plain_times(fact_bookings(hvfhv_trips(spark, folder), order_day_rates(spark, folder), HVFHV))


def dqc_report(spark: SparkSession, folder: str) -> DataFrame:
    facts = fact_bookings(green_trips(spark, folder), order_day_rates(spark, folder), GREEN)
    return quality_report(facts, BLOCKING_CHECKS).select("check_name", "violations")


def fact_contract_report(spark: SparkSession, folder: str) -> DataFrame:
    """The contract of the fact table when trips of vendor 1 lack their platform key."""
    trips = green_trips(spark, folder).withColumn("VendorID", F.nullif(F.col("VendorID"), F.lit(1)))
    return contract_report(fact_bookings(trips, order_day_rates(spark, folder), GREEN), FACT_BOOKINGS)


# --- storage --------------------------------------------------------------------------------------------------------


def dated_orders(spark: SparkSession, folder: str) -> DataFrame:
    parts = partition_values("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        parts["year"].alias("year"),
        parts["month"].alias("month"),
    )


def _staged_orders(spark: SparkSession, folder: str, label: str) -> str:
    path = scratch_path(spark, label)
    stage(dated_orders(spark, folder), path, MONTH_PARTITIONS)
    discard_at_exit(spark, path)
    return path


def _plain_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", F.col("amount").cast("double"))


def period_rows(spark: SparkSession, folder: str) -> DataFrame:
    path = _staged_orders(spark, folder, "orders-by-month")
    return _plain_amount(period_scan(spark, path, PERIOD, keep_partitions=False))


def partition_publish(spark: SparkSession, folder: str) -> DataFrame:
    """All orders as published history; finished orders of all months restated, one month of them published."""
    main = _staged_orders(spark, folder, "orders-main")
    staging = scratch_path(spark, "orders-staging")
    orders = dated_orders(spark, folder)
    restated = orders.where("o_orderstatus = 'F'").withColumn(
        "amount", (F.col("amount") * 2).cast("decimal(18,2)")
    )
    stage(restated, staging, MONTH_PARTITIONS)
    discard_at_exit(spark, staging)
    contract = orders.schema
    require_quality(
        staged_table(spark, staging, contract),
        [Check("missing key", "o_orderkey IS NULL"), Check("negative amount", "amount < 0")],
    )
    publish(spark, staging, main, contract, MONTH_PARTITIONS, PERIOD)
    return (
        staged_table(spark, main, contract)
        .groupBy("year", "month")
        .agg(
            F.count("*").alias("orders"),
            F.count_if(F.col("o_orderstatus") != "F").alias("unfinished"),
            F.sum("amount").cast("double").alias("amount"),
        )
    )


def _customer_file(spark: SparkSession, folder: str) -> str:
    """Customers as CSV with commas and quotes inside a field."""
    path = scratch_path(spark, "customers-csv")
    label = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"'))
    customers = table(spark, folder, "customer").select("c_custkey", label.alias("label"), "c_acctbal")
    customers.write.options(header=True, quote='"', escape='"').csv(path)
    discard_at_exit(spark, path)
    return path


def csv_dim_scan(spark: SparkSession, folder: str) -> DataFrame:
    return csv_table(spark, _customer_file(spark, folder), "c_custkey long, label string, c_acctbal double")


def new_table_name(path: str) -> str:
    return "fareloom_" + path.rsplit("-", 1)[-1]


def csv_inferred_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The same file with types found by an extra pass over it."""
    return csv_table(spark, _customer_file(spark, folder))


def csv_table_listing(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of an external CSV table whose columns are named differently from the file's header."""
    path = _customer_file(spark, folder)
    table = new_table_name(path)
    renamed = StructType().add("customer_id", "long").add("customer_label", "string").add("balance", "double")
    catalog.create_csv_table(spark, table, renamed, path)
    return spark.table(table).select("*")


def catalog_partition_query(spark: SparkSession, folder: str) -> DataFrame:
    """The first 100 rows of one partition of an external table; only that partition is registered at first."""
    path = _staged_orders(spark, folder, "orders-table")
    table = new_table_name(path)
    catalog.create_fact_table(spark, table, dated_orders(spark, folder).schema, MONTH_PARTITIONS, path)
    month = {"year": PERIOD.year, "month": PERIOD.month}
    catalog.add_partition(spark, table, month, f"{path}/{PERIOD.directory}")
    catalog.add_partition(spark, table, month)
    catalog.recover_partitions(spark, table)
    return _plain_amount(catalog.partition_rows(spark, table, month, limit=100, order_by=["o_orderkey"]))


def single_file_export(spark: SparkSession, folder: str) -> DataFrame:
    """A grouped result written as one file and read back."""
    path = scratch_path(spark, "export")
    totals = (
        table(spark, folder, "orders")
        .groupBy("o_orderpriority", "o_orderstatus")
        .agg(
            F.count("*").alias("orders"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("amount"),
        )
    )
    compact_export(totals, path)
    discard_at_exit(spark, path)
    return parquet_table(spark, path, totals.schema)


def staged_partition_listing(spark: SparkSession, folder: str) -> DataFrame:
    """The months that staging holds, from directory names alone."""
    path = _staged_orders(spark, folder, "orders-listed")
    return staged_partitions(staged_table(spark, path, dated_orders(spark, folder).schema), MONTH_PARTITIONS)


def _lake(spark: SparkSession, folder: str, trips: DataFrame, month_of: Column) -> monthly_job.JobPaths:
    """Raw trips and rates stored by month, and empty places for the rest."""
    base = scratch_path(spark, "lake")
    paths = monthly_job.JobPaths(*[f"{base}/{n}" for n in ("bookings", "rates", "staging", "facts", "rejects")])

    def by_month(day: Column) -> dict[str, Column]:
        return {name: column for name, column in partition_values(day).items() if name != "day"}

    stage(trips.withColumns(by_month(month_of)), paths.bookings, MONTH_PARTITIONS)
    rates = order_day_rates(spark, folder)
    rate_day = F.col("exchange_rate_date").cast("date")
    # Rates of a day are kept with the trips of that day's file, which may be the file of the month before.
    rates = rates.unionByName(rates.withColumn("file_day", F.date_sub(rate_day, 1)), allowMissingColumns=True)
    rates = rates.withColumn("file_day", F.coalesce("file_day", rate_day)).withColumns(by_month(F.col("file_day")))
    stage(rates.drop("file_day").distinct(), paths.rates, MONTH_PARTITIONS)
    discard_at_exit(spark, base)
    return paths


def _job_green_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Trips that pass the checks: no negative durations and small totals."""
    return (
        green_trips(spark, folder)
        .withColumn("total_amount", F.col("fare_amount") * F.col("tip_amount"))
        .withColumn("lpep_dropoff_datetime", F.greatest("lpep_dropoff_datetime", "lpep_pickup_datetime"))
    )


def _job_hvfhv_trips(spark: SparkSession, folder: str) -> DataFrame:
    return (
        hvfhv_trips(spark, folder)
        .withColumns({part: F.col(part) / 100 for part in ("base_passenger_fare", "tolls", "sales_tax")})
        .withColumn("dropoff_datetime", F.greatest("dropoff_datetime", "pickup_datetime"))
    )


def monthly_fact_job(spark: SparkSession, folder: str) -> DataFrame:
    """The whole job for one month over raw trips and rates stored by month; the published rows."""
    paths = _lake(spark, folder, _job_green_trips(spark, folder), F.col("lpep_pickup_datetime"))
    monthly_job.run(spark, str(PERIOD), GREEN, paths)
    return _plain_times(staged_table(spark, paths.facts, FACT_BOOKINGS))


def _hvfhv_months(spark: SparkSession, folder: str) -> monthly_job.JobPaths:
    """Two months published one after the other. Each month's file begins on its second day and ends with the first
    day of the next month, whose rows are strays there."""
    file_day = F.date_sub(F.to_date("request_datetime"), 1)
    paths = _lake(spark, folder, _job_hvfhv_trips(spark, folder), file_day)
    for month in (EARLIER_PERIOD, PERIOD):
        monthly_job.run(spark, str(month), HVFHV, paths)
    return paths


def monthly_fact_job_hvfhv(spark: SparkSession, folder: str) -> DataFrame:
    """The job in the other dialect, with an earlier month already published and strays in the files."""
    return _plain_times(staged_table(spark, _hvfhv_months(spark, folder).facts, FACT_BOOKINGS))


def monthly_job_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The stray rows of both months, kept for later."""
    paths = _hvfhv_months(spark, folder)
    found = [staged_table(spark, paths.rejects_of(HVFHV, month), FACT_BOOKINGS) for month in (EARLIER_PERIOD, PERIOD)]
    return _plain_times(found[0].unionByName(found[1]))


DAY = ("1997", "06", "30")


def _platforms(spark: SparkSession) -> DataFrame:
    """Names of some platforms; the others are reported under a null name."""
    return rows_table(
        spark, [("HV0001", "first"), ("HV0002", "second"), ("HV0004", "fourth")], "platform_key string, platform_name string"
    )


def bookings_by_platform_day(spark: SparkSession, folder: str) -> DataFrame:
    facts = staged_table(spark, _hvfhv_months(spark, folder).facts, FACT_BOOKINGS)
    return reports.bookings_by_platform(facts, _platforms(spark), *DAY)


def bookings_by_platform_day_sql(spark: SparkSession, folder: str) -> DataFrame:
    facts = staged_table(spark, _hvfhv_months(spark, folder).facts, FACT_BOOKINGS)
    return reports.bookings_by_platform_sql(spark, facts, _platforms(spark), *DAY)


def quality_gate_report(spark: SparkSession, folder: str) -> DataFrame:
    """A month that fails its checks after another was published: what the gate found, and the published rows after."""
    day = F.col("lpep_pickup_datetime")
    bad = F.date_format(day, "yyyy-MM") == str(PERIOD)
    trips = _job_green_trips(spark, folder).withColumn(
        "total_amount", F.when(bad, F.col("fare_amount")).otherwise(F.col("total_amount"))
    )
    paths = _lake(spark, folder, trips, day)
    monthly_job.run(spark, str(EARLIER_PERIOD), GREEN, paths)
    try:
        monthly_job.run(spark, str(PERIOD), GREEN, paths)
        report = []
    except QualityError as error:
        report = [(row.check_name, row.violations) for row in error.rows if row.blocking]
    found = [F.struct(F.lit(name).alias("check_name"), F.lit(n).cast("long").alias("violations")) for name, n in report]
    kept = staged_table(spark, paths.facts, FACT_BOOKINGS).groupBy("year", "month").agg(F.count("*").alias("published_rows"))
    return kept.select("year", "month", "published_rows", F.inline(F.array(*found)))


QUERIES: dict[str, Query] = {
    "revenue_by_region": revenue_by_region,
    "revenue_by_region_sql": revenue_by_region_sql,
    "top_users_hourly": top_users_hourly,
    "top_users_hourly_sql": top_users_hourly_sql,
    "top_users": top_users,
    "avg_ratio_by_region": avg_ratio_by_region,
    "avg_ratio_by_region_sql": avg_ratio_by_region_sql,
    "orders_by_priority_label": orders_by_priority_label,
    "orders_by_priority_label_sql": orders_by_priority_label_sql,
    "time_keys": time_keys,
    "duration_metrics": duration_metrics,
    "duration_metrics_udf": duration_metrics_udf,
    "fare_total": fare_total,
    "flag_cast": flag_cast,
    "ip_validity": ip_validity,
    "ip_validity_udf": ip_validity_udf,
    "ip_validity_counts": ip_validity_counts,
    "dimension_lookup": dimension_lookup,
    "dimension_lookup_shuffled": dimension_lookup_shuffled,
    "dimension_lookup_text_key": dimension_lookup_text_key,
    "fx_enrich": fx_enrich,
    "fx_enrich_two_joins": fx_enrich_two_joins,
    "fact_green": fact_green,
    "fact_hvfhv": fact_hvfhv,
    "dqc_report": dqc_report,
    "contract_report": fact_contract_report,
    "period_scan": period_rows,
    "partition_publish": partition_publish,
    "csv_dim_scan": csv_dim_scan,
    "csv_inferred_scan": csv_inferred_scan,
    "csv_table_listing": csv_table_listing,
    "catalog_partition_query": catalog_partition_query,
    "single_file_export": single_file_export,
    "monthly_fact_job": monthly_fact_job,
    "monthly_fact_job_hvfhv": monthly_fact_job_hvfhv,
    "monthly_job_rejects": monthly_job_rejects,
    "bookings_by_platform_day": bookings_by_platform_day,
    "bookings_by_platform_day_sql": bookings_by_platform_day_sql,
    "quality_gate_report": quality_gate_report,
    "staged_partition_listing": staged_partition_listing,
}
