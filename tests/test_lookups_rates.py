from decimal import Decimal as D

import pytest
from result_helpers import final_plan, rows
from pyspark.sql import functions as F

from fareloom.operators import lookups
from fareloom.operators.lookups import attach, attach_dimension, heavy_keys, measured_bytes, spread_join
from fareloom.operators.rates import attach_rates, daily_rates


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on key 1, a tenth on the null key, the rest spread over 5000 keys."""
    return spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, 1)
        .when(F.col("id") % 10 != 1, F.pmod(F.xxhash64("id"), F.lit(5000)))
        .cast("int")
        .alias("k"),
        "id",
    )


def test_measured_bytes_grow_with_text(spark):
    short = spark.createDataFrame([("a",), (None,)], "s string")
    long = spark.createDataFrame([("a" * 1000,), (None,)], "s string")
    assert measured_bytes(long) - measured_bytes(short) == 999
    assert measured_bytes(short.limit(0)) == 0
    assert measured_bytes(spark.createDataFrame([([1, 2],)], "a array<int>")) > 0


def test_heavy_keys_are_found_and_few(spark, skewed):
    found = dict(heavy_keys(skewed, F.xxhash64("k"), 60))
    hot = spark.sql("SELECT xxhash64(1), xxhash64(CAST(NULL AS int))").first()
    assert set(found) == set(hot)
    assert 330 <= found[hot[0]] <= 340
    assert heavy_keys(skewed.limit(0), F.xxhash64("k")) == []
    assert heavy_keys(skewed, F.xxhash64("k")) == [], "few rows in all: nothing needs splitting"


def test_a_small_share_of_many_rows_is_split(spark):
    """A key with 0.09 % of the rows, but more of them than a piece should have."""
    keys = spark.range(100_000).select(F.when(F.col("id") < 90, -1).otherwise(F.col("id")).alias("k"))
    hot = spark.sql("SELECT xxhash64(-1L)").first()[0]
    assert [(key, pieces) for key, pieces in heavy_keys(keys, F.xxhash64("k"), 40) if key == hot] == [(hot, 3)]


def test_pieces_follow_the_rows_of_a_heavy_key(spark, monkeypatch):
    """With many more rows than ``SPLIT_KEYS`` pieces the heaviest keys still get pieces of ``rows_per_piece`` rows."""
    monkeypatch.setattr(lookups, "SPLIT_KEYS", 10)
    keys = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.pmod("id", F.lit(50))).alias("k"))
    hot = spark.sql("SELECT xxhash64(-1L)").first()[0]
    assert heavy_keys(keys, F.xxhash64("k"), 40) == [(hot, 500)]


MIXED = [("HOT",)] * 3000 + [("hot",)] * 500 + [("Cold",)] * 5 + [(None,)] * 400


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize(
    ("kind", "facts", "names"),
    [
        ("string collate UTF8_LCASE", MIXED, ["Hot", "COLD", "other", None]),
        ("string", MIXED, ["HOT", "cold", None]),
        ("decimal(10,2)", [(D("1.50"),)] * 3000 + [(D("2.00"),), (None,)], [D("1.5"), D("2"), None]),
        ("double", [(0.0,)] * 1500 + [(-0.0,)] * 1500 + [(float("nan"),)] * 900 + [(2.5,)], [-0.0, float("nan"), 2.5]),
        ("struct<a:string collate UTF8_LCASE>", [((x,),) for (x,) in MIXED], [("Hot",), ("COLD",), (None,)]),
    ],
)
def test_spread_join_keeps_every_match(spark, how, kind, facts, names):
    facts = spark.createDataFrame(facts, f"k {kind}").withColumn("id", F.monotonically_increasing_id())
    lookup = spark.createDataFrame([(name, i) for i, name in enumerate(names)], f"k {kind}, n int")
    plain, spread = facts.join(lookup, ["k"], how), spread_join(facts, lookup, ["k"], how, ["id"], 50)
    assert sorted(map(tuple, spread.select("id", "n").collect()), key=str) == sorted(
        map(tuple, plain.select("id", "n").collect()), key=str
    )
    assert plain.where("n = 0").count() > 2999


def test_a_known_size_spares_the_measurement(spark, skewed):
    lookup = spark.range(10).select(F.col("id").alias("k"), F.raise_error(F.lit("measured")).alias("name"))
    assert attach(skewed, lookup, ["k"], lookup_bytes=1000).columns == ["k", "id", "name"]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("key_type", ["int", "bigint"])
def test_spread_join_equals_plain_join(spark, skewed, how, key_type):
    lookup = spark.range(3000).select(F.col("id").cast(key_type).alias("k"), F.col("id").cast("string").alias("name"))
    lookup = lookup.union(spark.createDataFrame([(1, "twice"), (None, "never")], f"k {key_type}, name string"))
    wanted = skewed.join(F.broadcast(lookup), ["k"], how)
    spread = spread_join(skewed, lookup, ["k"], how, ["id"], 60)
    assert spread.columns == wanted.columns
    summary = [F.count("*"), F.sum(F.xxhash64("k", "id", "name").cast("decimal(38,0)")), F.count("name")]
    assert spread.agg(*summary).first() == wanted.agg(*summary).first()


def test_spread_join_splits_the_hot_key(spark, skewed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        lookup = spark.range(5000).select(F.col("id").cast("int").alias("k"))
        joined = spread_join(skewed, lookup, ["k"], "inner", ["id"], 60)
        sizes = [row[1] for row in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2 * sum(sizes) / 16
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_attach_broadcasts_only_within_the_bound(spark, skewed, tmp_path):
    lookup = spark.range(100).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("name"))
    facts = spark.range(10).select(F.col("id").cast("int").alias("k"), "id")
    assert "BroadcastHashJoin" in final_plan(attach(facts, lookup, ["k"]))
    wide = attach(skewed, lookup, ["k"], broadcast_bytes=10, rows_per_piece=60)
    logical = wide._jdf.queryExecution().analyzed().toString()
    assert "__salt" in logical
    with pytest.raises(ValueError):
        attach(facts, lookup, ["k"], "full")


def test_attach_dimension_inner_and_left(spark, locations):
    facts = spark.createDataFrame([(1, "a"), (3, "b"), (99, "c"), (None, "d")], "loc int, id string")
    options = dict(fact_key="loc", dimension_key="LocationID", attributes=["Borough"])
    inner = attach_dimension(facts, locations, **options)
    assert sorted(rows(inner)) == [(1, "a", "Queens"), (3, "b", "Bronx")]
    left = attach_dimension(facts, locations, how="left", **options)
    assert sorted(rows(left), key=str)[-1] == (None, "d", None)
    assert left.count() == 4


def enriched(facts, rates, **options):
    return attach_rates(
        facts, rates, ["GBP", "EUR"], currency="cur", day=F.to_date("day"), **options
    )


@pytest.fixture(scope="module")
def amounts(spark):
    return spark.createDataFrame(
        [("a", "USD", "2024-06-01"), ("b", "USD", "2024-06-02"), ("c", "JPY", "2024-06-01"), ("d", "USD", None)],
        "id string, cur string, day string",
    )


@pytest.mark.parametrize("mode", ["error", "expand"])
@pytest.mark.parametrize("limit", [{}, {"broadcast_bytes": -1}])
@pytest.mark.parametrize("kind", ["string", "date", "timestamp"])
def test_rates_keep_every_row(amounts, make_rates, mode, limit, kind):
    rates = make_rates(
        [("USD", "GBP", "2024-06-01", 0.8), ("USD", "EUR", "2024-06-01", 0.9), ("USD", "CHF", "2024-06-02", 0.7),
         ("USD", "EUR", "2024-06-02", 0.95)]
    ).withColumn("exchange_rate_date", F.col("exchange_rate_date").cast(kind))
    result = enriched(amounts, rates, on_duplicate=mode, **limit).select("id", "gbp_rate", "eur_rate")
    assert sorted(rows(result)) == [
        ("a", 0.8, 0.9),
        ("b", None, 0.95),
        ("c", None, None),
        ("d", None, None),
    ]


def test_duplicate_rates_fail_or_expand(amounts, make_rates):
    rates = make_rates(
        [("USD", "GBP", "2024-06-01", 0.8), ("USD", "GBP", "2024-06-01", 0.81), ("USD", "EUR", "2024-06-01", 0.9)]
    )
    with pytest.raises(Exception, match="more than one GBP rate for USD on 2024-06-01"):
        enriched(amounts, rates).collect()
    expanded = enriched(amounts, rates, on_duplicate="expand").where("id = 'a'")
    assert sorted(rows(expanded.select("gbp_rate", "eur_rate"))) == [(0.8, 0.9), (0.81, 0.9)]
    with pytest.raises(ValueError):
        enriched(amounts, rates, on_duplicate="first")


def test_unreadable_rate_dates_match_nothing(amounts, make_rates):
    rates = make_rates([("USD", "GBP", "soon", 0.8), ("USD", "GBP", None, 0.7)])
    assert set(rows(enriched(amounts, rates.where("exchange_rate_date = 'soon'")).select("gbp_rate"))) == {(None,)}


def test_daily_rates_are_one_row_per_day(make_rates):
    day = "2024-06-01"
    rates = make_rates([("USD", "GBP", day, 0.8), ("USD", "EUR", day, 0.9), ("EUR", "GBP", day, 0.85)])
    result = daily_rates(rates, ["GBP", "EUR"])
    assert sorted((row[0], *row[2:]) for row in rows(result)) == [("EUR", 0.85, None), ("USD", 0.8, 0.9)]
