"""Sketches, reconciliation, membership, incremental staging and JSON columns against plain Python, and their plans."""

import math
import random
from collections import Counter
from itertools import product
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareloom.functions.semistructured import items, with_fields
from fareloom.operators.membership import rows_by_existence, with_membership
from fareloom.operators.reconcile import differing_partitions, surplus_rows
from fareloom.operators.sketches import distinct_counts, quantiles, sketched, store, stored
from fareloom.sources.publishing import stage, staged_table
from fareloom.streaming.incoming import take_new_files
from result_helpers import final_plan, rows

DAYS = StructType().add("day", "integer")


# --- sketches -------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def measured(spark):
    rng = random.Random(5)
    sizes = [lambda: rng.lognormvariate(3, 4), lambda: -rng.lognormvariate(0, 2), lambda: 0.0, lambda: rng.choice([1e-300, 1e300])]
    odd = [None, math.nan, math.inf, -math.inf]
    return [
        (rng.choice([1, 1, 1, 2, 3]), f"u{rng.randrange(3000)}", rng.choice(odd) if k % 50 == 0 else rng.choice(sizes)())
        for k in range(8000)
    ]


def test_quantiles_of_merged_days_are_within_the_accuracy(spark, measured, tmp_path):
    path = str(tmp_path / "sketches")
    facts = spark.createDataFrame(measured, "day int, user string, size double").repartition(7)
    store(sketched(facts, ["day"], {"users": F.col("user")}, {"size": F.col("size")}), path, ["day"])
    at = {f"q{k}": k / 20 for k in range(21)}
    sketches = stored(spark, path, DAYS)
    for days in ([1], [2, 3], [1, 2, 3]):
        own = sketches.where(F.col("day").isin(days))
        values = sorted(v for d, _, v in measured if d in days and v is not None and math.isfinite(v))
        found = quantiles(own, [], "size", at).first()
        for label, q in at.items():
            exact = values[max(1, math.ceil(q * len(values))) - 1]
            assert found[label] == pytest.approx(exact, rel=0.0101, abs=0)
        users = len({u for d, u, _ in measured if d in days})
        assert distinct_counts(own, [], ["users"]).first().users == pytest.approx(users, rel=0.05)


def test_sketches_are_read_instead_of_facts_and_one_day_is_replaced(spark, measured, tmp_path):
    path = str(tmp_path / "sketches")
    facts = spark.createDataFrame(measured, "day int, user string, size double")
    store(sketched(facts, ["day"], {"users": F.col("user")}, {"size": F.col("size")}), path, ["day"])
    before = {r.day: r.half for r in quantiles(stored(spark, path, DAYS), ["day"], "size", {"half": 0.6}).collect()}
    again = facts.where("day = 2").withColumn("size", F.lit(7.0))
    store(sketched(again, ["day"], {"users": F.col("user")}, {"size": F.col("size")}), path, ["day"])
    answer = quantiles(stored(spark, path, DAYS), ["day"], "size", {"half": 0.6})
    after = {r.day: r.half for r in answer.collect()}
    assert after[2] == pytest.approx(7, rel=0.01) and {d: after[d] for d in (1, 3)} == {d: before[d] for d in (1, 3)}
    assert final_plan(answer).count("FileScan parquet") == 1


def test_sketches_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([(1, None, None)], "day int, user string, size double")
    made = sketched(none, ["day"], {"users": F.col("user")}, {"size": F.col("size")})
    assert rows(distinct_counts(made, ["day"], ["users"])) == [(1, 0)]
    assert rows(quantiles(made, ["day"], "size", {"half": 0.5})) == []
    assert rows(sketched(none.where("day = 2"), ["day"], {"users": F.col("user")}, {"size": F.col("size")})) == []
    with pytest.raises(ValueError, match="rows"):
        sketched(none.withColumnRenamed("day", "rows"), ["rows"], {}, {"size": F.col("size")})


# --- reconciliation -------------------------------------------------------------------------------------------------


def test_surplus_equals_counted_rows(spark):
    rng = random.Random(9)
    pool = [(d, k, s) for d in (1, 2, None) for k in (1, None) for s in ("a", "", None)]
    staged, published = ([rng.choice(pool) for _ in range(60)] for _ in range(2))
    same = [(7, 5, "x")] * 40 + [(7, 6, None)]
    schema = "day int, number int, word string"
    a, b = spark.createDataFrame(staged + same, schema), spark.createDataFrame(same + published, schema)
    wanted = Counter(staged)
    wanted.subtract(published)
    found = {r[:3]: r[3] for r in rows(surplus_rows(a, b, ["day"]))}
    assert found == {row: n for row, n in wanted.items() if n}
    unequal = {d for d in (1, 2, None) if any(n and row[0] == d for row, n in wanted.items())}
    assert {r[0] for r in rows(differing_partitions(a, b, ["day"]))} == unequal


def test_nulls_in_other_places_differ(spark):
    schema = "day int, x int, y int"
    a, b = spark.createDataFrame([(1, 3, None)], schema), spark.createDataFrame([(1, None, 3)], schema)
    assert rows(differing_partitions(a, b, ["day"])) == [(1, 0)]
    assert sorted(rows(surplus_rows(a, b, ["day"])), key=str) == [(1, 3, None, 1), (1, None, 3, -1)]
    assert rows(surplus_rows(a, a, ["day"])) == [] and rows(surplus_rows(a.where("x = 0"), b.where("x = 0"), ["day"])) == []


def test_equal_partitions_are_not_read_twice(spark, tmp_path):
    facts = spark.range(300).selectExpr("id", "id % 5 AS amount", "CAST(id % 3 AS STRING) AS day")
    paths = [str(tmp_path / name) for name in ("staged", "published")]
    stage(facts.withColumn("amount", F.expr("amount + IF(id = 4, 1, 0)")), paths[0], ["day"])
    stage(facts, paths[1], ["day"])
    staged, published = (staged_table(spark, path, facts.schema) for path in paths)
    found = surplus_rows(staged, published, ["day"])
    assert sorted(rows(found)) == [(4, 4, "1", -1), (4, 5, "1", 1)]
    for path in paths:
        for gone in ("day=0", "day=2"):
            for file in Path(path, gone).glob("part-*"):
                file.write_bytes(b"")  # reading any of these now would fail
    assert sorted(rows(found)) == [(4, 4, "1", -1), (4, 5, "1", 1)]


def test_other_columns_are_refused(spark):
    a = spark.createDataFrame([(1, 2)], "day int, x int")
    with pytest.raises(ValueError, match="columns differ"):
        surplus_rows(a, a.withColumn("x", F.col("x").cast("long")), ["day"])
    with pytest.raises(ValueError, match="partition columns"):
        surplus_rows(a, a, [])
    with pytest.raises(ValueError, match="surplus"):
        surplus_rows(a.withColumn("surplus", F.lit(1)), a.withColumn("surplus", F.lit(1)), ["day"])


# --- membership -----------------------------------------------------------------------------------------------------


def is_in(value, entries):
    if not entries:
        return False
    if value is None:
        return None
    if value in entries:
        return True
    return None if None in entries else False


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_membership_equals_three_valued_logic(spark, broadcast):
    lists = {"none": [], "nulls": [None, None], "some": [1, 2, 2], "both": [1, None], "hot": [3] * 500}
    own = [(g, v) for g, v in product([*lists, "absent", None], [None, 1, 3])] * 2
    others = [(g, v) for g, entries in lists.items() for v in entries] + [(None, 1)]
    a, b = spark.createDataFrame(own, "g string, v int"), spark.createDataFrame(others, "g string, v int")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        found = with_membership(a, b, "v", "v", {"g": "g"})
        assert Counter(rows(found)) == Counter((g, v, is_in(v, lists.get(g, []))) for g, v in own)
        assert "NestedLoop" not in final_plan(found) and "Cartesian" not in final_plan(found)
        for entries in lists.values():
            listed = spark.createDataFrame([(e,) for e in entries], "entry int")
            answer = with_membership(a, listed, "v", "entry", name="there")
            assert Counter(rows(answer)) == Counter((g, v, is_in(v, entries)) for g, v in own)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_existence(spark):
    own = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "k int, x string")
    others = spark.createDataFrame([(1,)] * 50 + [(None,)], "k int")
    assert sorted(rows(rows_by_existence(own, others, {"k": "k"}))) == [(1, "a"), (1, "a")]
    assert Counter(rows(rows_by_existence(own, others, {"k": "k"}, exists=False))) == Counter([(2, "b"), (None, "c")])
    assert Counter(rows(rows_by_existence(own, others, {"k": "k"}, exists=False, null_safe=True))) == Counter([(2, "b")])
    assert rows(rows_by_existence(own, others.where("k > 5"), {"k": "k"})) == []
    with pytest.raises(ValueError):
        rows_by_existence(own, others, {})
    with pytest.raises(ValueError, match="x"):
        with_membership(own, others, "k", "k", name="x")


# --- incremental staging --------------------------------------------------------------------------------------------


def test_runs_over_late_and_repeated_files_equal_one_batch(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / name) for name in ("landing", "target", "checkpoint"))
    schema = spark.createDataFrame([], "id long, at timestamp_ntz, x int").schema

    def drop(*records):
        spark.sql(f"SELECT * FROM VALUES {', '.join(records)} AS t(id, at, x)").selectExpr(
            "CAST(id AS LONG) AS id", "CAST(at AS TIMESTAMP_NTZ) AS at", "x"
        ).write.mode("append").parquet(landing)

    def run():
        take_new_files(
            spark, landing, schema, target, checkpoint, ["id"], partition_by=["day"],
            prepare=lambda records: records.withColumn("day", F.date_format("at", "yyyy-MM-dd")),
        )
        found = spark.read.schema(StructType(list(schema.fields)).add("day", "string")).parquet(target)
        return sorted(rows(found.select("id", "x", "day")))

    drop("(1, '2024-06-30 10:00:00', 1)", "(2, '2024-06-30 11:00:00', 2)", "(2, '2024-06-30 11:00:00', 2)")
    first = [(1, 1, "2024-06-30"), (2, 2, "2024-06-30")]
    assert run() == first
    drop("(3, '2019-01-01 00:00:00', 3)", "(1, '2024-06-30 10:00:00', 1)")  # years late, and one repeated
    assert run() == first + [(3, 3, "2019-01-01")]
    assert run() == first + [(3, 3, "2019-01-01")]  # nothing new


# --- JSON -----------------------------------------------------------------------------------------------------------


def test_fields_and_problems(spark):
    texts = ['{"k": 5, "u": {"v": [1, 2]}}', '{"k": "x"}', '{"k": "7"}', '{"k": null}', "{}", '{"k": 5', "", None, "3", "[1]"]
    found = with_fields(
        spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, raw string"),
        "raw", {"k": ("$.k", "bigint"), "second": ("$.u.v[1]", "int")},
    )
    assert found.columns == ["n", "raw", "k", "second", "problem"]
    wanted = [
        (5, 2, None), (None, None, "k is no bigint"), (7, None, None), (None, None, None), (None, None, None),
        (None, None, "not JSON"), (None, None, "not JSON"), (None, None, None), (None, None, None), (None, None, None),
    ]
    assert [tuple(r)[2:] for r in sorted(rows(found))] == wanted
    with pytest.raises(ValueError, match="raw"):
        with_fields(found, "raw", {"raw": ("$.k", "int")})
    assert "Python" not in final_plan(found)


def test_items(spark):
    texts = ['{"b": 1, "a": [true]}', "[10, null]", "[]", "{}", "5", "{", None]
    found = items(spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, raw string"), "raw")
    assert sorted(tuple(r)[0:1] + tuple(r)[2:] for r in rows(found)) == [
        (0, 0, "a", "[true]"), (0, 1, "b", "1"), (1, 0, None, "10"), (1, 1, None, "null"),
    ]
