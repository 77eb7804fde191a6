"""As-of join, interval join, sessions, subtotals and top rows against plain Python, and their plans."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fareloom.operators.asof import asof_join
from fareloom.operators.intervals import overlap_join
from fareloom.operators.rates import attach_last_rates
from fareloom.operators.sessions import sessions
from fareloom.operators.subtotals import cube_sets, rollup_sets, subtotals, top_rows
from result_helpers import final_plan, rows


def loops(plan):
    return "NestedLoop" in plan or "Cartesian" in plan


# --- as-of ----------------------------------------------------------------------------------------------------------


def last_known(facts, known, within=None):
    out = []
    for number, key, at in facts:
        found = []
        for column in (2, 3):
            past = [(t, k[column]) for k in known for t in [k[1]] if k[0] == key is not None and at is not None
                    and t is not None and t <= at and k[column] is not None]
            best = max(past, default=(None, None))
            found.append(None if best[0] is None or (within is not None and best[0] < at - within) else best)
        times = [f[0] for f in found if f]
        out.append((number, key, at, *[f and f[1] for f in found], max(times, default=None)))
    return sorted(out, key=str)


@pytest.mark.parametrize("within", [None, 40])
@pytest.mark.parametrize("pieces", [1_000_000, 20])
def test_asof_equals_plain_python(spark, within, pieces):
    rng = random.Random(3)
    keys = ["hot"] * 6 + ["a", "b", None]
    facts = [(k, rng.choice(keys), rng.choice([rng.randrange(-500, 500), 7, None])) for k in range(400)]
    known = [
        (rng.choice(keys), rng.choice([rng.randrange(-400, 400), None]), rng.choice([rng.randrange(99), None]), rng.choice([1.5, 2.5, None]))
        for _ in range(120)
    ]
    f = spark.createDataFrame(facts, "number int, key string, at long")
    k = spark.createDataFrame(known, "key string, since long, x int, y double")
    joined = asof_join(
        f, k, ["key"], fact_time="at", known_time="since", values=["x", "y"], within=within, at_column="newest",
        ranges=7, rows_per_piece=pieces,
    )
    assert joined.columns == ["number", "key", "at", "x", "y", "newest"]
    assert sorted(rows(joined), key=str) == last_known(facts, known, within)


def test_asof_spreads_a_hot_key_over_tasks(spark):
    facts = spark.range(20_000).selectExpr("id AS number", "IF(id >= 0, 'hot', '') AS key", "id AS at")
    known = spark.range(0, 20_000, 100).selectExpr("'hot' AS key", "id AS since", "id AS x")
    joined = asof_join(facts, known, ["key"], fact_time="at", known_time="since", values=["x"])
    assert joined.where("x <> at - at % 100").count() == 0
    spread = joined.groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 1 and max(r["count"] for r in spread) < 15_000
    one_moment = facts.withColumn("at", F.expr("IF(number >= 0, 5000L, 0L)"))
    dealt = asof_join(one_moment, known, ["key"], fact_time="at", known_time="since", values=["x"], rows_per_piece=1000)
    assert [r.x for r in dealt.select("x").distinct().collect()] == [5000] and dealt.count() == 20_000
    assert max(r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()) < 15_000
    assert not loops(final_plan(dealt))


def test_asof_of_empty_tables_and_timestamps(spark):
    facts = spark.createDataFrame([(1, "a", dt.datetime(2024, 6, 1, 12))], "n int, key string, at timestamp_ntz")
    known = spark.createDataFrame([("a", dt.datetime(2024, 6, 1, 11), 5)], "key string, since timestamp_ntz, x int")
    options = dict(fact_time="at", known_time="since", values=["x"])
    assert rows(asof_join(facts, known, ["key"], **options).select("x")) == [(5,)]
    assert rows(asof_join(facts, known, ["key"], within=60_000_000, **options).select("x")) == [(None,)]
    assert rows(asof_join(facts, known.limit(0), ["key"], **options).select("x")) == [(None,)]
    assert rows(asof_join(facts.limit(0), known, ["key"], **options)) == []


def test_last_rates_fill_days_and_leave_facts_in_place(spark, make_rates):
    rates = make_rates([("USD", "GBP", "2024-06-03", 0.8), ("USD", "EUR", "2024-06-05", 0.9), ("USD", "GBP", "2024-06-10", 0.7)])
    days = ["2024-06-02", "2024-06-03", "2024-06-07", "2024-06-09", "2024-06-12", None]
    facts = spark.createDataFrame([(k, "USD", d) for k, d in enumerate(days)] + [(9, "JPY", "2024-06-07")], "n int, cur string, day string")
    joined = attach_last_rates(facts, rates, ["GBP", "EUR"], currency="cur", day=F.col("day").cast("date"))
    got = {r.n: (r.gbp_rate, r.eur_rate) for r in joined.collect()}
    assert got == {
        0: (None, None), 1: (0.8, None), 2: (0.8, 0.9), 3: (0.8, 0.9), 4: (0.7, 0.9), 5: (None, None), 9: (None, None)
    }
    assert "BroadcastHashJoin" in final_plan(joined)
    young = attach_last_rates(facts, rates, ["GBP", "EUR"], currency="cur", day=F.col("day").cast("date"), max_age_days=3)
    assert {r.n: (r.gbp_rate, r.eur_rate) for r in young.collect()}[3] == (None, None)


# --- intervals ------------------------------------------------------------------------------------------------------


def test_overlaps_equal_all_pairs(spark):
    rng = random.Random(8)

    def some(count):
        out = []
        for k in range(count):
            start = rng.randrange(-1000, 1000)
            length = rng.choice([0, 0, 1, 3, 4, 5, 20, 300, 3000, -2, None])
            out.append((k, rng.choice(["x", "y", None]), start, None if length is None else start + length))
        return out

    left, right = some(150), some(150)
    a = spark.createDataFrame(left, "a long, key string, a0 long, a1 long")
    b = spark.createDataFrame(right, "b long, key string, b0 long, b1 long")

    def meets(p, q):
        return None not in (p[3], q[3]) and p[2] <= p[3] and q[2] <= q[3] and p[2] <= q[3] and q[2] <= p[3]

    keyed = overlap_join(a, b, left_interval=("a0", "a1"), right_interval=("b0", "b1"), on=["key"])
    wanted = sorted((p[0], q[0]) for p in left for q in right if p[1] == q[1] is not None and meets(p, q))
    assert sorted(rows(keyed.select("a", "b"))) == wanted and wanted
    free = overlap_join(a.drop("key"), b.drop("key"), left_interval=("a0", "a1"), right_interval=("b0", "b1"))
    assert sorted(rows(free.select("a", "b"))) == sorted((p[0], q[0]) for p in left for q in right if meets(p, q))
    assert not loops(final_plan(free))
    assert rows(overlap_join(a, b.limit(0), left_interval=("a0", "a1"), right_interval=("b0", "b1"), on=["key"])) == []
    with pytest.raises(ValueError, match="both sides"):
        overlap_join(a, a, left_interval=("a0", "a1"), right_interval=("a0", "a1"), on=["key"])


def test_long_intervals_touch_few_bins(spark):
    long = spark.range(50).selectExpr("id AS a", "0L AS a0", "(1L << 50) + id AS a1")
    short = spark.range(2000).selectExpr("id AS b", "id * 1000003 AS b0", "id * 1000003 + 5 AS b1")
    pairs = overlap_join(long, short, left_interval=("a0", "a1"), right_interval=("b0", "b1"))
    assert pairs.count() == 100_000


# --- sessions -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("ranges", [1, 5, 64])
def test_sessions_equal_plain_python(spark, ranges):
    rng = random.Random(ranges)
    data = [(rng.choice(["hot"] * 5 + ["a", "b", None]), rng.choice([rng.randrange(2000), 77, None]), rng.randrange(9)) for _ in range(500)]
    found = sessions(spark.createDataFrame(data, "key string, at long, x int"), "key", "at", 10, {"total": F.col("x")}, ranges)
    wanted = []
    for key in {d[0] for d in data}:
        number, open_row = 0, None
        for at, x in sorted((d[1], d[2]) for d in data if d[0] == key and d[1] is not None):
            if open_row is None or at - open_row[3] > 10:
                number += 1
                open_row = [key, number, at, at, 0, 0]
                wanted.append(open_row)
            open_row[3], open_row[4], open_row[5] = at, open_row[4] + 1, open_row[5] + x
    assert found.columns == ["key", "session", "start", "end", "rows", "total"]
    assert sorted(map(str, rows(found))) == sorted(str(tuple(w)) for w in wanted)


def test_sessions_of_a_hot_user_are_spread(spark):
    events = spark.range(20_000).selectExpr("IF(id >= 0, 1, 0) AS user", "id * 2 + IF(id % 1000 = 0, -1, 0) AS at")
    found = sessions(events, "user", "at", 2)
    assert found.count() == 21 and found.agg(F.sum("rows")).first()[0] == 20_000
    plan = final_plan(sessions(events, "user", "at", 2))
    assert "hashpartitioning(key" in plan and "range" in plan and not loops(plan)
    assert rows(sessions(events.limit(0), "user", "at", 2)) == []


# --- subtotals and top rows -----------------------------------------------------------------------------------------


def test_subtotals_equal_grouping_sets_and_expand_partials(spark):
    rng = random.Random(2)
    data = [(rng.choice(["p", "q", None]), rng.choice([1, 2, None]), rng.choice([rng.randrange(50), None])) for _ in range(300)]
    df = spark.createDataFrame(data, "g string, h int, x int")
    x = F.col("x")
    measures = {"n": ("count", x), "s": ("sum", x), "lo": ("min", x), "hi": ("max", x), "avg": ("mean", x)}
    for sets, name in ((rollup_sets(["g", "h"]), "ROLLUP"), (cube_sets(["g", "h"]), "CUBE"), ([["h"], []], None)):
        found = subtotals(df, ["g", "h"], sets, measures)
        grouping = f"{name}(g, h)" if name else "GROUPING SETS ((h), ())"
        direct = spark.sql(
            "SELECT g, h, grouping_id(g, h) AS level, count(x) AS n, sum(x) AS s, min(x) AS lo, max(x) AS hi, avg(x) AS avg "
            f"FROM {{df}} GROUP BY {grouping}", df=df,
        ) if name else None
        if direct is not None:
            assert sorted(map(str, rows(found))) == sorted(map(str, rows(direct)))
        else:
            assert {r.level for r in found.collect()} == {2, 3}
    plan = final_plan(subtotals(df, ["g", "h"], cube_sets(["g", "h"]), measures))
    assert plan.count("Expand") == 1 and plan.index("Expand") < plan.rindex("HashAggregate")
    assert plan.count("Scan") == 1


def test_top_rows_with_and_without_ties(spark):
    df = spark.createDataFrame([("a", 5, 1), ("a", 5, 2), ("a", 4, 3), ("a", 4, 4), ("a", 3, 5), ("b", 1, 6)], "g string, x int, n int")
    tied = top_rows(df, ["g"], [F.desc("x")], 3)
    assert sorted(rows(tied.select("n", "rank"))) == [(1, 1), (2, 1), (3, 3), (4, 3), (6, 1)]
    assert sorted(rows(top_rows(df, ["g"], [F.desc("x"), F.asc("n")], 3, ties=False).select("n"))) == [(1,), (2,), (3,), (6,)]
    assert "WindowGroupLimit" in final_plan(tied)
