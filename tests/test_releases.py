"""Releases: all partitions at once, without reading or writing data files."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fareloom.plans import monthly_job
from fareloom.plans.dialects import GREEN
from fareloom.plans.tables import FACT_BOOKINGS
from fareloom.sources.periods import Period
from fareloom.sources.publishing import stage
from fareloom.sources.releases import ReleaseConflict, Releases
from result_helpers import rows

SCHEMA = "amount int, year string, month string, day string"


@pytest.fixture
def releases(spark, tmp_path):
    name = f"facts_{tmp_path.name}".replace("-", "_")
    return Releases(name, str(tmp_path / "facts"), spark.createDataFrame([], SCHEMA).schema)


def run_of(spark, releases, *data):
    return releases.stage(spark.createDataFrame(data, SCHEMA))


def shown(spark, releases):
    return sorted(rows(spark.table(releases.name).select("amount", "month", "day")))


FIRST = [(1, "2024", "05", "31"), (2, "2024", "06", "01"), (3, "2024", "06", "02")]
SECOND = [(20, "2024", "06", "01"), (40, "2024", "06", "03"), (50, "2024", "07", "01")]


def data_files(releases):
    return {p: p.read_bytes() for p in Path(releases.base, "runs").rglob("part-*.parquet")}


def test_a_release_replaces_the_runs_partitions_and_keeps_the_others(spark, releases):
    assert releases.publish(spark, run_of(spark, releases, *FIRST)) == 1
    before = data_files(releases)
    run = run_of(spark, releases, *SECOND)
    assert shown(spark, releases) == [(1, "05", "31"), (2, "06", "01"), (3, "06", "02")]
    assert releases.publish(spark, run, Period.parse("2024-06")) == 2
    assert shown(spark, releases) == [(1, "05", "31"), (3, "06", "02"), (20, "06", "01"), (40, "06", "03")]
    after = data_files(releases)
    assert before.items() <= after.items() and len(after) == len(before) + 3  # the run's own, nothing copied


def test_publishing_reads_no_data_file(spark, releases):
    run = run_of(spark, releases, *FIRST)
    for path in data_files(releases):
        path.write_bytes(b"not parquet")
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    assert releases.publish(spark, run) == 1
    assert len(releases.locations(spark, 1)) == 3


@pytest.mark.parametrize("step", ["manifest", "table", "view"])
def test_an_aborted_publish_leaves_all_old_rows_readable(spark, releases, monkeypatch, step):
    releases.publish(spark, run_of(spark, releases, *FIRST))
    old, run = shown(spark, releases), run_of(spark, releases, *SECOND)

    def fail(*args, **options):
        raise OSError("gone")

    with monkeypatch.context() as broken:
        if step == "manifest":
            broken.setattr("pyspark.sql.DataFrameWriter.parquet", fail)
        elif step == "table":
            broken.setattr("fareloom.sources.releases.add_partitions", fail)
        else:
            whole = type(spark).sql
            broken.setattr(
                type(spark), "sql", lambda s, q, *a, **k: fail() if "REPLACE VIEW" in q else whole(s, q, *a, **k)
            )
        with pytest.raises(OSError):
            releases.publish(spark, run)
    assert shown(spark, releases) == old
    # Before the manifest nothing is published; after it, all of the run is, once the name is pointed to it.
    assert releases.newest(spark) == (1 if step == "manifest" else 2)
    if step == "manifest":
        releases.publish(spark, run)
    else:
        releases.point(spark)
    assert shown(spark, releases) == [(1, "05", "31"), (3, "06", "02"), (20, "06", "01"), (40, "06", "03"), (50, "07", "01")]


def test_going_back_and_unused_runs(spark, releases):
    first, second = run_of(spark, releases, *FIRST), run_of(spark, releases, *SECOND)
    releases.publish(spark, first)
    old = shown(spark, releases)
    releases.publish(spark, second)
    releases.point(spark, 1)
    assert shown(spark, releases) == old
    restated = run_of(spark, releases, *[(9, *row[1:]) for row in [*FIRST, *SECOND]])
    releases.publish(spark, restated)
    assert releases.unused_runs(spark, 1) == sorted([first, second])
    assert releases.unused_runs(spark, 2) == [] == releases.unused_runs(spark, 9)


def test_two_writers_of_one_version_are_found(spark, releases):
    releases.publish(spark, run_of(spark, releases, *FIRST))
    path = f"{releases.base}/releases/version=1"
    spark.createDataFrame([("x", "y", "z")], "partition string, location string, writer string").write.mode("append").parquet(path)
    with pytest.raises(ReleaseConflict):
        releases.point(spark)


def test_values_with_signs_and_an_unknown_version(spark, tmp_path):
    own = Releases("signs_" + tmp_path.name.replace("-", "_"), str(tmp_path), spark.range(1).selectExpr("id", "'' AS place").schema, ["place"])
    data = spark.createDataFrame([(1, "a b/c=d"), (2, "it's"), (3, "100%")], "id long, place string")
    own.publish(spark, own.stage(data))
    assert sorted(rows(spark.table(own.name))) == sorted(rows(data))
    with pytest.raises(ValueError, match="no release 7"):
        own.point(spark, 7)


def test_only_the_partitions_asked_for_are_scanned(spark, releases):
    releases.publish(spark, run_of(spark, releases, *FIRST))
    one = spark.table(releases.name).where("month = '06' AND day = '02'")
    assert rows(one.select("amount")) == [(3,)]
    files = one.select(F.input_file_name()).distinct().collect()
    assert len(files) == 1 and "day=02" in files[0][0]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_monthly_job_publishes_releases(spark, tmp_path, make_trips, june_rates):
    paths = monthly_job.JobPaths(*[str(tmp_path / n) for n in ("bookings", "rates", "staging", "facts", "rejects")])
    month = {"year": F.lit("2024"), "month": F.lit("06")}
    trips = make_trips([("2024-06-01 10:00:00", "2024-06-01 10:20:00", 3.0, 12.0), ("2024-06-02 11:00:00", "2024-06-02 11:30:00", 5.0, 20.0)])
    stage(trips.withColumns(month), paths.bookings, ["year", "month"])
    stage(june_rates.withColumns(month), paths.rates, ["year", "month"])
    name = "job_" + tmp_path.name.replace("-", "_")
    for version in (1, 2):
        result = monthly_job.run(spark, "2024-06", GREEN, paths, release_name=name)
        assert [check["violations"] for check in result.checks] == [0] * len(result.checks)
        assert spark.table(name).columns == FACT_BOOKINGS.fieldNames()
        assert sorted(rows(spark.table(name).select("day", "total_fare"))) == [("01", 12.0), ("02", 20.0)]
        assert Releases(name, paths.facts, FACT_BOOKINGS).newest(spark) == version
