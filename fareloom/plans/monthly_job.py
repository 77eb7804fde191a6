"""The monthly fact job: build, stage, check, publish.

    spark-submit --py-files fareloom.zip fareloom/plans/monthly_job.py --date_str 2024-06 --dialect green \
        --bookings … --rates … --staging … --facts … --rejects …
"""

from __future__ import annotations

import argparse
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from fareloom.operators.contracts import SchemaFinding, schema_findings
from fareloom.operators.quality import check_counts, counted_checks, pass_or_raise
from fareloom.plans.dialects import DIALECTS, Dialect
from fareloom.plans.fact_bookings import FACT_CHECKS, fact_bookings
from fareloom.plans.tables import FACT_BOOKINGS
from fareloom.session import open_session
from fareloom.sources.periods import Period, period_scan
from fareloom.sources.publishing import DAY_PARTITIONS, balanced, publish, require_apart, stage, staged_table
from fareloom.sources.releases import Releases

logger = logging.getLogger(__name__)

_BOOKING_DAY = "__booking_day"
_LEVELS = {"error": logging.ERROR, "data": logging.INFO, "info": logging.INFO}

# Optional cap on rows per written file. 0 leaves file sizes to the rebalanced write, which suits large months; a month
# of a small table is usually written with 200000.
MAX_RECORDS_PER_FILE = 0


class ContractError(Exception):
    """The built table lacks a contract column or has it with another type."""


class StrayRowsError(Exception):
    """The month's files hold rows of other days and there is no path to keep them in."""


@dataclass(frozen=True)
class JobPaths:
    """Base paths: raw bookings and rates by month, the staging area, the fact table, and rows of other months.

    No two of them may be equal or nested: the job overwrites below some of them.
    """

    bookings: str
    rates: str
    staging: str
    facts: str
    rejects: str | None = None

    def __post_init__(self) -> None:
        require_apart({name: path for name, path in vars(self).items() if path})

    def staging_of(self, dialect: Dialect, period: Period) -> str:
        """Each month of each dialect is staged apart, so that runs side by side do not meet."""
        return f"{self.staging.rstrip('/')}/{dialect.name}/{period}"

    def rejects_of(self, dialect: Dialect, period: Period) -> str | None:
        return self.rejects and f"{self.rejects.rstrip('/')}/dialect={dialect.name}/period={period}"


@dataclass(frozen=True)
class StagedMonth:
    """A month in staging, with what was counted on the way there."""

    path: str
    table: DataFrame
    findings: list[SchemaFinding]
    checks: list[Row]
    stray_rows: int


@dataclass(frozen=True)
class JobResult:
    checks: list[Row]
    findings: list[SchemaFinding]
    stray_rows: int


def transform(
    spark: SparkSession,
    period: Period,
    dialect: Dialect,
    paths: JobPaths,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    staging_path: str | None = None,
) -> StagedMonth:
    """Build one month and write it to staging, counting checks and stray rows in the same pass.

    The one shuffle, which groups rows by day for the write, moves the raw columns rather than the nearly twice as many
    fact columns; building the facts and joining the rates leave rows where they are.
    """
    raw = period_scan(spark, paths.bookings, period).select(*dialect.columns())
    by_day = balanced(raw.withColumn(_BOOKING_DAY, F.to_date(dialect.requested)), [_BOOKING_DAY])
    facts = fact_bookings(by_day, period_scan(spark, paths.rates, period), dialect)
    findings = schema_findings(facts.schema, FACT_BOOKINGS)
    for finding in findings:
        logger.log(_LEVELS[finding.severity], "contract (%s): %s", finding.severity, finding)
    errors = [finding for finding in findings if finding.severity == "error"]
    if errors:
        raise ContractError(f"built table does not fit its contract: {errors}")
    path, counts = staging_path or paths.staging_of(dialect, period), Observation()
    # A row without a booking day belongs to no period.
    stray = F.count_if(~F.coalesce(period.contains(), F.lit(False))).alias("stray_rows")
    stage(facts.observe(counts, stray, *check_counts(FACT_CHECKS)), path, DAY_PARTITIONS, max_records_per_file, balance=False)
    found = counts.get
    return StagedMonth(
        path,
        staged_table(spark, path, FACT_BOOKINGS),
        findings,
        counted_checks(found, FACT_CHECKS),
        found["stray_rows"],
    )


def load(
    spark: SparkSession,
    staged: StagedMonth,
    period: Period,
    dialect: Dialect,
    paths: JobPaths,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    releases: Releases | None = None,
) -> tuple[list[Row], int]:
    """Publish the month if no blocking check fails; otherwise raise and leave the fact table as it is.

    With ``releases`` the staged files themselves become the month's partitions, all days at once.

    Rows that belong to other months (a month's raw files can hold some) never replace published days. They are
    written to the rejects path first; without one the load raises, so that no row is lost unseen.
    """
    checks = pass_or_raise(staged.checks)
    if staged.stray_rows:
        rejects = paths.rejects_of(dialect, period)
        if not rejects:
            raise StrayRowsError(f"{staged.stray_rows} rows are outside {period}: give a rejects path to keep them in")
        logger.warning("%d staged rows are outside %s and go to %s", staged.stray_rows, period, rejects)
        inside = F.coalesce(period.contains(), F.lit(False))
        staged.table.where(~inside).write.mode("overwrite").parquet(rejects)
    if releases:
        releases.publish(spark, staged.path, period)
    else:
        publish(spark, staged.path, paths.facts, FACT_BOOKINGS, DAY_PARTITIONS, period, max_records_per_file)
    return checks, staged.stray_rows


def run(
    spark: SparkSession,
    date_str: str,
    dialect: Dialect,
    paths: JobPaths,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    release_name: str | None = None,
) -> JobResult:
    """Transform and load one month. Every failure is raised.

    With ``release_name`` the facts path holds releases, and that name shows the newest one in the catalog.
    """
    period = Period.parse(date_str)
    releases = Releases(release_name, paths.facts, FACT_BOOKINGS, DAY_PARTITIONS) if release_name else None
    run_path = releases.new_run() if releases else None
    staged = transform(spark, period, dialect, paths, max_records_per_file, run_path)
    checks, stray_rows = load(spark, staged, period, dialect, paths, max_records_per_file, releases)
    logger.info("published %s", period)
    return JobResult(checks, staged.findings, stray_rows)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build and publish one month of the booking fact table")
    parser.add_argument("--date_str", required=True, help="month as YYYY-MM")
    parser.add_argument("--dialect", required=True, choices=sorted(DIALECTS))
    for name in ("bookings", "rates", "staging", "facts"):
        parser.add_argument(f"--{name}", required=True, help=f"base path of {name}")
    parser.add_argument("--rejects", help="base path for rows of other months")
    parser.add_argument("--release_name", help="catalog name; the facts path then holds atomic releases")
    parser.add_argument("--max_records_per_file", type=int, default=MAX_RECORDS_PER_FILE)
    options = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO)
    paths = JobPaths(options.bookings, options.rates, options.staging, options.facts, options.rejects)
    spark = open_session("booking facts")
    try:
        run(
            spark, options.date_str, DIALECTS[options.dialect], paths, options.max_records_per_file, options.release_name
        )
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
