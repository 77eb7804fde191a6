"""Named row checks counted in one pass, and the gate that reads the counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A predicate that is true for bad rows. Checks that do not block are reported only."""

    name: str
    bad_when: str
    blocking: bool = True


class QualityError(Exception):
    """At least one blocking check counted a violation; ``failures`` maps check names to counts, ``rows`` is the
    whole report."""

    def __init__(self, failures: dict[str, int], rows: Sequence[Row] = ()):
        self.failures = failures
        self.rows = list(rows)
        listed = ", ".join(f"{name}: {count}" for name, count in failures.items())
        super().__init__(f"data quality checks failed ({listed})")


def quality_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check with its number of violations; a single scan whatever the number of checks."""
    counts = df.agg(*[F.count_if(F.expr(check.bad_when)).alias(f"c{i}") for i, check in enumerate(checks)])
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(check.name).alias("check_name"),
                        F.col(f"c{i}").alias("violations"),
                        F.lit(check.blocking).alias("blocking"),
                    )
                    for i, check in enumerate(checks)
                ]
            )
        )
    )


def check_counts(checks: Sequence[Check]) -> list[Column]:
    """Aggregates that count the violations of each check, for use in an observation of rows on their way elsewhere."""
    return [F.count_if(F.expr(check.bad_when)).alias(f"check_{i}") for i, check in enumerate(checks)]


def counted_checks(counts: Mapping[str, int], checks: Sequence[Check]) -> list[Row]:
    """Report rows from the counts of ``check_counts``."""
    named = Row("check_name", "violations", "blocking")
    return [named(check.name, counts[f"check_{i}"], check.blocking) for i, check in enumerate(checks)]


def pass_or_raise(rows: list[Row]) -> list[Row]:
    """The report rows, or an error that names all blocking checks that failed."""
    failures = {row.check_name: row.violations for row in rows if row.blocking and row.violations}
    if failures:
        raise QualityError(failures, rows)
    return rows


def require_quality(df: DataFrame, checks: Sequence[Check]) -> list[Row]:
    """Run the report and raise if a blocking check failed, naming all that did. Returns the report rows."""
    return pass_or_raise(quality_report(df, checks).collect())
