"""Month periods and scans limited to one of them."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Period:
    """One calendar month, kept as the zero-padded text used in directory names."""

    year: str
    month: str

    @classmethod
    def parse(cls, text: str) -> "Period":
        match = re.fullmatch(r"([0-9]{4})-(0[1-9]|1[0-2])", text)
        if not match:
            raise ValueError(f"expected a period like 2024-06, got {text!r}")
        return cls(*match.groups())

    def __str__(self) -> str:
        return f"{self.year}-{self.month}"

    @property
    def directory(self) -> str:
        return f"year={self.year}/month={self.month}"

    def contains(self, year: str = "year", month: str = "month") -> Column:
        """Predicate on partition columns; compares numbers, so ``'06'`` and ``6`` are the same month."""
        return (F.col(year).cast("int") == int(self.year)) & (F.col(month).cast("int") == int(self.month))


def period_scan(spark: SparkSession, base: str, period: Period, keep_partitions: bool = False) -> DataFrame:
    """Rows of one month of a Parquet dataset laid out as ``year=…/month=…``.

    Only the month's directory is listed, so planning does not grow with the history kept next to it. The base path
    keeps ``year`` and ``month`` known as partition columns for the filter; they are not part of the result unless
    asked for.
    """
    base = base.rstrip("/")
    scan = spark.read.option("basePath", base).parquet(f"{base}/{period.directory}").where(period.contains())
    return scan if keep_partitions else scan.drop("year", "month")
