"""Partitioned staging and replacement of whole partitions in a published dataset."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from fareloom.session import has_files
from fareloom.sources.periods import Period

DAY_PARTITIONS = ("year", "month", "day")


def balanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Group rows by the given columns for a partitioned write.

    The rebalance hint lets adaptive execution split a value that holds a large share of the rows over many tasks, and
    merge small values into one task, instead of giving every value to exactly one. Without adaptive execution it
    would do just that, so rows then stay where they are, at the price of more files.
    """
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    return df.hint("rebalance", *by) if adaptive else df


def _parts(path: str) -> tuple[str, list[str]]:
    """(scheme and authority, folder names) of a path in normal form; an absent scheme is empty."""
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(.*)", path)
    scheme, authority, rest = found.groups() if found else ("", "", path)
    normal = posixpath.normpath("/" + rest)
    return f"{scheme.lower()}://{authority or ''}" if scheme else "", [part for part in normal.split("/") if part]


def require_apart(paths: Mapping[str, str]) -> None:
    """Raise unless no path equals or lies within another.

    Paths are compared in normal form: doubled and trailing slashes, ``.`` and ``..`` do not hide an overlap. A path
    without a scheme may be in any store, so it is compared with all.
    """
    known = {name: _parts(path) for name, path in paths.items()}
    names = list(known)
    for i, one in enumerate(names):
        for other in names[i + 1 :]:
            (store, folders), (other_store, other_folders) = known[one], known[other]
            shorter = min(len(folders), len(other_folders))
            if (not store or not other_store or store == other_store) and (
                folders[:shorter] == other_folders[:shorter]
            ):
                raise ValueError(f"the paths of {one} and {other} must not be equal or nested")


# Readers skip names that start with an underscore.
STAGING_MARK = "_staged_here"


def require_staging_area(spark: SparkSession, path: str) -> None:
    """Raise if ``path`` holds files that ``stage`` has not written: overwriting it would destroy other data."""
    path = path.rstrip("/")
    if not has_files(spark, f"{path}/{STAGING_MARK}") and has_files(spark, path):
        raise ValueError(f"{path} holds data and is no staging area; it is left as it is")


def stage(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = DAY_PARTITIONS,
    max_records_per_file: int = 0,
    balance: bool = True,
) -> None:
    """Overwrite the staging area ``path`` with ``df``, one directory per partition value.

    A path with files of any other origin is refused before anything is written. Rows are balanced by partition value
    first, unless the caller has done so on narrower rows.
    """
    require_staging_area(df.sparkSession, path)
    rows = balanced(df, partition_by) if balance else df
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)
    mark = df.sparkSession.range(1).selectExpr("'fareloom' AS value").coalesce(1)
    mark.write.mode("overwrite").text(f"{path.rstrip('/')}/{STAGING_MARK}")


def staged_table(spark: SparkSession, path: str, contract: StructType) -> DataFrame:
    """Read staged data back under its contract, so that partition values keep the declared type."""
    return spark.read.schema(contract).parquet(path)


def staged_partitions(df: DataFrame, partition_by: Sequence[str] = DAY_PARTITIONS) -> DataFrame:
    """Distinct partition values; reads no data columns of a partitioned table."""
    return df.select(*partition_by).distinct()


def publish(
    spark: SparkSession,
    staging_path: str,
    main_path: str,
    contract: StructType,
    partition_by: Sequence[str] = DAY_PARTITIONS,
    period: Period | None = None,
    max_records_per_file: int = 0,
) -> None:
    """Replace in ``main_path`` the partitions present in staging; leave every other partition as it is.

    With a period only that month's partitions are replaced, so a few stray rows cannot wipe out a day of another
    month. Without one, every staged partition is. Staged files already hold one partition value each, so this is a
    map-only copy done by the executors, without a shuffle. A run that fails before its commit leaves the main
    path's partitions untouched, and running it again gives the same result.
    """
    require_apart({"staging": staging_path, "main": main_path})
    rows = staged_table(spark, staging_path, contract)
    if period:
        rows = rows.where(period.contains())
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(main_path)


def compact_export(df: DataFrame, path: str, files: int = 1) -> None:
    """Write an aggregated result as a fixed number of Parquet files.

    Coalescing narrows the last stage to ``files`` tasks, so the input must already be small: a grouped or limited
    result, not a fact table.
    """
    df.coalesce(files).write.mode("overwrite").parquet(path)
