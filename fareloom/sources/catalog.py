"""External tables over published paths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)


def create_fact_table(
    spark: SparkSession, name: str, contract: StructType, partition_by: Sequence[str], location: str
) -> None:
    """External Parquet table with string-typed directory partitions."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_columns(contract)}) USING parquet "
        f"PARTITIONED BY ({', '.join(partition_by)}) LOCATION {_text(location)}"
    )


def create_csv_table(spark: SparkSession, name: str, schema: StructType, location: str) -> None:
    """External CSV table; columns bind by position, so they may be named differently from the header."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_columns(schema)}) USING csv "
        "OPTIONS (header 'true', sep ',', quote '\"', escape '\"', enforceSchema 'true') "
        f"LOCATION {_text(location)}"
    )


def add_partition(
    spark: SparkSession, table: str, values: Mapping[str, str], location: str | None = None
) -> None:
    """Register one partition; registering it again changes nothing."""
    spec = ", ".join(f"{column}={_text(value)}" for column, value in values.items())
    where = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}){where}")


def add_partitions(
    spark: SparkSession, table: str, partitions: Sequence[tuple[Mapping[str, str], str]], batch: int = 500
) -> None:
    """Register many partitions with their locations, so many per statement; those that are there stay as they are."""
    for k in range(0, len(partitions), batch):
        added = [
            f"PARTITION ({', '.join(f'{c}={_text(v)}' for c, v in values.items())}) LOCATION {_text(location)}"
            for values, location in partitions[k : k + batch]
        ]
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(added)}")


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Register every partition directory found below the table's location."""
    spark.catalog.recoverPartitions(table)


def partition_rows(
    spark: SparkSession,
    table: str,
    values: Mapping[str, str],
    limit: int | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """All columns of one partition, optionally only the first ``limit`` rows of an order."""
    rows = spark.table(table)
    for column, value in values.items():
        rows = rows.where(rows[column] == value)
    if order_by:
        rows = rows.orderBy(*order_by)
    return rows if limit is None else rows.limit(limit)
