"""Table readers and SQL text over DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def parquet_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet scan; the schema comes from the footers unless given."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def csv_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header line and double-quoted fields.

    With a schema the file is read once; without one, types are inferred by an extra pass, which suits small
    dimension files only.
    """
    reader = spark.read.options(header=True, quote='"', escape='"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def rows_table(spark: SparkSession, rows: Iterable[tuple], columns: Sequence[str] | str) -> DataFrame:
    """A few literal rows as a table."""
    return spark.createDataFrame(list(rows), columns)


def register(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` known to SQL text under a session-wide name."""
    df.createOrReplaceTempView(name)
    return df


def sql_table(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """SQL text to DataFrame; ``{name}`` in the text stands for the DataFrame passed as ``name``."""
    return spark.sql(text, **frames)
