"""Declared columns out of JSON text, and its items as rows; text that doesn't fit is told apart, never lost.

Text is parsed once into a variant, inside Spark.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NOT_JSON = "not JSON"


def with_fields(
    df: DataFrame, column: str, fields: Mapping[str, tuple[str, str]], problem: str = "problem"
) -> DataFrame:
    """Adds a column per field, each a path (``$.a.b[0]``) and a type, and why a row doesn't fit (null if it does).

    A missing path or a JSON null gives null and is no problem, nor is a null text. A value that can't be cast gives null
    and ``<field> is no <type>``, for the first such field. Rows with a problem keep their text, for a reject path.
    """
    clash = sorted({problem, *fields} & set(df.columns))
    if clash:
        raise ValueError(f"the rows have columns {clash}")
    whole, text = f"{problem} parsed", F.col(f"`{column}`")
    parsed = df.withColumn(whole, F.try_parse_json(text))
    found = {name: F.try_variant_get(F.col(f"`{whole}`"), path, kind) for name, (path, kind) in fields.items()}
    why = F.when(text.isNotNull() & F.col(f"`{whole}`").isNull(), NOT_JSON)
    for name, (path, kind) in fields.items():
        given = F.try_variant_get(F.col(f"`{whole}`"), path, "variant")
        why = why.when(given.isNotNull() & ~F.is_variant_null(given) & found[name].isNull(), f"{name} is no {kind}")
    return parsed.select(*[F.col(f"`{c}`") for c in df.columns], *[c.alias(n) for n, c in found.items()], why.alias(problem))


def items(df: DataFrame, column: str, prefix: str = "item") -> DataFrame:
    """One row per member of the JSON object or array in ``column``: ``<prefix>_place``, ``_key`` (null in arrays),
    ``_value`` (JSON text). Text without members, or that is no JSON, gives no row."""
    whole = f"{prefix} parsed"
    parsed = df.withColumn(whole, F.try_parse_json(F.col(f"`{column}`")))
    members = df.sparkSession.tvf.variant_explode(F.col(f"`{whole}`").outer())
    return parsed.lateralJoin(members).select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("pos").alias(f"{prefix}_place"),
        F.col("key").alias(f"{prefix}_key"),
        F.to_json("value").alias(f"{prefix}_value"),
    )
