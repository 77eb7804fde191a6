"""EXISTS, IN and their negations against a table of any size, with SQL's answers for nulls.

Spark plans a single NOT IN as a null-aware anti join that always broadcasts the list, and a correlated one with several
columns as a nested loop. Here a list is reduced to its distinct entries and one row per group first, and all joins are
equal joins, so Catalyst may broadcast or shuffle either side and a hot key of the list is one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all(conditions: list[Column]) -> Column:
    found = F.lit(True)
    for condition in conditions:
        found = found & condition
    return found


def rows_by_existence(
    df: DataFrame, others: DataFrame, on: Mapping[str, str], *, exists: bool = True, null_safe: bool = False
) -> DataFrame:
    """Rows with (or without) a row of ``others`` that has the same keys; ``on`` maps own columns to theirs.

    A null key matches nothing, as in EXISTS, unless ``null_safe`` lets it match null, as in INTERSECT and EXCEPT.
    """
    if not on:
        raise ValueError("name at least one pair of columns")
    names = [f"other key {k}" for k in range(len(on))]
    keys = others.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(on.values(), names, strict=True)])
    if not null_safe:
        keys = keys.dropna()
    pairs = [(F.col(f"`{own}`"), F.col(f"`{n}`")) for own, n in zip(on, names, strict=True)]
    same = _all([a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])
    return df.join(keys.distinct(), same, "left_semi" if exists else "left_anti")


def with_membership(
    df: DataFrame,
    others: DataFrame,
    value: str,
    other_value: str,
    on: Mapping[str, str] | None = None,
    name: str = "found",
) -> DataFrame:
    """Adds the boolean ``value IN (SELECT other_value FROM others WHERE <on>)``, null where SQL can't tell.

    False for an empty list, whatever the value; else null for a null value, true for a match, null if the list holds
    a null, and false. NOT IN keeps the rows with false. A null among the ``on`` columns has an empty list.
    """
    if name in df.columns:
        raise ValueError(f"the rows have a column {name}")
    on = on or {}
    keys = [f"{name} key {k}" for k in range(len(on))]
    entry, hit, nulls = f"{name} entry", f"{name} hit", f"{name} nulls"
    listed = others.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(on.values(), keys, strict=True)], F.col(f"`{other_value}`").alias(entry)
    )
    if keys:
        listed = listed.dropna(subset=keys)
    same = _all([F.col(f"`{own}`") == F.col(f"`{k}`") for own, k in zip(on, keys, strict=True)])
    own = F.col(f"`{value}`")
    members = listed.where(F.col(entry).isNotNull()).distinct().withColumn(hit, F.lit(True))
    joined = df.join(members, (own == F.col(f"`{entry}`")) & same, "left").drop(*keys)
    if keys:
        groups = listed.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.max(F.col(entry).isNull()).alias(nulls))
        joined = joined.join(groups, same, "left").drop(*keys)
    else:
        # A list for all rows has one answer: null if it is empty, else whether it holds a null.
        joined = joined.withColumn(nulls, F.lit(listed.agg(F.max(F.col(entry).isNull())).first()[0]).cast("boolean"))
    answer = (
        F.when(F.col(nulls).isNull(), False)
        .when(F.col(hit), True)
        .when(own.isNull() | F.col(nulls), F.lit(None).cast("boolean"))
        .otherwise(False)
    )
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], answer.alias(name))
