"""Dated exchange rates: one row per source currency and day, and their left join onto facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.operators.asof import asof_join
from fareloom.operators.lookups import attach

_FROM = "__rate_currency"
_DAY = "__rate_day"


def rate_column(currency: str) -> str:
    return f"{currency.lower()}_rate"


def daily_rates(rates: DataFrame, currencies: Sequence[str]) -> DataFrame:
    """Rates turned from one row per target currency into one column per target currency.

    ``exchange_rate_date`` may be text, date or timestamp. A second rate for the same currencies and day fails the
    query that uses it, since it would otherwise repeat facts or pick a rate at random.
    """
    columns: list[Column] = []
    for currency in currencies:
        quoted = F.col("to_currency") == currency
        duplicate = F.concat(
            F.lit(f"more than one {currency} rate for "), F.col("from_currency"), F.lit(" on "), F.col(_DAY)
        )
        columns.append(
            F.when(F.count_if(quoted) > 1, F.raise_error(duplicate).cast("double"))
            .otherwise(F.max(F.when(quoted, F.col("rate"))).cast("double"))
            .alias(rate_column(currency))
        )
    return (
        rates.where(F.col("to_currency").isin(*currencies))
        .withColumn(_DAY, F.col("exchange_rate_date").try_cast("date"))
        .groupBy("from_currency", _DAY)
        .agg(*columns)
        .withColumnsRenamed({"from_currency": _FROM})
    )


def attach_rates(
    facts: DataFrame,
    rates: DataFrame,
    currencies: Sequence[str],
    *,
    currency: str,
    day: Column,
    on_duplicate: str = "error",
    **options,
) -> DataFrame:
    """Add ``gbp_rate``-like columns; facts without a rate keep null.

    ``on_duplicate="error"`` joins once against the pivoted rates. ``on_duplicate="expand"`` repeats a fact for every
    combination of duplicate rates, as separate outer joins on raw rates do.
    """
    keyed = facts.withColumns({_FROM: F.col(currency), _DAY: day.cast("date")})
    if on_duplicate == "error":
        return attach(keyed, daily_rates(rates, currencies), [_FROM, _DAY], "left", **options).drop(_FROM, _DAY)
    if on_duplicate != "expand":
        raise ValueError("on_duplicate is 'error' or 'expand'")
    for target in currencies:
        quoted = rates.where(F.col("to_currency") == target).select(
            F.col("from_currency").alias(_FROM),
            F.col("exchange_rate_date").try_cast("date").alias(_DAY),
            F.col("rate").cast("double").alias(rate_column(target)),
        )
        keyed = attach(keyed, quoted, [_FROM, _DAY], "left", **options)
    return keyed.drop(_FROM, _DAY)


def attach_last_rates(
    facts: DataFrame,
    rates: DataFrame,
    currencies: Sequence[str],
    *,
    currency: str,
    day: Column,
    max_age_days: int | None = None,
    **options,
) -> DataFrame:
    """Like ``attach_rates``, with the last known rate where a day has none, at most ``max_age_days`` old.

    Only the distinct currencies and days of the facts go through the as-of join; its result is an ordinary lookup by
    equality, so the facts stay where they are as long as it is small enough to broadcast.
    """
    keyed = facts.withColumns({_FROM: F.col(currency), _DAY: day.cast("date")})
    asked = keyed.select(_FROM, _DAY).where(F.col(_FROM).isNotNull() & F.col(_DAY).isNotNull()).distinct()
    names = [rate_column(target) for target in currencies]
    quotes = daily_rates(rates, currencies).withColumnRenamed(_DAY, "__quoted")
    last = asof_join(
        asked, quotes, [_FROM], fact_time=_DAY, known_time="__quoted", values=names, within=max_age_days
    )
    return attach(keyed, last, [_FROM, _DAY], "left", **options).drop(_FROM, _DAY)
