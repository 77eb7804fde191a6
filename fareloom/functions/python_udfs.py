"""Arrow-transferred Python versions of two native expressions.

They exist for callers who want the UDF form; every plan in this package uses the native expression. The functions are
local to their factories so that they travel to the workers by value.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from fareloom.functions.measures import MIN_MILES, MIN_SECONDS
from fareloom.functions.network import OCTET, foreign_digits


def miles_per_minute_udf():
    """``(miles double, seconds double) -> double`` on whole Arrow batches."""
    seconds_limit, miles_limit = MIN_SECONDS, MIN_MILES

    def efficiency(miles: pd.Series, seconds: pd.Series) -> pd.Series:
        usable = (seconds > seconds_limit) & (miles > miles_limit)
        return (miles / (seconds / 60)).where(usable)

    return F.pandas_udf(efficiency, "double")


def is_ipv4_udf():
    """``(text string) -> boolean`` on whole Arrow batches, null counting as false."""
    foreign, plain = foreign_digits()
    digits = str.maketrans(foreign, plain)
    address = rf"{OCTET}(?:\.{OCTET}){{3}}"

    def check(text: pd.Series) -> pd.Series:
        text = text.astype(object)
        ascii_only = text.str.fullmatch(r"[\x00-\x7F]*", na=True).astype(bool)
        if not ascii_only.all():
            text = text.where(ascii_only, text.str.translate(digits))
        return text.str.fullmatch(address, na=False).astype(bool)

    return F.pandas_udf(check, "boolean")
