"""IPv4 text validity as a native expression."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareloom.functions.temporal import ColumnLike, as_column

# Leading zeros of any number, then a value of at most 255. \A and \z anchor the whole text: $ would let a final
# newline through.
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
IPV4_PATTERN = rf"\A{OCTET}(?:\.{OCTET}){{3}}\z"


@cache
def foreign_digits() -> tuple[str, str]:
    """Decimal digits of other scripts and the ASCII digits of the same value, generated from Unicode."""
    digits = [
        char for char in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(char) == "Nd"
    ]
    return "".join(digits), "".join(str(unicodedata.decimal(char)) for char in digits)


def is_ipv4(text: ColumnLike) -> Column:
    """True for four dot-separated decimal numbers from 0 to 255; false for anything else and for null.

    Digits of other scripts count as digits. They are translated only for text that is not plain ASCII, so ordinary
    rows cost one regular expression.
    """
    text = as_column(text)
    foreign, plain = foreign_digits()
    translated = text.rlike(r"[^\x00-\x7F]") & F.translate(text, foreign, plain).rlike(IPV4_PATTERN)
    return F.coalesce(text.rlike(IPV4_PATTERN) | translated, F.lit(False))
