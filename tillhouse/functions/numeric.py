"""Money and ratios.

Sums stay decimal, so they do not depend on task order. A quotient is taken as a double and
rounded through decimal(28,10), which restores exact halves before the half-up rounding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
# A price times a weighed quantity, still within one machine word.
LINE = "decimal(18,6)"
_WIDE = "decimal(28,10)"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def rounded(value: Column | str, places: int) -> Column:
    return F.round(_col(value).cast(_WIDE), places)


def money(value: Column | str) -> Column:
    """A floating amount as currency with two significant places."""
    return rounded(value, 2).cast(MONEY)


def divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as a double; NULL when the denominator is zero."""
    return _col(numerator).cast("double") / F.nullif(_col(denominator).cast("double"), F.lit(0.0))


def ratio(numerator: Column | str, denominator: Column | str, places: int) -> Column:
    return rounded(divide(numerator, denominator), places)


def percent(numerator: Column | str, denominator: Column | str, places: int) -> Column:
    return rounded(divide(numerator, denominator) * 100, places)


def mean(value: Column | str) -> Column:
    """Aggregate mean from an exact sum."""
    return divide(F.sum(_col(value)), F.count(_col(value)))
