"""Value rules: code maps, unit conversion, rounding and null defaults."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def map_codes(c: Column, names: Mapping[int, str]) -> Column:
    """Look a code up in a small constant table; unknown codes become null."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.create_map(*pairs)[c]


def round_half_even(c: Column, digits: int) -> Column:
    """Round a double to ``digits`` the way IEEE ``rint`` does.

    ``round`` works on the decimal text of the double and rounds ties up, so it
    differs from this on values such as 230.665.
    """
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def milliseconds_to_seconds(c: Column) -> Column:
    return round_half_even(c / F.lit(1000), 2)


def default(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def truthy(c: Column) -> Column:
    """Boolean in which a missing value counts as true."""
    return F.coalesce(c.cast("boolean"), F.lit(True))


def null_if(c: Column, value) -> Column:
    return F.nullif(c, F.lit(value))


def not_value(c: Column, value) -> Column:
    """``c != value`` that keeps rows in which ``c`` is null."""
    return ~c.eqNullSafe(F.lit(value))


def ignore_nan(c: Column) -> Column:
    """Treat NaN as missing, as column statistics do."""
    return F.when(~F.isnan(c), c)


def outside(c: Column, low, high) -> Column:
    """True where the value lies outside the range; a null is no violation."""
    return F.coalesce(~c.between(low, high), F.lit(False))
