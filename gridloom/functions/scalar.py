"""Scalar functions as column expressions. Missing values are NULL; a denominator of zero gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalised_difference(a: Column, b: Column) -> Column:
    """(a - b) / (a + b)."""
    return F.try_divide(a - b, a + b)


def kernel_ndvi(nir: Column, red: Column) -> Column:
    """tanh of the squared normalised difference."""
    return F.tanh(F.pow(normalised_difference(nir, red), 2))


def saturation_pressure(celsius: Column) -> Column:
    """Saturation vapour pressure in hPa (Clausius-Clapeyron)."""
    return 6.11 * F.exp(F.lit(2500000 / 461) * (F.lit(1 / 273) - F.try_divide(F.lit(1.0), 273 + celsius)))


def vpd_from_humidity(relative: Column, celsius: Column) -> Column:
    return (100 - relative) / 100 * saturation_pressure(celsius)


def vpd_from_pressure(pressure: Column, celsius: Column) -> Column:
    return saturation_pressure(celsius) - pressure


def blended_temperature(low: Column, high: Column, k: Column) -> Column:
    return low + k * (high - low)


def kelvin_to_celsius(c: Column) -> Column:
    return c - 273.15


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limits that leave NULL alone, which greatest() and least() would not."""
    if low is not None:
        c = F.when(c < low, F.lit(low)).otherwise(c)
    return F.when(c > high, F.lit(high)).otherwise(c) if high is not None else c


def finite_or(c: Column, value: float | None) -> Column:
    """NULL, NaN and infinities replaced."""
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.when(bad, F.lit(value).cast("double")).otherwise(c)


def days_in_month(t: Column) -> Column:
    return F.dayofmonth(F.last_day(t))


def days_since(t: Column, origin: str = "1970-01-01") -> Column:
    return F.datediff(t.cast("date"), F.lit(origin).cast("date"))


def strip_suffix(c: Column, *suffixes: str) -> Column:
    return F.regexp_replace(c, "(" + "|".join(suffixes) + ")$", "")


def number_with_unit(c: Column) -> Column:
    """'12.5m' as 12.5; NULL if it is no number."""
    return c.substr(F.lit(1), F.length(c) - 1).try_cast("double")


def looked_up(c: Column, table: dict, default=None) -> Column:
    """The entry of a fixed table for a key, as a map literal."""
    found = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))[c]
    return found if default is None else F.coalesce(found, F.lit(default))


def without_end(c: Column, n: int) -> Column:
    """All but the last n characters."""
    return F.substr(c, F.lit(1), F.greatest(F.length(c) - n, F.lit(0)))


def from_end(c: Column, first: int, last: int) -> Column:
    """The characters from the first-last to the last-last one, the latter left out (as in the slice ``[-first:-last]``)."""
    start = F.greatest(F.length(c) - first, F.lit(0))
    return F.substr(c, start + 1, F.greatest(F.length(c) - last - start, F.lit(0)))
