"""Weather expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _num0(x) -> Column:
    """Numeric value with unparsable / missing counted as 0."""
    return F.coalesce(_c(x).cast("string").try_cast("double"), F.lit(0.0))


def rain_flag(rain) -> Column:
    return (_num0(rain) > 0).cast("int")


def snow_flag(snow, rain=None, either: bool = False) -> Column:
    """2024 rule: snow only; 2025 / single-station rule: rain or snow (2.X.16)."""
    if either and rain is not None:
        return ((_num0(snow) > 0) | (_num0(rain) > 0)).cast("int")
    return (_num0(snow) > 0).cast("int")


def discomfort_index(temp, humidity) -> Column:
    """``0.81*T + 0.01*H*(0.99*T - 14.3) + 46.3``."""
    t, h = _c(temp), _c(humidity)
    return F.lit(0.81) * t + F.lit(0.01) * h * (F.lit(0.99) * t - F.lit(14.3)) + F.lit(46.3)


def rain_log1p(rain) -> Column:
    return F.log1p(_num0(rain))
