"""Great-circle distances as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
EARTH_RADIUS_KM = 6371.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _hav_a(lat1, lon1, lat2, lon2) -> Column:
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dl = F.radians(_c(lon2)) - F.radians(_c(lon1))
    return F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Metres, arcsin form, radius 6,371,000."""
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(_hav_a(lat1, lon1, lat2, lon2)))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Kilometres, atan2 form, radius 6371."""
    a = _hav_a(lat1, lon1, lat2, lon2)
    return F.lit(EARTH_RADIUS_KM) * F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


HAV_M_SQL = ("2 * 6371000.0 * asin(sqrt(pow(sin((radians({la2}) - radians({la1})) / 2), 2) + "
             "cos(radians({la1})) * cos(radians({la2})) * pow(sin((radians({lo2}) - radians({lo1})) / 2), 2)))")


def hav_m_sql(la1, lo1, la2, lo2) -> str:
    """DuckDB text of :func:`haversine_m` (oracle side)."""
    return HAV_M_SQL.format(la1=la1, lo1=lo1, la2=la2, lo2=lo2)
