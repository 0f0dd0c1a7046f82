"""Scalar time and calendar expressions.

Every function returns a ``Column`` built from built-in Spark functions, so it
stays inside whole-stage code generation. Timestamps are ``timestamp_ntz``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trunc(unit: str, ts) -> Column:
    """``date_trunc`` that stays ``timestamp_ntz`` (Spark returns a zoned value;
    the session zone is UTC, so the cast back is the identity on wall time)."""
    return F.date_trunc(unit, _c(ts)).cast("timestamp_ntz")


def window_start(ts, duration: str, start: str | None = None) -> Column:
    """Start of the tumbling window holding ``ts``, as ``timestamp_ntz``."""
    return F.window(_c(ts), duration, startTime=start).start.cast("timestamp_ntz")


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_seconds(ts) -> Column:
    return F.timestamp_diff("MICROSECOND", _epoch(), _c(ts)) / 1e6


def from_epoch_seconds(x) -> Column:
    return F.timestamp_add("MICROSECOND", F.round(_c(x) * 1e6).cast("bigint"), _epoch())


# P1 --------------------------------------------------------------------------
def ts_from_date_hour(date, hour) -> Column:
    """``ts = date + hour`` on timestamp_ntz."""
    return F.to_timestamp_ntz(_c(date).cast("string")) + F.make_dt_interval(hours=_c(hour))


# P2 --------------------------------------------------------------------------
def parse_yyyymmdd(x) -> Column:
    """``YYYYMMDD`` number or text to date; ``.0`` stripped; bad values to null."""
    s = F.regexp_replace(_c(x).cast("string"), r"\.0+$", "")
    return F.to_date(F.try_to_timestamp(F.lpad(s, 8, "0"), F.lit("yyyyMMdd")))


def parse_date_hhmm(date, hhmm) -> Column:
    """``YYYYMMDD`` + ``HHMM`` float text (``1735.0``) to timestamp_ntz; bad to null."""
    d = F.regexp_replace(_c(date).cast("string"), r"\.0+$", "")
    t = F.regexp_replace(_c(hhmm).cast("string"), r"\.0+$", "")
    txt = F.concat(F.lpad(d, 8, "0"), F.lpad(t, 4, "0"))
    return F.to_timestamp_ntz(F.try_to_timestamp(txt, F.lit("yyyyMMddHHmm")))


# P3 --------------------------------------------------------------------------
def hhmm_hour(x) -> Column:
    return F.floor(_c(x) / 100).cast("int")


def hhmm_minute(x) -> Column:
    return F.pmod(F.floor(_c(x)).cast("bigint"), F.lit(100)).cast("int")


def add_minutes(ts, minutes, sign: int = 1) -> Column:
    """``ts + minutes`` (fractional minutes kept to the microsecond)."""
    micros = F.round(_c(minutes) * F.lit(60_000_000.0)).cast("bigint") * F.lit(sign)
    return F.timestamp_add("MICROSECOND", micros, _c(ts))


# P4 --------------------------------------------------------------------------
def departure_ts(ts, basis, minutes, arrival_value: str = "arr") -> Column:
    """Arrival rows move back by the trip minutes; departure rows stay."""
    return F.when(_c(basis) == arrival_value, add_minutes(ts, minutes, -1)).otherwise(_c(ts))


# P5 --------------------------------------------------------------------------
def end_hour_raw(hour, minutes) -> Column:
    return F.floor(_c(hour) - _c(minutes) / 60)


def end_day_shift(hour, minutes) -> Column:
    return F.floor(end_hour_raw(hour, minutes) / 24).cast("int")


def end_hour(hour, minutes) -> Column:
    raw = end_hour_raw(hour, minutes)
    return (raw - F.floor(raw / 24) * 24).cast("int")


# P6 --------------------------------------------------------------------------
def arrival_hour(dep_ts, minutes) -> Column:
    """Arrival time floored to the hour: ``dep + minutes``."""
    return trunc("hour", add_minutes(dep_ts, minutes))


# P7 --------------------------------------------------------------------------
def shift_minutes(ts_a, ts_b) -> Column:
    return F.timestamp_diff("SECOND", _c(ts_b), _c(ts_a)) / 60.0


# P8 --------------------------------------------------------------------------
def weekday0(d) -> Column:
    """Weekday with Monday = 0 (pandas ``dayofweek``)."""
    return F.weekday(_c(d))


def date_parts(ts) -> dict[str, Column]:
    t = _c(ts)
    return {"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t),
            "hour": F.hour(t), "minute": F.minute(t), "weekday": F.weekday(t),
            "dayofyear": F.dayofyear(t), "week": F.weekofyear(t)}


# P9 --------------------------------------------------------------------------
def iso_year_week(d) -> Column:
    """``YYYY-WW`` ISO label (2024-12-30 -> ``2025-01``)."""
    y = F.date_part(F.lit("YEAROFWEEK"), _c(d))
    return F.concat(y.cast("string"), F.lit("-"), F.lpad(F.weekofyear(_c(d)).cast("string"), 2, "0"))


# P10 -------------------------------------------------------------------------
def week_of_month(d) -> Column:
    return (F.floor((F.dayofmonth(_c(d)) - 1) / 7) + 1).cast("int")


def year_month_label(d) -> Column:
    return F.date_format(_c(d), "yyyy-MM")


# P11 -------------------------------------------------------------------------
def floor_hours(ts, hours: int) -> Column:
    """Floor to an n-hour block counted from midnight."""
    if hours == 1:
        return trunc("hour", ts)
    return window_start(ts, f"{hours} hours")


def floor_day(ts) -> Column:
    return trunc("day", ts)


# P12 / P13 -------------------------------------------------------------------
def cyclic(x, period: float, zero_based_shift: float = 0.0) -> tuple[Column, Column]:
    """``sin/cos(2*pi*(x-shift)/period)``."""
    ang = F.lit(2 * math.pi) * (_c(x) - F.lit(zero_based_shift)) / F.lit(float(period))
    return F.sin(ang), F.cos(ang)


# P14 -------------------------------------------------------------------------
def weekday_one_hot(d, prefix: str = "dow_") -> dict[str, Column]:
    wd = F.weekday(_c(d))
    return {f"{prefix}{i}": (wd == i).cast("int") for i in range(7)}


# P15 -------------------------------------------------------------------------
def one_hot(col, categories: list, prefix: str) -> dict[str, Column]:
    """One column per category of the training set; unseen values get all zeros."""
    return {f"{prefix}{v}": F.coalesce((_c(col) == F.lit(v)).cast("int"), F.lit(0))
            for v in categories}


# P16 -------------------------------------------------------------------------
def weekend_flag(d) -> Column:
    return (F.weekday(_c(d)) >= 5).cast("int")


# P17 / P18 -------------------------------------------------------------------
def hour_in(hour, hours) -> Column:
    return _c(hour).isin(list(hours)).cast("int")


def hour_between(hour, lo: int, hi: int) -> Column:
    return _c(hour).between(lo, hi).cast("int")


# P19 -------------------------------------------------------------------------
def time_group(hour) -> Column:
    """7-9 -> 1, 18-20 -> 2, 0-5 -> 3, else 0."""
    h = _c(hour)
    return (F.when(h.between(7, 9), 1).when(h.between(18, 20), 2)
             .when(h.between(0, 5), 3).otherwise(0))


# P20 -------------------------------------------------------------------------
def season(month) -> Column:
    return F.floor((F.pmod(_c(month), F.lit(12)) + 3) / 3).cast("int")


# Korean weekday names, Monday first.
WEEKDAY_NAMES_KO = ["월", "화", "수", "목", "금", "토", "일"]


def weekday_name_ko(d) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES_KO]), F.weekday(_c(d)) + 1)


# P24 -------------------------------------------------------------------------
def interactions(hour, workday, temp, hour_sin, rain, rush) -> dict[str, Column]:
    return {
        "hour_x_workday": _c(hour) * _c(workday),
        "hour_x_weekend": _c(hour) * (F.lit(1) - _c(workday)),
        "rain_x_rush": _c(rain) * _c(rush),
        "temp_x_hour_sin": _c(temp) * _c(hour_sin),
        "temp_sq": _c(temp) * _c(temp),
    }


# P25 / P26 -------------------------------------------------------------------
def signed_log1p(x) -> Column:
    return F.signum(_c(x)) * F.log1p(F.abs(_c(x)))


def clip(x, lo=None, hi=None) -> Column:
    out = _c(x)
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi) if not isinstance(hi, (Column, str)) else _c(hi))
    return out


# P27 / P28 -------------------------------------------------------------------
def safe_ratio(a, b, fill: float = 0.0) -> Column:
    """Zero denominator and non-finite results to ``fill``."""
    r = F.try_divide(_c(a), F.nullif(_c(b), F.lit(0)))
    r = F.when(F.isnan(r) | (F.abs(r) == F.lit(float("inf"))), F.lit(None)).otherwise(r)
    return F.coalesce(r, F.lit(fill))


def smoothed_ratio(a, b, eps: float = 0.1) -> Column:
    return _c(a) / (_c(b) + F.lit(eps))


# P29 / P30 / P31 -------------------------------------------------------------
# The district token (Hangul or digits ending in 동).
DONG_PATTERN = "([가-힣0-9]+동)"


def extract_dong(*texts) -> Column:
    """First district token ``...동`` over several text columns."""
    return F.coalesce(*[F.nullif(F.regexp_extract(_c(t), DONG_PATTERN, 1), F.lit("")) for t in texts])


def strip_words(x, words: list[str]) -> Column:
    out = _c(x)
    for w in words:
        out = F.replace(out, F.lit(w), F.lit(""))
    return F.regexp_replace(out, r"\s+", "")


def contains_flag(x, token: str) -> Column:
    return F.coalesce(F.contains(_c(x), F.lit(token)), F.lit(False)).cast("int")


# P32 / P33 -------------------------------------------------------------------
def map_values(x, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(_c(x) == F.lit(k), F.lit(v)) if expr is None
                else expr.when(_c(x) == F.lit(k), F.lit(v)))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def select_rules(rules: list[tuple[Column, object]], default=None) -> Column:
    """First matching rule wins (``np.select``)."""
    expr = None
    for cond, val in rules:
        v = val if isinstance(val, Column) else F.lit(val)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


# P34 / P35 -------------------------------------------------------------------
def to_number(x) -> Column:
    """Numeric parse with bad values to null (pandas ``errors='coerce'``)."""
    return _c(x).try_cast("double")


def capacity(lcd, qr) -> Column:
    return F.coalesce(_c(lcd), F.lit(0)) + F.coalesce(_c(qr), F.lit(0))


# P39 -------------------------------------------------------------------------
def ts_from_parts(year, month, day, hour) -> Column:
    return F.make_timestamp_ntz(_c(year), _c(month), _c(day), _c(hour), F.lit(0), F.lit(0))


# W-MON week --------------------------------------------------
def week_start_w_mon(d) -> Column:
    """Start (Tuesday) of the pandas ``W-MON`` period containing ``d``."""
    return F.date_sub(_c(d), F.pmod(F.weekday(_c(d)) - 1, F.lit(7)))


# Cycle start (I4, SURVEY 2.X.9) ---------------------------------------------
def cycle_start(ts) -> Column:
    """12-hour shifts starting 04:00 and 16:00; 00-03 belongs to the day before."""
    return window_start(ts, "12 hours", "4 hours")
