"""Canonical columns and column resolution.

Inputs arrive with source names (Korean headers, HHMM variants). One
``resolve_columns`` step maps the first existing candidate onto each canonical
name; nothing downstream looks at source names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Canonical name -> candidate source names, first existing wins.
CANDIDATES: dict[str, list[str]] = {
    "base_date": ["base_date", "기준_날짜", "날짜", "date"],
    "hour": ["hour", "시간대", "기준_시간대", "기준_시간"],
    "basis": ["basis", "집계_기준"],
    "start_id": ["start_id", "시작_대여소_ID", "대여소_ID"],
    "start_name": ["start_name", "시작_대여소명"],
    "end_id": ["end_id", "종료_대여소_ID"],
    "end_name": ["end_name", "종료_대여소명"],
    "cnt": ["cnt", "전체_건수"],
    "use_min": ["use_min", "전체_이용_분"],
    "use_dist": ["use_dist", "전체_이용_거리"],
    "temp": ["temp", "온도"],
    "humidity": ["humidity", "습도"],
    "discomfort": ["discomfort", "불쾌지수"],
    "rain": ["rain", "강수량"],
    "snow": ["snow", "적설량"],
    "ts": ["ts", "timestamp", "datetime"],
}

# Basis labels of the source data and their canonical codes.
BASIS_CODES = {"출발시간": "dep", "도착시간": "arr"}

TRIPS_RAW_SCHEMA = T.StructType([
    T.StructField("기준_날짜", T.LongType()),
    T.StructField("집계_기준", T.StringType()),
    T.StructField("기준_시간대", T.DoubleType()),
    T.StructField("시작_대여소_ID", T.StringType()),
    T.StructField("시작_대여소명", T.StringType()),
    T.StructField("종료_대여소_ID", T.StringType()),
    T.StructField("종료_대여소명", T.StringType()),
    T.StructField("전체_건수", T.DoubleType()),
    T.StructField("전체_이용_분", T.DoubleType()),
    T.StructField("전체_이용_거리", T.DoubleType()),
])


def safe_get_col(df: DataFrame, candidates: list[str]) -> str | None:
    """F16: first candidate present in ``df`` (None when none is)."""
    cols = set(df.columns)
    return next((c for c in candidates if c in cols), None)


def resolve_columns(df: DataFrame, candidates: dict[str, list[str]] | None = None,
                    defaults: dict[str, object] | None = None, keep_other: bool = True) -> DataFrame:
    """Rename the first present candidate of each canonical name; absent canonical
    names get their default (if given). Missing names are ignored (F15)."""
    candidates = candidates or CANDIDATES
    defaults = defaults or {}
    ren = {}
    for canon, cands in candidates.items():
        hit = safe_get_col(df, cands)
        if hit is not None and hit != canon and canon not in df.columns:
            ren[hit] = canon
    out = df.withColumnsRenamed(ren) if ren else df
    add = {k: F.lit(v) for k, v in defaults.items() if k not in out.columns}
    out = out.withColumns(add) if add else out
    if not keep_other:
        out = out.select(*[c for c in candidates if c in out.columns])
    return out


def select_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    """select in the given order, silently skipping absent names."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in cols if c in have])


def drop_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def numeric_columns(df: DataFrame, exclude: list[str] = ()) -> list[str]:
    """numeric columns of the schema, minus the excluded names."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC) and f.name not in set(exclude)]


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df
