"""Scans and sinks.

Readers take explicit schemas (no inference pass over the data) and select only
the requested columns, so Parquet scans prune columns and push filters. Writers
are plain DataFrame writers; per-station outputs are ``partitionBy`` datasets.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Text form of timestamps in CSV, microseconds kept (Spark's default writes milliseconds).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def csv_writer(df: DataFrame, header: bool = True):
    return df.write.option("header", header).option("timestampNTZFormat", TS_FORMAT)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes null on ingest, so Spark's
    null rules (skipped by aggregates, ``coalesce``) apply as pandas' NaN rules do."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not fl:
        return df
    return df.withColumns({c: F.nanvl(F.col(f"`{c}`"), F.lit(None).cast(dict(df.dtypes)[c])) for c in fl})


# S1 --------------------------------------------------------------------------
def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None,
                 schema: T.StructType | None = None, nan_as_null: bool = True) -> DataFrame:
    """Parquet scan; ``columns`` prunes the ReadSchema, filters applied afterwards are
    pushed into the scan by Catalyst."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    df = df.select(*columns) if columns else df
    return nan_to_null(df) if nan_as_null else df


# S2 / S3 / S4 / S14 -------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, header: bool = True,
             encoding: str = "UTF-8", multiline: bool = False, lineage: bool = False) -> DataFrame:
    """CSV with header; a UTF-8 BOM is dropped by Spark. ``encoding`` may be
    ``cp949``/``euc-kr`` (needs ``spark.sql.legacy.javaCharsets``). ``path`` may be
    a glob (S4); ``lineage`` adds the source file path."""
    r = spark.read.option("header", header).option("encoding", encoding) \
        .option("timestampNTZFormat", TS_FORMAT)
    if multiline:
        r = r.option("multiLine", True).option("escape", '"').option("quote", '"')
    if schema is not None:
        r = r.schema(schema)
    df = r.csv(path)
    if lineage:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return df


def drop_unnamed_index(df: DataFrame) -> DataFrame:
    """Drop a leading index column written without a name (``''``, ``_c0``,
    ``Unnamed: 0``)."""
    bad = [c for c in df.columns if c in ("", "_c0") or c.startswith("Unnamed")]
    return df.drop(*bad)


# S5 / S6 ---------------------------------------------------------------------
def narrow(df: DataFrame, casts: dict[str, str], safe: bool = True) -> DataFrame:
    """Missing to 0 first, then narrowing casts; ``safe`` uses ``try_cast`` so an
    overflowing value becomes null instead of failing the job (ANSI mode)."""
    out = {}
    for c, t in casts.items():
        v = F.coalesce(F.col(c), F.lit(0))
        out[c] = v.try_cast(t) if safe else v.cast(t)
    return df.withColumns(out)


def csv_to_parquet(spark: SparkSession, src: str, dst: str, schema: T.StructType, casts: dict[str, str] = None,
                   compression: str = "zstd", encoding: str = "UTF-8") -> DataFrame:
    """One read with the explicit schema, narrowing casts, one write: Spark splits
    the input; there is no chunk loop."""
    df = read_csv(spark, src, schema, encoding=encoding)
    if casts:
        df = narrow(df, casts)
    df.write.mode("overwrite").option("compression", compression).parquet(dst)
    return spark.read.parquet(dst)


# S7 --------------------------------------------------------------------------
WEATHER_JSON_SCHEMA = T.StructType([T.StructField("hourly", T.StructType([
    T.StructField("time", T.ArrayType(T.StringType())),
    T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
    T.StructField("relative_humidity_2m", T.ArrayType(T.DoubleType())),
    T.StructField("precipitation", T.ArrayType(T.DoubleType())),
    T.StructField("snowfall", T.ArrayType(T.DoubleType()))]))])


def read_weather_json(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Landed weather payloads (struct of parallel hourly arrays) to one row per hour."""
    df = spark.read.schema(WEATHER_JSON_SCHEMA).option("multiLine", multiline).json(path)
    z = df.select(F.inline(F.arrays_zip("hourly.time", "hourly.temperature_2m", "hourly.relative_humidity_2m",
                                        "hourly.precipitation", "hourly.snowfall")))
    return z.select(F.to_timestamp_ntz("time").alias("ts"), F.col("temperature_2m").alias("temp"),
                    F.col("relative_humidity_2m").alias("humidity"), F.col("precipitation").alias("rain"),
                    F.col("snowfall").alias("snow"))


def weather_to_json(df: DataFrame, path: str) -> None:
    """Inverse of :func:`read_weather_json`: one payload per day (24 hours at most)."""
    day = df.groupBy(F.to_date("ts").alias("d")).agg(
        F.array_sort(F.collect_list(F.struct("ts", "temp", "humidity", "rain", "snow"))).alias("h"))
    out = day.select(F.struct(
        F.transform("h", lambda x: F.date_format(x["ts"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
        F.transform("h", lambda x: x["temp"]).alias("temperature_2m"),
        F.transform("h", lambda x: x["humidity"]).alias("relative_humidity_2m"),
        F.transform("h", lambda x: x["rain"]).alias("precipitation"),
        F.transform("h", lambda x: x["snow"]).alias("snowfall")).alias("hourly"))
    out.write.mode("overwrite").json(path)


# S8 --------------------------------------------------------------------------
def cache_or_build(spark: SparkSession, path: str, build, fmt: str = "parquet") -> DataFrame:
    """Read the landed dataset if it exists, otherwise build and write it once
    (``mode('ignore')`` keeps a concurrent writer's copy)."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        build().write.mode("ignore").format(fmt).save(path)
        return spark.read.format(fmt).load(path)


# S9 / S10 / S11 / S12 -------------------------------------------------------------
def write_partitioned(df: DataFrame, path: str, keys: list[str], fmt: str = "csv", header: bool = True,
                      mode: str = "overwrite") -> None:
    """One file set per key value (``partitionBy``), e.g. one CSV folder per station
    (S9) or a keyed result store partitioned by station and k (S11)."""
    w = df.write.mode(mode).partitionBy(*keys).format(fmt)
    if fmt == "csv":
        w = w.option("header", header)
    w.save(path)


def list_keys(spark: SparkSession, path: str, keys: list[str], fmt: str = "parquet") -> DataFrame:
    """The stored key values (distinct partition values; reads no data columns)."""
    return spark.read.format(fmt).option("header", True).load(path).select(*keys).distinct()


BOM = "\ufeff"


def write_station_csv(df: DataFrame, path: str, key: str = "station_id") -> None:
    """One CSV file per station, below ``<key>=<value>/``, each with a header and a byte
    order mark (the mark is the first character of the header line)."""
    first, *rest = [c for c in df.columns if c != key]
    marked = df.select(F.col(first).alias(BOM + first), *rest, key)
    marked.repartition(key).write.mode("overwrite").partitionBy(key).option("header", True).option("encoding", "UTF-8").csv(path)


def write_keyed(df: DataFrame, path: str, keys: list[str]) -> None:
    """Put the tables of the keys in ``df`` into the store at ``path`` (created if absent).
    The tables of these keys are replaced, those of other keys stay (dynamic partition
    overwrite, committed when all are written)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def read_keyed(spark: SparkSession, path: str, schema: str | None = None, **key) -> DataFrame:
    """The store's table of one key (or of all keys that agree with the named ones): only
    their folders are listed in the scan."""
    found = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    for name, value in key.items():
        found = found.filter(F.col(name) == F.lit(value))
    return found


# S13 -------------------------------------------------------------------------
def read_error_log(spark: SparkSession, path: str) -> DataFrame:
    """Quoted multi-line CSV whose ``error_text`` holds XML; the result code and
    message are taken out with ``xpath_string``."""
    schema = "measured_at string, status_code int, code string, message string, error_text string"
    df = read_csv(spark, path, schema, multiline=True)
    return df.withColumns({"xml_code": F.xpath_string("error_text", F.lit("RESULT/CODE")),
                           "xml_message": F.xpath_string("error_text", F.lit("RESULT/MESSAGE"))})


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's checkpoint directory (shared storage on a
    cluster), never a machine-local temporary folder."""
    from ..session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/stationflow-io/{name}-{uuid.uuid4().hex[:12]}"
