"""Small helpers shared by the operators: id filters, size-checked broadcast,
lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dimensions at or under this many rows are broadcast; larger ones are joined by
# shuffle. Station, district, subway and calendar dimensions are far below it.
BROADCAST_MAX_ROWS = 2_000_000

# Literal id lists at or under this length become an ``IN`` predicate (pushed to
# the Parquet scan); longer lists go through a semi join.
INLIST_MAX = 1000


def bounded_broadcast(dim: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``dim`` only after checking its row count; otherwise leave the
    join to a shuffle (and to AQE, which may still broadcast at run time).

    Used for dimensions read from small base tables (stations, id lists), where the
    count is cheap. Tables derived from the large inputs (hourly weather, quantile
    edges, context features) get no hint at all: counting them would compute them
    twice, and AQE already converts a join to a broadcast at run time from the
    materialised size, with the shuffle join as the fallback."""
    n = dim.limit(max_rows + 1).count()
    return F.broadcast(dim) if n <= max_rows else dim


def id_filter(df: DataFrame, col: str, ids) -> DataFrame:
    """Keep rows whose ``col`` is in ``ids`` (None = keep all).

    ``ids`` may be a Python list (IN predicate) or a one-column DataFrame (semi
    join, broadcast only if its size is checked small).
    """
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        key = ids.columns[0]
        right = ids.select(F.col(key).alias(col)).distinct()
        return df.join(bounded_broadcast(right), col, "left_semi")
    ids = list(ids)
    if len(ids) <= INLIST_MAX:
        return df.filter(F.col(col).isin(ids))
    spark = df.sparkSession
    right = spark.createDataFrame([(i,) for i in ids], [col])
    return df.join(F.broadcast(right), col, "left_semi")  # size known: len(ids)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the session's ``spark.checkpoint.dir`` (shared storage on
    a cluster) and read it back, so lost executors do not replay long lineages. Unlike
    ``checkpoint()`` the rows are computed once, later reads take only the columns they
    need, and the planner knows the size (a small table is broadcast by itself)."""
    from .session import ensure_checkpoint_dir

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
