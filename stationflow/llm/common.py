"""Helpers shared by the training-data operators: table access, tables written in
the shared folder, group counts that follow the input, byte-string hashing."""

from __future__ import annotations

import math
import uuid
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, ensure_checkpoint_dir

# Rows per Arrow batch sent to a Python worker. Texts average a few kB and can be far
# longer, so the default of 10,000 rows would make batches of many MB.
ARROW_BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings every operator of this subpackage relies on (idempotent)."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back: cuts the
    lineage like ``checkpoint()``, but compressed (``compression``, or as the session says)
    and column-pruned on later reads."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def groups_for(amount: float | None, per_group: float) -> int:
    """Number of groups so that each holds about ``per_group``; grows with the input."""
    return max(1, math.ceil((amount or 0) / per_group))


def total_bytes(df: DataFrame, column: str) -> int:
    return df.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0


# ---------------------------------------------------------------- hashing of bytes

def mix64(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64, elementwise (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def odd_constants(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=4)
def byte_table(seed: int = 11) -> np.ndarray:
    """A random 64-bit value per byte, so that polynomial hashes have no short cycles."""
    return np.random.default_rng(seed).integers(0, 2**64, 256, dtype=np.uint64)


def slices(sizes, limit: int):
    """Cut ``range(len(sizes))`` into runs whose sizes add up to about ``limit``; an item
    above the limit makes a run of its own."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
