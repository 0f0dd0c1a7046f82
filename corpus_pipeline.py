"""A corpus pipeline over ``documents``: language ID, MinHash near-dedup, suffix-array
dedup, packing.

Each stage is a function of ``(spark, docs, sf_dir)``; it works on all that its predecessor
kept, and all but the last return the columns of ``documents``. :func:`run` writes what a
stage returns as Parquet below ``spark.checkpoint.dir`` and rereads it as the next one's
documents, so that a lost executor repeats no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import langid, minhash, packing, suffix_dedup
from stationflow.llm.common import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told: those without text or letters go, and those whose
    best language has no more than half of the probability."""
    found = langid.identify(docs, names=("_lang_pred", "_lang_score"))
    return found.filter((F.col("_lang_pred") != langid.UNKNOWN) & (F.col("_lang_score") > 0.5)).select(docs.columns)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (five-word shingles,
    similarity 0.8 or more), once."""
    kept = minhash.near_duplicates(docs, words=5, percent=80).filter("kept").select(F.col("doc_id").alias("_kept")).distinct()
    left = docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("_kept")), "left_semi")
    return left.withColumn("_text", F.xxhash64("text")).dropDuplicates(["doc_id", "_text"]).select(docs.columns)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 50 bytes that an earlier document has; characters cut in
    part go, and documents of which nothing is left."""
    left = suffix_dedup.remove_repeats(docs, text_column=True)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
                               .cast(docs.schema["n_chars"].dataType))
    return left.filter((F.col("n_removed") == 0) | (F.length("text") > 0)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' ids and their places in sequences of 1024."""
    return packing.pack_documents(docs)


STAGES = [("language_id", language_id), ("minhash_dedup", minhash_dedup), ("suffix_array_dedup", suffix_array_dedup), ("packing", pack)]

ORACLE_SQL = None   # no stage can be written in SQL; tests/llm holds each against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
