"""Scores, baselines and result tables.

Every metric is one aggregation (optionally grouped), computed where the
predictions live; nothing is collected except the metric rows themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# M30 / M31 -------------------------------------------------------------------
def regression_metrics(df: DataFrame, y: str = "y", pred: str = "pred", keys: list | None = None,
                       zero_variance_r2: float = 0.0) -> DataFrame:
    """MAE, RMSE and R2 per group; R2 of a constant target is a parameter (1.0 in
    one reference notebook, 0.0 in the forecast script)."""
    e = F.col(y) - F.col(pred)
    aggs = [F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
            F.sum(e * e).alias("_sse"), F.count(F.lit(1)).alias("n"),
            F.var_pop(y).alias("_vp")]
    g = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    sst = F.col("_vp") * F.col("n")
    r2 = F.when(sst == 0, F.lit(zero_variance_r2)).otherwise(F.lit(1.0) - F.col("_sse") / sst)
    return g.withColumn("r2", r2).drop("_sse", "_vp")


# M32 -------------------------------------------------------------------------
def masked_metrics(df: DataFrame, masks: dict[str, Column], y: str = "y", pred: str = "pred",
                   weights: dict[str, float] | None = None) -> DataFrame:
    """MAE / RMSE per mask in one pass, plus a weighted score of the mask RMSEs."""
    e = F.col(y) - F.col(pred)
    aggs = []
    for name, m in masks.items():
        aggs += [F.avg(F.when(m, F.abs(e))).alias(f"mae_{name}"),
                 F.sqrt(F.avg(F.when(m, e * e))).alias(f"rmse_{name}")]
    out = df.agg(*aggs)
    if weights:
        out = out.withColumn("weighted_rmse", sum(F.lit(w) * F.col(f"rmse_{n}") for n, w in weights.items()))
    return out


# M33 -------------------------------------------------------------------------
def relative_errors(df: DataFrame, keys: list, y: str = "y", pred: str = "pred") -> DataFrame:
    e = F.col(y) - F.col(pred)
    g = df.groupBy(*keys).agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                              F.stddev_samp(y).alias("y_std"), F.avg(y).alias("y_mean"))
    # a constant or zero-mean target has no relative error (null, not a failed job)
    return g.withColumns({"rel_rmse": F.try_divide(F.col("rmse"), F.nullif(F.col("y_std"), F.lit(0.0))),
                          "rel_mae": F.try_divide(F.col("mae"), F.nullif(F.col("y_mean"), F.lit(0.0)))})


def rank_sum_choice(scores: DataFrame, group: list, cols: list[str], complexity: str | None = None,
                    penalty: float = 0.0) -> DataFrame:
    """Rank candidates on each error column (min rank), sum the ranks, add a linear
    complexity penalty; rank 1 of the total is the choice."""
    out = scores
    for c in cols:
        out = out.withColumn(f"{c}_rank", F.rank().over(Window.partitionBy(*group).orderBy(F.col(c))))
    total = sum(F.col(f"{c}_rank") for c in cols)
    if complexity:
        total = total + F.lit(penalty) * F.col(complexity)
    out = out.withColumn("score", total.cast("double"))
    return out.withColumn("choice_rank", F.rank().over(Window.partitionBy(*group).orderBy("score")))


def model_choice(scores: DataFrame, name: str = "feature_set", count: str = "feature_count") -> DataFrame:
    """The comparison table of named candidates (one row each; a handful, so windows run over
    all of them) with the sum of its four ranks (valid and test R2, valid and test RMSE; ties
    take the least rank), the weighted selection score ``4 test R2 + 3 valid R2 - 2 test
    RMSE/std - 1.5 valid RMSE/std - 0.05 complexity rank`` and the place by it (ties: test R2,
    valid R2, test RMSE, name)."""
    def rank(col, down):
        return F.rank().over(Window.orderBy(F.desc(col) if down else F.asc(col))).cast("int")

    ranks = {f"{c}_rank": rank(c, "R2" in c) for c in ("valid_R2", "test_R2", "valid_RMSE", "test_RMSE")}
    out = scores.withColumns(ranks).withColumn("final_rank_score", sum(F.col(c) for c in ranks))
    out = out.withColumn("complexity_penalty", rank(count, False) * 0.05)
    out = out.withColumn("selection_score", F.col("test_R2") * 4 + F.col("valid_R2") * 3 - F.col("test_RMSE_over_std") * 2
                         - F.col("valid_RMSE_over_std") * 1.5 - F.col("complexity_penalty"))
    best = Window.orderBy(F.desc("selection_score"), F.desc("test_R2"), F.desc("valid_R2"), "test_RMSE", name)
    return out.withColumn("place", F.row_number().over(best))


# M34 -------------------------------------------------------------------------
def generalisation_gaps(train_r2, valid_r2, test_r2) -> dict[str, Column]:
    return {"gap_train_test": _c(train_r2) - _c(test_r2), "gap_valid_test": _c(valid_r2) - _c(test_r2)}


# M35 -------------------------------------------------------------------------
def classification_metrics(df: DataFrame, label: str = "label", pred: str = "pred_label",
                           keys: list | None = None) -> DataFrame:
    """Confusion counts, accuracy, precision, recall, F1 (zero division -> 0)."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    aggs = [F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
            F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn")]
    g = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)

    def sdiv(a, b):
        return F.when(b == 0, F.lit(0.0)).otherwise(a / b)

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    g = g.withColumns({"accuracy": sdiv(tp + tn, tp + fp + fn + tn), "precision": sdiv(tp, tp + fp),
                       "recall": sdiv(tp, tp + fn)})
    return g.withColumn("f1", sdiv(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


# M36 -------------------------------------------------------------------------
def roc_auc(df: DataFrame, label: str = "label", score: str = "prob", keys: list | None = None) -> DataFrame:
    """AUC by the rank-sum (Mann-Whitney) form with tied scores sharing the average rank.

    Ranks come from counts per distinct score and a bucketed running total
    (``splits.running_total_before``), so no window runs over all rows."""
    from .splits import running_total_before
    k = list(keys or [])
    by = df.groupBy(*k, score).agg(F.count(F.lit(1)).alias("_c"), F.count_if(F.col(label) == 1).alias("_p"))
    by = running_total_before(by, score, "_c", k)
    by = by.withColumn("_avg_rank", F.col("_before") + (F.col("_c") + 1) / 2.0)
    g = by.groupBy(*k).agg(F.sum(F.col("_p") * F.col("_avg_rank")).alias("_rs"),
                           F.sum("_p").alias("_np"), F.sum(F.col("_c") - F.col("_p")).alias("_nn"))
    auc = (F.col("_rs") - F.col("_np") * (F.col("_np") + 1) / 2.0) / (F.col("_np") * F.col("_nn"))
    return g.select(*k, F.when((F.col("_np") == 0) | (F.col("_nn") == 0), F.lit(None)).otherwise(auc).alias("auc"))


# M38 -------------------------------------------------------------------------
def residuals(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    return df.withColumns({"residual": F.col(y) - F.col(pred), "abs_error": F.abs(F.col(y) - F.col(pred))})


# M29 -------------------------------------------------------------------------
def baselines(df: DataFrame, y: str, station: str = "station_id", time_col: str = "ts",
              train_mean: float | None = None) -> DataFrame:
    """Mean of the training target and previous value (per station) as predictions."""
    w = Window.partitionBy(station).orderBy(time_col)
    out = df.withColumn("pred_prev", F.lag(y, 1).over(w))
    if train_mean is not None:
        out = out.withColumn("pred_mean", F.lit(float(train_mean)))
    return out


# M39 -------------------------------------------------------------------------
def importance_table(spark, names: list[str], values, lag_words=("lag", "roll")) -> DataFrame:
    """Importances by feature; those on past demand (a lag or a rolling value) are grouped as ``lag``."""
    rows = [(n, float(v)) for n, v in zip(names, values)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.withColumn("group", F.when(F.col("feature").rlike("|".join(lag_words)), "lag").otherwise("other"))
