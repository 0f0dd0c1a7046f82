"""Model queries. Rows-only:
seeded fits whose outputs are metric tables; unit tests check the numerics.

Data: the diagnostic feature frame (station-hour panel, lags, calendar, weather),
target ``y`` = total flow; train before 2024-01-15, valid to 2024-01-22, test after.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import diagnose as dg
from ..operators import evaluate as ev
from ..operators import inventory as inv
from ..operators import models as md
from ..operators.extra_trees import fit_extra_trees
from ..operators.prepare import ExactPrepare
from ..sources import adapter as ad
from ..util import cut_lineage
from .catalog import register
from .q_diagnose import FEATURES, FF_SQL, feature_frame

# total_lag1 is the sum of the two flow lags, so it stays out
NUM = ["total_lag24", "inflow_lag1", "outflow_lag1", "hour", "weekday", "temp", "roll3"]
FOREST = {"numTrees": 100, "maxDepth": 8, "minInstancesPerNode": 5}


def _split(spark, sf_dir):
    ff = cut_lineage(feature_frame(spark, sf_dir))   # every fit, fold and score reads it
    v = F.lit("2024-01-15").cast("timestamp_ntz")
    t = F.lit("2024-01-22").cast("timestamp_ntz")
    return (ff.filter(F.col("ts") < v), ff.filter((F.col("ts") >= v) & (F.col("ts") < t)),
            ff.filter(F.col("ts") >= t))


def _scored(model, test, log_target=False, keys=("station_id",)):
    p = md.predict(model, test, log_target)
    return ev.regression_metrics(p, "y", "pred", keys=list(keys))


@register("m10_impute_scale_linear", "M10 M12", check="R")
def m10(spark, sf_dir):
    tr, _, te = _split(spark, sf_dir)
    return _scored(md.fit(tr, NUM, "y", "linear"), te)


@register("m11_mixed_pipeline", "M11 P15", check="R")
def m11(spark, sf_dir):
    tr, _, te = _split(spark, sf_dir)
    tr = tr.withColumn("station_cat", F.when(F.col("station_id") != "ST-5", F.col("station_id")))
    te = te.withColumn("station_cat", F.col("station_id"))
    m = md.fit(tr, NUM, "y", "linear", categorical=["station_cat"])
    return _scored(m, te)


PREP_SQL = FF_SQL + """,
tr AS (SELECT *, CASE WHEN station_id <> 'ST-5' THEN station_id END AS cat FROM ff WHERE ts < TIMESTAMP '2024-01-15'),
te AS (SELECT *, CASE WHEN hour(ts) = 3 THEN NULL WHEN hour(ts) = 5 THEN 'ST-new' ELSE station_id END AS cat FROM ff WHERE ts >= TIMESTAMP '2024-01-22')"""


def _prepared(spark, sf_dir):
    tr, _, te = _split(spark, sf_dir)
    tr = tr.withColumn("cat", F.when(F.col("station_id") != "ST-5", F.col("station_id")))
    te = te.withColumn("cat", F.when(F.hour("ts") == 5, "ST-new").when(F.hour("ts") != 3, F.col("station_id")))
    return ExactPrepare(numeric=NUM, categorical=["cat"]).fit(tr).transform(te)


@register("p36_median_of_train", "P36 M10", PREP_SQL + ",\nmed AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in NUM) + """ FROM tr)
SELECT te.station_id, te.ts, """ + ", ".join(f"round(coalesce(te.{c}, med.{c}), 6) AS {c}" for c in NUM) + " FROM te, med", check="T")
def p36(spark, sf_dir):
    """Test rows filled with the exact medians of the training rows."""
    x = _prepared(spark, sf_dir)
    return x.select("station_id", "ts", *[F.round(f"{c}__imp", 6).alias(c) for c in NUM])


@register("p15_one_hot_aligned", "P15 M11", PREP_SQL + """,
mode_ AS (SELECT cat AS m FROM tr WHERE cat IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
names AS (SELECT DISTINCT cat AS name FROM tr WHERE cat IS NOT NULL)
SELECT te.station_id, te.ts, names.name, CAST(coalesce(te.cat, m) = names.name AS DOUBLE) AS hot FROM te, mode_, names""")
def p15(spark, sf_dir):
    """Test rows aligned to the training categories: the mode for a missing one, zeros for a new one."""
    x = _prepared(spark, sf_dir)
    hot = [c for c in x.columns if c.endswith("__oh")]
    return x.select("station_id", "ts", F.inline(F.array(*[
        F.struct(F.lit(c[len("cat="):-len("__oh")]).alias("name"), F.col(f"`{c}`").alias("hot")) for c in hot])))


@register("m13_ridge", "M13", check="R")
def m13(spark, sf_dir):
    tr, _, te = _split(spark, sf_dir)
    return _scored(md.fit(tr, NUM, "y", "ridge", alpha=10.0), te)


@register("m14_lasso_grid_ts_folds", "M14 M23 M6", check="R")
def m14(spark, sf_dir):
    tr, va, _ = _split(spark, sf_dir)
    g = md.grid(regParam=[0.01, 0.1], elasticNetParam=[0.5, 1.0])
    return md.ts_search(tr.unionByName(va), NUM, "y", "lasso", g, ["ts", "station_id"], k=3)


@register("m15_poisson", "M15", check="R")
def m15(spark, sf_dir):
    tr, _, te = _split(spark, sf_dir)
    return _scored(md.fit(tr, NUM, "y", "poisson", regParam=0.01), te)


@register("m16_tweedie", "M16", check="R")
def m16(spark, sf_dir):
    tr, _, te = _split(spark, sf_dir)
    return _scored(md.fit(tr, NUM, "y", "tweedie", regParam=0.01, variancePower=1.5), te)


@register("m17_random_forest", "M17", check="R")
def m17(spark, sf_dir):
    tr, _, te = _split(spark, sf_dir)
    return _scored(md.fit(tr, NUM, "y", "rf", scale=False, **FOREST), te)


@register("m18_gbt_early_stopping", "M18", check="R")
def m18(spark, sf_dir):
    tr, va, te = _split(spark, sf_dir)
    both = tr.withColumn("is_val", F.lit(False)).unionByName(va.withColumn("is_val", F.lit(True)))
    m = md.fit(both, NUM, "y", "gbt", scale=False, maxIter=30, maxDepth=4, validationIndicatorCol="is_val",
               validationTol=0.01, prepare_on=tr)
    return _scored(m, te)


@register("m19_extra_trees", "M19", check="R")
def m19(spark, sf_dir):
    tr, _, te = _split(spark, sf_dir)
    forest = fit_extra_trees(tr, NUM, "y", trees=100, depth=8, min_leaf=5)
    return ev.regression_metrics(forest.predict(te.na.drop(subset=NUM)), "y", "pred", keys=["station_id"])


@register("m20_classifiers", "M20 M35", check="R")
def m20(spark, sf_dir):
    tr, _, te = _split(spark, sf_dir)
    tr, te = (x.withColumn("label", (F.col("y") > 0).cast("double")) for x in (tr, te))
    out = []
    for kind, params in (("logistic", {"regParam": 0.01}), ("gbt_classifier", {"maxIter": 10, "maxDepth": 3})):
        m = md.fit(tr, NUM, "label", kind, **params)
        p = m.transform(te).withColumn("pred_label", F.col("pred_label").cast("int"))
        out.append(ev.classification_metrics(p, "label", "pred_label").withColumn("model", F.lit(kind)))
    return out[0].unionByName(out[1])


@register("m21_log_target", "M21", check="R")
def m21(spark, sf_dir):
    tr, _, te = _split(spark, sf_dir)
    return _scored(md.fit(tr, NUM, "y", "linear", log_target=True), te, log_target=True)


@register("m22_weighted_fit", "M22 C13", check="R")
def m22(spark, sf_dir):
    from ..operators import profiles as pf
    tr, _, te = _split(spark, sf_dir)
    w = pf.week_weights(tr, "y")
    trw = pf.sample_weight(tr, w)
    return _scored(md.fit(trw, NUM, "y", "linear", weight="sample_weight"), te)


@register("m27_net_direct_vs_difference", "M27", check="R")
def m27(spark, sf_dir):
    tr, _, te = _split(spark, sf_dir)
    tr, te = (x.withColumn("net", F.col("inflow") - F.col("outflow")) for x in (tr, te))
    direct = md.predict(md.fit(tr, NUM, "net", "linear"), te).withColumnRenamed("pred", "p_net")
    pin = md.predict(md.fit(tr, NUM, "inflow", "linear"), te).select("station_id", "ts", F.col("pred").alias("p_in"))
    pout = md.predict(md.fit(tr, NUM, "outflow", "linear"), te).select("station_id", "ts",
                                                                        F.col("pred").alias("p_out"))
    j = direct.join(pin, ["station_id", "ts"]).join(pout, ["station_id", "ts"])
    a = ev.regression_metrics(j, "net", "p_net").withColumn("variant", F.lit("direct"))
    b = ev.regression_metrics(j.withColumn("p_diff", F.col("p_in") - F.col("p_out")), "net", "p_diff") \
        .withColumn("variant", F.lit("in_minus_out"))
    return a.unionByName(b)


@register("m28_flow_models_stock_choice", "M28 I3", check="R")
def m28(spark, sf_dir):
    """The model pair whose simulated stock is nearest on the validation weeks is fitted
    again on train and validation rows, then scored on the test rows."""
    tr, va, te = _split(spark, sf_dir)
    cap = ad.stations(spark, sf_dir).select("station_id", (F.col("lcd") + F.col("qr")).alias("capacity"))
    kinds = {"linear": {}, "poisson": {"regParam": 0.01}}

    def score(kind, train, test):
        keys = ["station_id", "ts"]
        p_in, p_out = (md.predict(md.fit(train, NUM, y, kind, **kinds[kind]), test)
                       .select(*keys, F.greatest("pred", F.lit(0.0)).alias(p)) for y, p in (("inflow", "p_in"), ("outflow", "p_out")))
        stock = lambda rows, i, o, name: inv.simulate_stock(rows.join(cap, "station_id"), i, o, "capacity") \
            .select(*keys, F.col("stock").alias(name))
        j = stock(p_in.join(p_out, keys), "p_in", "p_out", "pred").join(stock(test, "inflow", "outflow", "y"), keys)
        return ev.regression_metrics(j, "y", "pred").withColumn("model", F.lit(kind))

    tried = {k: cut_lineage(score(k, tr, va)) for k in kinds}       # one row each
    best = min(kinds, key=lambda k: tried[k].first()["mae"])
    rows = [t.withColumns({"stage": F.lit("validation"), "chosen": F.lit(int(k == best))}) for k, t in tried.items()]
    final = score(best, tr.unionByName(va), te).withColumns({"stage": F.lit("test"), "chosen": F.lit(1)})
    return rows[0].unionByName(rows[1]).unionByName(final)


@register("m37_oof_pooled_scores", "M37", check="R")
def m37(spark, sf_dir):
    tr, va, _ = _split(spark, sf_dir)
    _, oof = md.ts_search(tr.unionByName(va), NUM, "y", "linear", [{}], ["ts", "station_id"], k=3, oof=True)
    return ev.regression_metrics(oof, "y", "pred")


@register("m39_importance_table", "M39", check="R")
def m39(spark, sf_dir):
    tr, _, _ = _split(spark, sf_dir)
    m = md.fit(tr, NUM, "y", "rf", scale=False, **FOREST)
    names, vals = zip(*md.importances(m, NUM))
    t = ev.importance_table(spark, list(names), list(vals))
    return t.groupBy("group").agg(F.sum("importance").alias("importance"), F.count(F.lit(1)).alias("n"))


@register("m41_category_number_vs_onehot", "M41 P38 P15", check="R")
def m41(spark, sf_dir):
    tr, _, te = _split(spark, sf_dir)
    codes = tr.select("station_id").distinct().withColumn(
        "station_code", (F.dense_rank().over(Window.orderBy("station_id")) - 1).cast("double"))  # 25-row table
    tr2, te2 = (x.join(F.broadcast(codes), "station_id", "left") for x in (tr, te))
    a = ev.regression_metrics(md.predict(md.fit(tr2, NUM + ["station_code"], "y", "linear"), te2), "y", "pred")
    b = ev.regression_metrics(md.predict(md.fit(tr, NUM, "y", "linear", categorical=["station_id"]), te), "y", "pred")
    return a.withColumn("encoding", F.lit("number")).unionByName(b.withColumn("encoding", F.lit("one_hot")))


def _lag_features(frame):
    w = Window.partitionBy("station_id").orderBy("ts")
    return frame.withColumns({"lag1": F.lag("y", 1).over(w), "lag24": F.lag("y", 24).over(w),
                              "hour": F.hour("ts").cast("double"), "weekday": F.weekday("ts").cast("double")})


@register("i12_recursive_projection", "I12", check="R")
def i12(spark, sf_dir):
    ff = cut_lineage(feature_frame(spark, sf_dir).select("station_id", "ts", "y"))
    train = _lag_features(ff).filter(F.col("ts") < F.lit("2024-01-25").cast("timestamp_ntz"))
    m = md.fit(train, ["lag1", "lag24", "hour", "weekday"], "y", "linear")
    hist = ff.filter(F.col("ts") < F.lit("2024-01-25 04:00:00").cast("timestamp_ntz"))
    return md.recursive_projection(m, hist, "2024-01-25 04:00:00", 12, "station_id", "ts", "y", [1, 24],
                                   _lag_features, ad.stations(spark, sf_dir).select("station_id"))


@register("x10_partner_rules", "X10", check="R")
def x10(spark, sf_dir):
    tr, _, _ = _split(spark, sf_dir)
    prof = dg.feature_profile(tr, FEATURES)
    pairs = dg.corr_pairs(tr, FEATURES)
    m = md.fit(tr, FEATURES, "y", "rf", scale=False, **FOREST)
    imp = spark.createDataFrame(md.importances(m, FEATURES), "feature string, importance double")
    return dg.partner_rules(prof, pairs, imp, 0.95)


@register("x17_select_from_model", "X17", check="R")
def x17(spark, sf_dir):
    tr, _, te = _split(spark, sf_dir)
    m = md.fit(tr, FEATURES, "y", "rf", scale=False, **FOREST)
    keep = md.select_from_model(md.importances(m, FEATURES))
    s = ev.regression_metrics(md.predict(md.fit(tr, keep, "y", "linear"), te), "y", "pred")
    return s.withColumn("selected", F.lit(",".join(keep)))


@register("x20_permutation_importance", "X20 O5", check="R")
def x20(spark, sf_dir):
    tr, _, te = _split(spark, sf_dir)
    m = md.fit(tr, NUM, "y", "linear")
    return md.permutation_importance(m, te, NUM, "y", ["station_id", "ts"])


@register("x23_leak_checks", "X23", check="R")
def x23(spark, sf_dir):
    tr, _, te = _split(spark, sf_dir)
    return md.leak_checks(tr, te, NUM, "y", "linear", ["station_id", "ts"], prev_col="total_lag24")
