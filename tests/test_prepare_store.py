"""Fitted preparation, keyed store, marked CSV files."""

import glob

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from stationflow.operators import models as md
from stationflow.operators.prepare import ExactPrepare, ExactPrepareModel
from stationflow.sources import readers as rd


def test_exact_medians_modes_and_alignment(spark, tmp_path):
    rng = np.random.default_rng(0)
    a = rng.normal(0, 100, 501)
    rows = [(float(v), None if i % 3 else float(i), None, ["x", "y", None][i % 3] if i > 2 else "y", i % 2) for i, v in enumerate(a)] + [(float("nan"), None, None, None, None)]
    df = spark.createDataFrame(rows, "a double, b double, empty double, c string, d int").withColumn("none", F.lit(None).cast("string")).repartition(5)
    m = ExactPrepare(numeric=["a", "b", "empty"], categorical=["c", "d", "none"]).fit(df)
    assert m.getOrDefault("medians") == [float(np.median(a)), float(np.median(range(0, 501, 3))), 0.0]
    assert m.getOrDefault("modes")[1:] == ["0", ""] and m.getOrDefault("categories") == [["x", "y"], ["0", "1"], []]
    new = spark.createDataFrame([(None, 5.0, None, "z", 7), (1.0, None, 2.0, None, None)], "a double, b double, empty double, c string, d int") \
        .withColumn("none", F.lit("q"))
    mode = m.getOrDefault("modes")[0]

    def check(model):
        got = model.transform(new).collect()
        assert [got[0][f"{c}=" + v + "__oh"] for c, v in (("c", "x"), ("c", "y"), ("d", "0"), ("d", "1"))] == [0, 0, 0, 0]
        assert got[0]["a__imp"] == float(np.median(a)) and got[1]["empty__imp"] == 2.0 and got[0]["empty__imp"] == 0.0
        assert got[1][f"c={mode}__oh"] == 1 and got[1]["d=0__oh"] == 1 and got[1].none == "q"

    check(m)
    m.write().overwrite().save(str(tmp_path / "m"))
    check(ExactPrepareModel.load(str(tmp_path / "m")))
    p = Pipeline(stages=[ExactPrepare(numeric=["a"])]).fit(df)
    p.save(str(tmp_path / "p"))
    assert PipelineModel.load(str(tmp_path / "p")).transform(new).columns[-1] == "a__imp"


def test_rows_that_stop_the_training_do_not_reach_the_preparation(spark):
    tr = spark.createDataFrame([(float(i), float(i)) for i in range(50)], "x double, y double")
    both = tr.withColumn("v", F.lit(False)).unionByName(tr.select((F.col("x") + 1000).alias("x"), "y", F.lit(True).alias("v")))
    m = md.fit(both, ["x"], "y", "gbt", scale=False, maxIter=3, maxDepth=2, validationIndicatorCol="v", prepare_on=tr)
    assert m.stages[0].getOrDefault("medians") == [24.5]


def test_keyed_store_replaces_and_reads_only_the_keys(spark, tmp_path):
    path = str(tmp_path / "store")
    df = spark.createDataFrame([(s, k, i) for s in "abc" for k in (1, 2) for i in range(4)], "station string, k int, v int")
    rd.write_keyed(df, path, ["station", "k"])
    rd.write_keyed(df.filter("station = 'b' AND k = 2").withColumn("v", F.col("v") + 100), path, ["station", "k"])
    rd.write_keyed(df.filter("station = 'b' AND k = 2").limit(1).withColumn("v", F.lit(7)), path, ["station", "k"])
    one = rd.read_keyed(spark, path, station="b", k=2)
    assert [r.v for r in one.collect()] == [7] and rd.read_keyed(spark, path, station="a").count() == 8
    assert spark.read.parquet(path).count() == 21
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(station" in plan and "(k#" in plan
    assert all("station=b/k=2" in r[0] for r in one.select(F.input_file_name()).collect())


def test_station_csv_has_a_mark_and_reads_back(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([(1, "s1", "합정동"), (2, "s1", "b,c"), (3, "s2", None)], "id int, station_id string, name string")
    rd.write_station_csv(df.repartition(3), path)
    files = sorted(glob.glob(f"{path}/station_id=*/*.csv"))
    assert len(files) == 2 and all(open(f, "rb").read(3) == b"\xef\xbb\xbf" for f in files)
    back = rd.read_csv(spark, f"{path}/station_id=*/*.csv", "id int, name string")
    assert sorted((r.id, r.name) for r in back.collect()) == [(1, "합정동"), (2, "b,c"), (3, None)]


def test_cache_or_build_hides_no_other_error(spark, tmp_path):
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception):  # noqa: B017
        rd.cache_or_build(spark, str(bad), lambda: spark.range(1)).collect()
    assert rd.cache_or_build(spark, str(tmp_path / "new"), lambda: spark.range(3)).count() == 3
