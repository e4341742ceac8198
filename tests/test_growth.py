"""Steps whose cost per row or per task may not grow with columns or rows."""

import contextlib
import io
import re

import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from shopcast.operators import forecast as FC
from shopcast.operators import profile as PR
from shopcast.operators import train as TR


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_correlations_take_three_aggregates_for_any_number_of_columns(spark):
    rows = spark.range(400).select(*[F.rand(i).alias(f"c{i}") for i in range(30)], F.lit(1.0).alias("flat"),
                                   F.rand(77).alias("y"))
    cols = [f"c{i}" for i in range(30)] + ["flat"]
    out = PR.target_correlations(rows, "y", cols)
    assert plan(out).count("partial_var_pop(") <= 4       # keys and functions of one aggregate
    got = {r["feature"]: (r["n"], r["r"]) for r in out.collect()}
    assert got["flat"] == (400, 0.0) and len(got) == 31
    assert got["c3"][1] == pytest.approx(rows.stat.corr("c3", "y"), abs=1e-12)
    none = PR.target_correlations(rows.filter("y > 2"), "y", cols).collect()
    assert len(none) == 31 and {(r["n"], r["r"]) for r in none} == {(0, 0.0)}


def test_future_features_partitions_follow_the_history(spark, monkeypatch):
    history = spark.range(600).select(
        (F.col("id") % 20).alias("store"), F.expr("date_add(date'2001-01-01', cast(id div 20 as int))").alias("date"),
        (F.col("id") * 7 % 1000).alias("sales_cents"), (F.col("id") % 9 + 1).alias("customers"), F.lit(1).alias("open"))
    whole = FC.future_features(history, "2001-02-01", "2001-02-03").collect()
    monkeypatch.setattr(FC, "TASK_ROWS", 10)
    out = FC.future_features(history, "2001-02-01", "2001-02-03")
    assert re.search(r"hashpartitioning\(store#\d+L?, 60\), REPARTITION_BY_NUM", plan(out))
    assert sorted(out.collect()) == sorted(whole) and len(whole) == 60


def test_boosted_models_of_fewer_rounds_are_not_fitted_again(spark, monkeypatch):
    rows = spark.range(300).select(
        (F.col("id") % 10).alias("store"), F.expr("date_add(date'2001-01-01', cast(id as int))").alias("date"),
        F.rand(1).alias("a"), F.rand(2).alias("b")).withColumn("sales", F.col("a") * 10 + F.col("b") + F.rand(3))
    fitted, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, *a: fitted.append(self.getMaxIter()) or fit(self, *a))
    est = GBTRegressor(featuresCol="features_scaled", labelCol="sales", seed=TR.SEED)
    got = TR._tune(est, {"maxIter": [2, 5], "maxDepth": [2, 3]}, rows, ["a", "b"], "sales", 2)
    assert fitted == [5] * 2 * TR.FOLDS and got["maxIter"] in (2, 5) and got["maxDepth"] in (2, 3)
    data = TR.Pipeline(stages=TR.feature_stages(["a", "b"])).fit(rows).transform(rows).persist()
    long, short = fit(est.copy({est.maxIter: 5}), data), fit(est.copy({est.maxIter: 2}), data)
    assert TR._rmse(long, data, "sales", [2])[0] == pytest.approx(TR._rmse(short, data, "sales", [])[0], rel=1e-9)
    data.unpersist()
