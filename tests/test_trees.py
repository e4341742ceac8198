"""Trees grown from blocks against MLlib's own."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import regression as ML
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from shopcast.operators import train as TR
from shopcast.operators import trees as TB

COLUMNS = ["a", "b", "c", "d", "e", "flat"]


@pytest.fixture(scope="module")
def rows(spark):
    """Under 10,000 rows, so that MLlib takes all of them for its split candidates, too."""
    rng, n = np.random.default_rng(5), 4000
    p = pd.DataFrame({"a": rng.random(n), "b": rng.normal(size=n), "c": rng.integers(0, 2, n) * 1.0,
                      "d": rng.integers(0, 2, n) * 1.0, "e": rng.integers(0, 7, n) * 1.0, "flat": np.ones(n)})
    p["y"] = 10 * p.a + 3 * np.sin(3 * p.b) + 2 * p.c * p.d - p.e * p.c + rng.normal(size=n)
    df = VectorAssembler(inputCols=COLUMNS, outputCol="v").transform(spark.createDataFrame(p)).repartition(3).persist()
    yield df
    df.unpersist()


def both(rows, name, **settings):
    return [getattr(m, name)(featuresCol="v", labelCol="y", seed=42, **settings).fit(rows) for m in (ML, TB)]


@pytest.mark.parametrize("name,settings", [
    ("RandomForestRegressor", {"numTrees": 1, "maxDepth": 5, "bootstrap": False, "minInstancesPerNode": 2}),
    ("RandomForestRegressor", {"numTrees": 1, "maxDepth": 3, "bootstrap": False, "minInfoGain": 0.3, "maxBins": 8}),
    ("GBTRegressor", {"maxIter": 5, "maxDepth": 4, "stepSize": 0.1})])
def test_without_drawn_rows_the_models_are_mllibs(rows, monkeypatch, name, settings):
    monkeypatch.setattr(TB, "REBASE", 3)
    monkeypatch.setattr(TB, "TASK_ROWS", (1000, 1 << 21))        # several partitions
    theirs, ours = both(rows, name, **settings)
    assert type(ours) is type(theirs) and ours.totalNumNodes == theirs.totalNumNodes
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), rtol=1e-9)
    x = ours.transform(theirs.transform(rows).withColumnRenamed("prediction", "p"))
    assert x.agg(F.max(F.abs(F.col("p") - F.col("prediction")))).first()[0] < 1e-9


def test_drawn_rows_and_features(rows, monkeypatch):
    """Forests and boosting with drawn rows: errors like MLlib's, the same
    trees whatever sums fit a task or the driver."""
    def rmse(model):
        return TR.regression_metrics(model.transform(rows), "y").first()["rmse"]

    theirs, ours = both(rows, "RandomForestRegressor", numTrees=20, maxDepth=5, minInstancesPerNode=2)
    assert rmse(ours) == pytest.approx(rmse(theirs), rel=0.1)
    assert len({t.toDebugString.split("\n", 1)[1] for t in ours.trees}) == 20
    monkeypatch.setattr(TB, "DRIVER_BYTES", 0)                   # sums by a shuffle
    again = TB.RandomForestRegressor(featuresCol="v", labelCol="y", seed=42, numTrees=20, maxDepth=5,
                                     minInstancesPerNode=2, maxMemoryInMB=0).fit(rows)
    assert [t.toDebugString.split("\n", 1)[1] for t in again.trees] == [t.toDebugString.split("\n", 1)[1] for t in ours.trees]
    theirs, ours = both(rows, "GBTRegressor", maxIter=8, maxDepth=4, subsamplingRate=0.8)
    assert rmse(ours) == pytest.approx(rmse(theirs), rel=0.1)


def test_forests_cut_out_of_a_larger_one_are_what_their_own_fit_gives(rows):
    def shown(model):
        return [re.sub(r"\d+\.\d+(E-?\d+)?", lambda x: f"{float(x[0]):.9g}", t.toDebugString.split("\n", 1)[1])
                for t in model.trees]

    est = TB.RandomForestRegressor(featuresCol="v", labelCol="y", seed=42, minInstancesPerNode=2)
    settings = [{"numTrees": k, "maxDepth": d} for k in (2, 4) for d in (2, 4)]
    for x, model in zip(settings, est.fit_cuts(rows, settings)):
        own = est.copy({est.getParam(k): v for k, v in x.items()}).fit(rows)
        assert shown(model) == shown(own) and model.getMaxDepth() == x["maxDepth"] and model.getNumTrees == x["numTrees"]
    assert len(est.fit_cuts(rows, [{"numTrees": 1, "maxDepth": 1}, {"numTrees": 2, "maxDepth": 1}])) == 2


def test_sums_of_siblings_are_read_for_the_lighter_one_only(rows, monkeypatch):
    """The last level apart, which needs the squares by cell."""
    seen, keep = [], TB.with_siblings
    monkeypatch.setattr(TB, "with_siblings", lambda sums, *a: seen.append(sums.shape[1]) or keep(sums, *a))
    TB.GBTRegressor(featuresCol="v", labelCol="y", seed=42, maxIter=1, maxDepth=4).fit(rows)
    assert seen == [1, 2]


def test_split_candidates_do_not_follow_a_column_of_the_same_seed(spark):
    df = spark.range(0, 60000, 1, 2).select(F.rand(42).alias("a"), F.rand(7).alias("y"))
    df = VectorAssembler(inputCols=["a"], outputCol="v").transform(df.withColumn("y", F.col("a") * 5))
    model = TB.RandomForestRegressor(featuresCol="v", labelCol="y", seed=42, numTrees=2, maxDepth=1).fit(df)
    cuts = [float(x) for t in model.trees for x in re.findall(r"<= (\d+\.\d+)", t.toDebugString)]
    assert len(cuts) == 2 and all(0.4 < x < 0.6 for x in cuts)


def test_weights_are_poisson_and_shares():
    w = TB.drawn(1.0, True)
    assert w.mean() == pytest.approx(1.0, abs=1e-3) and (w == 0).mean() == pytest.approx(np.exp(-1), abs=1e-4)
    assert w.var() == pytest.approx(1.0, abs=3e-3)
    assert TB.drawn(0.8, False).mean() == pytest.approx(0.8, abs=1e-4) and TB.drawn(1.0, False) is None


def test_bins_share_columns_and_come_back():
    layout = TB.Layout([np.array([0.5])] * 9 + [np.arange(1.0, 32.0), np.array([])])
    assert max(layout.widths) <= TB.SHARED and len(layout.widths) == 2
    x = np.random.default_rng(1).random((500, 11)) * np.array([1.0] * 9 + [33.0, 1.0])
    sums = {c: np.bincount(v, minlength=layout.widths[c]).astype(float) for c, v in enumerate(layout.encode(x))}
    got = layout.by_feature(sums, 1)[0]
    for f, t in enumerate(layout.thresholds):
        want = np.bincount(np.searchsorted(t, x[:, f], side="left"), minlength=len(t) + 1)
        assert (got[layout.start[f]:layout.start[f] + len(t) + 1] == want).all()


def test_the_training_run_grows_its_trees_from_blocks(rows, spark):
    made = TR.estimators({"numTrees": 3, "maxDepth": 2}, {"maxIter": 2, "maxDepth": 2})
    assert isinstance(made["RandomForestRegressor"], TB.RandomForestRegressor)
    assert isinstance(made["GBTRegressor"], TB.GBTRegressor)
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    both(rows, "GBTRegressor", maxIter=3, maxDepth=2)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    weighted = rows.withColumn("w", F.lit(1.0))                  # left to MLlib
    assert TB.GBTRegressor(featuresCol="v", labelCol="y", weightCol="w", maxIter=1, maxDepth=1).fit(weighted).getNumTrees == 1
