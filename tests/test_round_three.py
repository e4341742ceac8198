"""Correlations without overflow, sparse one-hot, medians, split summary, folds, saved models."""

import contextlib
import datetime as dt
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopcast.operators import features as FE
from shopcast.operators import forecast as FC
from shopcast.operators import profile as PR
from shopcast.operators import train as TR
from shopcast.plans import modeling, reports
from shopcast.session import materialize, run_dir
from shopcast.sources.tables import daily_sales, last_day, stores

from conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


# -- M1, M2 ----------------------------------------------------------------------

def test_correlation_of_very_large_values(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 10 ** 15, 1000) + 10 ** 16
    y = x // 2 + rng.integers(0, 10 ** 14, 1000)
    df = spark.createDataFrame([(int(a), int(b), 7, i) for i, (a, b) in enumerate(zip(x, y))],
                               "a long, b long, same long, i long")
    want = round(float(np.corrcoef(x.astype(float), y.astype(float))[0, 1]), 4)
    got = {(r.column_a, r.column_b): r.r for r in PR.correlations(df, ["a", "b", "same", "i"]).collect()}
    assert got["a", "b"] == want and got["a", "same"] == got["same", "i"] == 0.0
    by = {r.feature: r.r for r in PR.correlation_with(df, "b", ["a", "same", "i"]).collect()}
    assert by["a"] == want and by["same"] == 0.0 and by["i"] == got["b", "i"]
    assert {r.column: r.std for r in PR.profile(df, ["a"]).collect()}["a"] == pytest.approx(x.std(ddof=1), rel=1e-12)


def test_correlation_of_few_rows(spark):
    empty = spark.createDataFrame([], "a long, b double")
    for df in (empty, empty.unionByName(spark.createDataFrame([(1, 2.0), (None, 3.0)], "a long, b double"))):
        assert [tuple(r) for r in PR.correlations(df, ["a", "b"]).collect()] == [("a", "b", 0.0)]
        assert [(r.feature, r.r) for r in PR.correlation_with(df, "b", ["a"]).collect()] == [("a", 0.0)]


# -- F5, A20 ---------------------------------------------------------------------

def test_sparse_vector_equals_dense_columns(spark):
    rows = [(1, dt.date(2001, 1, d), s, t) for d, s, t in
            [(1, "0", "a"), (2, "a", "b"), (3, None, "c"), (4, "b c", None), (5, "0", "c"), (6, "a", "zz")]]
    df = spark.createDataFrame(rows, "store long, date date, state_holiday string, store_type string")
    seen = df.filter("store_type <> 'zz' or store_type is null")
    drop = {"day_of_week": False, "state_holiday": True, "store_type": True}
    table = materialize(FE.category_table(FE.add_calendar(seen), tuple(drop)), "cats")
    out = FE.one_hot_vector(df, table, drop)
    assert out.columns[-1] == "one_hot" and out.count() == len(rows)
    cats = FE.categories(FE.add_calendar(seen), tuple(drop))
    dense = {r.date: [v for v in r[2:]] for r in FE.one_hot(df, cats, drop).collect()}
    assert {r.date: [int(v) for v in r.one_hot.toArray()] for r in out.collect()} == dense
    assert FE.one_hot_names(table, drop)[-2:] == ["store_type_b", "store_type_c"]


def test_a_hundred_thousand_categories(spark):
    """No list of values on the driver, vectors with one entry a column."""
    n = 100_000
    df = spark.range(2 * n).select(F.col("id").alias("store"), F.lit(dt.date(2001, 1, 1)).alias("date"),
                                   F.format_string("v%06d", F.col("id") % n).alias("assortment"))
    table = materialize(FE.category_table(df, ("assortment",)), "cats")
    out = FE.one_hot_vector(df, table, {"assortment": True}, "hot")
    hit = out.filter("store in (0, 1, 99999, 100001)").collect()
    got = {r.store: (r.hot.size, r.hot.indices.tolist()) for r in hit}
    assert got == {0: (n - 1, []), 1: (n - 1, [0]), 99_999: (n - 1, [n - 2]), 100_001: (n - 1, [0])}


def test_one_hot_without_categories(spark):
    df = spark.createDataFrame([(1, dt.date(2001, 1, 1), None)], "store long, date date, assortment string")
    table = FE.category_table(df, ("assortment",))
    assert [r.one_hot.size for r in FE.one_hot_vector(df, table, {"assortment": True}).collect()] == [0]


# -- P4, P5 ----------------------------------------------------------------------

def test_medians_of_each_store_are_exact(spark):
    rows = [(1, 10, 2), (1, 20, 0), (1, 31, 1), (1, None, None), (2, 7, 3), (2, 8, 3), (3, None, 1)]
    df = spark.createDataFrame(rows, "store long, sales_cents long, customers long")
    got = {r.store: (r.h_med, r.spc_median) for r in FC.store_medians(df).collect()}
    assert got == {1: (40, 0.05), 2: (15, (7 / 300 + 8 / 300) / 2), 3: (None, None)}


def test_history_medians_need_no_join_and_one_exchange(spark):
    rows = spark.createDataFrame([(1, 1.0, 0), (1, 4.0, 0), (1, None, 1), (2, None, 1), (3, 5.0, 1)],
                                 "store long, f double, w int")
    out = FC.filled(rows, ["f"], F.col("w") == 1)
    p = plan(out)
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2.5, 1), (2, 0.0, 1), (3, 5.0, 1)]
    assert "MergeJoin" not in p and "HashJoin" not in p and p.count("hashpartitioning(store") == 1


# -- A14, W6, T1 -----------------------------------------------------------------

def scans(spark, monkeypatch, module, run) -> tuple[list[str], str]:
    """All plans of a run: those of the tables it writes and its result's."""
    plans = []

    def recorded(df, name):
        plans.append(plan(df))
        return materialize(df, name)
    monkeypatch.setattr(module, "materialize", recorded)
    return plans, plan(run())


@pytest.mark.parametrize("name", ["report_below_mean", "report_cumulative"])
def test_reports_scan_the_lines_once(spark, monkeypatch, name):
    sales, dim = daily_sales(spark, SF_SMALL), stores(spark, SF_SMALL)
    run = {"report_below_mean": lambda: reports.report_below_mean(sales, dim),
           "report_cumulative": lambda: reports.report_cumulative(sales)}[name]
    written, result = scans(spark, monkeypatch, reports, run)
    lines = [p.count("lineitem.parquet]") for p in [*written, result]]
    assert sum(lines) == 1 and lines[-1] == 0


def test_split_counts_write_one_row_a_day(spark, monkeypatch):
    written = []
    monkeypatch.setattr(TR, "materialize", lambda df, name: written.append(df.columns) or materialize(df, name))
    days = [dt.date(2001, 1, d) for d in (1, 1, 1, 2, 2, 3, 4, 4, 4, 4)]
    df = spark.createDataFrame([(i, d, 1.0) for i, d in enumerate(days)], "store long, date date, x double")
    for fraction in (0.0, 0.05, 0.3, 0.45, 0.8, 1.0):
        cut, got = int(len(days) * fraction), {r.split: tuple(r)[1:] for r in TR.split_counts(df, fraction).collect()}
        sides = {"train": days[:cut], "test": days[cut:]}
        assert got == {k: (len(v), v[0], v[-1]) for k, v in sides.items() if v}
        label = {r.store: r.split for r in TR.split_label(df, fraction).collect()}
        assert label == {i: "train" if i < cut else "test" for i in range(len(days))}
    assert ["date", "c"] in written
    assert TR.split_counts(df.limit(0)).count() == 0


def test_last_day_reads_one_column(spark):
    assert last_day(spark, SF_SMALL) == daily_sales(spark, SF_SMALL).agg(F.max("date")).first()[0]


# -- T3, T4, IO5, IO6, P1 --------------------------------------------------------

def test_folds_do_not_depend_on_partitions(spark):
    df = daily_sales(spark, SF_SMALL).select("store", "date")
    a = {(r.store, r.date): r.fold for r in TR.with_folds(df.repartition(3)).collect()}
    assert a == {(r.store, r.date): r.fold for r in TR.with_folds(df.coalesce(1)).collect()}
    share = sum(a.values()) / len(a)
    assert set(a.values()) == {0, 1} and 0.45 < share < 0.55


def test_tuning_uses_the_fold_column(spark):
    df = spark.createDataFrame([(i, dt.date(2001, 1, 1 + i % 28), float(i % 7), float(3 * (i % 7))) for i in range(80)],
                               "store long, date date, x double, sales double")
    got = TR._tune(TR.RandomForestRegressor(featuresCol="features_scaled", labelCol="sales", seed=1),
                   {"numTrees": [1, 3], "maxDepth": [1, 3]}, df, ["x"], "sales", 1)
    assert set(got) == {"numTrees", "maxDepth"} and got["maxDepth"] == 3


def test_saved_run_scores_like_the_fitted_one(spark, tmp_dir):
    from shopcast.operators import clean as C
    history = materialize(C.clean_join(daily_sales(spark, SF_SMALL), stores(spark, SF_SMALL)), "clean")
    run, out = modeling.run_linear(history), run_dir(spark, "linear")
    modeling.save_run(spark, run, out)
    loaded = modeling.load_best(spark, out)
    assert loaded["best"] == run["best"] and loaded["features"] == run["selected"] and loaded["cats"] == run["cats"]
    day = last_day(spark, SF_SMALL)
    table = FC.future_design(history, str(day + dt.timedelta(1)), str(day + dt.timedelta(5)), loaded["cats"])
    a = {(r.scenario, r.store, r.date): r.pred_cents for r in FC.predict_with_model(loaded["model"], table).collect()}
    b = {(r.scenario, r.store, r.date): r.pred_cents
         for r in FC.predict_with_model(run["models"][run["best"]], table).collect()}
    assert a == b and len(a) > 0


def test_training_leaves_nothing_persisted(spark, monkeypatch):
    """Runs are kept by application and key; frames are released."""
    monkeypatch.setattr(TR, "tune_forest", lambda *a: {"numTrees": 1, "maxDepth": 1})
    monkeypatch.setattr(TR, "tune_boosted", lambda *a: {"maxIter": 1, "maxDepth": 1})
    from shopcast.operators import clean as C
    history = materialize(C.clean_join(daily_sales(spark, SF_SMALL), stores(spark, SF_SMALL)), "clean")
    spark.catalog.clearCache()
    run = modeling.run_training(history, key="kept")
    assert modeling.run_training(history, key="kept") is run
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
    assert set(run["metrics"]) == {"LinearRegression", "RandomForestRegressor", "GBTRegressor"}
    modeling._RUNS.clear()
