"""Sinks round trips (IO4-IO6, IO10)."""

import datetime as dt

from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression

from shopcast import sinks
from shopcast.operators import train as TR
from shopcast.operators.clean import in_years
from shopcast.sources.schemas import SALES_SCHEMA


def test_table_partitioned_by_year_and_pruned(spark, tmp_dir):
    rows = [(1, dt.date(y, 3, 1), 1, 100 * y, 1, 0, "O", 0) for y in (1999, 2000, 2001)]
    df = spark.createDataFrame(rows, SALES_SCHEMA)
    path = f"{tmp_dir}/clean"
    sinks.write_table(df, path)
    back = spark.read.parquet(path)
    assert sorted(r.year for r in back.select("year").collect()) == [1999, 2000, 2001]
    got = in_years(back, [2000])
    assert [r.sales_cents for r in got.collect()] == [200000]
    import io
    import contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain("formatted")
    assert "PartitionFilters" in buf.getvalue() and "year" in buf.getvalue()


def test_features_categories_and_model_round_trip(spark, tmp_dir):
    sinks.write_features(spark, ["b", "a", "c"], f"{tmp_dir}/features")
    assert sinks.read_features(spark, f"{tmp_dir}/features") == ["b", "a", "c"]
    cats = {"store_type": ["t1", "t2"], "day_of_week": ["1", "2", "3"]}
    sinks.write_categories(spark, cats, f"{tmp_dir}/cats")
    assert sinks.read_categories(spark, f"{tmp_dir}/cats") == cats
    df = spark.createDataFrame([(float(x), 3.0 * x) for x in range(20)], "x double, sales double")
    m = Pipeline(stages=TR.feature_stages(["x"]) + [LinearRegression(
        featuresCol="features_scaled", labelCol="sales")]).fit(df)
    sinks.save_model(m, f"{tmp_dir}/model")
    m2 = sinks.load_model(f"{tmp_dir}/model")
    a = [r.prediction for r in m.transform(df).collect()]
    b = [r.prediction for r in m2.transform(df).collect()]
    assert a == b


def test_forecast_export_names_the_run(spark, tmp_dir):
    fc = spark.createDataFrame(
        [(s, dt.date(2001, 11, 5) + dt.timedelta(days=i), 0, 1.5, 2) for s in (3, 7) for i in range(3)],
        "store long, date date, promo long, sales double, customers long")
    sinks.write_forecast(fc, f"{tmp_dir}/fc")
    back = spark.read.parquet(f"{tmp_dir}/fc")
    tags = {(r.store_tag, str(r.run_from), str(r.run_to)) for r in back.collect()}
    assert tags == {("S3-S7_2stores", "20011105", "20011107")}
    one = sinks.forecast_tags(fc.filter("store = 3")).first()
    assert one.store_tag == "S3"
    assert back.first().date == "2001-11-05" or len(back.first().date) == 10


def test_save_run_and_load_best_by_metadata(spark, tmp_dir):
    from shopcast.plans.modeling import load_best, save_run
    df = spark.createDataFrame([(float(x), 2.0 * x + 1.0) for x in range(30)], "x double, sales double")
    fit = Pipeline(stages=TR.feature_stages(["x"]) + [LinearRegression(
        featuresCol="features_scaled", labelCol="sales")]).fit(df)
    metrics = {"LinearRegression": TR.evaluate(fit, df),
               "Other": {"rmse": 99.0, "mae": 9.0, "r2": 0.1}}
    run = {"selected": ["x"], "cats": {"store_type": ["t1"]}, "metrics": metrics,
           "models": {"LinearRegression": fit}, "best": TR.best_model(metrics)}
    save_run(spark, run, f"{tmp_dir}/run")
    got = load_best(spark, f"{tmp_dir}/run")
    assert got["best"] == "LinearRegression" and got["features"] == ["x"]
    assert got["cats"] == {"store_type": ["t1"]}
    assert got["model"].transform(df).count() == 30
