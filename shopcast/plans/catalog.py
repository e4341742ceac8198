"""The query catalogue: one callable per implemented operator.

Each entry takes ``(spark, sf_dir)``, reads the driver tables of that
directory (whole tables, no sampling) and returns a DataFrame whose column
names match the oracle text of the same key in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopcast.operators import clean as C
from shopcast.operators import features as FE
from shopcast.operators import forecast as FC
from shopcast.operators import profile as PR
from shopcast.operators import train as TR
from shopcast.operators import scoring as SC
from shopcast.operators.clean import in_years
from shopcast.plans import reports as R
from shopcast.plans import roundtrips as RT
from shopcast.sources.tables import daily_sales, last_day, stores

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values chosen for the driver tables (history runs 1995-01-02 to
# 2001-11-04): the quarter report compares 2000 and 2001.
QUARTER_YEARS = (2000, 2001)
KPI_FROM, KPI_TO = "1997-03-01", "2000-10-31"
PROFILE_COLS = ["sales_cents", "customers", "open", "promo", "school_holiday"]
CORR_COLS = ["store", "open", "customers", "promo", "school_holiday",
             "competition_distance"]


def _clean(spark, d):
    return C.clean_join(daily_sales(spark, d), stores(spark, d))


def _impute(spark, d):
    return C.impute_median(stores(spark, d), "competition_distance")


def _both(fn):
    return lambda spark, d: fn(daily_sales(spark, d), stores(spark, d))


def _sales(fn):
    return lambda spark, d: fn(daily_sales(spark, d))


BASELINE_UNTIL, STREAM_YEAR = 2000, 2001
# Fixed value: days in the forecast horizon.
HORIZON_DAYS = 30


def _horizon(spark, d):
    """First and last forecast day: the days after the last history day, the
    largest value of one column of the raw table."""
    last = last_day(spark, d)
    return str(last + timedelta(days=1)), str(last + timedelta(days=HORIZON_DAYS))


def _clean_table(spark, d):
    """The cleaned history written once to the shared folder (as the
    pipeline's cleaning step does), so the many references of a forecast
    plan read one Parquet table instead of re-aggregating line items."""
    from shopcast.session import materialize
    return materialize(_clean(spark, d), "clean")


def _history_table(spark, d):
    """The cleaned history without the holiday columns, which no forecast
    reads: the day's status text is the one aggregate that has to sort."""
    from shopcast.session import materialize
    return materialize(_clean(spark, d).drop("state_holiday", "school_holiday"), "history")


def _hist(spark, d):
    return FC.cut_history(daily_sales(spark, d), _horizon(spark, d)[0])


def _cycle(spark, d):
    return FC.suggest_cycle(FC.promo_streaks(_hist(spark, d)))


def _pattern(spark, d):
    return FC.promo_pattern(_cycle(spark, d), *_horizon(spark, d))


def _forecast(spark, d):
    return FC.forecast_reference(_history_table(spark, d), *_horizon(spark, d))


def _future_rows(spark, d):
    history, days = _history_table(spark, d), _horizon(spark, d)
    cycle = FC.suggest_cycle(FC.promo_streaks(FC.cut_history(history, days[0])))
    return FC.future_rows(history, FC.promo_pattern(cycle, *days), *days)


def _future_features_gaps(spark, d):
    """P5 at work: a third of the last ten days has no figures."""
    start, end = _horizon(spark, d)
    gap = (F.datediff(F.lit(start).cast("date"), "date") <= 10) & ((F.col("store") + F.dayofmonth("date")) % 3 == 0)
    history = _history_table(spark, d)
    planted = history.withColumns({c: F.when(~gap, F.col(c)) for c in ("sales_cents", "customers")})
    return FC.future_features(planted, start, end)


CATEGORY_COLUMNS = ("day_of_week",) + FE.CATEGORICAL


def _categories(spark, d):
    seen = C.join_stores(FE.category_rows(daily_sales(spark, d)), stores(spark, d))
    return FE.category_table(seen, CATEGORY_COLUMNS)


def _one_hot(spark, d):
    """The days' statuses are written once, for the category table and for
    the rows that are encoded with it."""
    from shopcast.session import materialize
    days = materialize(daily_sales(spark, d).select("store", "date", "state_holiday"), "statuses")
    dim = stores(spark, d)
    table = materialize(FE.category_table(C.join_stores(FE.category_rows(days), dim), CATEGORY_COLUMNS), "categories")
    return FE.one_hot_wide(C.join_stores(days, dim), table)


def _split(spark, d):
    feats = FE.build_features(_clean(spark, d), cats={})   # which rows stay, not which columns
    return TR.split_counts(feats, 0.8)


def _until(year):
    return f"{year + 1:04d}-01-01"


def _year_sales(spark, d, year):
    """The fact rows of one year, the range pushed to the scan."""
    return in_years(daily_sales(spark, d, f"{year:04d}-01-01", _until(year)), year)


def _baseline(spark, d):
    hist = daily_sales(spark, d, date_to=_until(BASELINE_UNTIL))
    return SC.store_baseline(hist, BASELINE_UNTIL)


def _anoms(spark, d):
    return SC.anomalies(SC.score(_year_sales(spark, d, STREAM_YEAR), _baseline(spark, d)))


STREAM_FILES = 16


def _stream_out(spark, d):
    """One year as a table with a folder and file for each seven days, scored
    by the stream, ``STREAM_FILES`` files to a trigger and a trigger as soon
    as the last one is done; the output folder."""
    from shopcast.session import run_dir
    from shopcast.sinks.tables import write_table
    from shopcast.streaming.anomaly import score_directory
    base = run_dir(spark, "stream")
    facts = _year_sales(spark, d, STREAM_YEAR).withColumn("part", F.floor((F.dayofyear("date") - 1) / 7))
    write_table(facts.repartition("part"), f"{base}/input", partition_by=("part",))
    return score_directory(spark, f"{base}/input", _baseline(spark, d), f"{base}/out", f"{base}/checkpoint",
                           max_files=STREAM_FILES, trigger="0 seconds")


def _stream_scored(spark, d):
    from shopcast.streaming.anomaly import read_scored
    return read_scored(spark, _stream_out(spark, d))


def _stream_anomalies(spark, d):
    from shopcast.streaming.anomaly import read_anomalies
    return read_anomalies(spark, _stream_out(spark, d))


def _stream_totals(spark, d):
    from shopcast.streaming.anomaly import stream_totals
    return stream_totals(spark, _stream_out(spark, d))


def _report(data, columns, chosen, label):
    from shopcast.operators import select as SE
    return SE.feature_report(data, columns, chosen, label).withColumn("f_stat", F.round("f_stat", 2))


def _f_tests(spark, d):
    """M3-M5 on the cleaned numeric columns: MLlib's F-test and the report."""
    from shopcast.operators import select as SE
    from shopcast.session import materialize
    data = materialize(_clean(spark, d).select(*CORR_COLS, "sales_cents"), "numbers")
    columns = SE.candidates(data, ("sales_cents",))
    return _report(data, columns, SE.select_features(data.na.drop(), columns, "sales_cents"), "sales_cents")


def _fold_rows(spark, d):
    """The tuning sample of the open days, with folds and weekdays."""
    rows = daily_sales(spark, d).filter("open = 1 and sales_cents > 0")
    return TR.with_folds(FE.add_calendar(TR.tuning_sample(rows)))


def _fold_counts(spark, d):
    return _fold_rows(spark, d).groupBy("fold").agg(
        F.count("*").alias("n"), F.min("date").alias("first_date"), F.sum("sales_cents").alias("sales_cents"))


def _fold_metrics(spark, d):
    m = TR.fold_metrics(_fold_rows(spark, d))
    return m.select("fold", "n", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])


def _mean_metrics(spark, d):
    """The metrics of a fixed predictor, each store's mean open day in
    whole cents up to 2000, on its open days of 2001."""
    base = _baseline(spark, d).select("store", F.round(F.col("base_mean") * 100).alias("prediction"))
    test = _year_sales(spark, d, STREAM_YEAR).filter("open = 1 and sales_cents > 0").join(base, "store")
    m = TR.regression_metrics(test, "sales_cents")
    return m.select("n", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])


def _run(spark, d, clean=None):
    from shopcast.plans.modeling import run_training
    return run_training(clean or _clean_table(spark, d), key=d)


def _feature_report(spark, d):
    """M3-M5 on the whole feature table; needs no training."""
    from shopcast.plans.modeling import feature_run
    r = feature_run(_clean_table(spark, d))
    return _report(r["features"], r["candidates"], r["selected"], "sales")


def _linear(spark, d, *unread: str):
    """A linear run, saved and loaded again (IO5, IO6): (history, run, loaded).

    ``unread``: columns that the caller doesn't read.  The run reads neither
    the status text nor the customers, and a distinct count of customers is
    a second shuffle of all lines."""
    from shopcast.plans import modeling
    from shopcast.session import materialize, run_dir
    history = materialize(_clean(spark, d).drop("state_holiday", *unread), "history")
    out = run_dir(spark, "linear")
    run = modeling.run_linear(history)
    modeling.save_run(spark, run, out)
    return history, run, modeling.load_best(spark, out)


def _linear_comparison(spark, d):
    m = TR.model_comparison(spark, _linear(spark, d, "customers")[1]["metrics"])
    return m.select("model", *[F.round(c, 4).alias(c) for c in ("rmse", "mae", "r2")], "best")


def _linear_importance(spark, d):
    """T8 of the loaded model, by the loaded feature list."""
    loaded = _linear(spark, d, "customers")[2]
    return TR.importance(spark, loaded["best"], loaded["model"], loaded["features"]).withColumn(
        "importance", F.round("importance", 4))


def _linear_forecast(spark, d):
    """P1 with the loaded model and the loaded categories, then P6."""
    history, _, loaded = _linear(spark, d)
    days = _horizon(spark, d)
    table = FC.future_design(history, *days, loaded["cats"])
    return FC.forecast_design(history, table, loaded["model"], days[0]).drop("sales_cents")


def _model_comparison(spark, d):
    return TR.model_comparison(spark, _run(spark, d)["metrics"])


def _importance(spark, d):
    r = _run(spark, d)
    frames = [TR.importance(spark, n, m, r["selected"]) for n, m in r["models"].items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _forecast_model(spark, d):
    clean = _clean_table(spark, d)
    r = _run(spark, d, clean)
    return FC.forecast_with_model(clean, r["models"][r["best"]], r["cats"],
                                  *_horizon(spark, d)).drop("sales_cents")


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "report_store_type": _both(R.report_store_type),
        "report_promo_effect": _sales(R.report_promo_effect),
        "report_month": _sales(R.report_month),
        "report_top_stores": _both(lambda s, st: R.report_top_stores(s, st, 3)),
        "report_growth": _sales(R.report_growth),
        "report_below_mean": _both(lambda s, st: R.report_below_mean(s, st, 20)),
        "report_weekday": _sales(R.report_weekday),
        "report_competition": _both(R.report_competition),
        "report_cumulative": _sales(lambda s: R.report_cumulative(s, 5)),
        "report_quarter": lambda spark, d: R.report_quarter(
            daily_sales(spark, d, f"{min(QUARTER_YEARS):04d}-01-01", _until(max(QUARTER_YEARS))),
            stores(spark, d), QUARTER_YEARS),
        "report_quartiles": _sales(R.report_quartiles),
        "report_closures": _both(R.report_closures),
        "network_kpis": _sales(lambda s: R.network_kpis(s, KPI_FROM, KPI_TO)),
        "null_counts": lambda spark, d: C.null_counts(stores(spark, d)),
        "null_counts_sales": lambda spark, d: C.null_counts(daily_sales(spark, d)),
        "impute_distance": _impute,
        "fill_defaults": lambda spark, d: C.clean_stores(stores(spark, d)),
        "clean_join": _clean,
        "sales_by_day": _sales(PR.sales_by_day),
        "promo_sales_by_day": _sales(PR.promo_sales_by_day),
        "sales_by_weekday": _sales(PR.sales_by_weekday),
        "sales_by_month": _sales(PR.sales_by_month),
        "profile": _sales(lambda s: PR.profile(s, PROFILE_COLS)),
        "histogram_sales": _sales(lambda s: PR.histogram(s, 50)),
        "histogram_log_sales": _sales(lambda s: PR.histogram(s, 50, log=True)),
        "correlation_with_sales": lambda spark, d: PR.correlation_with(
            _clean(spark, d), "sales_cents", CORR_COLS),
        "calendar_features": _sales(FE.calendar_features),
        "one_hot": _one_hot,
        "lags": _sales(lambda s: FE.add_lags(s).select(
            "store", "date", *[f"{p}_lag_{k}" for k in FE.LAGS
                               for p in ("sales", "customers")])),
        "rolling_open": _sales(lambda s: FE.add_rolling(s.filter("open = 1")).select(
            "store", "date", *FE.rolling_columns().keys())),
        "rolling_full": _sales(lambda s: FE.add_rolling(s, full=True).select(
            "store", "date", *FE.rolling_columns().keys())),
        "store_baseline": lambda spark, d: _baseline(spark, d).select(
            "store", "base_mean", "base_std", "base_count"),
        "scored": lambda spark, d: SC.scored_year(_year_sales(spark, d, STREAM_YEAR),
                                                  _baseline(spark, d), STREAM_YEAR),
        "anomalies": _anoms,
        "top_anomalies": lambda spark, d: SC.top_anomalies(_anoms(spark, d), 15),
        "anomaly_summary": lambda spark, d: SC.anomaly_summary(_anoms(spark, d)),
        "stream_scored": _stream_scored,
        "stream_anomalies": _stream_anomalies,
        "correlation_matrix": lambda spark, d: PR.correlations(
            _clean(spark, d), CORR_COLS + ["sales_cents"]),
        "categories": _categories,
        "eligible_stores": lambda spark, d: FC.eligible_stores(_hist(spark, d)),
        "forecast_detail": lambda spark, d: FC.forecast_detail(_forecast(spark, d)),
        "promo_streaks": lambda spark, d: FC.promo_streaks(_hist(spark, d)),
        "suggest_cycle": _cycle,
        "promo_pattern": _pattern,
        "customers_by_weekday": lambda spark, d: FC.customers_by_weekday(_hist(spark, d)),
        "basket": lambda spark, d: FC.basket(_hist(spark, d)),
        "future_rows": _future_rows,
        "future_features": lambda spark, d: FC.future_features(
            _history_table(spark, d), *_horizon(spark, d)),
        "future_features_gaps": _future_features_gaps,
        "forecast": lambda spark, d: _forecast(spark, d).drop("sales_cents"),
        "uplift": lambda spark, d: FC.uplift(_forecast(spark, d)),
        "extra_staff": lambda spark, d: FC.extra_staff(_forecast(spark, d)),
        "forecast_kpis": lambda spark, d: FC.forecast_kpis(_forecast(spark, d)),
        "split_counts": _split,
        "written_table": lambda spark, d: RT.written_table(_clean(spark, d)),
        "sql_views": lambda spark, d: RT.sql_views(spark, daily_sales(spark, d), stores(spark, d)),
        "csv_sales": _sales(RT.csv_sales),
        "csv_stores": lambda spark, d: RT.csv_stores(stores(spark, d)),
        "date_rejects": _sales(RT.date_rejects),
        "forecast_export": lambda spark, d: RT.exported_forecast(_forecast(spark, d)),
        "sales_per_customer": _sales(lambda s: C.sales_per_customer(s).select(
            "store", "date", "sales_per_customer")),
        "drop_incomplete": lambda spark, d: C.drop_incomplete(stores(spark, d)),
        "stream_totals": _stream_totals,
        "tuning_sample": _sales(TR.tuning_sample),
        "mean_metrics": _mean_metrics,
        "f_tests": _f_tests,
        "fold_counts": _fold_counts,
        "fold_metrics": _fold_metrics,
        "linear_comparison": _linear_comparison,
        "linear_importance": _linear_importance,
        "linear_forecast": _linear_forecast,
        "feature_report": _feature_report,
        "model_comparison": _model_comparison,
        "importance": _importance,
        "forecast_model": _forecast_model,
    }
    return q
