"""The training run shared by the model-based catalogue keys.

clean table -> features -> chronological split -> candidate columns ->
F-test selection -> tuning on a 10 % hashed sample -> three regressors ->
metrics -> best model.  Results are kept per input folder in this process,
so the comparison, importance and forecast keys train once.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.functions.exact import cents_to_units
from shopcast.operators import features as FE
from shopcast.operators import select as SE
from shopcast.operators import train as TR
from shopcast.session import materialize

_RUNS: dict[str, dict] = {}


def feature_run(clean: DataFrame, label: str = "sales") -> dict:
    """M3, M4: the written feature table, its candidates and the selected
    ones.  Selection runs over the whole feature table, as the original
    pipeline does (it selects before it splits)."""
    cats = FE.feature_categories(clean)
    feats = materialize(FE.build_features(clean, cats), "features")
    cands = SE.candidates(feats)
    return {"cats": cats, "features": feats, "candidates": cands,
            "selected": SE.select_features(feats, cands, label)}


def run_training(clean: DataFrame, key: str | None = None, label: str = "sales",
                 parallelism: int = 4, partitions: int | None = None) -> dict:
    """Everything from features to the best model.  With a ``key`` the run
    (fitted models, metrics, the path of the feature table) is kept for as
    long as the Spark application lives; no frame stays persisted."""
    if key is not None:
        key = f"{clean.sparkSession.sparkContext.applicationId}:{key}"
        if key in _RUNS:
            return _RUNS[key]
    run = feature_run(clean, label)
    # the written table is read again for each pass: MLlib keeps its own binned rows
    # while it grows trees, and a cache of the wide rows would push those to disk
    train, test = (TR.dealt(x.select("store", "date", *run["selected"], label), partitions)
                   for x in TR.chronological_split(run["features"], 0.8, materialize_input=False))
    sample = TR.fit_input(TR.tuning_sample(train))
    try:
        rf = TR.tune_forest(sample, run["selected"], label, parallelism)
        gbt = TR.tune_boosted(sample, run["selected"], label, parallelism)
    finally:
        sample.unpersist()
    models, metrics = TR.train_all(train, test, run["selected"], rf, gbt, label)
    run |= {"rf": rf, "gbt": gbt, "models": models, "metrics": metrics, "best": TR.best_model(metrics)}
    if key is not None:
        _RUNS[key] = run
    return run


#: What the linear run learns from: columns that are known for a future day.
LINEAR_FEATURES = ("promo", "is_weekend", "month", "school_holiday")
LINEAR_CATEGORICAL = ("store_type", "assortment")


def run_linear(clean: DataFrame, label: str = "sales") -> dict:
    """Two ridge models on columns that are known in advance: the calendar,
    promo and store columns, and promo alone.  Same stages, split, settings
    and metrics as the training run, with results that can be had in closed
    form."""
    rows = clean.filter((F.col("open") == 1) & (F.col("sales_cents") > 0))
    cats = FE.categories(rows, LINEAR_CATEGORICAL)
    rows = FE.add_calendar(rows).select(
        "store", "date", *LINEAR_FEATURES, *FE.one_hot_columns(cats, FE.DROP_FIRST),
        cents_to_units(F.col("sales_cents")).alias(label))
    features = [c for c in rows.columns if c not in ("store", "date", label)]
    # the rows are a narrow projection of a written table: no second copy of it
    train, test = TR.chronological_split(rows, 0.8, materialize_input=False)
    inputs = {"known": features, "promo": features[:1]}

    def fit(name: str):
        model = Pipeline(stages=[*TR.feature_stages(inputs[name]), TR.linear_regression(label)]).fit(train)
        return model, TR.evaluate(model, test, label)

    # at once, so that the cores a pass of one leaves idle serve the other
    with ThreadPool(len(inputs)) as pool:
        fitted = dict(zip(inputs, pool.map(inheritable_thread_target(clean.sparkSession)(fit), inputs)))
    models, metrics = ({name: x[i] for name, x in fitted.items()} for i in (0, 1))
    best = TR.best_model(metrics)
    return {"cats": cats, "selected": inputs[best], "models": models, "metrics": metrics, "best": best}


def save_run(spark, run: dict, out_dir: str) -> None:
    """IO5 + IO6: keep what scoring needs next to the best model: the chosen
    feature list, the one-hot category table, the model comparison (which
    names the best model) and the best fitted pipeline."""
    from shopcast import sinks
    sinks.write_features(spark, run["selected"], f"{out_dir}/features")
    sinks.write_categories(spark, run["cats"], f"{out_dir}/categories")
    TR.model_comparison(spark, run["metrics"]).coalesce(1).write.mode("overwrite").parquet(
        f"{out_dir}/comparison")
    sinks.save_model(run["models"][run["best"]], f"{out_dir}/models/{run['best']}")


def load_best(spark, out_dir: str) -> dict:
    """Load the best model by the stored comparison, not by a fixed path."""
    from shopcast import sinks
    best = (spark.read.parquet(f"{out_dir}/comparison").filter("best")
            .select("model").first()["model"])
    return {"best": best,
            "model": sinks.load_model(f"{out_dir}/models/{best}"),
            "features": sinks.read_features(spark, f"{out_dir}/features"),
            "cats": sinks.read_categories(spark, f"{out_dir}/categories")}
