"""Forecasting for all stores at once.

History and future rows of every store are one DataFrame.  Future sales
placeholders are the store's median (never an earlier prediction), so every
lag and rolling feature of a future day is an ordinary window over
history ∪ future, partitioned by store: no per-day loop, no per-store
driver round trip, one prediction pass for all stores and both scenarios.
Sales in these windows are integer half-cents (2 x cents), because a median
of cents may end in .5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopcast.functions.calendar import calendar_dict, date_range, day_of_week
from shopcast.functions.exact import cents_to_units, dec, moment_std, round_ratio
from shopcast.operators.features import LAGS, WINDOWS, by_store
from shopcast.operators.joins import lookup_with_default

col = F.col

# Fallback promo cycle, default basket, customers per staff
# member, and the history needed before a store is forecast.
DEFAULT_ON, DEFAULT_OFF = 5, 9
DEFAULT_BASKET = 10.0
CUSTOMERS_PER_STAFF = 100
MIN_HISTORY = 20
#: History rows in a task that sorts the rows of its stores.
TASK_ROWS = 1 << 18
STATIC_COLUMNS = ("store_type", "assortment", "competition_distance", "promo_interval")


# ---------------------------------------------------------------- history
def cut_history(history: DataFrame, start: str) -> DataFrame:
    """History strictly before the first forecast day (no duplicate dates)."""
    return history.filter(col("date") < F.lit(start).cast("date"))


def eligible_stores(history: DataFrame, n: int = MIN_HISTORY) -> DataFrame:
    """P10: stores with at least ``n`` history rows."""
    return history.groupBy("store").agg(F.count("*").alias("n_history")).filter(
        col("n_history") >= n).select("store")


def check_range(start: str, end: str) -> None:
    """P10: the end of the horizon may not precede its start."""
    if str(end) < str(start):
        raise ValueError(f"forecast end {end} is before start {start}")


def customers_by_weekday(history: DataFrame) -> DataFrame:
    """Mean customers per store and weekday."""
    g = history.groupBy("store", day_of_week("date").alias("day_of_week")).agg(
        F.count("customers").alias("n"), F.sum(dec(col("customers"))).alias("c"))
    return g.select("store", "day_of_week",
                    (col("c").cast("double") / col("n").cast("double")).alias("avg_customers"))


def basket(history: DataFrame) -> DataFrame:
    """Euros per customer by store, weekday and promo: a ratio of sums
    over days with customers."""
    g = history.filter(col("customers") > 0).groupBy(
        "store", day_of_week("date").alias("day_of_week"),
        col("promo").cast("long").alias("promo")).agg(
        F.sum(dec(col("sales_cents"))).alias("s"), F.sum(dec(col("customers"))).alias("c"))
    return g.select("store", "day_of_week", "promo",
                    (col("s").cast("double") / (col("c") * 100).cast("double")).alias("basket"))


# ---------------------------------------------------------------- promo cycle
def promo_streaks(history: DataFrame) -> DataFrame:
    """Runs of equal promo value per store (gaps and islands)."""
    w = by_store()
    change = F.when(F.lag("promo").over(w) == col("promo"), 0).otherwise(1)
    runs = history.select("store", "date", col("promo").cast("long").alias("promo"),
                          change.alias("chg"))
    runs = runs.withColumn("run_id", F.sum("chg").over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("long"))
    return runs.groupBy("store", "run_id").agg(
        F.min("promo").alias("promo"), F.min("date").alias("start_date"),
        F.max("date").alias("end_date"), F.count("*").alias("length"))


def suggest_cycle(streaks: DataFrame, default_on: int = DEFAULT_ON,
                  default_off: int = DEFAULT_OFF) -> DataFrame:
    """Most common on-run and off-run length per store (ties -> the
    shorter run); a store lacking either kind of run gets the default pair."""
    counts = streaks.groupBy("store", "promo", "length").agg(F.count("*").alias("k"))
    mode = counts.groupBy("store", "promo").agg(
        F.max(F.struct(col("k"), (-col("length")).alias("neg"))).alias("m"))
    per = mode.groupBy("store").agg(
        F.max(F.when(col("promo") == 1, -col("m.neg"))).alias("on"),
        F.max(F.when(col("promo") == 0, -col("m.neg"))).alias("off"))
    both = col("on").isNotNull() & col("off").isNotNull()
    return per.select("store",
                      F.when(both, col("on")).otherwise(default_on).cast("long").alias("days_on"),
                      F.when(both, col("off")).otherwise(default_off).cast("long").alias("days_off"))


def promo_pattern(cycle: DataFrame, start: str, end: str) -> DataFrame:
    """Repeat ``days_on`` promo days then ``days_off`` days from ``start``."""
    check_range(start, end)
    rows = cycle.select("store", "days_on", "days_off", date_range(start, end).alias("date"))
    pos = F.datediff(col("date"), F.lit(start).cast("date"))
    period = col("days_on") + col("days_off")
    return rows.select("store", "date", F.when(F.pmod(pos, period) < col("days_on"), 1)
                       .otherwise(0).cast("long").alias("promo"))


# ---------------------------------------------------------------- future rows
def last_static(history: DataFrame, cols=STATIC_COLUMNS) -> DataFrame:
    """Static store attributes from each store's last history row."""
    have = [c for c in cols if c in history.columns]
    if not have:
        return history.select("store").distinct()
    last = history.groupBy("store").agg(
        F.max_by(F.struct(*have), col("date")).alias("s"))
    return last.select("store", *[col(f"s.{c}").alias(c) for c in have])


def future_calendar(stores: DataFrame, start: str, end: str) -> DataFrame:
    """one row per store and day of the horizon (a generator per store
    row; the horizon length is a parameter, not data)."""
    check_range(start, end)
    return stores.select("store", date_range(start, end).alias("date"))


def future_rows(history: DataFrame, promo: DataFrame, start: str, end: str) -> DataFrame:
    """Calendar parts, promo and interactions, holidays 0, static
    attributes from the last history row, for eligible stores.
    ``promo`` holds (store, date, promo) for the horizon (P3 or all 0)."""
    hist = cut_history(history, start)
    base = future_calendar(eligible_stores(hist), start, end)
    rows = base.join(promo, ["store", "date"]).withColumns(calendar_dict("date"))
    rows = rows.withColumns({
        "promo_weekend": (col("promo") * col("is_weekend")).cast("long"),
        "promo_month": (col("promo") * col("month")).cast("long"),
        "state_holiday": F.lit("0"), "school_holiday": F.lit(0).cast("long")})
    return rows.join(last_static(hist), "store", "left")


def sales_per_customer_ratio() -> Column:
    """Euros per customer of a day, 0 without customers."""
    return F.when(col("customers") == 0, F.lit(0.0)).otherwise(
        col("sales_cents").cast("double") / (col("customers") * 100).cast("double"))


def store_medians(history: DataFrame) -> DataFrame:
    """Per store the exact medians of sales (in half-cents, so that a middle
    between two cents stays whole) and of sales per customer, in one
    aggregate that holds a store's distinct values of a day's figures."""
    return history.groupBy("store").agg(
        (F.median("sales_cents") * 2).cast("long").alias("h_med"),
        F.median(sales_per_customer_ratio()).alias("spc_median"))


def store_partitions(history: DataFrame) -> int:
    """Partitions by store in proportion to the history: a task that sorts
    whole stores holds about ``TASK_ROWS`` rows however long the table is
    and whatever the session's number of shuffle partitions."""
    return max(history.sparkSession.sparkContext.defaultParallelism, -(-history.count() // TASK_ROWS))


def future_features(history: DataFrame, start: str, end: str,
                    min_history: int = MIN_HISTORY) -> DataFrame:
    """P4 + P5: lag, rolling and ratio features of every future day.

    Future sales = the store's median; future customers are unknown, so a
    customer lag that lands on a future (or missing) row takes the store's
    mean customers for the *current* row's weekday, else 0.  Rolling std is
    0 under two rows.  Sales per customer = sales lag 1 / customers lag 1,
    or the store's median history ratio when that lag is 0.

    As in training, lags run over all days and rolling frames over open
    days.  Everything that a row needs of its store comes by windows over
    one exchange by store: lags by date, frames by (open, date), the mean
    customers of the weekday, and the medians of P5.  Only the store's
    median sales must be known before its future rows are made.  ``history``
    is counted first, so it had better be a written table.
    """
    hist = cut_history(history, start)
    fut = future_calendar(eligible_stores(hist, min_history), start, end).join(store_medians(hist), "store").select(
        "store", "date", col("h_med").alias("h"), F.lit(None).cast("long").alias("customers"),
        F.lit(1).alias("open"), "spc_median", F.lit(1).alias("is_future"))
    past = hist.select("store", "date", (col("sales_cents") * 2).alias("h"), "customers", "open",
                       F.lit(None).cast("double").alias("spc_median"), F.lit(0).alias("is_future"))
    # stores without future rows go last, with ``filled``
    u = past.unionByName(fut).withColumn("day_of_week", day_of_week("date"))
    u = u.repartition(store_partitions(hist), "store")
    w = by_store()
    feats, rolled = {}, {}
    for k in LAGS:
        feats[f"_hl{k}"] = F.lag("h", k).over(w)
        feats[f"_cl{k}"] = F.lag("customers", k).over(w)
    for wd in WINDOWS:
        fr = Window.partitionBy("store", "open").orderBy("date").rowsBetween(-wd, -1)
        rolled[f"_n{wd}"] = F.count("h").over(fr)
        rolled[f"_s{wd}"] = F.sum(dec(col("h"))).over(fr)
        rolled[f"_q{wd}"] = F.sum(dec(col("h")) * dec(col("h"))).over(fr)
        rolled[f"_m{wd}"] = F.max("h").over(fr)
    weekday = Window.partitionBy("store", "day_of_week")
    mean = F.sum(dec(col("customers"))).over(weekday).cast("double") / F.when(
        F.count("customers").over(weekday) > 0, F.count("customers").over(weekday)).cast("double")
    u = (u.withColumns(feats).withColumn("avg_customers", mean).withColumns(rolled).filter("open = 1")
         .withColumn("spc_median", F.max("spc_median").over(Window.partitionBy("store"))))
    out = [col("store"), col("date")]
    for k in LAGS:
        out.append((col(f"_hl{k}").cast("double") / 200.0).alias(f"sales_lag_{k}"))
        out.append(F.coalesce(col(f"_cl{k}").cast("double"), col("avg_customers"),
                              F.lit(0.0)).alias(f"customers_lag_{k}"))
    for wd in WINDOWS:
        n, s, q, m = (col(f"_{x}{wd}") for x in "nsqm")
        out.append(F.when(n > 0, s.cast("double") / (n * 200).cast("double"))
                   .alias(f"sales_roll_mean_{wd}"))
        out.append(F.when(n > 1, moment_std(n, s, q) / 200.0).otherwise(F.lit(0.0))
                   .alias(f"sales_roll_std_{wd}"))
        out.append(F.when(n > 0, m.cast("double") / 200.0).alias(f"sales_roll_max_{wd}"))
    r = u.select(*out, "spc_median", "is_future")
    ratio = F.when(col("customers_lag_1") != 0, col("sales_lag_1") / col("customers_lag_1"))
    r = r.withColumn("sales_per_customer", F.coalesce(ratio, col("spc_median"))).drop("spc_median")
    names = [c for c in r.columns if c not in ("store", "date", "is_future")]
    return filled(r, names, col("is_future") == 1).drop("is_future")


def filled(rows: DataFrame, cols: list[str], wanted: Column) -> DataFrame:
    """P5: the ``wanted`` rows, where a feature that is still null takes the
    exact median of that column over the store's other rows, else 0.

    The medians run over each store's partition, in the exchange by store
    that the features already have (at most one value per history day and
    column), so no row is joined back."""
    per_store = Window.partitionBy("store")
    medians = {f"_med_{c}": F.median(F.when(~wanted, col(c))).over(per_store) for c in cols}
    out = rows.withColumns(medians).filter(wanted)
    return out.withColumns({c: F.coalesce(col(c), col(f"_med_{c}"), F.lit(0.0)) for c in cols}).drop(*medians)


def fill_from_history(df: DataFrame, cols: list[str], history: DataFrame | None = None) -> DataFrame:
    """P5 for rows and a history that are two tables; without a history, 0."""
    if history is None:
        return df.na.fill(0.0, subset=cols)
    both = df.withColumn("_wanted", F.lit(True)).unionByName(
        history.withColumn("_wanted", F.lit(False)), allowMissingColumns=True)
    return filled(both, cols, col("_wanted")).select(df.columns)


# ---------------------------------------------------------------- scenarios
def scenario_promos(history: DataFrame, start: str, end: str,
                    cycle: DataFrame | None = None) -> DataFrame:
    """P7 input: (scenario, store, date, promo) for 'base' (no promo) and
    'promo' (the store's suggested or given cycle)."""
    hist = cut_history(history, start)
    elig = eligible_stores(hist)
    cyc = cycle if cycle is not None else suggest_cycle(promo_streaks(hist))
    cyc = cyc.join(elig, "store", "left_semi")
    promo = promo_pattern(cyc, start, end).withColumn("scenario", F.lit("promo"))
    base = future_calendar(elig, start, end).select(
        "store", "date", F.lit(0).cast("long").alias("promo"), F.lit("base").alias("scenario"))
    return base.unionByName(promo)


def weekday_promo_means(history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A data-driven reference predictor: each store's mean sales of open
    days by (weekday, promo), rounded to the cent, with the store's open-day
    mean as fallback.  Exact and SQL-checkable; the MLlib model is the
    production predictor (``predict_with_model``)."""
    od = history.filter((col("open") == 1) & (col("sales_cents") > 0))
    by = od.groupBy("store", day_of_week("date").alias("day_of_week"),
                    col("promo").cast("long").alias("promo")).agg(
        round_ratio(F.sum(dec(col("sales_cents"))), F.count("*")).alias("pred_cents"))
    overall = od.groupBy("store").agg(
        round_ratio(F.sum(dec(col("sales_cents"))), F.count("*")).alias("store_cents"))
    return by, overall


def predict_reference(history: DataFrame, promos: DataFrame, start: str) -> DataFrame:
    """P1 with the reference predictor: (scenario, store, date, promo,
    pred_cents)."""
    hist = cut_history(history, start)
    by, overall = weekday_promo_means(hist)
    p = (promos.withColumn("day_of_week", day_of_week("date"))
         .join(by, ["store", "day_of_week", "promo"], "left").join(overall, "store", "left"))
    return p.select("scenario", "store", "date", "promo", "day_of_week",
                    F.coalesce(col("pred_cents"), col("store_cents"), F.lit(0))
                    .cast("long").alias("pred_cents"))


def finish_forecast(pred: DataFrame, history: DataFrame, start: str) -> DataFrame:
    """P6 + J6: sales clipped at 0; customers = int(sales / basket) for the
    (weekday, promo) basket of the store, 10 when unknown."""
    b = basket(cut_history(history, start))
    p = lookup_with_default(pred, b, ["store", "day_of_week", "promo"], "basket",
                            DEFAULT_BASKET)
    cents = F.greatest(col("pred_cents"), F.lit(0))
    sales = cents.cast("double") / 100.0
    size = F.when(col("basket") > 0, col("basket")).otherwise(F.lit(float(DEFAULT_BASKET)))
    cust = F.when(cents > 0, F.floor(sales / size)).otherwise(0).cast("long")
    return p.select("scenario", "store", "date", "promo", cents.alias("sales_cents"),
                    sales.alias("sales"), cust.alias("customers"))


def forecast_reference(history: DataFrame, start: str, end: str) -> DataFrame:
    """Both scenarios for all eligible stores with the reference predictor."""
    promos = scenario_promos(history, start, end)
    return finish_forecast(predict_reference(history, promos, start), history, start)


def forecast_detail(fc: DataFrame) -> DataFrame:
    """Date, store, promo, sales (2 digits), customers (0 digits)."""
    return fc.select("scenario", F.date_format("date", "yyyy-MM-dd").alias("date"),
                     "store", "promo", cents_to_units(col("sales_cents")).alias("sales"),
                     "customers")


def uplift(fc: DataFrame) -> DataFrame:
    """Totals per scenario, difference and percent (0 when the base
    total is not positive)."""
    g = fc.groupBy("store").agg(
        F.sum(F.when(col("scenario") == "base", dec(col("sales_cents")))).alias("b"),
        F.sum(F.when(col("scenario") == "promo", dec(col("sales_cents")))).alias("p"))
    pct = F.when(col("b") > 0, round_ratio((col("p") - col("b")) * 10000, col("b")).cast("double")
                 / 100.0).otherwise(F.lit(0.0))
    return g.select("store", (col("b").cast("double") / 100.0).alias("total_base"),
                    (col("p").cast("double") / 100.0).alias("total_promo"),
                    ((col("p") - col("b")).cast("double") / 100.0).alias("uplift"),
                    pct.alias("uplift_pct"))


def extra_staff(fc: DataFrame, per_staff: int = CUSTOMERS_PER_STAFF) -> DataFrame:
    """Extra staff per promo day = ceil(daily uplift / base basket /
    per_staff), not below 0; the store figure is the ceiling of the mean over
    promo days (0 when there are none).  Both scenarios of a day are paired
    by one aggregate on (store, date), the base basket by a window over each
    store's days."""
    is_base, is_promo = col("scenario") == "base", col("scenario") == "promo"
    day = fc.groupBy("store", "date").agg(
        F.sum(F.when(is_base, col("sales_cents"))).alias("b"),
        F.sum(F.when(is_base, col("customers"))).alias("bc"),
        F.sum(F.when(is_promo, col("sales_cents"))).alias("p"),
        F.max(F.when(is_promo, col("promo"))).alias("promo"))
    w = Window.partitionBy("store")
    sb, sc = F.sum(dec(col("b"))).over(w), F.sum("bc").over(w)
    day = day.withColumn("avg_basket", sb.cast("double") / F.when(sc > 0, sc * 100).cast("double"))
    extra = ((col("p") - col("b")).cast("double") / 100.0) / col("avg_basket")
    staff = F.greatest(F.ceil(extra / float(per_staff)), F.lit(0)).cast("long")
    g = day.filter(col("p").isNotNull()).withColumn("staff", staff).groupBy("store").agg(
        F.count(F.when(col("promo") == 1, 1)).alias("n"),
        F.sum(F.when(col("promo") == 1, col("staff"))).alias("t"))
    mean_ceil = F.when(col("n") > 0, F.call_function(
        "div", col("t") + col("n") - 1, col("n"))).otherwise(F.lit(0))
    return g.select("store", mean_ceil.cast("long").alias("extra_staff"))


def forecast_kpis(fc: DataFrame) -> DataFrame:
    """Per store and scenario: total and mean sales, total customers;
    for the promo scenario the lift and lift % over base (when base > 0).
    The base total reaches the promo row through a window over the store's
    (at most two) scenario rows, not a self-join."""
    g = fc.groupBy("store", "scenario").agg(
        F.count("*").alias("n"), F.sum(dec(col("sales_cents"))).alias("s"),
        F.sum("customers").alias("total_customers"))
    g = g.withColumn("bs", F.max(F.when(col("scenario") == "base", col("s")))
                     .over(Window.partitionBy("store")))
    promo_row = (col("scenario") == "promo") & (col("bs") > 0)
    return g.select(
        "store", "scenario", (col("s").cast("double") / 100.0).alias("total_sales"),
        (round_ratio(col("s"), col("n")).cast("double") / 100.0).alias("avg_sales"),
        "total_customers",
        F.when(promo_row, (col("s") - col("bs")).cast("double") / 100.0).alias("lift"),
        F.when(promo_row, round_ratio((col("s") - col("bs")) * 10000, col("bs")).cast("double")
               / 100.0).alias("lift_pct"))


# ---------------------------------------------------------------- model path
def future_design(history: DataFrame, start: str, end: str, cats: dict[str, list[str]],
                  promos: DataFrame | None = None, drop_first: dict | None = None,
                  extra: DataFrame | None = None) -> DataFrame:
    """P2 for both scenarios: calendar, promo, holiday and static columns of
    each (scenario, store, future day), one-hot columns from the category
    table that is kept with the model, and the columns of ``extra`` (store,
    date, ...)."""
    from shopcast.operators.features import DROP_FIRST, one_hot_columns
    hist = cut_history(history, start)
    rows = promos if promos is not None else scenario_promos(history, start, end)
    if extra is not None:
        rows = rows.join(extra, ["store", "date"])
    rows = rows.join(last_static(hist), "store", "left").withColumns(calendar_dict("date"))
    rows = rows.withColumns({
        "promo_weekend": (col("promo") * col("is_weekend")).cast("long"),
        "promo_month": (col("promo") * col("month")).cast("long"),
        "state_holiday": F.lit("0"), "school_holiday": F.lit(0).cast("long"),
        "open": F.lit(1).cast("long")})
    return rows.select("*", *one_hot_columns(cats, drop_first or DROP_FIRST))


def future_feature_table(history: DataFrame, start: str, end: str,
                         cats: dict[str, list[str]], promos: DataFrame | None = None,
                         drop_first: dict | None = None) -> DataFrame:
    """P2 + P4 + P5 for both scenarios: every column the feature builder
    makes for training, for each (scenario, store, future day)."""
    return future_design(history, start, end, cats, promos, drop_first, future_features(history, start, end))


def predict_with_model(model, table: DataFrame) -> DataFrame:
    """One distributed ``transform`` over every store and scenario;
    predictions become integer cents (half-up)."""
    p = model.transform(table)
    cents = F.floor(col("prediction") * 100.0 + 0.5).cast("long")
    return p.select("scenario", "store", "date", "promo",
                    day_of_week("date").alias("day_of_week"), cents.alias("pred_cents"))


def forecast_with_model(history: DataFrame, model, cats: dict[str, list[str]],
                        start: str, end: str) -> DataFrame:
    """P7 with the trained model: both scenarios, clipped, with customers."""
    return forecast_design(history, future_feature_table(history, start, end, cats), model, start)


def forecast_design(history: DataFrame, table: DataFrame, model, start: str) -> DataFrame:
    """P1 and P6 on a table of future rows."""
    return finish_forecast(predict_with_model(model, table), history, start)
