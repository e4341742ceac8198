"""The business reports (A7-A14, W4-W7, A18) as DataFrame plans.

Each report reads the fact table ``sales`` (one row per store and day) and
the dimension ``stores``.  Facts are first reduced per store (partial +
final hash aggregate, so a hot store is combined map-side), and only the
per-store rows meet the dimension; the join strategy (broadcast or
sort-merge) is left to the planner's size check and AQE, since the number
of stores grows with the data.  Money stays in integer cents and every
rounded figure is an exact half-up integer division (``functions.exact``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopcast.functions.bands import distance_band
from shopcast.functions.calendar import day_of_week
from shopcast.functions.exact import cents_to_units, dec, ratio_to_units, round_ratio
from shopcast.operators.clean import in_years, open_days
from shopcast.operators.joins import semi_join_top, with_scalar
from shopcast.plans.ordering import ntile
from shopcast.session import materialize

col = F.col


def _euro_mean(s, n):
    """round(s / n) cents as euros (2 digits)."""
    return cents_to_units(round_ratio(s, n))


def _per_store(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy("store", *keys).agg(
        F.count("*").alias("n"),
        F.sum(dec(col("sales_cents"))).alias("s"),
        F.sum(dec(col("customers"))).alias("c"))


def _with_type(per_store: DataFrame, stores: DataFrame,
               cols=("store_type",)) -> DataFrame:
    return per_store.join(stores.select("store", *cols), "store")


def report_store_type(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Per store type, stores, mean and total sales, mean customers."""
    g = (_with_type(_per_store(open_days(sales)), stores)
         .groupBy("store_type")
         .agg(F.count("*").alias("n_stores"), F.sum("n").alias("n"),
              F.sum("s").alias("s"), F.sum("c").alias("c")))
    return (g.select("store_type", "n_stores",
                     _euro_mean(col("s"), col("n")).alias("avg_sales"),
                     cents_to_units(col("s")).alias("total_sales"),
                     ratio_to_units(col("c"), col("n")).alias("avg_customers"))
            .orderBy(col("avg_sales").desc(), "store_type"))


def report_promo_effect(sales: DataFrame) -> DataFrame:
    """Promo vs none.  Sales per customer is the mean of per-day ratios
    (not a ratio of sums); each ratio is fixed to 1e-6 cent first."""
    d = open_days(sales, need_customers=True).withColumn(
        "r", round_ratio(col("sales_cents") * 1_000_000, col("customers")))
    g = d.groupBy("promo").agg(
        F.count("*").alias("n"), F.sum(dec(col("sales_cents"))).alias("s"),
        F.sum(dec(col("customers"))).alias("c"), F.sum(dec(col("r"))).alias("rs"))
    return (g.select(col("promo").cast("long").alias("promo"),
                     col("n").alias("n_days"),
                     _euro_mean(col("s"), col("n")).alias("avg_sales"),
                     ratio_to_units(col("c"), col("n")).alias("avg_customers"),
                     cents_to_units(round_ratio(col("rs"), col("n") * 1_000_000))
                     .alias("avg_sales_per_customer"))
            .orderBy("promo"))


def report_month(sales: DataFrame) -> DataFrame:
    """Month-of-year summary."""
    g = open_days(sales).groupBy(F.month("date").cast("long").alias("month")).agg(
        F.count("*").alias("n"), F.sum(dec(col("sales_cents"))).alias("s"),
        F.sum(dec(col("customers"))).alias("c"))
    return (g.select("month", _euro_mean(col("s"), col("n")).alias("avg_sales"),
                     cents_to_units(col("s")).alias("total_sales"),
                     ratio_to_units(col("c"), col("n")).alias("avg_customers"))
            .orderBy("month"))


def report_top_stores(sales: DataFrame, stores: DataFrame, n: int = 3) -> DataFrame:
    """Rank stores inside each type by mean sales, keep rank <= n (ties
    kept).  Catalyst plans the rank filter as a partial + final
    WindowGroupLimit, so a huge store type is cut to n rows per task before
    its shuffle."""
    ps = _with_type(_per_store(open_days(sales)), stores)
    w = Window.partitionBy("store_type").orderBy(
        (col("s").cast("double") / col("n").cast("double")).desc())
    ranked = ps.withColumn("sales_rank", F.rank().over(w)).filter(
        col("sales_rank") <= n)
    return (ranked.select("store", "store_type",
                          _euro_mean(col("s"), col("n")).alias("avg_sales"),
                          cents_to_units(col("s")).alias("total_sales"),
                          col("sales_rank").cast("long").alias("sales_rank"))
            .orderBy("store_type", "sales_rank", "store"))


def report_growth(sales: DataFrame) -> DataFrame:
    """Month-over-month total and growth %.  The window runs over the
    monthly aggregate (one row per calendar month), a bounded table."""
    g = open_days(sales).groupBy(
        F.year("date").cast("long").alias("year"),
        F.month("date").cast("long").alias("month")).agg(
        F.sum(dec(col("sales_cents"))).alias("s"))
    prev = F.lag("s").over(Window.orderBy("year", "month"))
    g = g.withColumn("p", prev)
    return (g.select("year", "month",
                     cents_to_units(col("s")).alias("total_sales"),
                     cents_to_units(col("p")).alias("prev_total_sales"),
                     ratio_to_units((col("s") - col("p")) * 100, col("p"))
                     .alias("growth_pct"))
            .orderBy("year", "month"))


def report_below_mean(sales: DataFrame, stores: DataFrame, n: int = 20) -> DataFrame:
    """Stores whose mean is below the mean over all open rows (a mean
    over rows, not over stores); the worst ``n``.  The per-store totals are
    written once and read by both branches, so the lines are scanned once;
    the system mean is a one-row aggregate of them, joined by a broadcast of
    that single row."""
    per_store = materialize(_per_store(open_days(sales)), "per-store")
    system = per_store.agg(F.sum("n").alias("sn"), F.sum("s").alias("ss"))
    ps = with_scalar(_with_type(per_store, stores), system)
    below = ps.filter(col("s") * col("sn") < col("ss") * col("n"))
    return (below.select(
        "store", "store_type",
        _euro_mean(col("s"), col("n")).alias("avg_sales"),
        _euro_mean(col("ss"), col("sn")).alias("system_avg"),
        cents_to_units(round_ratio(col("s") * col("sn") - col("ss") * col("n"),
                                   dec(col("n")) * col("sn"))).alias("diff"),
        (col("s").cast("double") / col("n").cast("double")).alias("_o"))
        .orderBy("_o", "store").limit(n).drop("_o"))


def report_weekday(sales: DataFrame) -> DataFrame:
    """A10: weekday summary (1 = Monday)."""
    g = open_days(sales).groupBy(day_of_week("date").alias("day_of_week")).agg(
        F.count("*").alias("n"), F.sum(dec(col("sales_cents"))).alias("s"),
        F.sum(dec(col("customers"))).alias("c"))
    return (g.select("day_of_week",
                     _euro_mean(col("s"), col("n")).alias("avg_sales"),
                     ratio_to_units(col("c"), col("n")).alias("avg_customers"),
                     col("n").alias("n_days"))
            .orderBy("day_of_week"))


def report_competition(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """By competition distance band (a null distance is the last band)."""
    ps = _with_type(_per_store(open_days(sales)), stores,
                    ("competition_distance",))
    g = ps.groupBy(distance_band("competition_distance").alias("distance_band")).agg(
        F.count("*").alias("n_stores"), F.sum("n").alias("n"),
        F.sum("s").alias("s"), F.sum("c").alias("c"))
    return (g.select("distance_band", "n_stores",
                     _euro_mean(col("s"), col("n")).alias("avg_sales"),
                     ratio_to_units(col("c"), col("n")).alias("avg_customers"))
            .orderBy(col("avg_sales").desc(), "distance_band"))


def top_stores_by_sales(sales: DataFrame, n: int) -> DataFrame:
    """J4 inner part: the ``n`` stores with the largest total (ties by id).
    ``orderBy().limit()`` is a TakeOrderedAndProject: per-task top-n, then
    one merge of at most n rows per task."""
    totals = open_days(sales).groupBy("store").agg(F.sum(dec(col("sales_cents"))).alias("s"))
    return totals.orderBy(col("s").desc(), "store").limit(n).select("store")


def report_cumulative(sales: DataFrame, n: int = 5) -> DataFrame:
    """Running sales total over open days for the ``n`` largest stores.
    The open days (three columns) are written once; the totals and the rows of the largest stores are read from
    there, so the lines are scanned once.  The top-n frame has at most n
    rows, so it is broadcast to the semi join; each running window holds one
    store's days."""
    days = materialize(sales.filter(col("open") == 1).select("store", "date", "open", "sales_cents"), "open-days")
    rows = semi_join_top(days, top_stores_by_sales(days, n), "store")
    w = Window.partitionBy("store").orderBy("date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (rows.select("store", "date",
                        cents_to_units(col("sales_cents")).alias("sales"),
                        cents_to_units(F.sum("sales_cents").over(w))
                        .alias("cumulative_sales"))
            .orderBy("store", "date"))


def report_quarter(sales: DataFrame, stores: DataFrame,
                   years=(2000, 2001)) -> DataFrame:
    """Year x quarter x store type for the given years."""
    od = in_years(open_days(sales), years)
    ps = _with_type(_per_store(od, F.year("date").cast("long").alias("year"),
                               F.quarter("date").cast("long").alias("quarter")),
                    stores)
    g = ps.groupBy("year", "quarter", "store_type").agg(
        F.count("*").alias("n_stores"), F.sum("n").alias("n"),
        F.sum("s").alias("s"))
    return (g.select("year", "quarter", "store_type",
                     cents_to_units(col("s")).alias("total_sales"),
                     _euro_mean(col("s"), col("n")).alias("avg_sales"),
                     "n_stores")
            .orderBy("store_type", "year", "quarter"))


def report_quartiles(sales: DataFrame) -> DataFrame:
    """Stores in quartiles of mean sales, then a summary per quartile.
    The summary uses each store's *rounded* mean, as the report defines.
    NTILE is computed without a single-partition window (plans.ordering)."""
    ps = _per_store(open_days(sales)).select(
        "store", round_ratio(col("s"), col("n")).alias("avg_cents"),
        (col("s").cast("double") / col("n").cast("double")).alias("_o"))
    q = ntile(ps, [col("_o").desc(), col("store").asc()], 4, "quartile")
    g = q.groupBy("quartile").agg(
        F.count("*").alias("n_stores"), F.min("avg_cents").alias("lo"),
        F.max("avg_cents").alias("hi"), F.sum(dec(col("avg_cents"))).alias("t"))
    return (g.select("quartile", "n_stores",
                     cents_to_units(col("lo")).alias("min_avg_sales"),
                     cents_to_units(col("hi")).alias("max_avg_sales"),
                     _euro_mean(col("t"), col("n_stores")).alias("mean_avg_sales"))
            .orderBy("quartile"))


def report_closures(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Closure rate per store type.  The closed count is null (not 0)
    for a type without closed days, and so is its percentage."""
    ps = sales.groupBy("store").agg(
        F.count("*").alias("n"),
        F.count(F.when(col("open") == 0, 1)).alias("closed"),
        F.count(F.when(col("open") == 1, 1)).alias("n_open"),
        F.sum(F.when(col("open") == 1, dec(col("sales_cents")))).alias("s_open"))
    g = _with_type(ps, stores).groupBy("store_type").agg(
        F.sum("n").alias("n"), F.sum("closed").alias("closed"),
        F.sum("n_open").alias("n_open"), F.sum("s_open").alias("s_open"))
    closed = F.when(col("closed") > 0, col("closed"))
    return (g.select("store_type", col("n").alias("total_days"),
                     closed.alias("closed_days"),
                     ratio_to_units(closed * 100, col("n")).alias("closure_pct"),
                     _euro_mean(col("s_open"), F.when(col("n_open") > 0, col("n_open")))
                     .alias("avg_open_sales"))
            .orderBy(col("closure_pct").desc_nulls_last(), "store_type"))


def network_kpis(sales: DataFrame, date_from: str | None = None,
                 date_to: str | None = None) -> DataFrame:
    """Stores in the network (all rows), mean sales and customers per
    store-day inside the date range."""
    in_range = F.lit(True)
    if date_from:
        in_range = in_range & (col("date") >= F.lit(date_from).cast("date"))
    if date_to:
        in_range = in_range & (col("date") <= F.lit(date_to).cast("date"))
    g = sales.agg(
        F.countDistinct("store").alias("n_stores"),
        F.count(F.when(in_range, 1)).alias("n"),
        F.sum(F.when(in_range, dec(col("sales_cents")))).alias("s"),
        F.sum(F.when(in_range, dec(col("customers")))).alias("c"))
    return g.select("n_stores",
                    _euro_mean(col("s"), F.when(col("n") > 0, col("n"))).alias("avg_sales"),
                    ratio_to_units(col("c"), F.when(col("n") > 0, col("n")))
                    .alias("avg_customers"))
