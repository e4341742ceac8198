"""Exploration and profiling (A1-A6, PF2, M1, M2).

All of these are single aggregations: partial aggregates on every task, one
small final stage, nothing collected row by row.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopcast.functions.calendar import day_of_week
from shopcast.functions.exact import cents_to_units, dec, ratio_to_units, round_half_up, round_ratio
from shopcast.operators.clean import open_days

col = F.col


def _euro_mean(s, n):
    return cents_to_units(round_ratio(s, n))


def sales_by_day(df: DataFrame) -> DataFrame:
    """A1: total sales per day over rows with sales."""
    g = open_days(df, mode="sales").groupBy("date").agg(
        F.sum(dec(col("sales_cents"))).alias("s"))
    return g.select("date", cents_to_units(col("s")).alias("total_sales")).orderBy("date")


def promo_sales_by_day(df: DataFrame) -> DataFrame:
    """A2: mean sales per day on promo days (rounded to the cent)."""
    g = open_days(df, mode="sales").filter(col("promo") == 1).groupBy("date").agg(
        F.count("*").alias("n"), F.sum(dec(col("sales_cents"))).alias("s"))
    return g.select("date", _euro_mean(col("s"), col("n")).alias("avg_sales")).orderBy("date")


def sales_by_weekday(df: DataFrame) -> DataFrame:
    """A3: mean sales per weekday (1 = Monday)."""
    g = open_days(df, mode="sales").groupBy(day_of_week("date").alias("day_of_week")).agg(
        F.count("*").alias("n"), F.sum(dec(col("sales_cents"))).alias("s"))
    return g.select("day_of_week", _euro_mean(col("s"), col("n")).alias("avg_sales")) \
        .orderBy("day_of_week")


def sales_by_month(df: DataFrame) -> DataFrame:
    """A4: mean sales per month of year."""
    g = open_days(df, mode="sales").groupBy(F.month("date").cast("long").alias("month")).agg(
        F.count("*").alias("n"), F.sum(dec(col("sales_cents"))).alias("s"))
    return g.select("month", _euro_mean(col("s"), col("n")).alias("avg_sales")).orderBy("month")


def _is_integral(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType,
                      (T.LongType, T.IntegerType, T.ShortType, T.ByteType))


def profile(df: DataFrame, cols: list[str], digits: int = 4) -> DataFrame:
    """A5: count, mean, sample std, min, max per column, one row per column.

    One pass: count, sum (an exact decimal for integer columns) and the
    mergeable centred moment of the std per column, then unpivoted.  Mean
    and std are rounded to ``digits`` decimals.
    """
    aggs = []
    for c in cols:
        x = dec(col(c)) if _is_integral(df, c) else col(c).cast("double")
        aggs += [F.count(c).alias(f"{c}__n"), F.sum(x).alias(f"{c}__s1"),
                 F.stddev_samp(col(c).cast("double")).alias(f"{c}__std"),
                 F.min(col(c)).cast("double").alias(f"{c}__min"),
                 F.max(col(c)).cast("double").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = []
    for c in cols:
        n, s1 = col(f"{c}__n"), col(f"{c}__s1")
        if _is_integral(df, c):
            mean = ratio_to_units(s1, F.when(n > 0, n), digits)
        else:
            mean = round_half_up(s1 / n, digits)
        rows.append(F.struct(F.lit(c).alias("column"), n.alias("n"), mean.alias("mean"),
                             round_half_up(col(f"{c}__std"), digits).alias("std"),
                             col(f"{c}__min").alias("min"), col(f"{c}__max").alias("max")))
    return wide.select(F.inline(F.array(*rows)))


def _bin_ids(rng: DataFrame, bins: int) -> DataFrame:
    ids = rng.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    return ids.withColumn("bin", col("bin").cast("long"))


def _bins_frame(df: DataFrame, value, bins: int):
    """(value, lo, hi) with lo/hi the column range as a one-row broadcast."""
    rng = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    return df.select(value.alias("v")).crossJoin(F.broadcast(rng)), rng


def histogram(df: DataFrame, bins: int = 50, log: bool = False,
              digits: int = 6) -> DataFrame:
    """Equal-width histogram of sales (euros) over rows with sales.

    ``log=True`` bins ``log1p(sales)`` (F6).  Bin i covers
    [lo + i*w, lo + (i+1)*w) and the top edge belongs to the last bin.  On
    cents the bin index is exact integer arithmetic; edges and centres are
    reported as doubles (log edges rounded to ``digits``).  Empty bins are
    kept with count 0.
    """
    rows = open_days(df, mode="sales")
    if not log:
        x = col("sales_cents")
        data, rng = _bins_frame(rows, x, bins)
        width = col("hi") - col("lo")
        b = F.when(width > 0, F.least(F.call_function(
            "div", (col("v") - col("lo")) * bins, width), F.lit(bins - 1))).otherwise(0)
        counts = data.groupBy(b.cast("long").alias("bin")).agg(F.count("*").alias("count"))
        i = col("bin")
        edges = _bin_ids(rng, bins)
        d = float(bins * 100)
        lo_e = (col("lo") * bins + i * (col("hi") - col("lo"))).cast("double") / d
        hi_e = (col("lo") * bins + (i + 1) * (col("hi") - col("lo"))).cast("double") / d
        ctr = (col("lo") * bins * 2 + (i * 2 + 1) * (col("hi") - col("lo"))).cast("double") \
            / (2 * d)
    else:
        x = F.log1p(col("sales_cents").cast("double") / 100.0)
        data, rng = _bins_frame(rows, x, bins)
        width = col("hi") - col("lo")
        b = F.when(width > 0, F.least(F.floor((col("v") - col("lo")) * bins / width),
                                      F.lit(bins - 1))).otherwise(0)
        counts = data.groupBy(b.cast("long").alias("bin")).agg(F.count("*").alias("count"))
        i = col("bin")
        edges = _bin_ids(rng, bins)
        w = (col("hi") - col("lo")) / bins
        lo_e = round_half_up(col("lo") + i * w, digits)
        hi_e = round_half_up(col("lo") + (i + 1) * w, digits)
        ctr = round_half_up(col("lo") + (i + 0.5) * w, digits)
    out = edges.join(counts, "bin", "left").select(
        "bin", lo_e.alias("bin_start"), hi_e.alias("bin_end"), ctr.alias("center"),
        F.coalesce(col("count"), F.lit(0)).cast("long").alias("count"))
    return out.orderBy("bin")


def _complete(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[col(c).cast("double").alias(c) for c in cols]).na.drop()


def correlations(df: DataFrame, cols: list[str], digits: int = 4) -> DataFrame:
    """M1: Pearson r for all pairs of numeric columns.

    Rows with a null in any of ``cols`` are left out.  One Gramian of the
    centred rows (dense vectors, so MLlib subtracts the means before it
    multiplies and merges k x k matrices): no moment can overflow, and the
    plan has k columns, not k^2 expressions.  A zero-variance column gives
    r = 0 (not NaN, not an error), as do fewer than two rows.  Output
    (column_a, column_b, r) rounded to ``digits``.
    """
    rows = _complete(df, cols).select(array_to_vector(F.array(*cols)).alias("v")).persist()
    try:
        matrix = (Correlation.corr(rows, "v").first()[0].toArray() if len(rows.take(2)) == 2
                  else np.zeros((len(cols), len(cols))))
    finally:
        rows.unpersist()
    pairs = [(cols[i], cols[j], float(np.nan_to_num(matrix[i, j]))) for i, j in combinations(range(len(cols)), 2)]
    out = df.sparkSession.createDataFrame(pairs, "column_a string, column_b string, r double")
    return out.withColumn("r", round_half_up(col("r"), digits))


def target_correlations(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """(feature, n, r): each column's r with ``target``, in one pass of
    mergeable centred moments; 0 for a zero-variance column and without rows.

    A row becomes one (feature, value, target) row for each column; these
    are added up before the shuffle by three aggregates, whatever the number
    of columns.  An aggregate for each column makes a generated method that
    the JVM no longer compiles."""
    data = _complete(df, [*cols, target]).select(col(target).alias("_y"), *cols)
    sums = data.unpivot(["_y"], cols, "feature", "_x").groupBy("feature").agg(
        F.count("*").alias("n"), F.var_pop("_x").alias("_vx"), F.var_pop("_y").alias("_vy"),
        F.covar_pop("_x", "_y").alias("_c"))
    every = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, cols))).alias("feature"))
    varies = (col("_vx") > 0) & (col("_vy") > 0)
    r = F.when(varies, col("_c") / (F.sqrt("_vx") * F.sqrt("_vy"))).otherwise(F.lit(0.0))
    return every.join(sums, "feature", "left").select("feature", F.coalesce("n", F.lit(0)).alias("n"), r.alias("r"))


def correlation_with(df: DataFrame, target: str, cols: list[str],
                     digits: int = 4) -> DataFrame:
    """M2: each column's r with ``target``, sorted by r descending."""
    r = target_correlations(df, target, [c for c in cols if c != target])
    return (r.select("feature", round_half_up(col("r"), digits).alias("r"))
            .withColumn("abs_r", F.abs("r")).orderBy(col("r").desc(), "feature"))
