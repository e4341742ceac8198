"""Per-store baseline and anomaly scoring (A15, ST1-ST3, S3, A21).

The same functions score a batch table and each micro-batch of the stream.
The baseline is one row per store, computed once; figures are rounded to
the cent *before* scoring, and the z-score to two digits *before* the
threshold test, as the anomaly rule defines (z = 3.004 is not an anomaly).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.functions.exact import cents_to_units, dec, moment_std, round_ratio
from shopcast.operators.clean import in_years, open_days

col = F.col

Z_THRESHOLD = 3.0


def store_baseline(df: DataFrame, until: int = 2000) -> DataFrame:
    """Per store mean, sample std (both rounded to the cent) and count
    over open days up to ``until``; stores with a null or zero std drop out.
    Keeps integer-cent columns for exact scoring."""
    hist = in_years(open_days(df), until=until)
    g = hist.groupBy("store").agg(
        F.count("*").alias("n"), F.sum(dec(col("sales_cents"))).alias("s1"),
        F.sum(dec(col("sales_cents")) * col("sales_cents")).alias("s2"))
    b = g.select(
        "store", round_ratio(col("s1"), col("n")).alias("base_mean_cents"),
        F.floor(moment_std(col("n"), col("s1"), col("s2")) + 0.5).cast("long")
        .alias("base_std_cents"),
        col("n").alias("base_count"))
    b = b.filter(col("base_std_cents").isNotNull() & (col("base_std_cents") > 0))
    return b.select("store", "base_mean_cents", "base_std_cents",
                    cents_to_units(col("base_mean_cents")).alias("base_mean"),
                    cents_to_units(col("base_std_cents")).alias("base_std"),
                    "base_count")


def _scores(joined: DataFrame) -> DataFrame:
    diff = col("sales_cents") - col("base_mean_cents")
    zh = round_ratio(diff * 100, col("base_std_cents"))
    dt = round_ratio(diff * 1000, col("base_mean_cents"))
    return joined.select(
        "store", "date", cents_to_units(col("sales_cents")).alias("sales"),
        "base_mean", "base_std",
        (zh.cast("double") / 100.0).alias("z_score"),
        (dt.cast("double") / 10.0).alias("deviation_pct"))


def score(df: DataFrame, baseline: DataFrame) -> DataFrame:
    """ST1: z-score (2 digits) and deviation % (1 digit) of each open day
    against its store's baseline.  Stores without a baseline drop out.
    How ``baseline`` is joined is left to the planner and its size statistics."""
    return _scores(open_days(df).join(baseline, "store"))


def score_all(df: DataFrame, baseline: DataFrame) -> DataFrame:
    """Every row of ``df``; those that ``score`` leaves out have no z-score."""
    known = baseline.withColumnRenamed("store", "_store")
    counts = (col("store") == col("_store")) & (col("open") == 1) & (col("sales_cents") > 0)
    return _scores(df.join(known, counts, "left"))


SCORED_COLUMNS = ["store", "date", "sales", "base_mean", "z_score", "deviation_pct"]
ANOMALY_COLUMNS = ["store", "date", "sales", "base_mean", "base_std",
                   "deviation_pct", "z_score", "direction"]


def with_direction(df: DataFrame) -> DataFrame:
    """ST3: 'drop' below the mean, else 'spike'."""
    return df.withColumn("direction", F.when(col("z_score") < 0, "drop")
                         .otherwise("spike"))


def anomalies(scored: DataFrame, k: float = Z_THRESHOLD) -> DataFrame:
    """ST2: abs(rounded z) strictly above ``k``."""
    return with_direction(scored.filter(F.abs(col("z_score")) > k)).select(
        ANOMALY_COLUMNS)


def top_anomalies(anoms: DataFrame, n: int = 15) -> DataFrame:
    """S3: the ``n`` largest abs(z) (ties by store, date); a per-task top-n
    then one merge (TakeOrderedAndProject)."""
    return anoms.orderBy(F.abs(col("z_score")).desc(), "store", "date").limit(n)


def anomaly_summary(anoms: DataFrame) -> DataFrame:
    """Counts by direction, one row."""
    return anoms.agg(F.count("*").alias("n_anomalies"),
                     F.count(F.when(col("z_score") < 0, 1)).alias("n_drop"),
                     F.count(F.when(col("z_score") > 0, 1)).alias("n_spike"))


def scored_year(df: DataFrame, baseline: DataFrame, year: int = 2001) -> DataFrame:
    """Batch form of the stream: score one year against the baseline."""
    return score(in_years(df, year), baseline).select(SCORED_COLUMNS)
