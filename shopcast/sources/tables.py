"""The two base tables built from the driver's Parquet files.

A store is a supplier, a day is a shipping date, and an open day has a line
that was not returned.  ``daily_sales`` is one row per (store, date), so
every per-store window later on holds at most one row per calendar day,
whatever the skew of the line items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def daily_sales(spark: SparkSession, sf_dir: str, date_from: str | None = None,
                date_to: str | None = None) -> DataFrame:
    """Fact table: store, date, open, sales_cents, customers, promo,
    state_holiday, school_holiday.

    One aggregation; the distinct customer count is planned by Catalyst as
    a partial aggregate on (store, date, order) below the final one, so a
    hot store-day is pre-combined map-side before any shuffle.

    ``date_from`` (inclusive) / ``date_to`` (exclusive) restrict the days on
    the raw ``l_shipdate`` column, where the predicate reaches the Parquet
    scan (PushedFilters, row-group skipping); a filter on the derived
    ``date`` would stop above the aggregate's cast.
    """
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")
    if date_from:
        li = li.filter(F.col("l_shipdate") >= F.lit(date_from).cast("timestamp_ntz"))
    if date_to:
        li = li.filter(F.col("l_shipdate") < F.lit(date_to).cast("timestamp_ntz"))
    kept = F.col("l_returnflag") != "R"
    return (li.groupBy(F.col("l_suppkey").cast("long").alias("store"),
                       F.col("l_shipdate").cast("date").alias("date"))
            .agg(F.max(F.when(kept, 1).otherwise(0)).alias("open"),
                 F.sum(F.when(kept, F.round(F.col("l_extendedprice") * 100)
                              .cast("long")).otherwise(0)).cast("long")
                 .alias("sales_cents"),
                 F.countDistinct(F.when(kept, F.col("l_orderkey")))
                 .alias("customers"),
                 F.max(F.when(F.col("l_discount") >= 0.06, 1).otherwise(0))
                 .alias("promo"),
                 F.min("l_linestatus").alias("state_holiday"),
                 F.max(F.when(F.col("l_tax") >= 0.08, 1).otherwise(0))
                 .alias("school_holiday")))


def last_day(spark: SparkSession, sf_dir: str):
    """The last date of the fact table, read from one column of the raw one."""
    li = _read(spark, sf_dir, "lineitem")
    return li.agg(F.max("l_shipdate").cast("date").alias("d")).first()["d"]


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension: store, store_type, assortment, competition_distance,
    promo_interval.  ``nation`` is the fixed 25-row table, so its join is a
    broadcast with a proven size bound."""
    sup = _read(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_nationkey", "s_acctbal")
    nat = _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    j = sup.join(F.broadcast(nat), sup.s_nationkey == nat.n_nationkey)
    return j.select(
        F.col("s_suppkey").alias("store"),
        F.concat(F.lit("t"), F.col("n_regionkey").cast("string"))
        .alias("store_type"),
        F.concat(F.lit("a"), (F.col("s_nationkey") % 3).cast("string"))
        .alias("assortment"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal"))
        .alias("competition_distance"),
        F.when(F.col("s_nationkey") % 2 != 0, F.lit("odd"))
        .alias("promo_interval"))


def load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(daily_sales, stores) for one scale-factor directory."""
    return daily_sales(spark, sf_dir), stores(spark, sf_dir)


def register(spark: SparkSession, sales: DataFrame, store_df: DataFrame,
             names: tuple[str, str] = ("sales", "stores")) -> None:
    """IO3: expose both tables to ``spark.sql``."""
    sales.createOrReplaceTempView(names[0])
    store_df.createOrReplaceTempView(names[1])
