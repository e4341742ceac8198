"""Catalogue entries that go through the library's own files.

Each writes a whole table the way the pipeline does (partitioned table, raw
CSV, forecast export) into the shared folder and returns what the matching
reader gives back, so sources and sinks are checked on the same rows as the
operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopcast import sinks
from shopcast.operators import clean as C
from shopcast.session import run_dir
from shopcast.sources import files, tables

col = F.col


def written_table(df: DataFrame) -> DataFrame:
    """IO4 then IO2: a table partitioned by year, written and read back."""
    spark = df.sparkSession
    path = run_dir(spark, "table")
    sinks.write_table(df, path)
    return files.read_table(spark, path).withColumn("year", col("year").cast("long"))


def sql_views(spark: SparkSession, sales: DataFrame, stores: DataFrame) -> DataFrame:
    """IO3: both tables as views, asked in SQL."""
    tables.register(spark, sales, stores, ("shopcast_sales", "shopcast_stores"))
    return spark.sql(
        "SELECT st.store_type, sa.promo, COUNT(*) AS n_days, SUM(sa.sales_cents) AS sales_cents "
        "FROM shopcast_sales sa JOIN shopcast_stores st ON sa.store = st.store "
        "WHERE sa.open = 1 GROUP BY st.store_type, sa.promo")


def sales_as_csv(sales: DataFrame, date_text) -> str:
    """The fact table as raw CSV files with the original header."""
    path = run_dir(sales.sparkSession, "sales-csv")
    sales.select(
        col("store").alias("Store"), (F.weekday("date") + 1).alias("DayOfWeek"), date_text.alias("Date"),
        (col("sales_cents").cast("decimal(18,0)") / 100).cast("decimal(18,2)").alias("Sales"),
        col("customers").alias("Customers"), col("open").alias("Open"), col("promo").alias("Promo"),
        col("state_holiday").alias("StateHoliday"), col("school_holiday").alias("SchoolHoliday"),
    ).write.option("header", "true").csv(path)
    return path


def csv_sales(sales: DataFrame) -> DataFrame:
    """IO1 + PF1: the fact table by way of raw CSV files."""
    path = sales_as_csv(sales, F.date_format("date", "M/d/yyyy"))
    return files.read_sales(sales.sparkSession, path).drop("date_text")


def csv_stores(stores: DataFrame) -> DataFrame:
    """IO1: the dimension by way of raw CSV files, columns in another order."""
    spark = stores.sparkSession
    path = run_dir(spark, "stores-csv")
    stores.select(
        col("promo_interval").alias("PromoInterval"), col("store").alias("Store"),
        col("assortment").alias("Assortment"), col("store_type").alias("StoreType"),
        col("competition_distance").alias("CompetitionDistance"),
    ).write.option("header", "true").csv(path)
    return files.read_stores(spark, path)


def date_rejects(sales: DataFrame) -> DataFrame:
    """PF1: raw files whose closed days carry dates of another format; those
    are kept with a null date and counted."""
    other = F.when(col("open") == 1, F.date_format("date", "M/d/yyyy")).otherwise(
        F.date_format("date", "yyyy.MM.dd"))
    return C.count_rejects(files.read_sales(sales.sparkSession, sales_as_csv(sales, other)))


def exported_forecast(fc: DataFrame) -> DataFrame:
    """IO10: a forecast by way of its export, with the run's tags.  The tags
    are directory names, so their types are declared, not guessed."""
    spark = fc.sparkSession
    path = run_dir(spark, "forecast")
    sinks.write_forecast(fc, path)
    return spark.read.schema(
        "scenario string, date string, store long, promo long, sales double, customers long, "
        "store_tag string, run_from string, run_to string").parquet(path)
