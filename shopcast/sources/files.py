"""File sources (IO1, IO2).

CSV columns are bound by header name, not by position: the header line is
read first, the declared types are laid out in the file's own column order,
a file lacking a declared column raises, and so does a file of the same
folder whose header differs from the first one's.  Dates arrive as ``M/d/yyyy``
text; rows whose date does not parse are kept with a null date and can be
counted with ``clean.count_rejects``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopcast.sources.schemas import RAW_SALES_SCHEMA, RAW_STORE_SCHEMA


def read_csv_by_name(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, typed by column *name* (extra columns as text)."""
    header = spark.read.option("header", "true").csv(path).columns
    types = {f.name: f.dataType for f in schema.fields}
    missing = [c for c in types if c not in header]
    if missing:
        raise ValueError(f"{path}: header lacks columns {missing}")
    file_schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    return (spark.read.schema(file_schema).option("header", "true")
            .option("mode", "PERMISSIVE").option("enforceSchema", "false").csv(path))


def read_sales(spark: SparkSession, path: str,
               date_format: str = "M/d/yyyy") -> DataFrame:
    """Raw daily sales CSV -> fact table in our names, sales in cents."""
    raw = read_csv_by_name(spark, path, RAW_SALES_SCHEMA)
    return raw.select(
        F.col("Store").alias("store"),
        F.try_to_date(F.col("Date"), date_format).alias("date"),
        F.col("Open").alias("open"),
        (F.col("Sales") * 100).cast("long").alias("sales_cents"),
        F.col("Customers").alias("customers"),
        F.col("Promo").alias("promo"),
        F.col("StateHoliday").alias("state_holiday"),
        F.col("SchoolHoliday").alias("school_holiday"),
        F.col("Date").alias("date_text"))


def read_stores(spark: SparkSession, path: str) -> DataFrame:
    """Raw store CSV -> dimension in our names."""
    raw = read_csv_by_name(spark, path, RAW_STORE_SCHEMA)
    return raw.select(
        F.col("Store").alias("store"),
        F.col("StoreType").alias("store_type"),
        F.col("Assortment").alias("assortment"),
        F.col("CompetitionDistance").alias("competition_distance"),
        F.col("PromoInterval").alias("promo_interval"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """IO2: a table written by ``sinks.write_table`` (Parquet, by name)."""
    return spark.read.parquet(path)
