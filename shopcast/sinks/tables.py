"""Writers and readers (IO4-IO6, IO10).

Everything is written in parallel by the executors (no single-file
coalesce, no rename through the driver).  Tables are Parquet, partitioned
by year or by forecast run so that later reads prune partitions.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

col = F.col


def write_table(df: DataFrame, path: str, partition_by=("year",)) -> None:
    """IO4: overwrite a table, partitioned (``year`` is derived from
    ``date`` when missing)."""
    if "year" in partition_by and "year" not in df.columns:
        df = df.withColumn("year", F.year("date").cast("long"))
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


FEATURES_SCHEMA = T.StructType([T.StructField("position", T.LongType()),
                                T.StructField("feature", T.StringType())])


def write_features(spark: SparkSession, features: list[str], path: str) -> None:
    """IO5: the chosen feature list as a small ordered table."""
    rows = [(i, f) for i, f in enumerate(features)]
    spark.createDataFrame(rows, FEATURES_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def read_features(spark: SparkSession, path: str) -> list[str]:
    """IO5: the feature list back, in order (a few dozen names)."""
    return [r["feature"] for r in spark.read.parquet(path).orderBy("position").collect()]


CATS_SCHEMA = T.StructType([T.StructField("column", T.StringType()),
                            T.StructField("position", T.LongType()),
                            T.StructField("value", T.StringType())])


def write_categories(spark: SparkSession, cats: dict[str, list[str]], path: str) -> None:
    """The one-hot category table kept next to the model."""
    rows = [(c, i, v) for c, vals in cats.items() for i, v in enumerate(vals)]
    spark.createDataFrame(rows, CATS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def read_categories(spark: SparkSession, path: str) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for r in spark.read.parquet(path).orderBy("column", "position").collect():
        out.setdefault(r["column"], []).append(r["value"])
    return out


def save_model(model: PipelineModel, path: str) -> None:
    """IO6: save a fitted pipeline, overwriting."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """IO6: load a fitted pipeline."""
    return PipelineModel.load(path)


def forecast_tags(fc: DataFrame) -> DataFrame:
    """IO10: the run's store range and dates as columns: ``store_tag`` is
    ``S<id>`` for one store, else ``S<first>-S<last>_<n>stores``; ``run_from``
    / ``run_to`` are the first and last forecast day (yyyyMMdd).  One small
    aggregate, broadcast back as a single row."""
    agg = fc.agg(F.min("store").alias("_s0"), F.max("store").alias("_s1"),
                 F.countDistinct("store").alias("_ns"),
                 F.date_format(F.min("date"), "yyyyMMdd").alias("run_from"),
                 F.date_format(F.max("date"), "yyyyMMdd").alias("run_to"))
    tag = F.when(col("_ns") == 1, F.concat(F.lit("S"), col("_s0").cast("string"))).otherwise(
        F.concat(F.lit("S"), col("_s0").cast("string"), F.lit("-S"), col("_s1").cast("string"),
                 F.lit("_"), col("_ns").cast("string"), F.lit("stores")))
    one = agg.select(tag.alias("store_tag"), "run_from", "run_to")
    return fc.crossJoin(F.broadcast(one))


def write_forecast(fc: DataFrame, out_dir: str) -> None:
    """IO10: export a forecast (date as yyyy-MM-dd, store, promo, sales,
    customers), one partition per store range and run dates; re-running the
    same run replaces only its own partition."""
    tagged = forecast_tags(fc.select(
        *([c for c in ("scenario",) if c in fc.columns]),
        "date", "store", "promo", "sales", "customers"))
    out = tagged.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("store_tag", "run_from", "run_to").parquet(out_dir))
