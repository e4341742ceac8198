"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a one-row aggregate to every row (a 1-row broadcast)."""
    return df.crossJoin(F.broadcast(one_row))


def semi_join_top(df: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """Keep rows whose key is in ``top`` (a limit-n frame, broadcast)."""
    return df.join(F.broadcast(top.select(key)), key, "left_semi")


def lookup_with_default(df: DataFrame, table: DataFrame, keys: list[str],
                        value: str, default) -> DataFrame:
    """Left join a lookup table; a missing key takes ``default``."""
    return (df.join(table.select(*keys, F.col(value).alias("_v")), keys, "left")
            .withColumn(value, F.coalesce(F.col("_v"), F.lit(default))).drop("_v"))
