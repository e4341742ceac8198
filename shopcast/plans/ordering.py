"""Global order without a single-partition window.

``Window.orderBy(...)`` with no partition moves every row to one task.  Here
rows are range-partitioned on the order, sorted inside each partition, and
numbered locally with ``monotonically_increasing_id`` (contiguous inside a
partition).  Per-partition counts are a table of at most
``spark.sql.shuffle.partitions`` rows, so their running offsets are
broadcast with a proven size bound.  The order must be total (add a unique
key as the last column).

The numbered rows are written once, with partition and local number, as a
table in the shared folder, and both the counts and the join read that
table.  The range partitioner samples its input to pick boundaries, so two
passes that each partition anew (one of them on fewer columns) would get
different boundaries; reading one table, they cannot.  The written table
also cuts lineage: a lost executor re-reads it instead of recomputing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopcast.session import materialize

_SHIFT = 33  # monotonically_increasing_id: partition index in the upper bits


def global_row_number(df: DataFrame, order: list[Column | str],
                      name: str = "row_number",
                      partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1..N along ``order``."""
    spark = df.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(p, *order).sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id())
              .withColumn("_pid", F.shiftright("_mid", _SHIFT)))
    ranged = ranged.withColumn(
        "_local", F.col("_mid") - F.shiftleft("_pid", _SHIFT) + 1).drop("_mid")
    ranged = materialize(ranged, "numbered")
    counts = ranged.groupBy("_pid").agg(F.count("*").alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0))
        .alias("_offset"))
    out = ranged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(name, F.col("_local") + F.col("_offset")).drop(
        "_pid", "_local", "_offset")


def ntile(df: DataFrame, order: list[Column | str], k: int,
          name: str = "ntile") -> DataFrame:
    """SQL ``NTILE(k) OVER (ORDER BY order)`` computed without one partition.

    Bucket sizes follow the SQL rule: the first ``N mod k`` buckets hold one
    row more than the others.
    """
    numbered = global_row_number(df, order, "_rn")
    total = numbered.agg(F.count("*").alias("_n"))  # one row
    j = numbered.crossJoin(F.broadcast(total))
    base = F.floor(F.col("_n") / k).cast("long")
    rem = (F.col("_n") % k).cast("long")
    cut = rem * (base + 1)
    r = F.col("_rn")
    bucket = F.when(r <= cut, F.floor((r - 1) / (base + 1)) + 1).otherwise(
        F.floor((r - 1 - cut) / F.when(base > 0, base)) + rem + 1)
    return j.withColumn(name, bucket.cast("long")).drop("_rn", "_n")
