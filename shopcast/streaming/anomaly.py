"""The anomaly stream (IO7-IO9, ST4-ST7).

file source (some files per trigger) -> open-day filter -> foreachBatch:
score against a static per-store baseline, write scored rows and anomalies,
then commit the batch with its observed counts.

Output of batch n goes to ``<table>/batch_id=<n>`` (overwritten as a whole),
and ``commits/batch_id=<n>`` is written last.  Readers look at committed
batches only, so a batch that fails half way shows nothing, and one that is
retried after an executor or driver loss replaces its earlier output.
``compact`` folds committed batches into runs (``streaming.runs``), so files
do not pile up.  The baseline is written once as a table in the shared
checkpoint folder (lineage cut, survives executor loss).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from shopcast.operators.scoring import (SCORED_COLUMNS, anomalies, score_all,
                                        Z_THRESHOLD)
from shopcast.session import materialize
from shopcast.sources.schemas import SALES_SCHEMA
from shopcast.streaming.runs import COMPACT_EVERY, commit, compact, live, read_live, write_batch

col = F.col

SCORED_SCHEMA = ("store long, date date, sales double, base_mean double, z_score double, "
                 "deviation_pct double")
ANOMALY_SCHEMA = ("store long, date date, sales double, base_mean double, base_std double, "
                  "deviation_pct double, z_score double, direction string")
TABLES = {"scored": SCORED_SCHEMA, "anomalies": ANOMALY_SCHEMA}
#: Name of the metrics that the running query reports with its progress.
ARRIVED = "arrived"


def read_sales_stream(spark: SparkSession, path: str, max_files: int = 1,
                      fmt: str = "parquet") -> DataFrame:
    """IO7: unbounded fact rows from a directory, fixed schema, ``max_files``
    new files per trigger.  Parquet binds columns by name; CSV files must
    carry the declared columns in the declared order (checked against the
    header)."""
    r = spark.readStream.schema(SALES_SCHEMA).option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        r = r.option("header", "true").option("enforceSchema", "false")
        df = r.csv(path)
    else:
        df = r.parquet(path)
    return df.filter((col("sales_cents") > 0) & (col("open") == 1))


def make_batch_writer(baseline: DataFrame, out_dir: str, k: float = Z_THRESHOLD,
                      every: int = COMPACT_EVERY):
    """ST4: the foreachBatch function: one persisted frame, two sinks, then
    the commit.  The counts are observed while the scored rows are written;
    no pass is made for them."""
    def process(batch_df: DataFrame, batch_id: int) -> None:
        spark, counts = batch_df.sparkSession, Observation()
        far = F.abs(col("z_score")) > k
        scored = score_all(batch_df, baseline).persist()
        try:
            seen = scored.observe(counts, F.count(F.lit(1)).alias("records"),
                                  F.count("z_score").alias("scored"),
                                  F.count(F.when(far, 1)).alias("anomalies"))
            write_batch(seen.filter("z_score is not null").select(SCORED_COLUMNS), out_dir, "scored", batch_id)
            write_batch(anomalies(scored, k), out_dir, "anomalies", batch_id)
            commit(spark, out_dir, batch_id, counts.get)
        finally:
            scored.unpersist()
        if (batch_id + 1) % every == 0:
            compact(spark, out_dir, TABLES, every)
    return process


def prepare_baseline(baseline: DataFrame) -> DataFrame:
    """Write the baseline once into the shared folder: lineage is cut, and
    the planner knows its size when it picks the join of each batch."""
    return materialize(baseline, "baseline")


def start_anomaly_query(stream_df: DataFrame, baseline: DataFrame, out_dir: str,
                        checkpoint: str, trigger: str | None = "5 seconds",
                        name: str = "anomaly_detection", k: float = Z_THRESHOLD,
                        writer: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """ST5: start with a trigger (``None`` = availableNow), a checkpoint and
    a query name."""
    stream_df = stream_df.observe(ARRIVED, F.count(F.lit(1)).alias("records"))
    w = (stream_df.writeStream.foreachBatch(writer or make_batch_writer(baseline, out_dir, k))
         .option("checkpointLocation", checkpoint).queryName(name))
    w = w.trigger(availableNow=True) if trigger is None else w.trigger(processingTime=trigger)
    return w.start()


def drain(query: StreamingQuery) -> None:
    """ST7: process what has arrived, then stop (also after a failure, which
    is raised)."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def supervise(start: Callable[[], StreamingQuery], until: Callable[[StreamingQuery], None] = drain,
              restarts: int = 3) -> int:
    """ST5: ``until(start())``, started again from its checkpoint when the
    query fails, at most ``restarts`` times.  Returns the restarts used."""
    used = 0
    while True:
        try:
            until(start())
            return used
        except StreamingQueryException:
            if used == restarts:
                raise
            used += 1


def score_directory(spark: SparkSession, inbox: str, baseline: DataFrame, out_dir: str, checkpoint: str,
                    max_files: int = 100, trigger: str = "5 seconds", fmt: str = "parquet",
                    name: str = "anomaly_detection") -> str:
    """IO7-IO9, ST4-ST7 end to end: score the files of ``inbox`` that the
    checkpoint has not seen, restart after failures, drain and stop."""
    prepared = prepare_baseline(baseline)
    supervise(lambda: start_anomaly_query(read_sales_stream(spark, inbox, max_files, fmt), prepared,
                                          out_dir, checkpoint, trigger, name))
    return out_dir


class LiveCounters(StreamingQueryListener):
    """ST6 while the query runs: batches and records from the metrics that
    come with its progress, by batch, so a batch that is run again counts
    once.  What is committed (``stream_totals``) survives a restart."""

    def __init__(self, name: str = "anomaly_detection") -> None:
        self.name, self.records = name, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(ARRIVED)
        if event.progress.name == self.name and seen is not None and seen["records"]:
            self.records[event.progress.batchId] = seen["records"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    @property
    def totals(self) -> dict:
        return {"batches": len(self.records), "records": sum(self.records.values())}


def stream_totals(spark: SparkSession, out_dir: str) -> DataFrame:
    """ST6: one row with the committed batches that had rows, their records
    and the anomalies among them, from the counts of the commits."""
    return live(spark, out_dir).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c)
                                      for c in ("batches", "records", "anomalies")))


def stream_stats(spark: SparkSession, out_dir: str) -> dict:
    """``stream_totals`` as a dict."""
    return stream_totals(spark, out_dir).first().asDict()


def read_scored(spark: SparkSession, out_dir: str) -> DataFrame:
    """IO8: all scored rows of committed batches."""
    return read_live(spark, out_dir, "scored", SCORED_SCHEMA)


def read_anomalies(spark: SparkSession, out_dir: str) -> DataFrame:
    """IO9: all anomalies of committed batches."""
    return read_live(spark, out_dir, "anomalies", ANOMALY_SCHEMA)
