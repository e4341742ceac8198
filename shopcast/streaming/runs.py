"""Output of many small batches as few files (IO8, IO9).

A batch n is the folder ``<table>/batch_id=<n>`` of each table and one row
of counts in ``commits/batch_id=<n>``, written last.  ``compact`` folds the
newest committed batches into a run, ``runs/<table>/first=<a>/last=<b>``,
again with a row of counts that is written last.  A run replaces what lies
within it, from the moment its counts are there; a crash before that leaves
folders that nobody reads and the next attempt overwrites.

- The newest batch is never folded: it is the only one that a restarted
  query can run again.
- Runs merge by size (a run joins when the newer ones together are as
  large), up to ``RUN_BATCHES``.  With a batch every five seconds a day has
  17,280 of them; they end as at most one full run, about ten smaller ones
  and 2 x ``every`` single batches.
- Replaced folders go with the *next* compaction, so a reader that has just
  planned its scan keeps its files for that long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Single batches that are folded at once, and the most batches of a run.
COMPACT_EVERY = 100
RUN_BATCHES = 20_000
COUNTS = "records long, scored long, anomalies long"


def _batch(out_dir: str, name: str, batch_id: int) -> str:
    return f"{out_dir}/{name}/batch_id={batch_id}"


def _run(out_dir: str, name: str, first: int, last: int) -> str:
    return f"{out_dir}/runs/{name}/first={first}/last={last}"


def write_batch(df: DataFrame, out_dir: str, name: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(_batch(out_dir, name, batch_id))


def _one_row(spark: SparkSession, row: dict, schema: str, path: str) -> None:
    names = [c.split()[0] for c in schema.split(", ")]
    spark.createDataFrame([tuple(int(row.get(c, 0)) for c in names)], schema).coalesce(1).write.mode(
        "overwrite").parquet(path)


def commit(spark: SparkSession, out_dir: str, batch_id: int, counts: dict) -> None:
    """From now on batch ``batch_id`` is read."""
    _one_row(spark, counts, COUNTS, _batch(out_dir, "commits", batch_id))


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def committed(spark: SparkSession, out_dir: str) -> DataFrame:
    """(first, last, batches, records, scored, anomalies) of every commit,
    replaced ones included.  ``batches`` counts those that had rows."""
    fields = ["first", "last", "batches", "records", "scored", "anomalies"]
    out = spark.createDataFrame([], ", ".join(f"{c} long" for c in fields))
    if _exists(spark, f"{out_dir}/commits"):
        one = spark.read.schema(COUNTS + ", batch_id long").parquet(f"{out_dir}/commits")
        out = out.unionByName(one.select(
            F.col("batch_id").alias("first"), F.col("batch_id").alias("last"),
            (F.col("records") > 0).cast("long").alias("batches"), "records", "scored", "anomalies"))
    if _exists(spark, f"{out_dir}/runs/commits"):
        run = spark.read.schema(f"batches long, {COUNTS}, first long, last long").parquet(f"{out_dir}/runs/commits")
        out = out.unionByName(run.select(fields))
    return out


def _spans(spark: SparkSession, out_dir: str) -> tuple[list, list]:
    """(live, replaced) commits, oldest first; a few hundred rows."""
    rows = sorted(committed(spark, out_dir).collect(), key=lambda r: (r["first"], -r["last"]))
    keep, gone, reach = [], [], -1
    for r in rows:
        (gone if r["last"] <= reach else keep).append(r)
        reach = max(reach, r["last"])
    return keep, gone


def live(spark: SparkSession, out_dir: str) -> DataFrame:
    """The counts of what is read: runs and the batches outside them."""
    keep, _ = _spans(spark, out_dir)
    return spark.createDataFrame([tuple(r) for r in keep], committed(spark, out_dir).schema)


def _folder(out_dir: str, name: str, r) -> str:
    return _batch(out_dir, name, r["first"]) if _single(r) else _run(out_dir, name, r["first"], r["last"])


def _single(r) -> bool:
    return r["first"] == r["last"]


def _read(spark: SparkSession, out_dir: str, name: str, schema: str, rows: list) -> DataFrame:
    if not rows:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[_folder(out_dir, name, r) for r in rows])


def read_live(spark: SparkSession, out_dir: str, name: str, schema: str) -> DataFrame:
    """A table's rows of all committed batches, each once."""
    return _read(spark, out_dir, name, schema, _spans(spark, out_dir)[0])


def to_merge(sizes: list[int], every: int = COMPACT_EVERY, most: int = RUN_BATCHES) -> int | None:
    """From which of the spans (their batches, oldest first) the newest are
    merged; None while fewer than ``every`` single batches wait."""
    at, total = len(sizes), 0
    while at and sizes[at - 1] == 1:
        at, total = at - 1, total + 1
    if total < max(every, 2):
        return None
    while at and sizes[at - 1] <= total and total + sizes[at - 1] <= most:
        at, total = at - 1, total + sizes[at - 1]
    return at


def compact(spark: SparkSession, out_dir: str, tables: dict[str, str], every: int = COMPACT_EVERY,
            most: int = RUN_BATCHES) -> bool:
    """Remove what earlier runs have replaced, then fold the newest batches
    (all but the last one) into a run; whether there was one to make."""
    keep, gone = _spans(spark, out_dir)
    for r in gone:
        for name in [*tables, "commits"]:
            fs, p = _path(spark, _folder(out_dir, name, r))
            fs.delete(p, True)
    closed = keep[:-1] if keep and _single(keep[-1]) else keep
    at = to_merge([r["last"] - r["first"] + 1 for r in closed], every, most)
    if at is None:
        return False
    rows = closed[at:]
    first, last = rows[0]["first"], rows[-1]["last"]
    for name, schema in tables.items():
        # as many files as the size asks for, not one for each batch
        whole = _read(spark, out_dir, name, schema, rows).hint("rebalance")
        whole.write.mode("overwrite").parquet(_run(out_dir, name, first, last))
    sums = {c: sum(r[c] for r in rows) for c in ("batches", "records", "scored", "anomalies")}
    _one_row(spark, sums, f"batches long, {COUNTS}", _run(out_dir, "commits", first, last))
    return True
