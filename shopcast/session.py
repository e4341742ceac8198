"""Session and scratch-space helpers.

The library never creates its own SparkSession inside operators; these
helpers exist for tests, the benchmark and command-line use.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "shopcast",
                shuffle_partitions: int | None = None,
                driver_memory: str = "16g") -> SparkSession:
    """Create (or reuse) a session configured for this library.

    AQE stays on so that shuffle partitions are coalesced and skewed joins
    are split at run time; the UI stays off (no server is opened).
    """
    master = master or os.environ.get("SHOPCAST_MASTER", "local[*]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", driver_memory))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def workers_ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver did.  On
    a cluster without a common install it goes along with ``--py-files``."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables that all executors reach.

    ``spark.checkpoint.dir`` of the session.  Where that is unset, a folder
    in the warehouse serves a session that runs on one machine (``local``
    masters: tests, the benchmark); on a cluster it is an error, as the
    default warehouse is a folder of one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return base.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one run (streams, tables)."""
    return f"{shared_dir(spark)}/shopcast/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing the
    plan) and fixes row order within partitions, so later passes over the
    result are deterministic.  Used instead of ``DataFrame.checkpoint``,
    which keeps the full logical plan around.
    """
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
