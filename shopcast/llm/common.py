"""Helpers shared by the operators: intermediate tables, graph components."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopcast.session import shared_dir

#: A word: space and the control characters 9 to 13 separate.
WORD = "[^\\x20\\x09-\\x0D]+"


def scratch(spark: SparkSession) -> str:
    """The folder for intermediate tables, shared by driver and executors:
    ``spark.checkpoint.dir`` of the session (see ``session.shared_dir``)."""
    return shared_dir(spark)


def table(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts the lineage: what a lost executor held is read again from the
    files, and what is used twice is computed once.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers_ready(df: DataFrame) -> DataFrame:
    """Let Python workers import this package from where the driver did.

    On a cluster without a common install the package goes along with
    ``--py-files``; the extra path does no harm there.
    """
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])
    return df


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    return workers_ready(df).mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph given as edges (a, b).

    Returns (node, comp) for every node of an edge; ``comp`` is the
    smallest node of the component.  Randomised contraction: in each round
    every node takes the neighbour (or itself) with the smallest hash of
    that round as its parent, edges move to the parents and loops vanish.
    At least a constant share of the nodes goes in each round whatever the
    shape, so long chains and stars end after a logarithmic number of
    rounds.  A round is one aggregate and joins; the tables of a round are
    written, so nothing of the graph is held on the driver.
    """
    edges = table(edges.filter("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    names = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    names = table(names.withColumn("root", F.col("node")), "nodes")
    turn = 0
    while not edges.isEmpty():
        turn += 1
        both = edges.select("a", "b").unionByName(edges.select(
            F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("n"))
        up = both.groupBy("a").agg(F.min(rank("b")).alias("m")).select(
            F.col("a").alias("child"), F.least("m", rank("a"))["n"].alias("parent"))
        up = table(up, f"parents{turn}")
        names = table(names.join(up, names.root == up.child, "left").select(
            "node", F.coalesce("parent", "root").alias("root")), f"nodes{turn}")
        left = edges.join(up.select(F.col("child").alias("a"), F.col("parent").alias("pa")), "a")
        moved = left.join(up.select(F.col("child").alias("b"), F.col("parent").alias("pb")), "b")
        edges = table(moved.filter("pa <> pb").select(
            F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(),
            f"edges{turn}")
    least = names.groupBy("root").agg(F.min("node").alias("comp"))
    return names.join(least, "root").select("node", "comp")
