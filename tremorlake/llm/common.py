"""Helpers of the corpus operators: scratch tables in the shared folder, text columns, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tremorlake.session import checkpoint_folder

BLANKS = r"\x20\x09-\x0D"  # the white space of the contracts: space, tab to carriage return
ARROW_ROWS = 500  # rows of an Arrow batch, so that long texts stay within a worker's memory
SMALL_ROWS = 500_000  # rows of two numbers each that may be broadcast: 8 MB, some 30 MB as a hash table


def small_batches(spark: SparkSession) -> SparkSession:
    """Arrow batches of few rows: a row can be a very long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def keep(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder; ``drop`` takes the files away again."""
    spark = df.sparkSession
    checkpoint_folder(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._scratch = path
    return kept


def drop(*tables: DataFrame) -> None:
    """Delete tables of ``keep`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it, that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sent(kept: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """How to join with columns of ``kept``, a written table of a few numbers a row: broadcast if it is
    counted to have at most ``SMALL_ROWS`` rows, else by a shuffle, whatever size Spark takes it for. Both give the same rows."""
    return F.broadcast if kept.count() <= SMALL_ROWS else lambda df: df.hint("merge")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected ``edges`` (a, b); root is the component's smallest node.

    Label propagation with pointer jumping: a node takes the smallest root among its neighbours and
    then that root's own root. Per round one aggregation, combined before its shuffle, so a node
    with very many neighbours is no hot task; labels and edges stay tables. No edges: an empty table.
    """
    both = keep(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = keep(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")))
    send = sent(labels)  # the nodes stay the same in every round
    while True:
        heard = both.join(send(labels), F.col("b") == F.col("node")).groupBy(F.col("a").alias("n2")).agg(F.min("root").alias("heard"))
        own = send(labels.select("node", F.col("root").alias("old")))
        best = heard.join(own, F.col("n2") == F.col("node")).select("node", "old", F.least("old", "heard").alias("best"))  # every node has a neighbour
        roots = send(labels.select(F.col("node").alias("r"), F.col("root").alias("rr")))
        jumped = keep(best.join(roots, F.col("best") == F.col("r")).select("node", "old", F.least("best", "rr").alias("root")))
        drop(labels)
        labels = jumped
        changed = labels.filter(F.col("root") != F.col("old")).limit(1).count()
        if not changed:
            drop(both)
            return labels.select("node", "root")
