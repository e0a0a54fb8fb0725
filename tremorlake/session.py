"""Session defaults shared by the library, the tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "tremorlake") -> SparkSession:
    """A local session for tests and the bench; on a cluster pass in the one you have."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TREMORLAKE_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """All times are UTC: set it on the session that runs our plans."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_folder(spark: SparkSession) -> None:
    """Make sure reliable checkpoints have a folder.

    The cluster names a shared one in ``spark.checkpoint.dir``. Only a local master without that
    setting gets a folder of its own; a cluster without it is an error, because a machine-local
    folder would be lost with its executor.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tremorlake-checkpoint-")
    context.setCheckpointDir(folder)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared checkpoint folder and go on from there.

    Lineage is cut, and lost executors cannot take the rows with them. Against ``checkpoint()``, which
    runs the last stage twice, the table is written in one pass, and later scans prune its columns.
    """
    spark = df.sparkSession
    checkpoint_folder(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._scratch = path
    return kept


def release(*tables: DataFrame) -> None:
    """Delete tables of ``durable`` that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
