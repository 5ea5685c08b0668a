"""Session defaults for tests and the bench; a cluster brings its own settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "scorewright") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores if cores != "*" else 8))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SCOREWRIGHT_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and hand-over tables, as the cluster names it.

    That is spark.checkpoint.dir, else the context's checkpoint folder. Only a session on one machine
    without either, as in tests, gets a folder of its own; on a cluster that is an error, as its
    machines share no temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        named = context._jsc.sc().getCheckpointDir()
        if named.isDefined():
            folder = named.get()
        elif context.master.startswith("local[") or context.master == "local":
            folder = tempfile.mkdtemp(prefix="scorewright-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def reliable_checkpoint(df):
    """Cut the lineage of a table that several jobs re-read (a split, a training table)."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
