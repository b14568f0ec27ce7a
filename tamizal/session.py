"""Session helpers shared by every query: table access, checkpoint folder, task spreading."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tamizal", cpus: str = "8", shuffle: int = 8) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TAMIZAL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the shared folder the cluster names in spark.checkpoint.dir.

    Without that setting a local session (tests on one machine) gets a folder of its own, removed at
    its end; a cluster has no folder that all its machines share, so there it is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = sc.getConf().get("spark.checkpoint.dir")
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        named = tempfile.mkdtemp(prefix="tamizal-ckpt-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)


def spread(df: DataFrame) -> DataFrame:
    """Gives CPU-heavy Python stages at least one task per core when the scan yields fewer."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df
