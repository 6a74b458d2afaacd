"""Session settings and the shared folder for lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE coalesces small shuffle partitions and splits skewed join partitions. The co-partition
# switch lets a join on (store, item, week) use data already partitioned by series.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Partition folders hold identifiers; reading "01" back as a number would change them.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Plans with many columns are built faster without a Python stack trace per expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Files of checkpoints nobody refers to any more are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def make_session(app: str = "daytally", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; ``master`` only for local runs and tests."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it gets a temporary folder once per session.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is None:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="daytally-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path for a table handed from one job to the next."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """Rows written as parquet in the shared folder and read back: later passes read the columns
    they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes a table that no later job reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
