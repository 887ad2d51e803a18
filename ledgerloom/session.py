"""Session defaults, table loading and lineage cuts shared by all operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings that every session should have; none depends on the data's size.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and the local bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("ledgerloom")
    settings = DEFAULTS | {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in (settings | extra).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One staged table; a directory of part files and a single file read alike."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir` of the session.

    Only a local session without one (tests, a single machine) gets a temporary
    folder; on a cluster that would be a path only the driver has, so it raises.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError("spark.checkpoint.dir names no shared folder")
    held = context._jsc.sc().getCheckpointDir()
    return held.get() if not held.isEmpty() else tempfile.mkdtemp(prefix="ledgerloom-")


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and go on from there."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """`df` in as many tasks as the session has cores, if its files make fewer; else as it is.

    For inputs of a few small files ahead of costly map work. A large input has
    more files than cores and isn't shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df
