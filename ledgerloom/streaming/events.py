"""Streams of events: windows with watermarks, sessions, idempotent upserts, running totals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: How late an event may come before its window is closed.
LATE = "10 minutes"


def read(spark: SparkSession, folder: str, name: str, files_per_trigger: int = 64) -> DataFrame:
    """The files of a table in a folder, or of the table's own directory, as a stream; the schema is that of the files there are."""
    own = f"{folder}/{name}.parquet"
    stream = spark.readStream.schema(spark.read.parquet(own).schema).option("maxFilesPerTrigger", files_per_trigger)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return stream.parquet(own)
    return stream.option("pathGlobFilter", f"{name}*.parquet").parquet(folder)


def windowed(events: DataFrame, at: str, size: str, slide: str | None, by: list[str], aggregates: list[Column], late: str | None = LATE) -> DataFrame:
    """Tumbling (no slide) or sliding windows with a watermark; state is dropped once a window can't change. Without `late` no event is too late and all state is kept."""
    timed = events.withColumn(at, F.col(at).cast("timestamp"))
    timed = timed.withWatermark(at, late) if late else timed
    window = F.window(at, size, slide) if slide else F.window(at, size)
    return timed.groupBy(window.alias("w"), *by).agg(*aggregates)


def sessions(events: DataFrame, at: str, gap: str, by: list[str], aggregates: list[Column], late: str = LATE) -> DataFrame:
    """Windows that end when `gap` goes by without an event of the key."""
    timed = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return timed.groupBy(F.session_window(at, gap).alias("w"), *by).agg(*aggregates)


def once_each(events: DataFrame, at: str, key: str, late: str = LATE) -> DataFrame:
    """Events without those whose key came before within the watermark."""
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def running_totals(events: DataFrame) -> DataFrame:
    """Count and sum of each user so far, told with every batch that has an event of theirs.

    A stateful aggregation in the JVM: its partial sums combine before the
    state's shuffle, so a hot user costs one row a task. Null values add nothing.
    """
    total = F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 6)
    return events.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"), total.alias("total"))


def upsert_into(path: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch that keeps the last told row of each key under `path`.

    Each batch writes its own folder, named by its number, so that a batch told
    again after a failure replaces itself; `latest` reads what holds.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch={number:012d}")

    return write


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last told row of each key of an upsert folder."""
    told = spark.read.parquet(f"{path}/batch=*")
    rest = [c for c in told.columns if c not in (*keys, "_batch", "batch")]
    return told.groupBy(*keys).agg(F.max(F.struct("_batch", *rest)).alias("m")).select(*keys, *[F.col(f"m.{c}").alias(c) for c in rest])


def run_available(stream: DataFrame, mode: str, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Takes in everything there is, in batches, and stops; a second run goes on after it."""
    query = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
