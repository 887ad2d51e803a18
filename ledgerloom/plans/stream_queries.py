"""Streaming queries, run over everything there is; their SQL twins are those of the batch form."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerloom.plans.window_queries import SQL as BATCH
from ledgerloom.session import shared_folder
from ledgerloom.streaming import events as E


def _folder(spark) -> str:
    """A new folder in the session's shared folder."""
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def stream_hourly(spark, d):
    """Events and value by hour and type."""
    to = _folder(spark)
    aggs = [F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total")]
    stream = E.windowed(E.read(spark, d, "events"), "ts", "1 hour", None, ["event_type"], aggs, late=None)
    flat = stream.select(F.unix_timestamp("w.start").alias("start"), "event_type", "events", "total")
    E.run_available(flat, "update", E.upsert_into(f"{to}/out", ["start", "event_type"]), f"{to}/state")
    return E.latest(spark, f"{to}/out", ["start", "event_type"])


def stream_sliding(spark, d):
    to = _folder(spark)
    aggs = [F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total")]
    stream = E.windowed(E.read(spark, d, "events"), "ts", "2 hours", "1 hour", [], aggs, late=None)
    flat = stream.select(F.unix_timestamp("w.start").alias("start"), "events", "total")
    E.run_available(flat, "update", E.upsert_into(f"{to}/out", ["start"]), f"{to}/state")
    return E.latest(spark, f"{to}/out", ["start"])


def stream_totals(spark, d):
    """Running count and sum per user, as the last batch left them."""
    to = _folder(spark)
    E.run_available(E.running_totals(E.read(spark, d, "events")), "update", E.upsert_into(f"{to}/out", ["user_id"]), f"{to}/state")
    return E.latest(spark, f"{to}/out", ["user_id"]).withColumn("total", F.round("total", 2))


SQL = {
    "stream_hourly": BATCH["tumbling_events"],
    "stream_sliding": BATCH["sliding_events"],
    "stream_totals": "SELECT user_id, count(*) AS events, round(SUM(value), 2) AS total FROM events GROUP BY 1",
}
QUERIES = {f.__name__: f for f in (stream_hourly, stream_sliding, stream_totals)}
