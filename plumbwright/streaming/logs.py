"""Windowed traffic reports over a stream of log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbwright.functions.cells import ratio
from plumbwright.operators.logs import SLICES, event_time, parse_lines, records


def timed_records(
    lines: DataFrame, watermark: str = "1 hour", line: str = "line", observe: str | None = None
) -> DataFrame:
    """Parsed records with an event time and a watermark; unreadable times drop out.

    Malformed lines and records with an unreadable time reach no window.  With
    ``observe`` their numbers and that of the records that do appear under this
    name in the progress of the query, per micro-batch.
    """
    parsed = parse_lines(lines, line).withColumn("event_ts", event_time(F.col("ts")))
    if observe:
        timed = F.col("event_ts").isNotNull()
        parsed = parsed.observe(
            observe,
            F.count_if(F.col("ok") & timed).alias("records"),
            F.count_if(F.col("ok") & ~timed).alias("unreadable_times"),
            F.count_if(~F.col("ok")).alias("malformed"),
        )
    timed = records(parsed)
    return timed.filter(F.col("event_ts").isNotNull()).withWatermark("event_ts", watermark)


def traffic_windows(timed: DataFrame, window: str = "1 hour", slow_ms: int = 500) -> DataFrame:
    """Requests, error rate and slow requests per window."""
    return (
        timed.groupBy(F.window("event_ts", window).alias("window"))
        .agg(
            F.count(F.lit(1)).alias("total_requests"),
            F.bround(ratio(100.0 * F.count_if(F.col("status") >= 400), F.count(F.lit(1))), 1).alias("error_rate_pct"),
            F.count_if(F.col("ms") >= slow_ms).alias("slow_requests"),
        )
        .select("window", "total_requests", "error_rate_pct", "slow_requests")
    )


def status_windows(timed: DataFrame, window: str = "1 hour") -> DataFrame:
    return timed.groupBy(F.window("event_ts", window).alias("window"), "status").agg(F.count(F.lit(1)).alias("n"))


def path_windows(timed: DataFrame, window: str = "1 hour") -> DataFrame:
    """Mean latency per window and path.  Rank them per micro-batch with ``top_paths``."""
    return timed.groupBy(F.window("event_ts", window).alias("window"), "path").agg(
        F.avg("ms").alias("avg_ms"), F.count(F.lit(1)).alias("n")
    )


def top_paths(batch: DataFrame, k: int = 3) -> DataFrame:
    """The k slowest paths of each window in a finished (batch) table."""
    slices = F.pmod(F.xxhash64("path"), F.lit(SLICES))
    within = Window.partitionBy("window", slices).orderBy(F.desc("avg_ms"), "path")
    order = Window.partitionBy("window").orderBy(F.desc("avg_ms"), "path")
    few = batch.withColumn("_at", F.row_number().over(within)).filter(F.col("_at") <= k).drop("_at")
    return few.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
