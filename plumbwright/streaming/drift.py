"""Drift rules on tumbling windows of a stream of raw rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbwright.functions.cells import field
from plumbwright.operators.drift import profile, violations


_BEAT = "_beat"


def with_heartbeats(rows: DataFrame, beats: DataFrame, event_time: str, beat_time: str | None = None) -> DataFrame:
    """Rows united with those of a stream that goes on when they stop, marked in the column ``_beat``.

    A heartbeat has a time (``beat_time``, by default named like ``event_time``) and
    no other cells.  It moves the watermark and opens the windows it falls into,
    so windows without rows are there and close.  Any stream with times of its own
    will do: a clock, or another feed of the same system.
    """
    own = rows.withColumns({event_time: field(event_time).cast("timestamp"), _BEAT: F.lit(False)})
    ticks = beats.select(field(beat_time or event_time).cast("timestamp").alias(event_time), F.lit(True).alias(_BEAT))
    return own.unionByName(ticks, allowMissingColumns=True)


def windowed_profile(
    rows: DataFrame, columns: Sequence[str], event_time: str, window: str = "1 hour", watermark: str = "1 hour",
    beats: DataFrame | None = None, beat_time: str | None = None,
) -> DataFrame:
    """Column statistics per window; rows later than the watermark are dropped.

    Event time is cast to a zoned timestamp, which watermarks require.  Columns
    that the rows do not have are empty.  With ``beats`` (see
    :func:`with_heartbeats`) a window in which only heartbeats fall is profiled as
    one of 0 rows.
    """
    if beats is not None:
        rows = with_heartbeats(rows, beats, event_time, beat_time)
    timed = rows.withColumn(event_time, field(event_time).cast("timestamp")).withWatermark(event_time, watermark)
    counted = None if beats is None else ~F.col(_BEAT)
    return profile(timed, columns, by=[F.window(event_time, window).alias("window")], counted=counted)


def baseline_columns(baseline: DataFrame) -> list[str]:
    """The profiled columns of a baseline, in their order: a list as short as the caller made it."""
    found = baseline.select("column_no", "column").distinct().orderBy("column_no").collect()
    return [r["column"] for r in found]


def live_alarms(
    rows: DataFrame, baseline: DataFrame, rules: list[Column], event_time: str, beats: DataFrame, window: str = "1 hour",
    watermark: str = "1 hour", beat_time: str | None = None,
) -> DataFrame:
    """Violations of a live feed that may fall silent as a whole or lose a column.

    Profiles the baseline's columns, whether the feed has them or not.  Write it
    in append mode: a window is judged once, when the heartbeats' watermark has
    passed its end; one without rows breaks the completeness rule of every column.
    """
    profiles = windowed_profile(rows, baseline_columns(baseline), event_time, window, watermark, beats, beat_time)
    return violations(profiles, baseline, rules)


def drift_monitor(profiles: DataFrame, baseline: DataFrame, rules: list[Column]) -> DataFrame:
    """Violations per window against a stored baseline profile.

    Write it in append mode, where every window is judged once, when it closes.
    In update mode a window that fired early and recovered would keep its alarm;
    to judge open windows, store the updated profiles and apply the rules to the
    stored table.
    """
    return violations(profiles, baseline, rules)
