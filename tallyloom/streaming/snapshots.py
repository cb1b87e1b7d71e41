"""Snapshots of a trailing window at regular ticks, over a stream or a table alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ticking_counts(rows: DataFrame, time: str, key: str, duration: str, every: str, late: str = "1 hour") -> DataFrame:
    """(tick, key, n, last): at every tick the rows of each key within `duration` before it, and the last one's time.

    A window holds times from its start to before the tick. Over a stream, state for a tick is dropped once `late` has
    passed since; rows that come later are left out, as a watermark has it. Null times belong to no tick.
    """
    ticks = rows.withWatermark(time, late).groupBy(F.window(time, duration, every).alias("w"), key)
    counted = ticks.agg(F.count("*").alias("n"), F.max(time).alias("last"))
    return counted.select(F.col("w.end").alias("tick"), key, "n", "last")
