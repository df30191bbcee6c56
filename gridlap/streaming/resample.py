"""Time grids and signal repair; the resampling runs on batches and on streams alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlap.streaming.ingest import ingest as ingest


def resample(df: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], every: str = "1 second", late: str | None = None) -> DataFrame:
    """Tumbling means of the values; on a stream, `late` is how long late rows are waited for."""
    if late is not None:
        df = df.withWatermark(time, late)
    return df.groupBy(*keys, F.window(time, every).alias("_w")).agg(*(F.avg(c).alias(c) for c in values)).select(*keys, F.col("_w.start").alias(time), *values)


def remove_jumps(df: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], most: float = 5000) -> DataFrame:
    """A value further than `most` from the one before becomes null."""
    w = Window.partitionBy(*keys).orderBy(time)
    return df.withColumns({c: F.when(F.coalesce(F.abs(F.col(c) - F.lag(c).over(w)) <= most, F.lit(True)), F.col(c)) for c in values})


def interpolate(df: DataFrame, keys: Sequence[str], time: str, values: Sequence[str]) -> DataFrame:
    """Nulls between known values become linear in time; at the ends the nearest known value goes on."""
    w, back = (Window.partitionBy(*keys).orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.asc(time), F.desc(time)))
    at = F.unix_micros(F.col(time).cast("timestamp")).cast("double")
    made = {}
    for c in values:
        point = F.when(F.col(c).isNotNull(), F.struct(at.alias("t"), F.col(c).cast("double").alias("v")))
        a = F.last(point, ignorenulls=True).over(w)
        b = F.last(point, ignorenulls=True).over(back)
        between = a["v"] + (b["v"] - a["v"]) * (at - a["t"]) / F.nullif(b["t"] - a["t"], F.lit(0.0))
        made[c] = F.coalesce(F.col(c).cast("double"), between, a["v"], b["v"])
    return df.withColumns(made)


def motion_features(df: DataFrame, keys: Sequence[str], time: str, speed: str = "Speed", throttle: str = "Throttle", rows: int = 5) -> DataFrame:
    """Throttle change, mean speed of the last rows, and speed change per second."""
    w = Window.partitionBy(*keys).orderBy(time)
    s = F.unix_micros(F.col(time).cast("timestamp")) / 1e6
    return df.withColumns({"throttle_delta": F.col(throttle) - F.lag(throttle).over(w), "rolling_mean_speed": F.avg(speed).over(w.rowsBetween(1 - rows, 0)), "acceleration": (F.col(speed) - F.lag(speed).over(w)) / F.nullif(s - F.lag(s).over(w), F.lit(0.0))})
