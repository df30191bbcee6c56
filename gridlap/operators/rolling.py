"""Rolling features over earlier laps only; one ordering serves every frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("session_key", "driver_number")
WINDOWS = (3, 5, 10)


def rolling_features(df: DataFrame, keys: Sequence[str] = KEYS, order: str = "lap_number", value: str = "lap_duration", windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Mean, deviation and best of the w laps before this one, the change to the previous lap, laps to go and share done.

    A frame ends at the row before, so no value depends on its own or a later lap. Laps to go and the share done use
    the driver's last lap, as the features are defined.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    x, lap, last = F.col(value), F.col(order), F.max(order).over(Window.partitionBy(*keys))
    made = {}
    for n in windows:
        frame = w.rowsBetween(-n, -1)
        made |= {f"rolling_avg_lap_{n}": F.avg(x).over(frame), f"rolling_std_lap_{n}": F.stddev_samp(x).over(frame), f"rolling_best_lap_{n}": F.min(x).over(frame)}
    made["lap_delta_prev"] = x - F.lag(x).over(w)
    made["laps_to_go"] = F.greatest(last - lap, F.lit(0))
    made["race_completion_pct"] = F.round(lap / F.nullif(last, F.lit(0)), 4)
    return df.withColumns(made)


def lagged(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS, order: str = "lap_number", prefix: str = "tele_prev_") -> DataFrame:
    """The columns' values of the previous row that exists, renamed with the prefix."""
    w = Window.partitionBy(*keys).orderBy(order)
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, *(F.lag(c).over(w).alias(prefix + c) for c in columns))


def outlier_flag(value: str, keys: Sequence[str] = KEYS, deviations: float = 3.0) -> F.Column:
    """Whether a value is more than so many sample deviations from its group's mean; null and constant groups: no."""
    w = Window.partitionBy(*keys)
    z = (F.col(value) - F.avg(value).over(w)) / F.nullif(F.stddev_samp(value).over(w), F.lit(0.0))
    return F.coalesce(F.abs(z) > deviations, F.lit(False))
