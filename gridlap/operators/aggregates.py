"""Summaries, distributions and statistics, each in one or two aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlap.operators import order, rows, store
from gridlap.operators.rolling import KEYS


def weather_by_session(weather: DataFrame) -> DataFrame:
    means = rows.present(weather, ("air_temperature", "track_temperature", "humidity", "pressure", "wind_speed"))
    return weather.where("session_key is not null").groupBy("session_key").agg(*(F.avg(c).alias(f"{c}_mean") for c in means), F.max("rainfall").alias("rainfall_max"))


def laps_by_driver(laps: DataFrame) -> DataFrame:
    x = "lap_duration"
    return laps.dropna(subset=list(KEYS)).groupBy(*KEYS).agg(F.count(x).alias("lap_count"), F.avg(x).alias("avg_lap_duration"), F.min(x).alias("best_lap_duration"), F.median(x).alias("median_lap_duration"), F.stddev_samp(x).alias("lap_duration_std"))


def stints_by_driver(stints: DataFrame) -> DataFrame:
    known = F.when(F.col("compound").isNotNull(), F.col("stint_number"))
    return stints.dropna(subset=list(KEYS)).groupBy(*KEYS).agg(F.count_distinct("stint_number").alias("stint_count"), F.max("tyre_age_at_start").alias("max_tyre_age_at_start"), F.min_by("compound", known).alias("first_compound"), F.max_by("compound", known).alias("last_compound"), F.count_distinct("compound").alias("compound_count"))


def telemetry_by_lap(car_data: DataFrame, keys: Sequence[str] = (*KEYS, "lap_number")) -> DataFrame:
    """Signals summed up for each lap; signals that are missing are left out, a sum of nothing is 0."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    made = {
        "Speed": [("max", F.max), ("min", F.min), ("mean", F.avg), ("std", F.stddev_samp)],
        "Throttle": [("mean", F.avg), ("q90", lambda c: F.percentile(c, 0.9))],
        "Brake": [("mean", F.avg), ("sum", total)],
        "RPM": [("mean", F.avg), ("std", F.stddev_samp)],
        "nGear": [("mean", F.avg), ("max", F.max)],
        "DRS": [("sum", total)],
    }
    found = [f(F.col(c).cast("double")).alias(f"{c.lower()}_{name}") for c, fs in made.items() if c in car_data.columns for name, f in fs]
    return car_data.dropna(subset=list(keys)).groupBy(*keys).agg(*found)


def histogram(df: DataFrame, value: str, bins: int, high: float | None = None) -> DataFrame:
    """bin (from 1), n: equal bins between least and greatest value; the greatest falls into the last one."""
    x = df.where(F.col(value).isNotNull()).select((F.least(F.col(value), F.lit(high)) if high is not None else F.col(value)).alias("x"))
    ends = x.agg(F.min("x").alias("a"), F.max("x").alias("b"))
    at = F.least(F.lit(bins), F.greatest(F.lit(1), F.floor((F.col("x") - F.col("a")) / (F.col("b") - F.col("a")) * bins) + 1))
    return x.crossJoin(F.broadcast(ends)).select(F.when(F.col("b") > F.col("a"), at).otherwise(1).cast("long").alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))


def box_plot(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers at the last values within 1.5 quartile distances, and the number of values beyond."""
    q = order.exact_quantiles_by(df.where(F.col(value).isNotNull()), by, [value], [0.25, 0.5, 0.75]).withColumnRenamed(value, "q")
    q = q.select(*by, F.col("q")[0].alias("q1"), F.col("q")[1].alias("q2"), F.col("q")[2].alias("q3"))
    x, reach = F.col(value), 1.5 * (F.col("q3") - F.col("q1"))
    inside = x.between(F.col("q1") - reach, F.col("q3") + reach)
    return df.where(x.isNotNull()).join(q, list(by)).groupBy(*by, "q1", "q2", "q3").agg(F.min(F.when(inside, x)).alias("low"), F.max(F.when(inside, x)).alias("high"), F.count_if(~inside).alias("outliers"))


def pivot_median(df: DataFrame, row: str, bin_of: str, edges: Sequence[float], value: str) -> DataFrame:
    """Median value by row and right-closed bin; empty cells are null."""
    label = F.lit(None).cast("string")
    names = []
    for a, b in zip(edges, edges[1:], strict=False):
        names.append(f"bin_{a:g}_{b:g}")
        label = F.when((F.col(bin_of) > a) & (F.col(bin_of) <= b), names[-1]).otherwise(label)
    medians = order.exact_quantiles_by(df.withColumn("_bin", label).where("_bin is not null"), [row, "_bin"], [value], [0.5])
    return medians.groupBy(row).pivot("_bin", names).agg(F.max(F.col(value)[0]))  # one row a cell


def medians(df: DataFrame, value: str, by: Sequence[str], name: str = "median") -> DataFrame:
    """by, and the exact median; groups of any size."""
    return order.exact_quantiles_by(df, by, [value], [0.5]).select(*by, F.col(value)[0].alias(name))


def spearman(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """a, b, correlation of ranks for every pair of columns, over rows without nulls; ties share their mean rank.

    The rows and each column's ranks are written once, so that Spark knows the ranks' size: where they are few, the rows meet
    them without a shuffle.
    """
    whole = store.cut(df.select(*columns).dropna("any"))
    ranked = whole
    for c in columns:
        ranked = ranked.join(store.cut(order.mean_ranks(whole, c).withColumnRenamed("rank", f"_r_{c}")), c)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    # Every column's mean rank is known, so a pair takes one plain sum; so many corr() at once are too much for compiled code.
    mean = (whole.count() + 1) / 2
    sums = ranked.select(*((F.col(f"_r_{c}") - mean).alias(c) for c in columns)).agg(*(F.sum(F.col(a) * F.col(b)).alias(f"{a}|{b}") for a, b in pairs))
    scale = lambda a, b: F.sqrt(F.col(f"`{a}|{a}`")) * F.sqrt(F.col(f"`{b}|{b}`"))
    return _tall(sums.select(*(F.try_divide(F.col(f"`{a}|{b}`"), scale(a, b)).alias(f"{a}|{b}") for a, b in pairs)), pairs, "correlation")


def _tall(row: DataFrame, pairs: Sequence[tuple[str, str]], name: str) -> DataFrame:
    cells = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias(name)) for a, b in pairs))
    return row.select(F.inline(cells))


def vif(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, vif, risk: variance inflation without a constant, from one aggregate of the columns' products."""
    import numpy as np

    whole = df.select(*columns).dropna("any")
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    sums = whole.agg(*(F.sum(F.col(columns[i]) * F.col(columns[j])).alias(f"g{i}_{j}") for i, j in pairs)).first()
    gram = np.zeros((len(columns), len(columns)))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = float(sums[f"g{i}_{j}"] or 0)
    inverse = np.linalg.pinv(gram)
    out = df.sparkSession.createDataFrame([(c, float(gram[i, i] * inverse[i, i])) for i, c in enumerate(columns)], "column string, vif double")
    return out.withColumn("risk", F.when(F.col("vif") > 10, "HIGH").when(F.col("vif") > 5, "MEDIUM").otherwise("OK"))


def trend_lines(df: DataFrame, y: str, x: str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))


def coverage(df: DataFrame, columns: Sequence[str], least: float = 0.3) -> DataFrame:
    """column, share, status: how many values are known."""
    row = df.agg(*(F.avg(F.col(c).isNotNull().cast("int")).alias(c) for c in columns))
    tall = row.unpivot([], list(columns), "column", "share")
    return tall.withColumn("status", F.when(F.col("share") < least, "warning").otherwise("ok"))


def missing_share(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """by, row_count, missing: how many rows each group has, and the share of them without a value."""
    return df.groupBy(*by).agg(F.count("*").alias("row_count"), F.avg(F.col(column).isNull().cast("int")).alias("missing"))


def win_rate(df: DataFrame, position: str = "position") -> DataFrame:
    rate = F.count_if(F.col(position) == 1) / F.count(position)
    return df.agg(F.count_if(F.col(position) == 1).alias("wins"), F.count(position).alias("total"), rate.alias("win_rate"), (1 / F.nullif(rate, F.lit(0.0))).alias("class_weight"))
