"""Joins that Spark has no single operator for: dimension look-ups with renamed clashes, the stint range join, as-of joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlap.operators import rows, store


def look_up(facts: DataFrame, dimension: DataFrame, on: Sequence[str], suffix: str = "_sess") -> DataFrame:
    """Left join facts to the first row a key of the dimension; clashing names of the dimension get the suffix.

    No broadcast is forced: Spark picks one if the dimension is small enough.
    """
    clash = set(facts.columns) - set(on)
    unique = rows.first_come(dimension, on)
    return facts.join(unique.withColumnsRenamed({c: c + suffix for c in unique.columns if c in clash}), list(on), "left")


def orphans(facts: DataFrame, dimension: DataFrame, on: Sequence[str]) -> DataFrame:
    return facts.join(dimension.select(*on).distinct(), list(on), "left_anti")


#: Widths of the cells in which intervals meet points; 1, and each a multiple of the one before.
WIDTHS = (1, 8, 64)


def interval_cells(low: Column, high: Column, widths: Sequence[int] = WIDTHS) -> Column:
    """The (width, cell) that together cover the whole numbers low to high, each of them once: the widest cells that lie inside."""
    if widths[0] != 1 or any(b % a for a, b in zip(widths, widths[1:], strict=False)):
        raise ValueError(widths)
    ends = [(F.ceil(low / w).cast("long"), (F.floor((high + 1) / w) - 1).cast("long")) for w in widths]
    span = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<bigint>"))
    cells = []
    for i, (w, (a, b)) in enumerate(zip(widths, ends, strict=True)):
        if i + 1 < len(widths):
            times = widths[i + 1] // w
            inner_a, inner_b = ends[i + 1][0] * times, (ends[i + 1][1] + 1) * times - 1
            own = F.when(inner_a <= inner_b, F.concat(span(a, inner_a - 1), span(inner_b + 1, b))).otherwise(span(a, b))
        else:
            own = span(a, b)
        cells.append(F.transform(own, _cell(w)))
    return F.concat(*cells)


def _cell(width: int):
    return lambda c: F.struct(F.lit(width).alias("width"), c.alias("cell"))


def range_join(points: DataFrame, intervals: DataFrame, by: Sequence[str], point: str, low: str, high: str, open_low: float = -1, open_high: float = 9999, widths: Sequence[int] = WIDTHS) -> DataFrame:
    """Points with every interval of their group that covers them.

    A point of a group without intervals stays with nulls; a point that no interval of its group covers goes. So it
    is an inner range join and the groups that match nothing, rather than an outer join filtered afterwards.

    Intervals are taken apart into cells of a few widths, and a point lies in one cell of each width: points and intervals meet by
    cell, so only those meet that belong together (but for fractions of a cell of width 1), and a large group is spread over its cells.
    """
    by = list(by)
    a, b = F.coalesce(F.col(low), F.lit(open_low)), F.coalesce(F.col(high), F.lit(open_high))
    dealt = intervals.where(a <= b).withColumn("_at", F.explode(interval_cells(F.floor(a).cast("long"), F.floor(b).cast("long"), widths)))
    met = points.withColumn("_at", F.explode(F.array(*(F.struct(F.lit(w).alias("width"), F.floor(F.col(point) / w).cast("long").alias("cell")) for w in widths))))
    apart = lambda df: df.withColumns({"_width": F.col("_at.width"), "_cell": F.col("_at.cell")}).drop("_at")
    inside = apart(met).join(apart(dealt), [*by, "_width", "_cell"]).where(F.col(point).between(a, b)).drop("_width", "_cell")
    alone = points.join(intervals.select(*by).distinct(), by, "left_anti")
    return inside.unionByName(alone, allowMissingColumns=True)


def as_of(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, values: Sequence[str], direction: str = "backward", tolerance: float | None = None, tie: Sequence[str] = (), slice_seconds: float | None = None, group_rows: int | None = None) -> DataFrame:
    """left with `values` of right's row at or before its time (backward), or of the nearest row (nearest).

    Both sides are unioned and ordered by time once per group: one shuffle, no pairs. An equal time matches. Of
    several right rows with one time the last in `tie` order is taken backward, the first forward. Of two equally
    near rows the earlier one is taken. A matched row's nulls stay null. tolerance is in seconds.
    Left rows without a time, or without a match, get nulls.

    A group is one window. Groups of more than group_rows rows, if there are any, are dealt into slices of time with about
    as many rows each, found from a sketch of the group's times (slice_seconds deals all groups into slices of one length
    instead). A slice is a window of its own, and takes over the nearest right row of the slices around it, of which a
    table of slices knows. group_rows takes a pass that counts the groups first.
    """
    if direction not in ("backward", "nearest"):
        raise ValueError(direction)
    own = F.struct(*left.columns)
    taken = F.struct(F.col(right_time).alias("_at"), *values)
    order = F.struct(*tie) if tie else F.lit(0)
    kind = right.select(taken.alias("r")).schema["r"].dataType
    both = right.where(F.col(right_time).isNotNull()).select(*by, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), order.alias("_tie"), taken.alias("_r"))
    both = both.unionByName(left.select(*by, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), own.alias("_l")), allowMissingColumns=True)
    within = list(by)
    if slice_seconds is not None:
        both = both.withColumn("_slice", F.floor(_seconds(F.col("_t")) / slice_seconds))
        within = [*by, "_slice"]
    elif group_rows is not None and (sliced := _sliced(both, list(by), group_rows)) is not None:
        both, within = sliced, [*by, "_slice"]
    w = Window.partitionBy(*within).orderBy("_t", "_side", "_tie")
    both = both.withColumn("_back", F.last("_r", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    if direction == "nearest":
        # Backward through the reversed order: a frame that runs to the end is computed anew at each row.
        back = Window.partitionBy(*within).orderBy(F.desc("_t"), F.desc("_side"), F.desc("_tie"))
        both = both.withColumn("_next", F.last("_r", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0)))
    if "_slice" in both.columns:
        both = _carried(both, list(by))
    both = both.where("_side = 1")
    away = lambda c: F.abs(_seconds(F.col(f"{c}._at")) - _seconds(F.col("_t")))
    found = F.col("_back")
    if direction == "nearest":
        found = F.when(F.col("_back").isNull() | (away("_next") < away("_back")), F.col("_next")).otherwise(F.col("_back"))
    both = both.withColumn("_found", F.when(F.col("_t").isNotNull(), found).cast(kind))
    if tolerance is not None:
        both = both.withColumn("_found", F.when(away("_found") <= tolerance, F.col("_found")))
    return both.select("_l.*", *(F.col(f"_found.{v}").alias(v) for v in values))


#: Rows of a group that one task may order, and into how many slices at most a larger group is dealt.
GROUP_ROWS, SLICES = 1 << 22, 4096


def _sliced(both: DataFrame, by: list[str], group_rows: int) -> DataFrame | None:
    """both with _slice: the number of slice ends of its group that lie before its time; None if no group has more than group_rows rows.

    Groups above the bound are at most a group_rows-th of all rows, so their ends are left to Spark's own size check.
    """
    large = both.groupBy(*by).agg(F.count("*").alias("_rows")).where(F.col("_rows") > group_rows)
    large = store.cut(large)
    most = large.agg(F.max("_rows")).first()[0]
    if most is None:
        return None
    slices = min(SLICES, -(-most // group_rows) * 2)
    times = both.join(large, by).groupBy(*by).agg(F.percentile_approx(_seconds(F.col("_t")), [i / slices for i in range(1, slices)], 10 * slices).alias("_ends"))
    ends = store.cut(times.withColumn("_ends", F.array_distinct("_ends")))
    # how many ends lie before a time: first by every 64th of them, then by those between two of these
    t, step = _seconds(F.col("_t")), 64
    coarse = F.transform(F.sequence(F.lit(1), F.size("_ends"), F.lit(step)), lambda i: F.element_at("_ends", i))
    ends = ends.where(F.size("_ends") > 0).withColumn("_coarse", coarse)
    block = F.greatest(F.lit(0), F.size(F.filter("_coarse", lambda e: e < t)) - 1) * step
    at = F.when(F.col("_ends").isNull() | t.isNull(), F.lit(0)).otherwise(block + F.size(F.filter(F.slice("_ends", block + 1, F.lit(step)), lambda e: e < t)))
    return both.join(ends, by, "left").withColumn("_slice", at).drop("_ends", "_coarse")


def _carried(both: DataFrame, by: list[str]) -> DataFrame:
    """both with _back and _next filled from the slices before and after; one row a slice is ordered by group."""
    right = F.when(F.col("_side") == 0, F.struct("_t", "_tie"))
    ends = both.where("_slice is not null").groupBy(*by, "_slice").agg(F.max_by("_r", right).alias("_last"), F.min_by("_r", right).alias("_first"))
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*by).orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    around = ends.select(*by, "_slice", F.last("_last", ignorenulls=True).over(before).alias("_before"), F.last("_first", ignorenulls=True).over(after).alias("_after"))
    both = both.join(around, [*by, "_slice"], "left").withColumn("_back", F.coalesce("_back", "_before"))
    return both.withColumn("_next", F.coalesce("_next", "_after")) if "_next" in both.columns else both


def _seconds(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp")) / 1e6


def tag_samples(samples: DataFrame, laps: DataFrame, by: Sequence[str], sample_time: str, lap_time: str, lap: str, values: Sequence[str] = (), group_rows: int | None = GROUP_ROWS) -> DataFrame:
    """Samples with the lap in which their time falls: from the lap's start up to the next lap's."""
    return as_of(samples, laps, by, sample_time, lap_time, [lap, *values], "backward", tie=[lap], group_rows=group_rows)
