"""Exact quantiles and ranks of columns and groups, without ordering them in one task or holding their values in one place."""

from __future__ import annotations

from collections.abc import Sequence
from math import isfinite

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlap.operators import store

#: Rank error of a sketch is 1 in ACCURACY; groups and brackets of up to MOST values are read out; points of a sketch.
ACCURACY, MOST, SLICES, GRID = 10_000, 1 << 16, 256, 1000


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float], most: int = MOST, grid: int = GRID) -> dict[str, list[float | None]]:
    """For each column its quantiles by linear interpolation; nulls and NaN don't count, none at all gives None.

    The columns are groups of exact_quantiles_by, so a task's work is narrow however many they are. df is read in a few passes.
    """
    columns = list(columns)
    if not columns:
        return {}
    cells = F.array(*(F.struct(F.lit(i).alias("c"), _number(c).alias("x")) for i, c in enumerate(columns)))
    found = {r.c: r.x for r in exact_quantiles_by(df.select(F.inline(cells)), ["c"], ["x"], shares, most, grid, written=True).collect()}
    return {c: list(found.get(i) or [None] * len(shares)) for i, c in enumerate(columns)}


def _number(c: str) -> Column:
    """The column as double, null for NaN."""
    return F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double"))


def exact_quantiles_by(df: DataFrame, by: Sequence[str], columns: Sequence[str], shares: Sequence[float], most: int = MOST, grid: int = GRID, written: bool = False) -> DataFrame:
    """by, and for each column the array of its quantiles in the group by linear interpolation; null keys are a group, nulls and NaN don't
    count, and a group without values has null.

    Groups of up to `most` rows are one aggregate. For the larger ones, all at once, each rank is bracketed by a sketch of
    its group, rows below, on and between the bracket's ends are counted, and so on within it until it holds up to `most`
    values, which are then read out: no task holds more of a group than a sketch or `most` values. Each pass is over a table
    of these columns that is written once to the shared folder (or over df, if it is `written` already); without larger
    groups there are two.
    """
    by, columns, shares = list(by), list(columns), list(shares)
    if not by:
        found = exact_quantiles(df if written else store.cut(df.select(*(f"`{c}`" for c in columns))), columns, shares, most, grid)
        return df.sparkSession.range(1).select(*(F.array(*(F.lit(v).cast("double") for v in found[c])).alias(c) if found[c][0] is not None else F.lit(None).cast("array<double>").alias(c) for c in columns))
    key = F.struct(*(F.col(f"`{b}`") for b in by)).alias("_k")  # as a struct, keys with nulls are equal
    rows = df.select(key, *(_number(c).alias(f"_x{i}") for i, c in enumerate(columns)))
    rows = rows if written else store.cut(rows)
    named = lambda f: f.select("_k.*", *(F.col(f"_x{i}").alias(c) for i, c in enumerate(columns)))
    exact = [F.percentile(f"_x{i}", F.array(*map(F.lit, shares))).alias(f"_x{i}") for i in range(len(columns))]
    large = store.cut(rows.groupBy("_k").agg(F.count("*").alias("_n"), *(F.count(f"_x{i}").alias(f"_n{i}") for i in range(len(columns)))).where(F.col("_n") > most))
    if large.isEmpty():
        return named(rows.groupBy("_k").agg(*exact))
    small = rows.join(large.select("_k"), "_k", "left_anti").groupBy("_k").agg(*exact)
    places = large.select("_k", F.inline(F.array(*(F.struct(F.lit(i).alias("c"), F.col(f"_n{i}").alias("n")) for i in range(len(columns)))))).where("n > 0")
    places = store.cut(places.select("_k", "c", F.posexplode(F.array(*((F.lit(s) * (F.col("n") - 1)) for s in map(float, shares)))).alias("share", "at"), "n"))
    tall = rows.join(large.select("_k"), "_k").select("_k", F.inline(F.array(*(F.struct(F.lit(i).alias("c"), F.col(f"_x{i}").alias("x")) for i in range(len(columns)))))).where("x is not null")
    values = _values_by(tall, places, most, grid)
    for name, r in (("low", F.floor("at")), ("high", F.ceil("at"))):
        places = places.withColumn(f"_{name}", r.cast("long")).join(values.select("_k", "c", F.col("r").alias(f"_{name}"), F.col("x").alias(name)), ["_k", "c", f"_{name}"])
    between = F.col("low") + (F.col("high") - F.col("low")) * (F.col("at") - F.floor("at"))
    made = places.groupBy("_k", "c").agg(F.transform(F.array_sort(F.collect_list(F.struct("share", between.alias("v")))), lambda q: q["v"]).alias("q"))
    wide = large.select("_k").join(made, "_k", "left").groupBy("_k").agg(*(F.max(F.when(F.col("c") == i, F.col("q"))).alias(f"_x{i}") for i in range(len(columns))))
    return named(small.unionByName(wide))


def _values_by(tall: DataFrame, places: DataFrame, most: int, grid: int) -> DataFrame:
    """_k, c, r, x: the values at the ranks below and above each place; tall has _k, c, x.

    A rank lies in an open interval `iv` of values (low and high end, rows up to low, rows inside), at first the whole
    line. Ranks of one interval share its sketch, ranks of one bracket its counts.
    """
    interval = lambda low, high, upto, n: F.struct(low.cast("double").alias("low"), high.cast("double").alias("high"), upto.cast("long").alias("upto"), n.cast("long").alias("n")).alias("iv")
    ranks = places.select("_k", "c", interval(F.lit(None), F.lit(None), F.lit(0), F.col("n")), F.explode(F.array(F.floor("at"), F.ceil("at")).cast("array<bigint>")).alias("r")).distinct()
    inside = lambda frame: tall.join(frame, ["_k", "c"]).where("(iv.low is null or x > iv.low) and (iv.high is null or x < iv.high)")
    own, x = ["_k", "c", "iv"], F.col("x")
    found = []
    while True:
        ranks = store.cut(ranks)
        few, many = ranks.where(F.col("iv.n") <= most), ranks.where(F.col("iv.n") > most)
        read = inside(few.select(*own).distinct()).groupBy(*own).agg(F.array_sort(F.collect_list("x")).alias("xs"))
        found.append(few.join(read, own).select("_k", "c", "r", F.element_at("xs", (F.col("r") - F.col("iv.upto") + 1).cast("int")).alias("x")))
        if many.isEmpty():
            break
        sketch = inside(many.select(*own).distinct()).groupBy(*own).agg(F.percentile_approx("x", [i / grid for i in range(grid + 1)], 10 * grid).alias("g"))
        place = F.floor((F.col("r") - F.col("iv.upto")) / F.col("iv.n") * grid).cast("int")
        bracket = F.struct(F.element_at("g", F.greatest(F.lit(1), place)).alias("a"), F.element_at("g", F.least(F.lit(grid + 1), place + 3)).alias("b"))
        met = store.cut(many.join(sketch, own).select(*own, "r", bracket.alias("t")))
        a, b = F.col("t.a"), F.col("t.b")
        counts = inside(met.select(*own, "t").distinct()).groupBy(*own, "t").agg(F.count_if(x < a).alias("below"), F.count_if(x <= a).alias("to_a"), F.count_if(x < b).alias("to_mid"), F.count_if(x <= b).alias("to_b"))
        counted = store.cut(met.join(counts, [*own, "t"]).withColumn("p", F.col("r") - F.col("iv.upto")))
        p, low, high, upto, n = F.col("p"), F.col("iv.low"), F.col("iv.high"), F.col("iv.upto"), F.col("iv.n")
        on_a, on_b = (p >= F.col("below")) & (p < F.col("to_a")), (p >= F.greatest("to_mid", "to_a")) & (p < F.col("to_b"))
        found.append(counted.where(on_a | on_b).select("_k", "c", "r", F.when(on_a, a).otherwise(b).alias("x")))
        before, after = p < F.col("below"), p >= F.greatest("to_a", "to_b")
        next_ = F.when(before, interval(low, a, upto, F.col("below"))).when(after, interval(b, high, upto + F.col("to_b"), n - F.col("to_b"))).otherwise(interval(a, b, upto + F.col("to_a"), F.col("to_mid") - F.col("to_a")))
        ranks = counted.where(~(on_a | on_b)).select("_k", "c", next_.alias("iv"), "r")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def mean_ranks(df: DataFrame, column: str, slices: int = SLICES) -> DataFrame:
    """column, rank: the mean rank, from 1, of each distinct value that isn't null.

    df is read once, for a table of its distinct values, which is written. These are dealt into slices of their order by
    approximate quantiles; a slice numbers its own distinct values and goes on from the rows of the slices before it, of
    which there are at most `slices`.
    """
    counts = store.cut(df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n")))
    ends = counts.agg(F.percentile_approx(column, [i / slices for i in range(1, slices)], ACCURACY)).first()[0] or []
    ends = sorted({e for e in map(float, ends) if isfinite(e)})
    bins = Bucketizer(splits=[float("-inf"), *ends, float("inf")], inputCol="_x", outputCol="_slice", handleInvalid="keep")
    sliced = bins.transform(counts.withColumn("_x", F.col(column).cast("double"))).drop("_x") if ends else counts.withColumn("_slice", F.lit(0.0))
    sums = sliced.groupBy("_slice").agg(F.sum("_n").alias("_rows"))
    before = sums.select("_slice", F.coalesce(F.sum("_rows").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # at most `slices` rows
    upto = F.sum("_n").over(Window.partitionBy("_slice").orderBy(column))
    placed = sliced.withColumn("_upto", upto).join(F.broadcast(before), "_slice")
    return placed.select(column, (F.col("_before") + F.col("_upto") - (F.col("_n") - 1) / 2).alias("rank"))
