"""Interval joins and as-of joins in large groups, and frequent values, against plain versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridlap.operators import joins, quality

T = dt.datetime(2024, 1, 1)


def test_cells_cover_an_interval_once(spark):
    rng = random.Random(1)
    spans = [(a, a + rng.choice((0, 1, 7, 8, 30, 200))) for a in (rng.randint(-150, 300) for _ in range(200))]
    df = spark.createDataFrame(spans, "a long, b long").select("a", "b", joins.interval_cells(F.col("a"), F.col("b")).alias("cells"))
    for r in df.collect():
        inside = sorted(x for c in r.cells for x in range(c.cell * c.width, (c.cell + 1) * c.width))
        assert inside == list(range(r.a, r.b + 1))
        assert len(r.cells) <= 4 * 7 + (r.b - r.a) // 64 + 2


@pytest.mark.parametrize("widths", [(1,), (1, 8, 64), (1, 4)])
def test_range_join_equals_all_pairs(spark, widths):
    rng = random.Random(2)
    pick = lambda: rng.choice((None, rng.randint(-5, 90), rng.randint(0, 300) / 4))
    points = [(i, rng.choice((1, 2, 3, None)), pick()) for i in range(250)]
    intervals = [(j, rng.choice((1, 2, None)), pick(), pick()) for j in range(60)]
    left = spark.createDataFrame([(i, k, None if x is None else float(x)) for i, k, x in points], "i int, k int, x double")
    right = spark.createDataFrame([(j, k, None if a is None else float(a), None if b is None else float(b)) for j, k, a, b in intervals], "j int, k int, a double, b double")
    got = sorted((r.i, -1 if r.j is None else r.j) for r in joins.range_join(left, right, ["k"], "x", "a", "b", widths=widths).collect())
    known = {k for _, k, _, _ in intervals if k is not None}
    want = [(i, j) for i, k, x in points for j, q, a, b in intervals if k == q and k is not None and x is not None and (-1 if a is None else a) <= x <= (9999 if b is None else b)]
    want += [(i, -1) for i, k, _ in points if k not in known]
    assert got == sorted(want)


def test_range_join_of_one_large_key_meets_only_what_belongs_together(spark):
    points = spark.range(100_000).select(F.lit(1).alias("k"), (F.col("id") % 10_000).alias("x"))
    intervals = spark.range(10_000).select(F.lit(1).alias("k"), F.col("id").alias("a"), F.col("id").alias("b"), F.col("id").alias("j"))
    assert joins.range_join(points, intervals, ["k"], "x", "a", "b").count() == 100_000
    crowded = intervals.select("k", F.lit(5).alias("a"), F.lit(5).alias("b"), "j")  # all in one cell, and all points beside it
    assert joins.range_join(points.where("x <> 5").withColumn("x", F.lit(6)), crowded, ["k"], "x", "a", "b").count() == 0


@pytest.mark.parametrize("direction", ["backward", "nearest"])
def test_slices_chosen_by_the_data_change_nothing(spark, direction):
    rng = random.Random(3)
    at = lambda n: [T + dt.timedelta(seconds=rng.choice((rng.randint(0, 40), rng.randint(0, 4000)))) for _ in range(n)]
    left = [(k, t if rng.random() > 0.05 else None, i) for k, n in ((1, 600), (2, 20), (3, 5)) for i, t in enumerate(at(n))]
    right = [(k, t, i if rng.random() > 0.1 else None) for k, n in ((1, 300), (2, 9)) for i, t in enumerate(at(n))]
    a, b = spark.createDataFrame(left, "k int, t timestamp, i int"), spark.createDataFrame(right, "k int, s timestamp, v int")
    plain, sliced, whole = (sorted(map(tuple, joins.as_of(a, b, ["k"], "t", "s", ["v"], direction, tie=["v"], group_rows=n).collect()), key=repr) for n in (None, 40, 10_000))
    assert plain == sliced == whole and len(plain) == len(left)
    both = joins._sliced(a.select("k", F.col("t").alias("_t")), ["k"], 40)
    sizes = {(r.k, r._slice): r["count"] for r in both.groupBy("k", "_slice").count().collect()}
    assert len([s for s in sizes if s[0] == 1]) > 8 and len([s for s in sizes if s[0] == 2]) == 1


def test_frequent_values_equal_counts(spark):
    rng = random.Random(4)
    rows = [(rng.choice(("a", "a", "b", None)), rng.choice((1, 1, 1, 2, rng.randint(3, 500))), float(rng.random() < 0.02), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "s string, n int, x double, `odd.name` int").repartition(6)
    for share in (0.01, 0.2, 0.5, 0.97):
        want = set()
        for i, c in enumerate(df.columns):
            for v in {r[i] for r in rows}:
                n = sum(r[i] == v for r in rows)
                if n >= share * len(rows):
                    want.add((c, None if v is None else str(v), n, len(rows)))
        assert {tuple(r) for r in quality.frequent_values(df, share).collect()} == want
    assert quality.frequent_values(df.where("false"), 0.5).count() == 0
    plan = quality.frequent_values(df, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan  # nothing is dealt by value


def test_expected_tables_that_are_missing(spark):
    df = spark.createDataFrame([(1,)], "session_key int")
    found = quality.validate({"sessions": df}, {}, expected=["sessions", "laps"]).collect()
    assert [tuple(r) for r in found] == [("laps", "warning", "file_exists", "File missing")]
