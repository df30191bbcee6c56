"""Scalar rules and row clean-up on hand-made edge tables."""

from pyspark.sql import functions as F

from gridlap.functions import coerce
from gridlap.operators import rows


def column(spark, values, rule, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", rule(F.col("v")).alias("o")).orderBy("i").collect()]


def test_numbers(spark):
    assert column(spark, [" 12 ", "1e3", "abc", "", "nan", "10d", "+1 LAP", None, "2F", "-0.5"], coerce.to_number) == [12, 1000, None, None, None, None, None, None, None, -0.5]
    assert column(spark, ["1.0", "7", "x", None], coerce.to_integer) == [1, 7, None, None]


def test_bool_text_and_times(spark):
    assert column(spark, ["true", "FALSE", "1", "0", "1.0", None], coerce.to_bool) == [True, False, True, False, None, None]
    assert column(spark, [" a ", "nan", "", None], coerce.clean_text) == ["a", "Unknown", "Unknown", "Unknown"]
    assert column(spark, ["soft", " Hard ", "hyper", None], lambda c: coerce.one_of(c, ["SOFT", "HARD"])) == ["SOFT", "HARD", "UNKNOWN", "UNKNOWN"]
    assert column(spark, ["0 days 00:01:30.5", "01:00:00", "x", None], coerce.to_seconds) == [90.5, 3600.0, None, None]
    assert [x is None for x in column(spark, ["2024-03-02T15:03:50+00:00", "bad", None], coerce.to_utc)] == [False, True, True]


def test_gaps(spark):
    gap = lambda c: coerce.null_outside(coerce.to_number(F.when(~coerce.is_lapped(c), c)), high=300)
    assert column(spark, ["+1 LAP", "1 lap", "nan", "", "12.5", "300", "300.1", None], gap) == [None, None, None, None, 12.5, 300.0, None, None]
    assert column(spark, ["+1 LAP", "1 lap", None], coerce.is_lapped) == [True, True, False]


def test_bounds_bins_and_flags(spark):
    assert column(spark, [0, 1, 2, 3, 60, 61, None], lambda c: coerce.right_closed_bin(c, 2, 60), "int") == [None, 0, 0, 2, 58, None, None]
    assert column(spark, [None, 1, 3, 4, 10, 11], lambda c: coerce.flag(c <= 3), "int") == [0, 1, 1, 0, 0, 0]
    assert column(spark, [None, -1, 5, 99], lambda c: coerce.clip(c, 0, 10), "int") == [None, 0, 5, 10]
    df = spark.createDataFrame([(v,) for v in (0, 1, 25, 26, None)], "p int")
    assert sorted(str(r.p) for r in df.where(coerce.in_range_or_null(F.col("p"), 1, 25)).collect()) == ["1", "25", "None"]


def test_first_per_key_and_nulls(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (None, "c", 3), (None, "d", 4)], "k int, v string, o int")
    assert sorted(r.v for r in rows.first_per_key(df, ["k"], ["o"]).collect()) == ["a", "c"]
    assert rows.drop_null_keys(df, ["k", "absent"]).count() == 2
    assert rows.drop_empty_columns(df.withColumn("n", F.lit(None).cast("int")), ["n", "v"]).columns == ["k", "v", "o"]
    assert rows.union_by_name([df, df.select("k").withColumn("z", F.lit(1))]).columns == ["k", "v", "o", "z"]


def test_stable_sample_ignores_partitions(spark):
    df = spark.range(1000)
    a = rows.stable_sample(df.repartition(3), 10, ["id"]).collect()
    assert a == rows.stable_sample(df.repartition(17), 10, ["id"]).collect() and len(a) == 10


def test_rows_at_maximum(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 2), (2, None)], "g int, x int")
    assert rows.rows_at_maximum(df, "x", ["g"]).count() == 2
    assert rows.rows_at_maximum(df, "x").count() == 2
