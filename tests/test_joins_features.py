"""As-of and range joins, rolling frames, cliffs, winsorizing: ties, bounds, nulls and missing groups."""

import datetime as dt
import random

from pyspark.sql import functions as F

from gridlap.operators import aggregates, cleaning, features, joins, rolling

T = dt.datetime(2024, 1, 1)


def at(*seconds):
    return [T + dt.timedelta(seconds=s) if s is not None else None for s in seconds]


def as_of(spark, left, right, direction, tolerance=None):
    a = spark.createDataFrame([(1, i, t) for i, t in enumerate(at(*left))] + [(2, 99, T)], "k int, i int, t timestamp")
    b = spark.createDataFrame([(1, t, v, o) for (t, (_, v, o)) in zip(at(*[r[0] for r in right]), right, strict=True)], "k int, w timestamp, v int, o int")
    got = joins.as_of(a, b, ["k"], "t", "w", ["v"], direction, tolerance, tie=["o"])
    return {r.i: r.v for r in got.collect()}


def test_backward_ties_nulls_and_gaps(spark):
    right = [(10, 1, 1), (10, 2, 2), (20, None, 3), (30, 4, 4)]
    assert as_of(spark, [5, 10, 15, 20, 25, 99, None], right, "backward") == {0: None, 1: 2, 2: 2, 3: None, 4: None, 5: 4, 6: None, 99: None}


def test_nearest_prefers_the_earlier(spark):
    right = [(10, 1, 1), (20, 2, 1), (20, 3, 2)]
    assert as_of(spark, [0, 14, 15, 16, 20, 90], right, "nearest") == {0: 1, 1: 1, 2: 1, 3: 2, 4: 3, 5: 3, 99: None}
    assert as_of(spark, [0, 14, 90], right, "nearest", tolerance=10) == {0: 1, 1: 1, 2: None, 99: None}


def test_slices_of_time_change_nothing(spark):
    rng = random.Random(3)
    left = [(rng.randint(1, 3), i, T + dt.timedelta(seconds=rng.randint(0, 400)) if rng.random() < 0.95 else None) for i in range(300)]
    right = [(rng.randint(1, 2), T + dt.timedelta(seconds=rng.choice((rng.randint(0, 400), rng.randint(150, 160)))), rng.choice((None, i)), i) for i in range(60)]
    a, b = spark.createDataFrame(left, "k int, i int, t timestamp"), spark.createDataFrame(right, "k int, w timestamp, v int, o int")
    for direction in ("backward", "nearest"):
        for tolerance in (None, 20):
            whole, sliced = (sorted(map(tuple, joins.as_of(a, b, ["k"], "t", "w", ["v", "o"], direction, tolerance, ["o"], s).collect()), key=repr) for s in (None, 7.5))
            assert whole == sliced and sum(r[-1] is not None for r in whole) > 50


def test_range_join_drops_and_keeps(spark):
    laps = spark.createDataFrame([(1, 1), (1, 5), (1, 7), (1, 9), (2, 3)], "k int, lap int")
    stints = spark.createDataFrame([(1, 1, 5, "a"), (1, 5, 6, "b"), (1, 9, None, "c")], "k int, lo int, hi int, s string")
    got = sorted((r.k, r.lap, r.s) for r in joins.range_join(laps, stints, ["k"], "lap", "lo", "hi").collect())
    assert got == [(1, 1, "a"), (1, 5, "a"), (1, 5, "b"), (1, 9, "c"), (2, 3, None)]


def test_look_up_renames_clashes(spark):
    facts = spark.createDataFrame([(1, "x")], "k int, name string")
    dim = spark.createDataFrame([(1, "y"), (1, "y")], "k int, name string")
    assert joins.look_up(facts, dim, ["k"]).collect()[0].asDict() == {"k": 1, "name": "x", "name_sess": "y"}


def laps_of(spark, values):
    return spark.createDataFrame([(1, 1, n, v) for n, v in values], "session_key int, driver_number int, lap_number int, lap_duration double")


def test_rolling_never_looks_ahead(spark):
    values = [(1, 90.0), (2, 92.0), (4, None), (5, 91.0), (6, 95.0)]
    one = {r.lap_number: r for r in rolling.rolling_features(laps_of(spark, values)).collect()}
    two = {r.lap_number: r for r in rolling.rolling_features(laps_of(spark, values[:3] + [(5, 1.0), (6, 2.0)])).collect()}
    assert one[1].rolling_avg_lap_3 is None and one[2].rolling_std_lap_3 is None and one[2].rolling_avg_lap_3 == 90
    assert one[5].rolling_avg_lap_3 == 91 and one[5].lap_delta_prev is None and one[6].rolling_best_lap_5 == 90
    assert one[6].laps_to_go == 0 and one[1].race_completion_pct == round(1 / 6, 4)
    assert all(one[n].rolling_avg_lap_10 == two[n].rolling_avg_lap_10 for n in (1, 2, 4, 5))


def test_outlier_flag(spark):
    rows = [(1, 100.0 + i % 2) for i in range(25)] + [(1, 400.0), (2, 5.0), (3, 1.0), (3, 1.0), (4, None)]
    df = spark.createDataFrame(rows, "g int, x double").withColumn("o", rolling.outlier_flag("x", ["g"]))
    assert [r.x for r in df.where("o").collect()] == [400.0] and df.where("o is null").count() == 0


def test_imputation_falls_back(spark):
    rows = [(1, 1, 10.0), (1, 1, None), (1, 2, None), (2, 3, None)]
    got = cleaning.impute(spark.createDataFrame(rows, "session_key int, driver_number int, x double"), ["x"]).collect()
    assert sorted((r.session_key, r.driver_number, r.x or -1) for r in got) == [(1, 1, 10), (1, 1, 10), (1, 2, 10), (2, 3, -1)]


def stint_case(spark, laps, rising):
    l = spark.createDataFrame([(1, 1, n, 90.0 * (1.05 if n > rising else 1)) for n in range(1, laps + 1)], "session_key long, driver_number long, lap_number long, lap_duration double")
    s = spark.createDataFrame([(1, 1, 1, 0, 99, "SOFT", None)], "session_key long, driver_number long, stint_number long, lap_start long, lap_end long, compound string, tyre_age_at_start long")
    return {r.compound: r.cliff for r in features.learn_cliffs(l, s).collect()}


def test_cliffs_need_laps_bins_and_a_rise(spark):
    assert stint_case(spark, 49, 10)["SOFT"] == 22
    assert stint_case(spark, 50, 10)["SOFT"] == int(0.6 * 10 + 0.4 * 22)
    assert stint_case(spark, 50, 90)["SOFT"] == 22


def test_winsorize_bounds_and_exemptions(spark):
    rows = [(i, float(i), float(i), 7.0, None) for i in range(101)]
    df = spark.createDataFrame(rows, "session_key int, x double, is_x double, c double, n double")
    got = features.winsorize(df).agg(F.min("x"), F.max("x"), F.max("is_x"), F.max("c"), F.count("n"), F.max("session_key")).first()
    assert tuple(got) == (1, 99, 100, 7, 0, 100)


def test_telemetry_sums_and_lag(spark):
    rows = [(1, 1, 1, 100.0, None), (1, 1, 3, 50.0, 1.0), (1, 1, 3, 60.0, 1.0)]
    df = spark.createDataFrame(rows, "session_key int, driver_number int, lap_number int, Speed double, Brake double")
    got = {r.lap_number: r for r in aggregates.telemetry_by_lap(df).collect()}
    assert got[1].speed_std is None and got[1].brake_sum == 0 and got[3].brake_sum == 2
    lag = {r.lap_number: r for r in features.lagged_telemetry(df).collect()}
    assert lag[1].tele_prev_speed_max is None and lag[3].tele_prev_speed_max == 100


def test_cleaners_skip_missing_columns_and_empty_tables(spark):
    for name, clean in cleaning.CLEANERS.items():
        empty = spark.createDataFrame([], "session_key string, driver_number string, date string, junk string")
        assert clean(empty).count() == 0, name


def test_targets_of_unknown_results(spark):
    df = laps_of(spark, [(1, 1.0)])
    none = spark.createDataFrame([], "session_key int, driver_number int, position int")
    r = features.targets(df, none).first()
    assert (r.final_position, r.target_win, r.target_top10) == (None, 0, 0)
