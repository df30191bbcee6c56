"""Exact quantiles and ranks against numpy, tables written once, and first rows in order of arrival."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlap.operators import features, joins, order, rows, store


@pytest.mark.parametrize(("most", "accuracy"), [(10_000, 10_000), (40, 60), (1, 100)])
def test_quantiles_equal_numpy(spark, most, accuracy):
    rng = random.Random(2)
    n = 3000
    cols = {
        "spread": [rng.gauss(0, 100) for _ in range(n)],
        "two": [float(rng.random() < 0.5) for _ in range(n)],
        "heavy": [5.0 if rng.random() < 0.4 else rng.random() * 10 for _ in range(n)],
        "gaps": [None if rng.random() < 0.3 else float("nan") if rng.random() < 0.1 else rng.random() for _ in range(n)],
        "none": [None] * n,
        "one": [None] * (n - 1) + [7.0],
    }
    df = spark.createDataFrame(list(zip(*cols.values(), strict=True)), ", ".join(f"{c} double" for c in cols)).repartition(5)
    shares = (0.0, 0.01, 0.5, 0.77, 0.99, 1.0)
    got = order.exact_quantiles(df, list(cols), shares, most, accuracy)
    for c, values in cols.items():
        known = [v for v in values if v is not None and v == v]
        want = np.quantile(known, shares).tolist() if known else [None] * len(shares)
        assert got[c] == (pytest.approx(want) if known else want)
    assert order.exact_quantiles(df.where("false"), ["spread"], (0.5,)) == {"spread": [None]} and order.exact_quantiles(df, [], (0.5,)) == {}


@pytest.mark.parametrize(("most", "grid"), [(10_000, 1000), (60, 8), (3, 60)])
def test_group_quantiles_equal_numpy(spark, most, grid):
    rng = random.Random(3)
    rows_ = [(k, rng.gauss(0, 9), rng.choice((1.0, 2.0, None, float("nan"), 5.5)), None) for k, n in ((1, 900), (None, 500), (2, 40), (3, 1)) for _ in range(n)]
    rows_ += [(4, 7.0, 7.0, None)] * 300 + [(5, None, None, None)] * 200
    df = spark.createDataFrame(rows_, "k int, x double, y double, none double").repartition(4)
    shares = [0.0, 0.01, 0.5, 0.9, 1.0]
    got = {r.k: r for r in order.exact_quantiles_by(df, ["k"], ["x", "y", "none"], shares, most, grid).collect()}
    assert set(got) == {r[0] for r in rows_}
    for k, r in got.items():
        for i, c in enumerate(("x", "y", "none"), 1):
            known = [v[i] for v in rows_ if v[0] == k and v[i] is not None and v[i] == v[i]]
            assert r[c] == (pytest.approx(np.quantile(known, shares).tolist()) if known else None), (k, c)
    whole = order.exact_quantiles_by(df, [], ["x", "none"], [0.5], most).first()
    assert whole.x == pytest.approx([np.median([v[1] for v in rows_ if v[1] is not None])]) and whole.none is None
    assert order.exact_quantiles_by(df.where("false"), ["k"], ["x"], [0.5]).count() == 0


@pytest.mark.parametrize("slices", [1, 7, 256])
def test_ranks_equal_their_definition(spark, slices):
    rng = random.Random(4)
    values = [rng.choice((rng.randint(0, 30) / 2, None, rng.random() * 15, 3.0)) for _ in range(800)]
    got = {r.x: r["rank"] for r in order.mean_ranks(spark.createDataFrame([(v,) for v in values], "x double"), "x", slices).collect()}
    known = sorted(v for v in values if v is not None)
    want = {v: np.mean([i + 1 for i, w in enumerate(known) if w == v]) for v in set(known)}
    assert got == pytest.approx(want)
    assert order.mean_ranks(spark.createDataFrame([], "x double"), "x").count() == 0


def test_winsorize_writes_its_input_once_and_clips(spark):
    df = spark.range(1001).select(F.col("id").alias("lap_number"), F.col("id").cast("double").alias("x"), F.lit(None).cast("double").alias("none"), F.col("id").alias("laps_to_go"))
    got = features.winsorize(df)
    assert got.agg(F.min("x"), F.max("x"), F.max("laps_to_go"), F.count("none")).first() == (10.0, 990.0, 1000, 0)
    assert features.winsorize(df, approximate=True).agg(F.min("x"), F.max("x")).first() == (10.0, 990.0)


def test_first_row_in_order_of_arrival(spark):
    many = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (1, "c", 1), (2, "z", 4)], "k int, v string, _ingest_order int").repartition(3, "v")
    assert sorted(map(tuple, rows.first_come(many, ["k"]).collect())) == [(1, "c"), (2, "z")]
    assert sorted(map(tuple, rows.first_come(many.drop("_ingest_order"), ["k"]).collect())) == [(1, "a"), (2, "z")]
    facts = spark.createDataFrame([(1, 0), (3, 0)], "k int, v int")
    assert sorted(map(tuple, joins.look_up(facts, many, ["k"]).collect()), key=repr) == [(1, 0, "c"), (3, 0, None)]
    assert rows.lower_names(spark.createDataFrame([(1, 2)], "Ab int, CD int")).columns == ["ab", "cd"]


def test_tables_are_written_to_the_shared_folder(spark):
    cut = store.cut(spark.range(5))
    assert store.shared_dir(spark).removeprefix("file://") in cut.inputFiles()[0] and cut.count() == 5


def test_copies_are_removed_at_the_end(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "_made", [])
    monkeypatch.setattr(store, "shared_dir", lambda _: f"file://{tmp_path}")
    store.cut(spark.range(3))
    assert list(tmp_path.glob("cut-*"))
    store.clear(spark)
    assert not list(tmp_path.glob("cut-*")) and not store._made


def test_first_row_of_tables_with_maps(spark):
    df = spark.createDataFrame([(1, {"b": 2}), (1, {"a": 1}), (2, None)], "k int, m map<string, int>")
    assert sorted((r.k, r.m) for r in rows.first_come(df, ["k"]).collect()) == [(1, {"a": 1}), (2, None)]


def test_spearman_reads_its_table_once(spark):
    from gridlap.operators import aggregates

    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [(float(i % 7), float(-i), i // 5, 3.0) for i in range(60)] + [(None, 1.0, 1, 3.0), (1.0, float("nan"), 1, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c long, d double").mapInArrow(counted, "a double, b double, c long, d double")
    got = {(r.a, r.b): r.correlation for r in aggregates.spearman(df, ["a", "b", "c", "d"]).collect()}
    assert read.value == len(rows)
    assert abs(got["a", "a"] - 1) < 1e-12 and got["a", "d"] is None and got["d", "d"] is None
    assert abs(got["b", "c"] + 0.9958246) < 1e-3 and got["a", "b"] < 0
