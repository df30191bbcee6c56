"""Every query with SQL gives DuckDB's rows; those without give some."""

import duckdb
import pytest

from gridlap.plans import catalog, views
from gridlap.plans.views import BASE


def shown(value):
    if value != value:  # DuckDB's NaN of a constant column's regression
        return None
    return round(float(value), 5) + 0.0 if isinstance(value, float) or hasattr(value, "as_tuple") else value


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    got = [tuple(map(shown, r)) for r in df.select(*sorted(df.columns)).collect()]
    if name not in catalog.ORACLES:
        assert got
        return
    found = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in found.description]
    order = [names.index(c) for c in sorted(names)]
    want = [tuple(shown(r[i]) for i in order) for r in found.fetchall()]
    assert sorted(df.columns) == sorted(names)
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_lap_master_orders_nothing_after_it_is_written(spark, sf_dir):
    df = catalog.QUERIES["lap_master"](spark, sf_dir)
    assert "Window" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.count() == df.select("session_key", "driver_number", "lap_number").distinct().count() > 0


def test_files_of_the_base_number_laps_and_drivers_once(spark, sf_dir, monkeypatch):
    made, real = [], views.Tables.__getattr__
    monkeypatch.setattr(views.Tables, "__getattr__", lambda self, name: made.append(name) or real(self, name))
    assert catalog.QUERIES["base_from_files"](spark, sf_dir).count() == real(views.Tables(spark, sf_dir), "drivers").count()
    assert made.count("laps") == 1 and made.count("drivers") == 1
