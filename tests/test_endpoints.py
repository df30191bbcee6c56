"""Reading endpoint folders by column name, with bad files, rows and values set apart, and taking sessions once."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from gridlap.operators import cleaning, rows
from gridlap.sources import endpoints, files, folder
from gridlap.streaming import ingest

SCHEMA = StructType().add("session_key", LongType()).add("lap_number", LongType()).add("lap_duration", DoubleType()).add("name", StringType())


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())


def test_columns_go_by_name_as_in_each_file_alone(spark, tmp_path):
    put(tmp_path / "laps/2024/1.csv", "session_key,lap_number,lap_duration,name\n7,9,80.5,a\n7,10,,NaN\n")
    put(tmp_path / "laps/2024/2.csv", "name,lap_number,session_key\n\"b, \"\"x\"\"\",1,8\n")
    put(tmp_path / "laps/2025/3.csv", "﻿lap_number,extra,session_key,extra\n3,e,9,f\n")
    pd.DataFrame({"lap_number": [5.0, None], "session_key": [6.0, 6.0]}).to_parquet(tmp_path / "laps/2025/4.parquet")
    pd.DataFrame({"session_key": [5], "lap_number": [2], "lap_duration": ["81.5"]}).to_parquet(tmp_path / "laps/2025/5.parquet")
    put(tmp_path / "laps.csv", "lap_duration,session_key\n99,1\n")
    got = endpoints.scan(spark, str(tmp_path), "laps", SCHEMA, legacy=[f"{tmp_path}/laps.csv", f"{tmp_path}/none.csv"])
    alone = []
    for path in ["laps/2024/1.csv", "laps/2024/2.csv", "laps/2025/3.csv", "laps/2025/4.parquet", "laps/2025/5.parquet", "laps.csv"]:
        frame = pd.read_parquet(tmp_path / path) if path.endswith("parquet") else pd.read_csv(tmp_path / path)
        alone.append(frame)
    want = pd.concat(alone, ignore_index=True)
    found = got.rows.orderBy(rows.INGEST_ORDER).toPandas()
    assert list(found.columns[:4]) == SCHEMA.names and {"extra", "extra.1"} <= set(found.columns)
    for c in ("session_key", "lap_number", "lap_duration"):
        assert found[c].astype(float).fillna(-1).tolist() == pd.to_numeric(want[c]).fillna(-1).tolist()
    assert found["name"].fillna("").tolist() == want["name"].fillna("").tolist()
    assert got.problems.count() == 0
    assert dict(got.rows.dtypes)["lap_number"] == "bigint"
    empty = endpoints.scan(spark, str(tmp_path), "absent", SCHEMA)
    assert empty.rows.count() == 0 and empty.rows.columns[:4] == SCHEMA.names and empty.problems.count() == 0


def test_what_cannot_be_read_is_told_and_the_rest_stays(spark, tmp_path):
    put(tmp_path / "laps/2024/1.csv", "session_key,lap_number,lap_duration,name\n1,1,80,a\n1,2,81\n1,3,82,a,b\n1,x,83,c\n")
    put(tmp_path / "laps/2024/2.csv", "")
    put(tmp_path / "laps/2024/3.parquet", b"no parquet")
    pd.DataFrame({"session_key": [2, 2], "lap_number": [1, 2]}).to_parquet(tmp_path / "laps/2024/4.parquet")
    pd.DataFrame({"session_key": range(9000), "lap_number": range(9000)}).to_parquet(tmp_path / "laps/2024/5.parquet")
    whole = bytearray((tmp_path / "laps/2024/5.parquet").read_bytes())
    whole[8:2000] = b"\xff" * 1992  # the footer can be read, the pages can't
    put(tmp_path / "laps/2024/5.parquet", bytes(whole))
    got = endpoints.scan(spark, str(tmp_path), "laps", SCHEMA)
    assert sorted((r.session_key, r.lap_number) for r in got.rows.where("session_key < 9").collect() if r.lap_number) == [(1, 1), (2, 1), (2, 2)]
    assert got.rows.where("name = 'c' and lap_number is null and lap_duration = 83").count() == 1
    said = sorted((r.file.rpartition("/")[2], r.problem, r.detail) for r in got.problems.collect())
    assert [s[:2] for s in said] == [("1.csv", "bad row"), ("1.csv", "bad row"), ("1.csv", "bad value"), ("2.csv", "bad file"), ("3.parquet", "bad file"), ("5.parquet", "bad file")]
    assert [s[2] for s in said[:3]] == ["1,2,81", "1,3,82,a,b", "lap_number=x"] and said[5][2].endswith("of 9000 rows")


def test_record_lists_of_any_layout(spark, tmp_path):
    data = [{"session_key": 1, "name": "a"}, {"session_key": 2, "name": "b\nc", "more": {"x": 1}}, {"session_key": 3}]
    put(tmp_path / "one/a.json", json.dumps(data))
    put(tmp_path / "many/a.json", json.dumps(data, indent=2))
    put(tmp_path / "lines/a.json", "\r\n".join(map(json.dumps, data)) + "\n\n")
    schema = StructType.fromDDL("session_key long, name string")
    want = [(1, "a"), (2, "b\nc"), (3, None)]
    for kind in ("one", "many", "lines"):
        got = endpoints.read_records(spark, f"{tmp_path}/{kind}", schema)
        assert [tuple(r)[:2] for r in got.rows.orderBy(rows.INGEST_ORDER).collect()] == want, kind
        assert got.problems.count() == 0
    put(tmp_path / "single/a.json", json.dumps(data[0], indent=1))
    put(tmp_path / "broken/a.json", '{"session_key": 4}\n{"session_key": \n{"session_key": "x", "name": "y"}\n')
    put(tmp_path / "broken/b.json", '[{"session_key": 5}, ')
    put(tmp_path / "none/a.json", "")
    put(tmp_path / "none/b.json", "[]")
    assert [tuple(r)[:2] for r in endpoints.read_records(spark, f"{tmp_path}/single", schema).rows.collect()] == [(1, "a")]
    broken = endpoints.read_records(spark, f"{tmp_path}/broken", schema)
    assert (4, None) in [tuple(r)[:2] for r in broken.rows.collect()]
    assert {r.detail for r in broken.problems.collect()} >= {'{"session_key": ', '[{"session_key": 5},'}
    none = endpoints.read_records(spark, f"{tmp_path}/none", schema)
    assert none.rows.count() == none.problems.count() == 0


def test_first_in_the_order_of_the_files(spark, tmp_path):
    put(tmp_path / "drivers/2024/1.csv", "session_key,driver_number,full_name\n1,4,second\n1,4,first\n")
    put(tmp_path / "drivers/2024/2.csv", "full_name,driver_number,session_key\nabove,4,1\nown,5,1\n,,\n")
    pd.DataFrame({"session_key": [1, 1], "driver_number": [6, 6], "full_name": ["z", "a"]}).to_parquet(tmp_path / "drivers/2024/0.parquet")
    read = folder.read_all(spark, str(tmp_path))["drivers"].rows.repartition(5)
    got = cleaning.clean_drivers(read)
    assert sorted((r.driver_number, r.full_name) for r in got.collect()) == [(4, "second"), (5, "own"), (6, "z")]
    assert not set(rows.META) & set(got.columns)


def test_sessions_are_taken_once(spark, tmp_path, monkeypatch):
    args = (spark, f"{tmp_path}/raw/laps", SCHEMA, f"{tmp_path}/out", f"{tmp_path}/check")
    put(tmp_path / "raw/laps/2024/1.csv", "session_key,lap_number\n1,1\n1,2\n")
    put(tmp_path / "raw/laps/2024/2.csv", "lap_number,session_key\n1,2\n")
    took = lambda: sorted((r.session_key, r.lap_number) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    # a run that breaks off after the rows are written and before the manifest is
    real = files.rewrite_partitions

    def breaks(*given):
        real(*given)
        raise RuntimeError("lost")

    monkeypatch.setattr(files, "rewrite_partitions", breaks)
    with pytest.raises(Exception, match="lost"):
        ingest.ingest(*args).awaitTermination(60)
    monkeypatch.undo()
    ingest.ingest(*args).awaitTermination(60)
    assert took() == [(1, 1), (1, 2), (2, 1)]
    pd.DataFrame({"session_key": [1], "lap_number": [9]}).to_parquet(tmp_path / "raw/laps/2024/1.parquet")  # the same session in another file
    put(tmp_path / "raw/laps/2025/1.csv", "session_key,lap_number,lap_duration\n1,7,80\n")
    ingest.ingest(*args).awaitTermination(60)
    assert took() == [(1, 1), (1, 2), (1, 7), (2, 1)]
    assert ingest.manifest(spark, f"{tmp_path}/out.manifest").count() == 3
    ingest.ingest(*args).awaitTermination(60)
    assert took() == [(1, 1), (1, 2), (1, 7), (2, 1)]


def test_rewriting_a_session_leaves_the_others(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "session_key int, v string")
    files.rewrite_partitions(df, f"{tmp_path}/t", ["session_key"])
    for _ in range(2):
        files.rewrite_partitions(spark.createDataFrame([(1, "d")], df.schema), f"{tmp_path}/t", ["session_key"])
    back = spark.read.parquet(f"{tmp_path}/t")
    assert sorted((r.session_key, r.v) for r in back.collect()) == [(1, "d"), (2, "c")]
    plan = back.where("session_key = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(session_key" in plan
    assert [f for f in back.where("session_key = 1").select(F.input_file_name()).distinct().collect() if "session_key=2" in f[0]] == []


def test_rows_are_counted_as_they_are_written(spark, tmp_path):
    put(tmp_path / "raw/laps/2024/1.csv", "lap_number,session_key,driver_number,lap_duration,date_start\n" + "".join(f"{i},1,4,{80 + i},2024-01-01T00:{i:02d}:00\n" for i in range(1, 9)) + "9,1,4,20,2024-01-01T01:00:00\n,,,,\n")
    put(tmp_path / "raw/position/2024/1.csv", "date,session_key,driver_number,position\n2024-01-01T00:00:00,1,4,2\n2024-01-01T01:00:00,1,4,1\n")
    put(tmp_path / "raw/sessions.csv", "session_key,session_type,year\n1,Race,2024\n2,Practice,2024\n")
    put(tmp_path / "raw/drivers.csv", "session_key,driver_number,full_name,team_name\n1,4,N,T\n")
    tables, summary, problems = folder.clean_folder(spark, f"{tmp_path}/raw", f"{tmp_path}/clean")
    assert {tuple(r) for r in summary.collect()} == {("laps", 10, 8, 2, "ok"), ("position", 2, 2, 0, "ok"), ("sessions", 2, 1, 1, "ok"), ("drivers", 1, 1, 0, "ok"), ("session_results", 0, 1, 0, "derived"), ("starting_grid", 0, 1, 0, "derived")}
    assert problems.count() == 0
    one = folder.build_base(spark, f"{tmp_path}/raw", f"{tmp_path}/clean2").collect()
    assert [(r.session_key, r.driver_number, r.year, r.grid_position, r.final_position, r.target_win, r.lap_count, r.best_lap_duration) for r in one] == [(1, 4, 2024, 2, 1, 1, 8, 81.0)]
    with pytest.raises(ValueError, match="no endpoint"):
        folder.clean_folder(spark, f"{tmp_path}/nothing", f"{tmp_path}/c")
