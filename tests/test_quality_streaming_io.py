import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridlap.operators import quality
from gridlap.sources import files
from gridlap.streaming import resample

T = dt.datetime(2024, 1, 1)


def test_checks(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (None, 700.0), (None, None)], "session_key int, lap_duration double")
    assert quality.duplicate_count(df, ["session_key"]).first().n == 2
    assert quality.duplicate_key(df, "laps", ["absent"]) is None
    issues = {(r.check, r.severity): r.message for r in quality.validate({"laps": df, "sessions": spark.createDataFrame([(2,)], "session_key int")}, {}).collect()}
    assert issues["consistency", "error"] == "Found data for 1 session(s) not present in sessions"
    assert issues["range", "warning"] == "Column lap_duration has 2 values outside [30, 600]"
    assert issues["missing_values", "warning"].endswith("has 2 nulls (50.0%)")
    half = spark.createDataFrame([(None,)] * 51 + [(1,)] * 49, "x int")
    assert quality.counted_issues(half, "f").first().severity == "error"
    assert quality.required_columns(spark, df, "laps", ["driver_number"]).count() == 1
    assert [r.check for r in quality.counted_issues(df.where("false"), "laps", [("lap_duration", 30, 600)]).collect()] == ["file_exists"]
    assert {(r.severity, r.n) for r in quality.by_severity(quality.counted_issues(df, "laps")).collect()} == {("warning", 2)}


def test_profiles_of_tables_without_such_columns(spark):
    no_columns, words = spark.range(3).select(), spark.createDataFrame([("b",), ("a",), (None,)], "w string")
    assert quality.dominant_values(no_columns).count() == quality.negatives(words).count() == quality.blanks(spark.range(2)).count() == 0
    assert tuple(quality.describe(words).first())[:5] == ("w", 2, 2, "a", 1)
    assert quality.describe(words.where("false")).first()[:3] == ("w", 0, 0)
    twice = spark.createDataFrame([(1, "x"), (1, "x"), (1, None), (None, None), (None, None)], "k int, v string")
    assert tuple(quality.duplicate_report(twice, "f", ["k", "absent"]).first()) == ("f", 5, 2, 40.0, "['k']", 3)
    assert tuple(quality.duplicate_report(twice.where("false"), "f", []).first()) == ("f", 0, 0, 0.0, "[]", None)
    files_ = {"none": twice.where("false"), "a": twice, "b": spark.createDataFrame([(1.0, 2)], "k double, z int"), "c": twice}
    found = {(r.file, r.column, r.issue, r.expected, r.got) for r in quality.schema_alignment(files_).collect()}
    assert found == {("b", "k", "type", "int", "double"), ("b", "z", "extra", None, "int"), ("b", "v", "missing", "string", None)}
    assert quality.schema_alignment({"a": twice}).count() == 0


def test_dominant_values_count_nulls(spark):
    df = spark.createDataFrame([(None, i % 50) for i in range(99)] + [(1, 1)], "a int, b int")
    assert [r.column for r in quality.dominant_values(df).collect()] == ["a"]
    assert quality.dominant_values(df.unionByName(df.limit(1).select(F.lit(2).alias("a"), F.lit(3).alias("b"))), 0.99).count() == 0


def test_interpolation_and_jumps(spark):
    rows = [(1, T + dt.timedelta(seconds=s), x) for s, x in [(0, None), (1, 10.0), (2, None), (4, 40.0), (5, None)]]
    df = spark.createDataFrame(rows, "k int, t timestamp, x double")
    assert [r.x for r in resample.interpolate(df, ["k"], "t", ["x"]).orderBy("t").collect()] == [10, 10, 20, 40, 40]
    assert [r.x for r in resample.remove_jumps(df.where("x is not null"), ["k"], "t", ["x"], 5).orderBy("t").collect()] == [10, None]


def test_resample_same_on_batch_and_stream(spark, tmp_path):
    rows = [(1, T + dt.timedelta(milliseconds=300 * i), float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "k int, t timestamp, x double")
    df.write.parquet(f"{tmp_path}/in")
    batch = resample.resample(df, ["k"], "t", ["x"])
    stream = resample.resample(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), ["k"], "t", ["x"], late="1 second")
    q = stream.writeStream.format("memory").queryName("resampled_test").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    q.awaitTermination(60)
    key = lambda r: r.t
    assert sorted(spark.table("resampled_test").collect(), key=key) == sorted(batch.collect(), key=key)


def test_ingest_reads_new_files_once(spark, tmp_path):
    schema = StructType.fromDDL("a int, b string")
    (tmp_path / "raw/2024").mkdir(parents=True)
    (tmp_path / "raw/2024/1.csv").write_text("a,b\n1,x\n")
    args = (spark, f"{tmp_path}/raw", schema, f"{tmp_path}/out", f"{tmp_path}/check")
    resample.ingest(*args).awaitTermination(60)
    (tmp_path / "raw/2024/2.csv").write_text("a,b\n2,y\n")
    resample.ingest(*args).awaitTermination(60)
    assert sorted(r.a for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2]


def test_endpoint_reader_tolerates(spark, tmp_path):
    schema = StructType.fromDDL("a int, b string")
    (tmp_path / "laps/2024").mkdir(parents=True)
    (tmp_path / "laps/2024/1.csv").write_text("a,b\n1,x\nbad,y\n")
    got = files.read_endpoint(spark, str(tmp_path), "laps", schema)
    assert sorted((r.a or 0, r._source_endpoint) for r in got.collect()) == [(0, "laps"), (1, "laps")]
    assert files.read_endpoint(spark, str(tmp_path), "absent", schema).count() == 0
    (tmp_path / "u1.csv").write_text("a\n1\n")
    (tmp_path / "u2.csv").write_text("a,c\n2,z\n")
    assert files.read_differing(spark, [f"{tmp_path}/u1.csv", f"{tmp_path}/u2.csv"]).columns == ["a", "c"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, "a"), (2, 0, "b")], "session_key int, target_win int, year string")
    assert files.write_both(df, f"{tmp_path}/t").count() == 2
    assert spark.read.option("header", True).csv(f"{tmp_path}/t.csv").count() == 2
    files.write_table(df, f"{tmp_path}/p", partition_by=["year"])
    assert spark.read.parquet(f"{tmp_path}/p").where("year = 'b'").count() == 1
    assert files.run_metadata(df).first().win_rate == 0.5
    listed = df.select(F.lit("laps").alias("endpoint"), "year", "session_key")
    assert files.not_ingested(listed, listed.limit(1)).count() == 1
    sessions = df.select("session_key", "year", F.lit("Race").alias("session_name"), F.lit(1).alias("date_start"))
    assert files.select_sessions(sessions, ["Race"], 1).count() == 2 and files.ingest_log(sessions).count() == 3
