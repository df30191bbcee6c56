"""The registered queries by name, and the SQL that gives the same rows.

Doubles are rounded to six digits on both sides; instants are given as microseconds since 1970.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlap.functions import coerce
from gridlap.operators import aggregates, cleaning, features, joins, quality, rolling, rows, store
from gridlap.plans.views import VIEWS, Tables, sql
from gridlap.sources import endpoints, files, folder
from gridlap.streaming import resample
from gridlap.streaming.ingest import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
K = ["session_key", "driver_number"]
L = [*K, "lap_number"]


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, instants to microseconds."""
    made = {c: F.round(c, 6) for c, t in df.dtypes if t in ("double", "float") or t.startswith("decimal")}
    made |= {c: F.unix_micros(F.col(c).cast("timestamp")) for c, t in df.dtypes if t.startswith("timestamp")}
    return df.withColumns(made) if made else df


def query(name: str, views: tuple[str, ...], oracle: str | None):
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: rounded(build(Tables(spark, sf_dir)))
        if oracle:
            ORACLES[name] = sql(views, oracle)
        return build

    return register


_ROLLING = ", ".join(
    f"round(avg(lap_duration) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 6) AS rolling_avg_lap_{n}, round(stddev_samp(lap_duration) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 6) AS rolling_std_lap_{n}, "
    f"round(min(lap_duration) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 6) AS rolling_best_lap_{n}"
    for n in rolling.WINDOWS
)


@query("rolling_features", ("laps",), f"""SELECT session_key, driver_number, lap_number, {_ROLLING}, round(lap_duration - lag(lap_duration) OVER w, 6) AS lap_delta_prev,
    greatest(max(lap_number) OVER (PARTITION BY session_key, driver_number) - lap_number, 0) AS laps_to_go,
    round(round(lap_number / max(lap_number) OVER (PARTITION BY session_key, driver_number), 4), 6) AS race_completion_pct
    FROM laps WINDOW w AS (PARTITION BY session_key, driver_number ORDER BY lap_number)""")
def _rolling(t: Tables) -> DataFrame:
    return rolling.rolling_features(t.laps).drop("date_start", "lap_duration", "i1_speed", "is_pit_out_lap")


# Cleaning ------------------------------------------------------------------------------------------------------------

_CLEAN_LAPS = """WITH a AS (SELECT * FROM laps WHERE lap_duration BETWEEN 30 AND 600),
    b AS (SELECT *, coalesce(abs((lap_duration - avg(lap_duration) OVER p) / nullif(stddev_samp(lap_duration) OVER p, 0)) > 3, false) AS is_outlier_lap,
      CASE WHEN i1_speed BETWEEN 0 AND 400 THEN i1_speed END AS s FROM a WINDOW p AS (PARTITION BY session_key, driver_number)),
    clean AS (SELECT session_key, driver_number, lap_number, date_start, lap_duration, is_outlier_lap, is_pit_out_lap,
      coalesce(s, median(s) OVER (PARTITION BY session_key, driver_number), median(s) OVER (PARTITION BY session_key)) AS i1_speed FROM b)"""


@query("clean_laps", ("laps",), f"{_CLEAN_LAPS} SELECT session_key, driver_number, lap_number, epoch_us(date_start) AS date_start, round(lap_duration, 6) AS lap_duration, round(i1_speed, 6) AS i1_speed, is_outlier_lap, is_pit_out_lap FROM clean")
def _clean_laps(t: Tables) -> DataFrame:
    return cleaning.clean_laps(t.laps)


@query("clean_weather", ("weather",), """WITH b AS (SELECT session_key, date, CASE WHEN humidity * 1.5 BETWEEN 0 AND 100 THEN humidity * 1.5 END AS humidity, CASE WHEN air_temperature - 46 BETWEEN -30 AND 60 THEN air_temperature - 46 END AS air_temperature FROM weather)
    SELECT session_key, epoch_us(date) AS date, round(coalesce(humidity, (SELECT median(humidity) FROM b)), 6) AS humidity, round(coalesce(air_temperature, (SELECT median(air_temperature) FROM b)), 6) AS air_temperature FROM b""")
def _clean_weather(t: Tables) -> DataFrame:
    return cleaning.clean_weather(t.weather.select("session_key", "date", (F.col("humidity") * 1.5).alias("humidity"), (F.col("air_temperature") - 46).alias("air_temperature")))


@query("clean_stints", ("stints",), """SELECT session_key, driver_number, stint_number, lap_start, lap_end, CASE WHEN compound IN ('SOFT', 'MEDIUM', 'WET') THEN compound ELSE 'UNKNOWN' END AS compound, tyre_age_at_start FROM stints WHERE lap_end >= lap_start""")
def _clean_stints(t: Tables) -> DataFrame:
    dirty = F.when(F.col("compound") == "HARD", "hyper").otherwise(F.concat(F.lit(" "), F.lower("compound")))
    return cleaning.clean_stints(t.stints.withColumn("compound", dirty))


@query("clean_intervals", ("intervals",), """SELECT session_key, driver_number, epoch_us(date) AS date, gap_to_leader LIKE '%LAP%' AS gap_to_leader_lapped, CASE WHEN try_cast(trim(gap_to_leader) AS DOUBLE) <= 300 THEN try_cast(trim(gap_to_leader) AS DOUBLE) END AS gap_to_leader FROM intervals""")
def _clean_intervals(t: Tables) -> DataFrame:
    return cleaning.clean_intervals(t.intervals)


@query("clean_position", ("position",), "SELECT session_key, driver_number, epoch_us(date) AS date, position * 2 AS position FROM position WHERE position * 2 <= 25")
def _clean_position(t: Tables) -> DataFrame:
    return cleaning.clean_position(t.position.withColumn("position", F.col("position") * 2))


@query("clean_sessions", ("sessions",), "SELECT session_key, year, session_type, circuit_key, 'Unknown' AS location, 'Unknown' AS gmt_offset FROM sessions WHERE session_type = 'Race'")
def _clean_sessions(t: Tables) -> DataFrame:
    dirty = F.when(F.col("session_type") == "Race", "Race").otherwise("Practice")
    return cleaning.clean_sessions(t.sessions.withColumns({"session_type": dirty, "location": F.when(F.col("session_key") < 0, "x").when(F.col("session_key") == 0, "Unknown"), "gmt_offset": F.lit(None).cast("string"), "circuit_short_name": F.lit(None).cast("string")}))


@query("clean_drivers", ("drivers",), f"SELECT session_key, driver_number, CASE WHEN driver_number % 3 = 0 THEN 'Unknown' ELSE full_name END AS full_name, team_name, '{cleaning.DEFAULT_HEADSHOT}' AS headshot_url FROM drivers")
def _clean_drivers(t: Tables) -> DataFrame:
    return cleaning.clean_drivers(t.drivers.withColumns({"full_name": F.when(F.col("driver_number") % 3 == 0, "nan").otherwise(F.concat(F.lit("  "), F.col("full_name"))), "headshot_url": F.lit("")}))


@query("clean_results", ("results",), "SELECT session_key, driver_number, position, 'Unknown' AS status FROM results WHERE position <= 25")
def _clean_results(t: Tables) -> DataFrame:
    both = t.results.withColumn("status", F.lit(""))
    return cleaning.clean_session_results(both.unionByName(both))


@query("clean_starting_grid", ("grid",), "SELECT session_key, driver_number, position + 20 AS position FROM grid WHERE position + 20 <= 25")
def _clean_grid(t: Tables) -> DataFrame:
    return cleaning.clean_starting_grid(t.grid.withColumn("position", F.col("position") + 20))


@query("clean_car_data", ("car_data",), """SELECT session_key, driver_number, lap_number, round(Speed, 6) AS "Speed", CASE WHEN Throttle BETWEEN 0 AND 100 THEN round(Throttle, 6) END AS "Throttle", CASE WHEN RPM BETWEEN 0 AND 20000 THEN round(RPM, 6) END AS "RPM", CAST(Brake AS DOUBLE) AS "Brake", CAST(nGear AS DOUBLE) AS "nGear" FROM car_data WHERE Speed BETWEEN 0 AND 400""")
def _clean_car(t: Tables) -> DataFrame:
    return cleaning.clean_car_data(t.car_data)


@query("clean_location", ("samples",), """SELECT session_key, driver_number, epoch_us(date) AS "Date", round(X, 6) AS "X" FROM samples""")
def _clean_location(t: Tables) -> DataFrame:
    return cleaning.clean_location(t.samples.select(*K, F.col("date").alias("Date"), F.col("X").cast("string").alias("X")))


@query("clean_raw_laps", ("raw_laps",), """WITH t AS (SELECT CAST(session_key AS BIGINT) AS session_key, CAST(CAST(driver_number AS DOUBLE) AS BIGINT) AS driver_number, CAST(lap_number AS BIGINT) AS lap_number, try_cast(date_start AS TIMESTAMP) AS date_start,
      try_cast(trim(lap_duration) AS DOUBLE) AS lap_duration, CASE lower(is_pit_out_lap) WHEN 'true' THEN true WHEN '1' THEN true WHEN 'false' THEN false WHEN '0' THEN false END AS is_pit_out_lap, coalesce(segments_sector_1, '') AS segments_sector_1 FROM raw_laps),
    a AS (SELECT * FROM t WHERE lap_duration BETWEEN 30 AND 600), b AS (SELECT *, coalesce(abs((lap_duration - avg(lap_duration) OVER p) / nullif(stddev_samp(lap_duration) OVER p, 0)) > 3, false) AS is_outlier_lap FROM a WINDOW p AS (PARTITION BY session_key, driver_number))
    SELECT session_key, driver_number, lap_number, epoch_us(date_start) AS date_start, lap_duration, is_pit_out_lap, segments_sector_1, is_outlier_lap FROM b WHERE date_start IS NOT NULL AND session_key IS NOT NULL""")
def _clean_raw_laps(t: Tables) -> DataFrame:
    return cleaning.clean_laps(t.raw_laps)


@query("clean_raw_car_data", ("raw_car",), """SELECT driver_number, sample, CASE WHEN sample % 7 = 0 THEN NULL WHEN sample % 2 = 0 THEN (sample % 6) * 60 + 10 + sample % 10 + 0.5 ELSE CAST(3600 + (20 + sample % 6) * 60 + 30 + sample % 10 AS DOUBLE) END AS "Time",
    CAST("Speed" AS DOUBLE) AS "Speed", epoch_us(try_cast("Date" AS TIMESTAMP)) AS "Date" FROM raw_car WHERE CAST("Speed" AS INT) <= 400 AND driver_number IS NOT NULL""")
def _clean_raw_car(t: Tables) -> DataFrame:
    return cleaning.clean_car_data(t.raw_car)


@query("empty_rows_and_keys", ("raw_laps",), "SELECT session_key, count(*) AS n FROM raw_laps WHERE session_key IS NOT NULL GROUP BY 1 UNION ALL SELECT 'not empty', count(*) FROM raw_laps WHERE driver_number IS NOT NULL")
def _p1(t: Tables) -> DataFrame:
    known = rows.drop_null_keys(rows.drop_empty_rows(t.raw_laps), ["session_key"]).groupBy("session_key").agg(F.count("*").alias("n"))
    return known.unionByName(rows.drop_empty_rows(t.raw_laps).agg(F.count("*").alias("n")).select(F.lit("not empty").alias("session_key"), "n"))


@query("lower_names", ("car_data",), "SELECT session_key, driver_number, lap_number, round(Speed, 6) AS speed, round(Throttle, 6) AS throttle, round(RPM, 6) AS rpm, Brake AS brake, nGear AS ngear FROM car_data")
def _p15(t: Tables) -> DataFrame:
    return rows.lower_names(t.car_data)


@query("clean_all", ("raw_laps", "weather", "stints", "position", "drivers", "sessions"), """WITH s AS (SELECT 'laps' AS file, (SELECT count(*) FROM raw_laps) AS raw_rows, (SELECT count(*) FROM raw_laps WHERE try_cast(trim(lap_duration) AS DOUBLE) BETWEEN 30 AND 600 AND try_cast(date_start AS TIMESTAMP) IS NOT NULL AND session_key IS NOT NULL) AS clean_rows
      UNION ALL SELECT 'weather', count(*), count(*) FROM weather UNION ALL SELECT 'stints', count(*), count(*) FILTER (lap_end >= lap_start) FROM stints UNION ALL SELECT 'position', count(*), count(*) FROM position
      UNION ALL SELECT 'drivers', count(*), count(*) FROM drivers UNION ALL SELECT 'sessions', count(*), count(*) FROM sessions UNION ALL SELECT 'meetings', (SELECT count(*) FROM sessions), NULL)
    SELECT file, raw_rows, coalesce(clean_rows, 0) AS clean_rows, raw_rows - coalesce(clean_rows, 0) AS dropped, CASE WHEN clean_rows IS NULL THEN 'skipped' ELSE 'ok' END AS status FROM s
    UNION ALL SELECT unnest(['session_results', 'starting_grid']), 0, (SELECT count(*) FROM (SELECT DISTINCT session_key, driver_number FROM position)), 0, 'derived'""")
def _c12(t: Tables) -> DataFrame:
    raw = {"laps": t.raw_laps, "weather": t.weather, "stints": t.stints, "position": t.position, "drivers": t.drivers, "sessions": t.sessions, "meetings": t.sessions}
    clean = cleaning.clean_all(raw)
    derived = [df.agg(F.count("*").alias("clean_rows")).select(F.lit(k).alias("file"), F.lit(0).cast("long").alias("raw_rows"), "clean_rows", F.lit(0).cast("long").alias("dropped"), F.lit("derived").alias("status")) for k, df in clean.items() if k not in raw]
    return rows.union_by_name([cleaning.cleaning_summary(raw, clean), *derived])


@query("derived_results", ("position",), "SELECT session_key, driver_number, epoch_us(max(date)) AS date, arg_max(position, date) AS position FROM position GROUP BY ALL")
def _derived_results(t: Tables) -> DataFrame:
    return cleaning.derive_from_position(t.position, last=True)


@query("derived_grid", ("position",), "SELECT session_key, driver_number, epoch_us(min(date)) AS date, arg_min(position, date) AS position FROM position GROUP BY ALL")
def _derived_grid(t: Tables) -> DataFrame:
    return cleaning.derive_from_position(t.position, last=False)


@query("cleaning_summary", ("laps", "position"), """WITH s AS (SELECT 'laps' AS file, (SELECT count(*) FROM laps) AS raw_rows, (SELECT count(*) FROM laps WHERE lap_duration BETWEEN 30 AND 600) AS clean_rows UNION ALL SELECT 'position', (SELECT count(*) FROM position), (SELECT count(*) FROM position))
    SELECT file, raw_rows, clean_rows, raw_rows - clean_rows AS dropped, 'ok' AS status FROM s""")
def _summary(t: Tables) -> DataFrame:
    return cleaning.clean_to({"laps": t.laps, "position": t.position}, f"{store.shared_dir(t.spark)}/clean-{uuid.uuid4().hex}", derive=False)[1]


# Folders of files --------------------------------------------------------------------------------------------------------


def _put(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """df as CSV files with its columns in the given order; instants as text, as the writer has milliseconds only."""
    files.write_table(df.select(*(F.col(c).cast("string").alias(c) for c in columns or df.columns)), path, "csv")


def _halves(t: Tables, laps: DataFrame | None = None) -> str:
    """A folder in which the laps (numbered once, and written) lie in two sets of files, whose columns come in different orders and aren't the same."""
    root = f"{store.shared_dir(t.spark)}/raw-{uuid.uuid4().hex}"
    laps = store.cut(t.laps) if laps is None else laps
    early, late = laps.where("lap_number <= 20"), laps.where("lap_number > 20")
    _put(early.where("i1_speed is null"), f"{root}/laps/2024/1.csv", ["lap_number", "is_pit_out_lap", "session_key", "date_start", "driver_number", "lap_duration"])
    _put(early.where("i1_speed is not null"), f"{root}/laps/2024/2.csv", ["i1_speed", "lap_duration", "date_start", "driver_number", "is_pit_out_lap", "lap_number", "session_key"])
    files.write_table(late, f"{root}/laps/2025/3.parquet")
    return root


@query("laps_from_files", ("laps",), "SELECT session_key, driver_number, lap_number, round(lap_duration, 6) AS lap_duration, round(i1_speed, 6) AS i1_speed, CAST(is_pit_out_lap AS VARCHAR) AS is_pit_out_lap, epoch_us(date_start) AS date_start FROM laps")
def _s1(t: Tables) -> DataFrame:
    return endpoints.scan(t.spark, _halves(t), "laps", folder.schema("laps")).rows.drop(*rows.META)


def _put_lines(df: DataFrame, header: str, path: str) -> None:
    """The column `line` as the lines of CSV files with that header, whatever their fields are: no separator that a line has is one for the writer."""
    df.select(F.col("line").alias(header)).write.option("header", True).option("sep", "\x01").option("quote", "").option("escapeQuotes", False).csv(path)


def _text_of(*columns: str) -> F.Column:
    return F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


@query("unreadable_laps", ("laps",), """SELECT problem, count(*) AS n, count(DISTINCT detail) AS details FROM (
      SELECT CASE WHEN lap_number % 9 = 0 THEN 'bad row' ELSE 'bad value' END AS problem, CASE WHEN lap_number % 9 = 0 THEN concat(session_key, ',', driver_number, ',', lap_number, ',', 1, ',', 2) ELSE concat('lap_duration=x', lap_number % 3) END AS detail FROM laps WHERE lap_number % 9 = 0 OR lap_number % 5 = 0) x GROUP BY 1
    UNION ALL SELECT 'good row', count(*), count(lap_number) FROM laps WHERE lap_number % 9 <> 0""")
def _s6(t: Tables) -> DataFrame:
    """Lines with a field too many and values that are no numbers are told, the others read."""
    root, n = f"{store.shared_dir(t.spark)}/raw-{uuid.uuid4().hex}", F.col("lap_number")
    line = F.when(n % 9 == 0, F.concat(_text_of("session_key", "driver_number", "lap_number"), F.lit(",1,2"))).when(n % 5 == 0, F.concat(_text_of("session_key", "driver_number", "lap_number"), F.lit(",x"), (n % 3).cast("string"))).otherwise(_text_of("session_key", "driver_number", "lap_number", "lap_duration"))
    _put_lines(t.laps.withColumn("line", line), "session_key,driver_number,lap_number,lap_duration", f"{root}/laps/2024/1.csv")
    read = endpoints.scan(t.spark, root, "laps", folder.schema("laps"))
    told = read.problems.groupBy("problem").agg(F.count("*").alias("n"), F.count_distinct("detail").alias("details"))
    return told.unionByName(read.rows.agg(F.count("*").alias("n"), F.count("lap_number").alias("details")).select(F.lit("good row").alias("problem"), "n", "details"))


@query("flat_and_absent_files", ("laps", "stints"), "SELECT 'laps' AS endpoint, count(*) AS n, sum(lap_number)::BIGINT AS laps FROM laps UNION ALL SELECT 'stints', count(*), sum(lap_start)::BIGINT FROM stints UNION ALL SELECT 'absent', 0, NULL")
def _s3(t: Tables) -> DataFrame:
    """A folder with a flat file of earlier days beside it, a flat file alone, and an endpoint without any file."""
    root = f"{store.shared_dir(t.spark)}/raw-{uuid.uuid4().hex}"
    _put(t.laps.where("driver_number % 2 = 0"), f"{root}/laps/2024/1.csv")
    _put(t.laps.where("driver_number % 2 = 1").drop("i1_speed"), f"{root}/laps.csv", ["lap_number", "session_key", "driver_number"])
    files.write_table(t.stints, f"{root}/stints.parquet")
    out = None
    for name, schema, value in (("laps", "laps", "lap_number"), ("stints", "stints", "lap_start"), ("absent", "laps", "lap_number")):
        read = files.read_endpoint(t.spark, root, name, folder.schema(schema), legacy=[f"{root}/{name}.csv", f"{root}/{name}.parquet"])
        one = read.agg(F.coalesce(F.max("_source_endpoint"), F.lit(name)).alias("endpoint"), F.count("*").alias("n"), F.sum(value).alias("laps"))
        out = one if out is None else out.unionByName(one)
    return out


@query("laps_from_records", ("laps",), "SELECT session_key, driver_number, lap_number, round(lap_duration, 6) AS lap_duration, is_pit_out_lap FROM laps")
def _s8(t: Tables) -> DataFrame:
    path = f"{store.shared_dir(t.spark)}/records-{uuid.uuid4().hex}"
    files.write_table(t.laps, path, "json")
    return endpoints.read_records(t.spark, path, t.laps.select(*L, "lap_duration", "is_pit_out_lap").schema).rows.drop(*rows.META)


@query("sessions_taken_once", ("laps",), "SELECT session_key, count(*) AS n, round(sum(lap_duration), 6) AS total FROM laps GROUP BY 1")
def _s9(t: Tables) -> DataFrame:
    """Files of some sessions are taken, then those of all, among them the first ones again under another name."""
    root = f"{store.shared_dir(t.spark)}/raw-{uuid.uuid4().hex}"
    early = t.laps.where("session_key < 4")
    for which, kind in ((early, "csv"), (t.laps, "parquet")):
        files.write_sessions(which.withColumns({"year": F.lit(2024), "date_start": F.col("date_start").cast("string")}), f"{root}/laps", kind)
        ingest(t.spark, f"{root}/laps", folder.schema("laps"), f"{root}-table", f"{root}-checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{root}-table").groupBy("session_key").agg(F.count("*").alias("n"), F.sum("lap_duration").alias("total"))


@query("chosen_sessions", ("sessions",), "SELECT session_key, year, session_type FROM sessions WHERE session_type = 'Race' QUALIFY row_number() OVER (PARTITION BY year ORDER BY circuit_key, session_key) <= 3")
def _s10(t: Tables) -> DataFrame:
    named = t.sessions.withColumns({"session_name": F.col("session_type"), "date_start": F.col("circuit_key")})
    return files.select_sessions(named, ["Race"], 3).select("session_key", "year", "session_type")


@query("sinks_read_back", ("laps",), """SELECT unnest(['csv', 'parquet', 'partitioned']) AS sink, count(*) AS n, round(sum(lap_duration), 6) AS total, count(i1_speed) AS speeds FROM laps
    UNION ALL SELECT 'rewritten', count(*), round(sum(CASE WHEN session_key = 3 THEN 1 ELSE lap_duration END), 6), count(i1_speed) FROM laps WHERE session_key <> 3 OR lap_number <= 2""")
def _s13(t: Tables) -> DataFrame:
    """Both sinks of a table, and a table by session of which one session is written anew."""
    path = f"{store.shared_dir(t.spark)}/sinks-{uuid.uuid4().hex}"
    own = t.laps.select(*L, "lap_duration", "i1_speed")
    both = files.write_both(own, f"{path}/laps")
    files.write_table(own, f"{path}/by", partition_by=["session_key"])
    files.write_table(own, f"{path}/again", partition_by=["session_key"])
    files.rewrite_partitions(own.where("session_key = 3 and lap_number <= 2").withColumn("lap_duration", F.lit(1.0)), f"{path}/again", ["session_key"])
    read = {"csv": t.spark.read.schema(own.schema).option("header", True).csv(f"{path}/laps.csv"), "parquet": both, "partitioned": t.spark.read.parquet(f"{path}/by"), "rewritten": t.spark.read.parquet(f"{path}/again")}
    return rows.union_by_name([df.agg(F.count("*").alias("n"), F.sum("lap_duration").alias("total"), F.count("i1_speed").alias("speeds")).select(F.lit(k).alias("sink"), "*") for k, df in read.items()])


@query("sampled_laps", ("laps",), "SELECT least(count(*), 500) AS n, least(count(*), 500) AS of_laps, least(count(*), 500) AS again FROM laps")
def _p19(t: Tables) -> DataFrame:
    """A sample has that many rows, all of the table, and is the same one however the table is dealt."""
    one = rows.stable_sample(t.laps.select(*L), 500, L)
    other = rows.stable_sample(t.laps.select(*L).repartition(7), 500, L)
    return one.join(t.laps.select(*L).withColumn("here", F.lit(1)), L, "left").join(other.withColumn("too", F.lit(1)), L, "left").agg(F.count("*").alias("n"), F.count("here").alias("of_laps"), F.count("too").alias("again"))


@query("required_columns", ("weather",), """SELECT 'weather' AS file, 'error' AS severity, 'required_columns' AS "check", 'Missing required columns: [''session_key'']' AS message FROM weather HAVING count(*) > 0
    UNION ALL SELECT 'weather', 'warning', 'missing_values', printf('Column humidity has %d nulls (%.1f%%)', count(*) FILTER (rainfall = 1), 100.0 * count(*) FILTER (rainfall = 1) / count(*)) FROM weather""")
def _q1(t: Tables) -> DataFrame:
    return quality.validate({"weather": t.weather.select(F.when(F.col("rainfall") < 1, F.col("humidity")).alias("humidity"), "rainfall")})


# Joins ---------------------------------------------------------------------------------------------------------------


@query("laps_with_session", ("laps", "sessions"), "SELECT l.session_key, driver_number, lap_number, year, session_type, circuit_key FROM laps l LEFT JOIN sessions s USING (session_key)")
def _laps_session(t: Tables) -> DataFrame:
    return joins.look_up(t.laps.select(*L), t.sessions, ["session_key"])


@query("laps_with_driver", ("laps", "drivers"), "SELECT session_key, driver_number, lap_number, full_name, team_name FROM laps LEFT JOIN drivers USING (session_key, driver_number)")
def _laps_driver(t: Tables) -> DataFrame:
    return joins.look_up(t.laps.select(*L), t.drivers, K)


@query("orphan_laps", ("laps", "sessions"), "SELECT session_key, count(*) AS n FROM laps WHERE session_key NOT IN (SELECT session_key FROM sessions WHERE year = 2024) GROUP BY 1")
def _orphans(t: Tables) -> DataFrame:
    return joins.orphans(t.laps, t.sessions.where("year = 2024"), ["session_key"]).groupBy("session_key").agg(F.count("*").alias("n"))


_TYRE = """tyre AS (SELECT l.session_key, l.driver_number, l.lap_number, l.lap_duration, s.stint_number, s.compound, l.lap_number - s.lap_start + coalesce(s.tyre_age_at_start, 0) AS tyre_age FROM laps l LEFT JOIN stints s USING (session_key, driver_number)
    WHERE l.lap_number >= coalesce(s.lap_start, -1) AND l.lap_number <= coalesce(s.lap_end, 9999))"""


@query("stint_range_join", ("laps", "stints"), f"WITH {_TYRE} SELECT session_key, driver_number, lap_number, stint_number, compound, tyre_age FROM tyre")
def _range(t: Tables) -> DataFrame:
    return features.tyre_laps(t.laps, t.stints).select(*L, "stint_number", "compound", "tyre_age")


_PACE = f"""{_TYRE}, aged AS (SELECT compound, lap_duration, CASE WHEN tyre_age > 0 AND tyre_age <= 60 THEN CAST((ceil(tyre_age / 2.0) - 1) * 2 AS BIGINT) END AS bin FROM tyre WHERE compound IS NOT NULL),
    med AS (SELECT compound, bin, median(lap_duration) AS median_lap FROM aged WHERE bin IS NOT NULL GROUP BY ALL HAVING median(lap_duration) IS NOT NULL),
    pace AS (SELECT *, median_lap / lag(median_lap) OVER (PARTITION BY compound ORDER BY bin) - 1 AS change FROM med)"""


@query("pace_by_tyre_age", ("laps", "stints"), f"WITH {_PACE} SELECT compound, bin, round(median_lap, 6) AS median_lap, round(change, 6) AS change FROM pace")
def _pace(t: Tables) -> DataFrame:
    return features.pace_by_age(features.tyre_laps(t.laps, t.stints))


_CLIFFS = f"""{_PACE}, dom(compound, domain) AS (VALUES {', '.join(f"('{c}', {n})" for c, n in features.CLIFF_DEFAULTS.items())}),
    enough AS (SELECT compound FROM tyre WHERE compound IS NOT NULL AND lap_duration IS NOT NULL GROUP BY 1 HAVING count(*) >= 50),
    learned AS (SELECT compound, min(CASE WHEN change > 0.01 THEN bin END) AS bin FROM pace WHERE compound IN (SELECT compound FROM enough) GROUP BY 1 HAVING count(*) >= 5),
    cliffs AS (SELECT compound, CAST(CASE WHEN bin IS NULL THEN domain ELSE greatest(5, floor(CAST(0.6 AS DOUBLE) * bin + CAST(0.4 AS DOUBLE) * domain)) END AS BIGINT) AS cliff FROM dom LEFT JOIN learned USING (compound))"""


@query("tyre_cliffs", ("laps", "stints"), f"WITH {_CLIFFS} SELECT compound, cliff FROM cliffs")
def _cliffs(t: Tables) -> DataFrame:
    return features.learn_cliffs(t.laps, t.stints)


@query("stint_features", ("laps", "stints"), f"""WITH {_CLIFFS} SELECT session_key, driver_number, lap_number, stint_number, compound, CASE WHEN tyre_age IS NOT NULL THEN greatest(tyre_age, 0) END AS current_tyre_age, coalesce(cliff, 30) AS compound_cliff,
    CASE WHEN tyre_age IS NOT NULL THEN greatest(coalesce(cliff, 30) - greatest(tyre_age, 0), 0) END AS laps_until_cliff, CAST(coalesce(greatest(tyre_age, 0) > coalesce(cliff, 30), false) AND tyre_age IS NOT NULL AS INT) AS is_past_cliff FROM tyre LEFT JOIN cliffs USING (compound)""")
def _stint_features(t: Tables) -> DataFrame:
    return features.stint_features(t.laps, t.stints, features.learn_cliffs(t.laps, t.stints)).select(*L, "stint_number", "compound", "current_tyre_age", "compound_cliff", "laps_until_cliff", "is_past_cliff")


@query("stint_features_overlapping", ("laps", "stints", "overlapping"), f"""WITH {_CLIFFS}, j AS (SELECT l.session_key, l.driver_number, l.lap_number, s.stint_number, s.compound, s.lap_start, s.tyre_age_at_start FROM laps l LEFT JOIN overlapping s USING (session_key, driver_number) WHERE l.lap_number >= coalesce(s.lap_start, -1) AND l.lap_number <= coalesce(s.lap_end, 9999)),
    f AS (SELECT session_key, driver_number, lap_number, min(stint_number) AS stint_number, first(compound ORDER BY stint_number) FILTER (compound IS NOT NULL) AS compound, first(lap_start ORDER BY stint_number) FILTER (lap_start IS NOT NULL) AS lap_start, first(tyre_age_at_start ORDER BY stint_number) FILTER (tyre_age_at_start IS NOT NULL) AS age FROM j GROUP BY 1, 2, 3),
    g AS (SELECT *, greatest(lap_number - lap_start + coalesce(age, 0), 0) AS a FROM f)
    SELECT session_key, driver_number, lap_number, stint_number, g.compound, CASE WHEN lap_start IS NOT NULL THEN a END AS current_tyre_age, coalesce(cliff, 30) AS compound_cliff FROM g LEFT JOIN cliffs ON coalesce(g.compound, 'UNKNOWN') = cliffs.compound""")
def _w15(t: Tables) -> DataFrame:
    return features.stint_features(t.laps, t.overlapping, features.learn_cliffs(t.laps, t.stints)).select(*L, "stint_number", "compound", "current_tyre_age", "compound_cliff")


_NEAR = """b AS (SELECT l.session_key, driver_number, lap_number, date_start, w.date AS bd, w.air_temperature AS ba, w.track_temperature AS bt, w.humidity AS bh, w.rainfall AS br, w.wind_speed AS bw FROM laps l ASOF LEFT JOIN weather w ON l.session_key = w.session_key AND l.date_start >= w.date),
    n AS (SELECT b.*, w.date AS nd, w.air_temperature AS na, w.track_temperature AS nt, w.humidity AS nh, w.rainfall AS nr, w.wind_speed AS nw FROM b ASOF LEFT JOIN weather w ON b.session_key = w.session_key AND b.date_start <= w.date),
    near AS (SELECT *, bd IS NULL OR coalesce(epoch_us(nd) - epoch_us(date_start) < epoch_us(date_start) - epoch_us(bd), false) AS after FROM n),
    first AS (SELECT session_key, arg_min(track_temperature, date) AS base FROM weather GROUP BY 1),
    wx AS (SELECT session_key, driver_number, lap_number, CASE WHEN after THEN na ELSE ba END AS air_temperature, CASE WHEN after THEN nt ELSE bt END AS track_temperature, CASE WHEN after THEN nh ELSE bh END AS humidity, CASE WHEN after THEN nr ELSE br END AS rainfall, CASE WHEN after THEN nw ELSE bw END AS wind_speed, base FROM near LEFT JOIN first USING (session_key))"""


@query("weather_as_of", ("laps", "weather"), f"""WITH {_NEAR} SELECT session_key, driver_number, lap_number, round(air_temperature, 6) AS air_temperature, round(track_temperature, 6) AS track_temperature, round(humidity, 6) AS humidity, round(rainfall, 6) AS rainfall, round(wind_speed, 6) AS wind_speed,
    round(round(track_temperature - base, 2), 6) AS track_temp_evolution FROM wx""")
def _weather(t: Tables) -> DataFrame:
    return features.weather_features(t.laps, t.weather).select(*L, *features.WEATHER, "track_temp_evolution")


_POSITION = """pos AS (SELECT l.session_key, l.driver_number, lap_number, date_start, p.position AS current_position FROM laps l ASOF LEFT JOIN position p ON l.session_key = p.session_key AND l.driver_number = p.driver_number AND l.date_start >= p.date)"""


@query("position_as_of", ("laps", "position"), f"""WITH {_POSITION} SELECT session_key, driver_number, lap_number, current_position, CAST(coalesce(current_position = 1, false) AS INT) AS is_leading, CAST(coalesce(current_position <= 3, false) AS INT) AS is_top3, CAST(coalesce(current_position <= 10, false) AS INT) AS is_top10,
    lag(current_position) OVER (PARTITION BY session_key, driver_number ORDER BY date_start, lap_number) - current_position AS position_gain_lap FROM pos""")
def _position(t: Tables) -> DataFrame:
    return features.position_features(t.laps, t.position).select(*L, "current_position", "is_leading", "is_top3", "is_top10", "position_gain_lap")


@query("telemetry_near_intervals", ("samples", "position"), """WITH b AS (SELECT s.session_key, s.driver_number, s.date AS t, p.date AS bd, p.position AS bp FROM samples s ASOF LEFT JOIN position p ON s.session_key = p.session_key AND s.driver_number = p.driver_number AND s.date >= p.date),
    n AS (SELECT b.*, p.date AS nd, p.position AS np FROM b ASOF LEFT JOIN position p ON b.session_key = p.session_key AND b.driver_number = p.driver_number AND b.t <= p.date),
    c AS (SELECT *, CASE WHEN bd IS NULL OR coalesce(epoch_us(nd) - epoch_us(t) < epoch_us(t) - epoch_us(bd), false) THEN nd ELSE bd END AS d, CASE WHEN bd IS NULL OR coalesce(epoch_us(nd) - epoch_us(t) < epoch_us(t) - epoch_us(bd), false) THEN np ELSE bp END AS p FROM n)
    SELECT session_key, driver_number, epoch_us(t) AS date, CASE WHEN abs(epoch_us(d) - epoch_us(t)) <= 86400000000 THEN p END AS position FROM c""")
def _near(t: Tables) -> DataFrame:
    return joins.as_of(t.samples.select(*K, "date"), t.position.withColumnRenamed("date", "at"), K, "date", "at", ["position"], "nearest", tolerance=86400, tie=["position"])


@query("tagged_samples", ("samples", "laps"), "SELECT s.session_key, s.driver_number, epoch_us(s.date) AS date, l.lap_number FROM samples s ASOF LEFT JOIN laps l ON s.session_key = l.session_key AND s.driver_number = l.driver_number AND s.date >= l.date_start")
def _tagged(t: Tables) -> DataFrame:
    return joins.tag_samples(t.samples.select(*K, "date"), t.laps, K, "date", "date_start", "lap_number")


@query("tagged_compounds", ("samples", "laps", "stints"), f"WITH {_TYRE}, own AS (SELECT l.session_key, l.driver_number, l.lap_number, l.date_start, y.compound FROM laps l JOIN tyre y USING (session_key, driver_number, lap_number)) SELECT s.session_key, s.driver_number, epoch_us(s.date) AS date, o.lap_number, o.compound FROM samples s ASOF LEFT JOIN own o ON s.session_key = o.session_key AND s.driver_number = o.driver_number AND s.date >= o.date_start")
def _tagged_compounds(t: Tables) -> DataFrame:
    return joins.tag_samples(t.samples.select(*K, "date"), features.tyre_laps(t.laps, t.stints), K, "date", "date_start", "lap_number", ["compound"])


@query("merged_telemetry", ("samples", "position"), "SELECT session_key, driver_number, epoch_us(coalesce(s.date, p.date)) AS date, round(Speed, 6) AS \"Speed\", position FROM samples s FULL JOIN position p USING (session_key, driver_number, date)")
def _merged(t: Tables) -> DataFrame:
    return t.samples.select(*K, "date", "Speed").join(t.position, [*K, "date"], "full")


_TARGETS = "final_position, CAST(coalesce(final_position = 1, false) AS INT) AS target_win, CAST(coalesce(final_position BETWEEN 1 AND 3, false) AS INT) AS target_podium, CAST(coalesce(final_position BETWEEN 1 AND 10, false) AS INT) AS target_top10"


@query("lap_targets", ("laps", "results"), f"SELECT session_key, driver_number, lap_number, {_TARGETS} FROM laps LEFT JOIN (SELECT session_key, driver_number, position AS final_position FROM results) r USING (session_key, driver_number)")
def _targets(t: Tables) -> DataFrame:
    return features.targets(t.laps.select(*L), t.results)


# Aggregates ----------------------------------------------------------------------------------------------------------

_WEATHER_SUMMARY = "SELECT session_key, round(avg(air_temperature), 6) AS air_temperature_mean, round(avg(track_temperature), 6) AS track_temperature_mean, round(avg(humidity), 6) AS humidity_mean, round(avg(pressure), 6) AS pressure_mean, round(avg(wind_speed), 6) AS wind_speed_mean, max(rainfall) AS rainfall_max FROM weather GROUP BY 1"
_LAP_SUMMARY = "SELECT session_key, driver_number, count(lap_duration) AS lap_count, round(avg(lap_duration), 6) AS avg_lap_duration, round(min(lap_duration), 6) AS best_lap_duration, round(median(lap_duration), 6) AS median_lap_duration, round(stddev_samp(lap_duration), 6) AS lap_duration_std FROM laps GROUP BY 1, 2"
_STINT_SUMMARY = "SELECT session_key, driver_number, count(DISTINCT stint_number) AS stint_count, max(tyre_age_at_start) AS max_tyre_age_at_start, arg_min(compound, stint_number) AS first_compound, arg_max(compound, stint_number) AS last_compound, count(DISTINCT compound) AS compound_count FROM stints GROUP BY 1, 2"


@query("weather_summary", ("weather",), _WEATHER_SUMMARY)
def _a1(t: Tables) -> DataFrame:
    return aggregates.weather_by_session(t.weather)


@query("lap_summary", ("laps",), _LAP_SUMMARY)
def _a2(t: Tables) -> DataFrame:
    return aggregates.laps_by_driver(t.laps)


@query("stint_summary", ("stints",), _STINT_SUMMARY)
def _a3(t: Tables) -> DataFrame:
    return aggregates.stints_by_driver(t.stints)


_BASE = f"""w AS ({_WEATHER_SUMMARY}), la AS ({_LAP_SUMMARY}), st AS ({_STINT_SUMMARY}), base AS (SELECT session_key, driver_number, full_name, team_name, year, session_type, circuit_key, g.position AS grid_position, r.position AS final_position, air_temperature_mean, track_temperature_mean, humidity_mean, pressure_mean, wind_speed_mean, rainfall_max,
    lap_count, avg_lap_duration, best_lap_duration, median_lap_duration, lap_duration_std, stint_count, max_tyre_age_at_start, first_compound, last_compound, compound_count
    FROM drivers LEFT JOIN sessions USING (session_key) LEFT JOIN grid g USING (session_key, driver_number) LEFT JOIN results r USING (session_key, driver_number) LEFT JOIN w USING (session_key) LEFT JOIN la USING (session_key, driver_number) LEFT JOIN st USING (session_key, driver_number))"""
_BASE_VIEWS = ("drivers", "sessions", "grid", "results", "weather", "laps", "stints")


def base_of(t: Tables) -> DataFrame:
    return features.base_table(t.drivers, t.sessions, t.grid, t.results, t.weather, t.laps, t.stints)


@query("driver_session_base", _BASE_VIEWS, f"WITH {_BASE} SELECT * EXCLUDE (final_position), {_TARGETS} FROM base")
def _c24(t: Tables) -> DataFrame:
    return base_of(t)


_CLEAN_BASE = _BASE.replace("FROM laps GROUP BY", "FROM laps WHERE lap_duration BETWEEN 30 AND 600 GROUP BY").replace("FROM stints GROUP BY", "FROM stints WHERE lap_end >= lap_start GROUP BY").replace("LEFT JOIN grid g", "LEFT JOIN (SELECT * FROM grid WHERE position <= 25) g").replace("LEFT JOIN results r", "LEFT JOIN (SELECT * FROM results WHERE position <= 25) r")


@query("base_from_files", _BASE_VIEWS, f"WITH {_CLEAN_BASE} SELECT * EXCLUDE (final_position), {_TARGETS} FROM base")
def _c24_files(t: Tables) -> DataFrame:
    """Files of all endpoints, read, cleaned and built; a driver who comes again in a later file keeps the first name."""
    laps, drivers = store.cut(t.laps), store.cut(t.drivers)
    stints = t.spark.sql(VIEWS["stints"][1], laps=laps)
    root = _halves(t, laps)
    for name, df in {"sessions": t.sessions, "weather": t.weather, "stints": stints, "starting_grid": t.grid, "session_results": t.results}.items():
        _put(df, f"{root}/{name}/2024/1.csv", sorted(df.columns))
    _put(drivers, f"{root}/drivers/2024/1.csv")
    _put(drivers.withColumn("full_name", F.lit("A later name")), f"{root}/drivers/2024/2.csv", ["team_name", "full_name", "session_key", "driver_number"])
    return folder.build_base(t.spark, root, f"{root}-clean")


@query("telemetry_by_lap", ("car_data",), "SELECT session_key, driver_number, lap_number, round(max(Speed), 6) AS speed_max, round(min(Speed), 6) AS speed_min, round(avg(Speed), 6) AS speed_mean, round(stddev_samp(Speed), 6) AS speed_std, round(avg(Throttle), 6) AS throttle_mean, round(quantile_cont(Throttle, 0.9), 6) AS throttle_q90, round(avg(Brake), 6) AS brake_mean, CAST(sum(Brake) AS DOUBLE) AS brake_sum, round(avg(RPM), 6) AS rpm_mean, round(stddev_samp(RPM), 6) AS rpm_std, round(avg(nGear), 6) AS ngear_mean, CAST(max(nGear) AS DOUBLE) AS ngear_max FROM car_data GROUP BY ALL")
def _a5(t: Tables) -> DataFrame:
    return aggregates.telemetry_by_lap(t.car_data)


@query("lagged_telemetry", ("car_data",), "WITH a AS (SELECT session_key, driver_number, lap_number, max(Speed) AS m, quantile_cont(Throttle, 0.9) AS q FROM car_data GROUP BY ALL) SELECT session_key, driver_number, lap_number, round(lag(m) OVER w, 6) AS tele_prev_speed_max, round(lag(q) OVER w, 6) AS tele_prev_throttle_q90 FROM a WINDOW w AS (PARTITION BY session_key, driver_number ORDER BY lap_number)")
def _c22(t: Tables) -> DataFrame:
    return features.lagged_telemetry(t.car_data).select(*L, "tele_prev_speed_max", "tele_prev_throttle_q90")


@query("winsorized_laps", ("laps",), "WITH q AS (SELECT quantile_cont(lap_duration, 0.01) AS a, quantile_cont(lap_duration, 0.99) AS b, quantile_cont(i1_speed, 0.01) AS c, quantile_cont(i1_speed, 0.99) AS d FROM laps) SELECT session_key, driver_number, lap_number, CASE WHEN lap_duration IS NOT NULL THEN round(least(greatest(lap_duration, a), b), 6) END AS lap_duration, CASE WHEN i1_speed IS NOT NULL THEN round(least(greatest(i1_speed, c), d), 6) END AS i1_speed FROM laps, q")
def _c21(t: Tables) -> DataFrame:
    return features.winsorize(t.laps.select(*L, "lap_duration", "i1_speed"))


_TELE = {"speed_max": "max(Speed)", "speed_min": "min(Speed)", "speed_mean": "avg(Speed)", "speed_std": "stddev_samp(Speed)", "throttle_mean": "avg(Throttle)", "throttle_q90": "quantile_cont(Throttle, 0.9)", "brake_mean": "avg(Brake)", "brake_sum": "sum(Brake)", "rpm_mean": "avg(RPM)", "rpm_std": "stddev_samp(RPM)", "ngear_mean": "avg(nGear)", "ngear_max": "max(nGear)"}
_CLIPPED = ["lap_duration", "i1_speed", "current_tyre_age", "lap_delta_prev", "race_completion_pct", *features.WEATHER, "track_temp_evolution", "current_position", "position_gain_lap", "final_position", *(f"tele_prev_{n}" for n in _TELE)]
_MASTER = f"""{_CLIFFS}, {_NEAR}, {_POSITION}, tele AS (SELECT session_key, driver_number, lap_number, {', '.join(f'{x} AS {n}' for n, x in _TELE.items())} FROM car_data GROUP BY 1, 2, 3),
    prev AS (SELECT session_key, driver_number, lap_number, {', '.join(f'CAST(lag({n}) OVER w AS DOUBLE) AS tele_prev_{n}' for n in _TELE)} FROM tele WINDOW w AS (PARTITION BY session_key, driver_number ORDER BY lap_number)),
    own AS (SELECT l.session_key, l.driver_number, l.lap_number, l.date_start, l.lap_duration, l.i1_speed, l.is_pit_out_lap, s.year, s.session_type, s.circuit_key, d.full_name, d.team_name, y.stint_number, y.compound,
      CASE WHEN y.tyre_age IS NOT NULL THEN greatest(y.tyre_age, 0) END AS current_tyre_age, coalesce(cliff, 30) AS compound_cliff, {', '.join(f'wx.{c}' for c in features.WEATHER)}, round(wx.track_temperature - wx.base, 2) AS track_temp_evolution,
      pos.current_position, r.position AS final_position, {', '.join(f'prev.tele_prev_{n}' for n in _TELE)}
      FROM tyre y JOIN laps l USING (session_key, driver_number, lap_number) LEFT JOIN sessions s USING (session_key) LEFT JOIN drivers d USING (session_key, driver_number) LEFT JOIN cliffs ON coalesce(y.compound, 'UNKNOWN') = cliffs.compound
      LEFT JOIN wx USING (session_key, driver_number, lap_number) LEFT JOIN pos USING (session_key, driver_number, lap_number) LEFT JOIN results r USING (session_key, driver_number) LEFT JOIN prev USING (session_key, driver_number, lap_number)),
    master AS (SELECT *, CASE WHEN current_tyre_age IS NOT NULL THEN greatest(compound_cliff - current_tyre_age, 0) END AS laps_until_cliff, CAST(coalesce(current_tyre_age > compound_cliff, false) AS INT) AS is_past_cliff, {_ROLLING}, lap_duration - lag(lap_duration) OVER w AS lap_delta_prev,
      greatest(max(lap_number) OVER (PARTITION BY session_key, driver_number) - lap_number, 0) AS laps_to_go, round(lap_number / max(lap_number) OVER (PARTITION BY session_key, driver_number), 4) AS race_completion_pct,
      CAST(coalesce(current_position = 1, false) AS INT) AS is_leading, CAST(coalesce(current_position <= 3, false) AS INT) AS is_top3, CAST(coalesce(current_position <= 10, false) AS INT) AS is_top10,
      lag(current_position) OVER (PARTITION BY session_key, driver_number ORDER BY date_start, lap_number) - current_position AS position_gain_lap, {_TARGETS.removeprefix('final_position, ')} FROM own WINDOW w AS (PARTITION BY session_key, driver_number ORDER BY lap_number)),
    ends AS (SELECT {', '.join(f'quantile_cont(CAST({c} AS DOUBLE), 0.01) AS low_{c}, quantile_cont(CAST({c} AS DOUBLE), 0.99) AS high_{c}' for c in _CLIPPED)} FROM master)"""


@query("lap_master", ("laps", "sessions", "drivers", "stints", "weather", "position", "results", "car_data"), f"""WITH {_MASTER} SELECT * EXCLUDE (date_start, {', '.join(_CLIPPED)}, {', '.join(f'low_{c}, high_{c}' for c in _CLIPPED)}), epoch_us(date_start) AS date_start,
    {', '.join(f'CASE WHEN {c} IS NOT NULL THEN round(least(greatest(CAST({c} AS DOUBLE), low_{c}), high_{c}), 6) END AS {c}' for c in _CLIPPED)} FROM master, ends""")
def _c23(t: Tables) -> DataFrame:
    return features.lap_master(t.laps, t.sessions, t.drivers, t.stints, t.weather, t.position, t.results, t.car_data)


@query("target_rate", _BASE_VIEWS, f"WITH {_BASE} SELECT round(avg(w), 6) AS win_rate, CAST(sum(w) AS BIGINT) AS wins FROM (SELECT CAST(coalesce(final_position = 1, false) AS INT) AS w FROM base)")
def _a9(t: Tables) -> DataFrame:
    return base_of(t).agg(F.avg("target_win").alias("win_rate"), F.sum("target_win").alias("wins"))


@query("lap_coverage", ("laps",), "SELECT 'lap_duration' AS \"column\", round(avg(CAST(lap_duration IS NOT NULL AS INT)), 6) AS share, 'ok' AS status FROM laps UNION ALL SELECT 'i1_speed', round(avg(CAST(i1_speed IS NOT NULL AS INT)), 6), 'ok' FROM laps")
def _a10(t: Tables) -> DataFrame:
    return aggregates.coverage(t.laps, ["lap_duration", "i1_speed"])


@query("dashboard_kpis", _BASE_VIEWS, f"WITH {_BASE} SELECT count(DISTINCT session_key) AS sessions, count(DISTINCT driver_number) AS drivers, round(avg(track_temperature_mean), 6) AS track_temperature, count(DISTINCT CASE WHEN rainfall_max > 0 THEN session_key END) AS wet_sessions FROM base")
def _a11(t: Tables) -> DataFrame:
    return base_of(t).agg(F.count_distinct("session_key").alias("sessions"), F.count_distinct("driver_number").alias("drivers"), F.avg("track_temperature_mean").alias("track_temperature"), F.count_distinct(F.when(F.col("rainfall_max") > 0, F.col("session_key"))).alias("wet_sessions"))


@query("wins_by_team", _BASE_VIEWS, f"WITH {_BASE} SELECT team_name, count(*) AS wins FROM base WHERE final_position = 1 GROUP BY 1 ORDER BY 2 DESC, 1")
def _a12(t: Tables) -> DataFrame:
    return base_of(t).groupBy("team_name").agg(F.sum("target_win").alias("wins")).where("wins > 0").orderBy(F.desc("wins"), "team_name")


@query("max_lap_by_driver", ("laps",), "SELECT driver_number, max(lap_number) AS max_lap FROM laps GROUP BY 1 ORDER BY 2 DESC, 1")
def _a13(t: Tables) -> DataFrame:
    return t.laps.groupBy("driver_number").agg(F.max("lap_number").alias("max_lap")).orderBy(F.desc("max_lap"), "driver_number")


@query("position_counts", ("position",), "SELECT position, count(*) AS n FROM position GROUP BY 1 ORDER BY 1")
def _a14(t: Tables) -> DataFrame:
    return t.position.groupBy("position").agg(F.count("*").alias("n")).orderBy("position")


@query("win_rate", ("results",), "SELECT count(*) FILTER (position = 1) AS wins, count(position) AS total, round(count(*) FILTER (position = 1) / count(position), 6) AS win_rate, round(count(position) / count(*) FILTER (position = 1), 6) AS class_weight FROM results")
def _a15(t: Tables) -> DataFrame:
    return aggregates.win_rate(t.results)


@query("degradation_curve", ("laps", "stints"), f"WITH {_TYRE}, a AS (SELECT compound, greatest(tyre_age, 0) AS age, lap_duration FROM tyre WHERE compound IS NOT NULL AND lap_duration IS NOT NULL), big AS (SELECT compound FROM a WHERE age <= 55 GROUP BY 1 HAVING count(*) >= 20) SELECT compound, age, round(median(lap_duration), 6) AS median_lap FROM a WHERE age <= 55 AND compound IN (SELECT compound FROM big) GROUP BY 1, 2")
def _a16(t: Tables) -> DataFrame:
    aged = features.tyre_laps(t.laps, t.stints).where("compound is not null and lap_duration is not null").withColumn("age", F.greatest("tyre_age", F.lit(0))).where("age <= 55")
    big = aged.groupBy("compound").agg(F.count("*").alias("n")).where("n >= 20").select("compound")
    return aggregates.medians(aged.join(big, "compound", "left_semi"), "lap_duration", ["compound", "age"], "median_lap")


@query("pace_by_temperature", ("laps", "stints", "weather"), f"WITH {_TYRE}, m AS (SELECT session_key, avg(track_temperature) AS temp FROM weather GROUP BY 1), j AS (SELECT compound, lap_duration, temp FROM tyre JOIN m USING (session_key) WHERE temp > 20 AND temp <= 60) SELECT compound, round(median(CASE WHEN temp <= 30 THEN lap_duration END), 6) AS bin_20_30, round(median(CASE WHEN temp > 30 AND temp <= 40 THEN lap_duration END), 6) AS bin_30_40, round(median(CASE WHEN temp > 40 AND temp <= 50 THEN lap_duration END), 6) AS bin_40_50, round(median(CASE WHEN temp > 50 THEN lap_duration END), 6) AS bin_50_60 FROM j GROUP BY 1")
def _a17(t: Tables) -> DataFrame:
    mean = t.weather.groupBy("session_key").agg(F.avg("track_temperature").alias("temp"))
    return aggregates.pivot_median(features.tyre_laps(t.laps, t.stints).join(mean, "session_key", "left"), "compound", "temp", [20, 30, 40, 50, 60], "lap_duration")


@query("lap_histogram", ("laps",), "WITH x AS (SELECT least(lap_duration, 200) AS x FROM laps WHERE lap_duration IS NOT NULL), e AS (SELECT min(x) AS a, max(x) AS b FROM x) SELECT CAST(least(80, greatest(1, floor((x - a) / (b - a) * 80) + 1)) AS BIGINT) AS bin, count(*) AS n FROM x, e GROUP BY 1")
def _a18(t: Tables) -> DataFrame:
    return aggregates.histogram(t.laps, "lap_duration", 80, 200.0)


@query("lap_box_plot", ("laps",), "WITH q AS (SELECT session_key, quantile_cont(lap_duration, 0.25) AS q1, quantile_cont(lap_duration, 0.5) AS q2, quantile_cont(lap_duration, 0.75) AS q3 FROM laps GROUP BY 1), j AS (SELECT *, lap_duration BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok FROM laps JOIN q USING (session_key) WHERE lap_duration IS NOT NULL) SELECT session_key, round(q1, 6) AS q1, round(q2, 6) AS q2, round(q3, 6) AS q3, round(min(CASE WHEN ok THEN lap_duration END), 6) AS low, round(max(CASE WHEN ok THEN lap_duration END), 6) AS high, count(*) FILTER (NOT ok) AS outliers FROM j GROUP BY session_key, q1, q2, q3")
def _a19(t: Tables) -> DataFrame:
    return aggregates.box_plot(t.laps, "lap_duration", ["session_key"])


@query("lap_spearman", ("laps",), "WITH x AS (SELECT lap_number, lap_duration, i1_speed FROM laps WHERE lap_duration IS NOT NULL AND i1_speed IS NOT NULL), r AS (SELECT rank() OVER (ORDER BY lap_number) + (count(*) OVER (PARTITION BY lap_number) - 1) / 2 AS a, rank() OVER (ORDER BY lap_duration) + (count(*) OVER (PARTITION BY lap_duration) - 1) / 2 AS b, rank() OVER (ORDER BY i1_speed) + (count(*) OVER (PARTITION BY i1_speed) - 1) / 2 AS c FROM x) SELECT 'lap_number' AS a, 'lap_number' AS b, round(corr(a, a), 6) AS correlation FROM r UNION ALL SELECT 'lap_number', 'lap_duration', round(corr(a, b), 6) FROM r UNION ALL SELECT 'lap_number', 'i1_speed', round(corr(a, c), 6) FROM r UNION ALL SELECT 'lap_duration', 'lap_duration', round(corr(b, b), 6) FROM r UNION ALL SELECT 'lap_duration', 'i1_speed', round(corr(b, c), 6) FROM r UNION ALL SELECT 'i1_speed', 'i1_speed', round(corr(c, c), 6) FROM r")
def _a20(t: Tables) -> DataFrame:
    return aggregates.spearman(t.laps, ["lap_number", "lap_duration", "i1_speed"])


@query("weather_vif", ("weather",), "WITH g AS (SELECT sum(air_temperature * air_temperature) AS a, sum(air_temperature * humidity) AS b, sum(humidity * humidity) AS c FROM weather), v AS (SELECT a * c / (a * c - b * b) AS v FROM g), n AS (SELECT unnest(['air_temperature', 'humidity']) AS \"column\") SELECT \"column\", round(v, 6) AS vif, CASE WHEN v > 10 THEN 'HIGH' WHEN v > 5 THEN 'MEDIUM' ELSE 'OK' END AS risk FROM v, n")
def _a21(t: Tables) -> DataFrame:
    return aggregates.vif(t.weather, ["air_temperature", "humidity"])


SIGNALS = ["lap_duration", "i1_speed", "i2_speed", "st_speed", "duration_sector_1", "duration_sector_2", "duration_sector_3"]
_PAIRS = [(a, b) for i, a in enumerate(SIGNALS) for b in SIGNALS[i:]]
_WHOLE = f"x AS (SELECT * FROM signals WHERE {' AND '.join(f'{c} IS NOT NULL' for c in SIGNALS)})"
_SIGNAL_RANKS = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS {c}" for c in SIGNALS)


@query("signal_spearman", ("signals",), f"WITH {_WHOLE}, r AS (SELECT {_SIGNAL_RANKS} FROM x) " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS correlation FROM r" for a, b in _PAIRS))
def _a20_all(t: Tables) -> DataFrame:
    return aggregates.spearman(t.signals, SIGNALS)


def _swept() -> str:
    """SQL that inverts the matrix of the signals' products by pivoting on one column after another."""
    n = len(SIGNALS)
    steps = ["g0 AS (SELECT " + ", ".join(f"sum({a} * {b}) AS m{i}{j}" for i, a in enumerate(SIGNALS) for j, b in enumerate(SIGNALS)) + " FROM x)"]
    for k in range(n):
        entry = lambda i, j, k=k: f"1 / m{k}{k}" if i == j == k else f"m{k}{j} / m{k}{k}" if i == k else f"-m{i}{k} / m{k}{k}" if j == k else f"m{i}{j} - m{i}{k} * m{k}{j} / m{k}{k}"
        steps.append(f"g{k + 1} AS (SELECT " + ", ".join(f"{entry(i, j)} AS m{i}{j}" for i in range(n) for j in range(n)) + f" FROM g{k})")
    each = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", g0.m{i}{i} * g{n}.m{i}{i} AS v FROM g0, g{n}" for i, c in enumerate(SIGNALS))
    return f"WITH {_WHOLE}, {', '.join(steps)}, v AS ({each}) SELECT \"column\", round(v, 6) AS vif, CASE WHEN v > 10 THEN 'HIGH' WHEN v > 5 THEN 'MEDIUM' ELSE 'OK' END AS risk FROM v"


@query("signal_vif", ("signals",), _swept())
def _a21_all(t: Tables) -> DataFrame:
    return aggregates.vif(t.signals, SIGNALS)


@query("grid_trend_by_team", _BASE_VIEWS, f"WITH {_BASE} SELECT team_name, round(regr_slope(final_position, grid_position), 6) AS slope, round(regr_intercept(final_position, grid_position), 6) AS intercept, round(regr_r2(final_position, grid_position), 6) AS r2 FROM base GROUP BY 1")
def _a22(t: Tables) -> DataFrame:
    return aggregates.trend_lines(base_of(t), "final_position", "grid_position", ["team_name"])


@query("rows_by_table", ("laps", "weather", "position"), "SELECT 'laps' AS file, count(*) AS n FROM laps UNION ALL SELECT 'weather', count(*) FROM weather UNION ALL SELECT 'position', count(*) FROM position")
def _a23(t: Tables) -> DataFrame:
    return rows.union_by_name([getattr(t, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("file"), "n") for n in ("laps", "weather", "position")])


@query("sessions_without_weather", ("laps", "weather"), "SELECT session_key, count(*) AS laps FROM laps WHERE session_key NOT IN (SELECT session_key FROM weather) GROUP BY 1")
def _a24(t: Tables) -> DataFrame:
    return t.laps.join(t.weather.select("session_key").distinct(), "session_key", "left_anti").groupBy("session_key").agg(F.count("*").alias("laps"))


@query("median_lap_by_outlier", ("laps",), f"{_CLEAN_LAPS} SELECT is_outlier_lap, count(*) AS n, round(median(lap_duration), 6) AS median_lap FROM clean GROUP BY 1")
def _a25(t: Tables) -> DataFrame:
    laps = store.cut(cleaning.clean_laps(t.laps).select("is_outlier_lap", "lap_duration"))
    return laps.groupBy("is_outlier_lap").agg(F.count("*").alias("n")).join(aggregates.medians(laps, "lap_duration", ["is_outlier_lap"], "median_lap"), "is_outlier_lap")


# Filters, limits, windows ---------------------------------------------------------------------------------------------


@query("laps_at_maximum", ("laps",), "SELECT session_key, driver_number, lap_number FROM laps l WHERE lap_number = (SELECT max(lap_number) FROM laps m WHERE m.session_key = l.session_key)")
def _p17(t: Tables) -> DataFrame:
    return rows.rows_at_maximum(t.laps.select(*L), "lap_number", ["session_key"])


@query("first_stint_by_driver", ("stints",), "SELECT session_key, driver_number, stint_number, compound FROM stints QUALIFY row_number() OVER (PARTITION BY session_key, driver_number ORDER BY stint_number) = 1")
def _p12(t: Tables) -> DataFrame:
    return rows.first_per_key(t.stints.select(*K, "stint_number", "compound"), K, ["stint_number"])


@query("first_sessions_by_year", ("sessions",), "SELECT session_key, year FROM sessions QUALIFY row_number() OVER (PARTITION BY year ORDER BY session_key) <= 2")
def _o6(t: Tables) -> DataFrame:
    return rows.first_n_per_group(t.sessions.select("session_key", "year"), ["year"], ["session_key"], 2)


@query("busiest_driver_series", ("laps",), """WITH r AS (SELECT *, avg(lap_duration) OVER (PARTITION BY session_key, driver_number ORDER BY lap_number ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS a FROM laps), x AS (SELECT * FROM r WHERE lap_duration IS NOT NULL AND a IS NOT NULL),
    d AS (SELECT driver_number FROM x GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), s AS (SELECT session_key FROM x WHERE driver_number IN (SELECT driver_number FROM d) GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT lap_number, round(lap_duration, 6) AS lap_duration, round(a, 6) AS rolling_avg_lap_3 FROM x WHERE driver_number IN (SELECT driver_number FROM d) AND session_key IN (SELECT session_key FROM s)""")
def _q20(t: Tables) -> DataFrame:
    known = rolling.rolling_features(t.laps).where("lap_duration is not null and rolling_avg_lap_3 is not null")
    for by in ("driver_number", "session_key"):
        known = known.join(F.broadcast(rows.most_frequent(known, [by]).select(by)), by, "left_semi")
    return known.select("lap_number", "lap_duration", "rolling_avg_lap_3").orderBy("lap_number")


@query("picker_values", ("sessions",), "SELECT DISTINCT year, session_type FROM sessions ORDER BY year DESC, session_type")
def _o8(t: Tables) -> DataFrame:
    return t.sessions.select("year", "session_type").distinct().orderBy(F.desc("year"), "session_type")


@query("result_table", _BASE_VIEWS, f"WITH {_BASE} SELECT session_key, full_name, team_name, grid_position, final_position, CASE WHEN final_position <= 10 THEN 'Finished' WHEN final_position > 10 THEN 'Unknown' END AS status FROM base WHERE year = 2024 AND session_type = 'Race'")
def _q19(t: Tables) -> DataFrame:
    results = cleaning.clean_session_results(t.results.withColumn("status", F.when(F.col("position") <= 10, " Finished").otherwise("nan")))
    base = features.base_table(t.drivers, t.sessions, t.grid, results.unionByName(t.results.where("position > 25").withColumn("status", F.lit("Unknown"))), t.weather, t.laps, t.stints)
    return base.where("year = 2024 and session_type = 'Race'").select("session_key", "full_name", "team_name", "grid_position", "final_position", "status")


@query("sessions_per_year", ("sessions",), "SELECT year, count(*) AS sessions FROM sessions GROUP BY 1 UNION ALL SELECT NULL, count(*) FROM sessions")
def _s11(t: Tables) -> DataFrame:
    return files.ingest_log(t.sessions)


@query("run_metadata", ("laps", "results", "stints"), f"""WITH {_CLIFFS}, m AS (SELECT CAST(coalesce(r.position = 1, false) AS INT) AS w FROM laps LEFT JOIN results r USING (session_key, driver_number)), said AS (SELECT string_agg(concat(compound, '=', cliff), ',' ORDER BY compound) AS tyre_cliffs FROM cliffs)
    SELECT count(*) AS row_count, round(avg(w), 6) AS win_rate, 7 AS col_count, min(tyre_cliffs) AS tyre_cliffs FROM m, said""")
def _s16(t: Tables) -> DataFrame:
    out = files.run_metadata(features.targets(t.laps.select(*L), t.results), cliffs=features.learn_cliffs(t.laps, t.stints))
    said = F.array_join(F.transform(F.map_entries("tyre_cliffs_used"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return out.select("row_count", "win_rate", "col_count", said.alias("tyre_cliffs"))


# Quality and profiling -------------------------------------------------------------------------------------------------


@query("duplicate_keys", ("weather",), "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT session_key FROM weather)) AS n FROM weather")
def _q2(t: Tables) -> DataFrame:
    return quality.duplicate_count(t.weather, ["session_key"])


@query("null_profile", ("laps",), "WITH r AS (SELECT count(*) AS row_count, count(*) - count(lap_duration) AS a, count(*) - count(i1_speed) AS b FROM laps) SELECT 'lap_duration' AS \"column\", a AS nulls, row_count, round(a / row_count, 6) AS share FROM r UNION ALL SELECT 'i1_speed', b, row_count, round(b / row_count, 6) FROM r UNION ALL SELECT 'lap_number', 0, row_count, 0.0 FROM r")
def _q4(t: Tables) -> DataFrame:
    return quality.null_shares(t.laps.select("lap_duration", "i1_speed", "lap_number"))


@query("validation_report", ("laps", "sessions"), """WITH s AS (SELECT * FROM sessions WHERE session_key <> 3), r AS (SELECT count(*) AS n, count(*) - count(lap_duration) AS a, count(*) - count(i1_speed) AS b, count(*) FILTER (lap_duration NOT BETWEEN 30 AND 600) AS c FROM laps)
    SELECT 'laps' AS file, 'warning' AS severity, 'missing_values' AS "check", printf('Column lap_duration has %d nulls (%.1f%%)', a, 100.0 * a / n) AS message FROM r UNION ALL SELECT 'laps', 'warning', 'missing_values', printf('Column i1_speed has %d nulls (%.1f%%)', b, 100.0 * b / n) FROM r
    UNION ALL SELECT 'laps', 'warning', 'range', printf('Column lap_duration has %d values outside [30, 600]', c) FROM r WHERE c > 0
    UNION ALL SELECT 'laps', 'error', 'consistency', printf('Found data for %d session(s) not present in sessions', count(DISTINCT session_key)) FROM laps WHERE session_key NOT IN (SELECT session_key FROM s)
    UNION ALL SELECT 'starting_grid', 'warning', 'file_exists', 'File missing'""")
def _q7(t: Tables) -> DataFrame:
    return quality.validate({"sessions": t.sessions.where("session_key <> 3"), "laps": t.laps}, expected=["sessions", "laps", "starting_grid"])


@query("table_summary", ("laps",), "WITH r AS (SELECT count(*) AS n, count(*) - count(lap_duration) AS a, count(*) - count(i1_speed) AS b FROM laps) SELECT 'laps' AS file, n AS row_count, CAST(7 AS BIGINT) AS col_count, CAST(2 AS BIGINT) AS cols_any_null, CAST(CASE WHEN a / n > 0.2 THEN 1 ELSE 0 END + CASE WHEN b / n > 0.2 THEN 1 ELSE 0 END AS BIGINT) AS drop_candidates, round(100.0 * (a / n + b / n) / 7, 6) AS null_pct FROM r")
def _q8(t: Tables) -> DataFrame:
    return quality.table_summary(t.laps, "laps")


@query("parse_shares", ("intervals",), "SELECT session_key AS file, round(avg(CAST(g IS NOT NULL AS INT)), 6) AS present, round(avg(CAST(try_cast(trim(g) AS DOUBLE) IS NOT NULL AS INT)), 6) AS parsed FROM (SELECT session_key, CASE WHEN gap_to_leader = 'nan' THEN 'x' ELSE nullif(gap_to_leader, '') END AS g FROM intervals) GROUP BY 1")
def _q9(t: Tables) -> DataFrame:
    text = F.when(F.col("gap_to_leader") == "nan", "x").otherwise(F.nullif(F.col("gap_to_leader"), F.lit("")))
    return quality.parse_shares(t.intervals.withColumn("gap_to_leader", text), F.col("session_key"), "gap_to_leader", "double")


#: What SQL calls a type, and what Spark does.
_TYPES = "{'BIGINT': 'bigint', 'DOUBLE': 'double', 'BOOLEAN': 'boolean', 'VARCHAR': 'string', 'TIMESTAMP': 'timestamp_ntz', 'INTEGER': 'int'}"


def _typed(view: str, columns: list[str]) -> str:
    """SQL for name, type and place of a view's columns, as the engine finds them in its rows."""
    return f"SELECT unnest([{', '.join(f'{chr(39)}{c}{chr(39)}' for c in columns)}]) AS c, unnest([{', '.join(f'typeof({c})' for c in columns)}]) AS t FROM (SELECT * FROM {view} LIMIT 1)"


@query("schema_alignment", ("laps", "raw_laps", "stints"), f"""WITH a AS ({_typed('laps', ['session_key', 'driver_number', 'lap_number', 'date_start', 'lap_duration', 'i1_speed', 'is_pit_out_lap'])}),
    b AS ({_typed('raw_laps', ['session_key', 'driver_number', 'lap_number', 'date_start', 'lap_duration', 'is_pit_out_lap', 'segments_sector_1'])}),
    j AS (SELECT coalesce(a.c, b.c) AS "column", a.t AS was, b.t AS got FROM a FULL JOIN b ON a.c = b.c), n AS (SELECT MAP {_TYPES} AS names)
    SELECT 'raw_laps' AS file, (SELECT count(*) FROM raw_laps) AS row_count, "column", CASE WHEN was IS NULL THEN 'extra' WHEN got IS NULL THEN 'missing' ELSE 'type' END AS issue, names[was] AS expected, names[got] AS got FROM j, n WHERE was IS DISTINCT FROM got""")
def _q9_schema(t: Tables) -> DataFrame:
    return quality.schema_alignment({"empty": t.stints.where("stint_number < 0"), "laps": t.laps, "raw_laps": t.raw_laps})


_DESCRIBED = "count({c}) AS n, CAST(NULL AS BIGINT) AS n_unique, CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS least, round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS q2, round(quantile_cont({c}, 0.75), 6) AS q3, round(CAST(max({c}) AS DOUBLE), 6) AS most"


@query("describe_laps", ("laps", "stints"), f"""WITH {_TYRE}, c AS (SELECT compound, count(*) AS n FROM tyre WHERE compound IS NOT NULL GROUP BY 1) SELECT 'lap_duration' AS "column", {_DESCRIBED.format(c='lap_duration')} FROM tyre UNION ALL SELECT 'tyre_age', {_DESCRIBED.format(c='tyre_age')} FROM tyre
    UNION ALL SELECT 'compound', sum(n), count(*), arg_min(compound, (-n, compound)), max(n), NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM c""")
def _q10(t: Tables) -> DataFrame:
    return quality.describe(features.tyre_laps(t.laps, t.stints).select("lap_duration", "tyre_age", "compound"))


_PROFILED = """SELECT '{c}' AS "column", '{t}' AS dtype, count(DISTINCT {c}) AS n_unique, count(*) - count({c}) AS nulls, round(100.0 * (count(*) - count({c})) / count(*), 2) AS null_pct,
    CASE WHEN count(DISTINCT {c}) = count(*) THEN 'ID/Key' WHEN count(DISTINCT {c}) < 30 THEN 'Categorical' WHEN '{t}' = 'string' THEN 'High-card text' ELSE 'Numeric' END AS likely_type, array_to_string(list_slice(list_sort(list(DISTINCT CAST({c} AS VARCHAR)) FILTER ({c} IS NOT NULL)), 1, 5), ',') AS samples FROM laps_of_drivers"""


@query("unique_profile", ("laps", "drivers"), "WITH laps_of_drivers AS (SELECT driver_number, lap_number, session_key, full_name, team_name, is_pit_out_lap, CASE WHEN lap_number % 3 = 0 THEN NULL ELSE lap_number END AS gaps, concat(CAST(driver_number AS STRING), '-', CAST(lap_number AS STRING)) AS id FROM laps JOIN drivers USING (session_key, driver_number)) " + " UNION ALL ".join(_PROFILED.format(c=c, t=t) for c, t in (("driver_number", "bigint"), ("lap_number", "bigint"), ("session_key", "bigint"), ("full_name", "string"), ("team_name", "string"), ("is_pit_out_lap", "boolean"), ("gaps", "bigint"), ("id", "string"))))
def _q11(t: Tables) -> DataFrame:
    both = t.laps.join(t.drivers, K).select("driver_number", "lap_number", "session_key", "full_name", "team_name", "is_pit_out_lap", F.when(F.col("lap_number") % 3 != 0, F.col("lap_number")).alias("gaps"), F.concat_ws("-", "driver_number", "lap_number").alias("id"))
    return quality.unique_profile(both)


_BASE_COLUMNS = ("session_key", "driver_number", "full_name", "team_name", "year", "session_type", "circuit_key", "grid_position", "final_position", *(f"{c}_mean" for c in ("air_temperature", "track_temperature", "humidity", "pressure", "wind_speed")), "rainfall_max", "lap_count", "avg_lap_duration", "best_lap_duration", "median_lap_duration", "lap_duration_std", "stint_count", "max_tyre_age_at_start", "first_compound", "last_compound", "compound_count", "target_win", "target_podium", "target_top10")
_MISSING = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", 100.0 * (count(*) - count({'1' if c.startswith('target_') else c})) / count(*) AS pct FROM base" for c in _BASE_COLUMNS)


@query("most_missing", _BASE_VIEWS, f"""WITH {_BASE}, x AS ({_MISSING}) SELECT "column", round(pct, 6) AS pct, CASE WHEN pct > 20 THEN 'drop' WHEN pct > 5 THEN 'watch' ELSE 'ok' END AS status FROM x ORDER BY x.pct DESC, "column" LIMIT 20""")
def _o4(t: Tables) -> DataFrame:
    return quality.most_missing(base_of(t))


@query("duplicate_report", ("weather",), "WITH w AS (SELECT session_key, rainfall, CAST(humidity > 50 AS INT) AS wet FROM weather) SELECT 'weather' AS file, count(*) AS row_count, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM w)) AS full_row_dups, round(100.0 * (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM w))) / count(*), 2) AS full_dup_pct, '[''session_key'']' AS key_cols, count(*) - (SELECT count(*) FROM (SELECT DISTINCT session_key FROM w)) AS key_dups FROM w")
def _q15(t: Tables) -> DataFrame:
    return quality.duplicate_report(t.weather.select("session_key", "rainfall", (F.col("humidity") > 50).cast("int").alias("wet")), "weather", ["session_key", "date"])


@query("missing_by_session", ("samples",), "SELECT session_key, count(*) AS row_count, round(avg(CAST(X IS NULL AS INT)), 6) AS missing FROM samples GROUP BY 1")
def _a24_share(t: Tables) -> DataFrame:
    return aggregates.missing_share(t.samples, "X", ["session_key"])


@query("negative_values", ("laps",), "SELECT 'x' AS \"column\", count(*) FILTER (lap_duration - 50 < 0) AS n, round(100.0 * count(*) FILTER (lap_duration - 50 < 0) / count(*), 6) AS pct, round(min(lap_duration - 50), 6) AS least FROM laps")
def _q12(t: Tables) -> DataFrame:
    return quality.negatives(t.laps.select((F.col("lap_duration") - 50).alias("x"), "lap_number"))


@query("blank_values", ("intervals",), "SELECT 'gap_to_leader' AS \"column\", count(*) FILTER (trim(gap_to_leader) = '') AS n FROM intervals")
def _q13(t: Tables) -> DataFrame:
    return quality.blanks(t.intervals.select("gap_to_leader"))


@query("low_variance", ("laps",), "SELECT 'z' AS \"column\", 'a' AS \"value\", round(count(*) FILTER (lap_number < 10000) / count(*), 6) AS share FROM laps")
def _q14(t: Tables) -> DataFrame:
    return quality.dominant_values(t.laps.select(F.when(F.col("lap_number") < 10000, "a").otherwise("b").alias("z"), "lap_number"))


@query("time_columns", ("raw_laps",), "SELECT 'date_start' AS \"column\", round(avg(CAST(try_cast(date_start AS TIMESTAMP) IS NOT NULL AS INT)) FILTER (date_start IS NOT NULL), 6) AS parsed, avg(CAST(try_cast(date_start AS TIMESTAMP) IS NOT NULL AS INT)) FILTER (date_start IS NOT NULL) > 0.8 AS convert FROM raw_laps UNION ALL SELECT 'end_text', 0.0, false FROM raw_laps HAVING count(*) > 0")
def _q16(t: Tables) -> DataFrame:
    return quality.time_columns(t.raw_laps.select("date_start", "lap_duration", F.when(F.col("lap_number").isNotNull(), "later").alias("end_text"), F.col("session_key").alias("label")))


_ODD_LAPS = "SELECT session_key, CASE WHEN lap_number % 2 = 0 THEN 1 END AS half, CASE WHEN lap_number % 10 <> 0 THEN 1 END AS most, CASE WHEN lap_number < 10000 THEN 'a' ELSE 'b' END AS same, lap_number % 5 - 2 AS below, lap_number % 7 AS above FROM laps"


@query("recommendations", ("laps",), f"WITH x AS ({_ODD_LAPS}), " + " UNION ALL ".join(
    ["c AS (SELECT 'session_key' AS \"column\", session_key AS v, CAST(session_key AS STRING) AS s FROM x", *(f"SELECT '{c}', {v}, CAST({c} AS STRING) FROM x" for c, v in (("half", "half"), ("most", "most"), ("same", "NULL"), ("below", "below"), ("above", "above")))]
) + """), k AS (SELECT "column", s, count(*) AS n FROM c GROUP BY 1, 2) SELECT "column", CASE WHEN avg(CAST(s IS NULL AS INT)) > 0.2 THEN 'drop' ELSE 'impute' END AS action FROM c GROUP BY 1 HAVING count(s) < count(*) UNION ALL SELECT "column", 'low variance' FROM k GROUP BY 1 HAVING max(n) >= 0.99 * sum(n)
    UNION ALL SELECT "column", 'negative' FROM c WHERE v < 0 GROUP BY 1 UNION ALL SELECT NULL, 'duplicates' FROM x HAVING count(*) > (SELECT count(*) FROM (SELECT DISTINCT * FROM x))""")
def _q17(t: Tables) -> DataFrame:
    n = F.col("lap_number")
    return quality.recommendations(t.laps.select("session_key", F.when(n % 2 == 0, 1).alias("half"), F.when(n % 10 != 0, 1).alias("most"), F.when(n < 10000, "a").otherwise("b").alias("same"), (n % 5 - 2).alias("below"), (n % 7).alias("above")))


# Time grids -------------------------------------------------------------------------------------------------------------


@query("resampled", ("samples",), "SELECT session_key, driver_number, epoch_us(time_bucket(INTERVAL 1 DAY, date, TIMESTAMP '1970-01-01')) AS date, round(avg(Speed), 6) AS \"Speed\" FROM samples GROUP BY 1, 2, 3")
def _t1(t: Tables) -> DataFrame:
    return resample.resample(t.samples.withColumn("date", F.col("date").cast("timestamp")), K, "date", ["Speed"], "1 day")


@query("without_jumps", ("samples",), "SELECT session_key, driver_number, epoch_us(date) AS date, CASE WHEN coalesce(abs(X - lag(X) OVER w) <= 5000, true) THEN round(X, 6) END AS \"X\" FROM samples WINDOW w AS (PARTITION BY session_key, driver_number ORDER BY date)")
def _w18(t: Tables) -> DataFrame:
    return resample.remove_jumps(t.samples.select(*K, "date", "X"), K, "date", ["X"])


@query("resampled_seconds", ("samples",), "SELECT session_key, driver_number, epoch_us(time_bucket(INTERVAL 1 SECOND, date, TIMESTAMP '1970-01-01')) AS date, round(avg(Speed), 6) AS \"Speed\", round(avg(Throttle), 6) AS \"Throttle\" FROM samples GROUP BY 1, 2, 3")
def _t1_seconds(t: Tables) -> DataFrame:
    return resample.resample(t.samples.withColumn("date", F.col("date").cast("timestamp")), K, "date", ["Speed", "Throttle"])


@query("interpolated", ("samples",), """WITH p AS (SELECT session_key, driver_number, CAST(epoch_us(date) AS DOUBLE) AS t, epoch_us(date) AS date, X, last_value(CASE WHEN X IS NOT NULL THEN CAST(epoch_us(date) AS DOUBLE) END IGNORE NULLS) OVER b AS t0, last_value(X IGNORE NULLS) OVER b AS x0, first_value(CASE WHEN X IS NOT NULL THEN CAST(epoch_us(date) AS DOUBLE) END IGNORE NULLS) OVER f AS t1, first_value(X IGNORE NULLS) OVER f AS x1
      FROM samples WINDOW b AS (PARTITION BY session_key, driver_number ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY session_key, driver_number ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT session_key, driver_number, date, round(coalesce(X, x0 + (x1 - x0) * (t - t0) / nullif(t1 - t0, 0), x0, x1), 6) AS "X" FROM p""")
def _w19(t: Tables) -> DataFrame:
    return resample.interpolate(t.samples.select(*K, "date", "X"), K, "date", ["X"])


@query("motion_features", ("samples",), "SELECT session_key, driver_number, epoch_us(date) AS date, round(Throttle - lag(Throttle) OVER w, 6) AS throttle_delta, round(avg(Speed) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS rolling_mean_speed, round((Speed - lag(Speed) OVER w) / nullif(epoch_us(date) / 1e6 - lag(epoch_us(date) / 1e6) OVER w, 0), 6) AS acceleration FROM samples WINDOW w AS (PARTITION BY session_key, driver_number ORDER BY date)")
def _w20(t: Tables) -> DataFrame:
    return resample.motion_features(t.samples, K, "date").select(*K, "date", "throttle_delta", "rolling_mean_speed", "acceleration")


@query("to_numbers", ("intervals",), "SELECT session_key, driver_number, epoch_us(date) AS date, CASE WHEN trim(gap_to_leader) IN ('nan', '', '+1 LAP') THEN NULL ELSE CAST(trim(gap_to_leader) AS DOUBLE) END AS gap, CAST(coalesce(gap_to_leader = '301', false) AS INT) AS far FROM intervals")
def _f1(t: Tables) -> DataFrame:
    return t.intervals.select(*K, "date", coerce.to_number(F.col("gap_to_leader")).alias("gap"), coerce.flag(F.col("gap_to_leader") == "301").alias("far"))
