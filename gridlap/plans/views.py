"""Timing tables as views of the test tables; the same text runs on Spark and in the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "laps": (("events",), """SELECT user_id % 10 AS session_key, user_id AS driver_number,
        CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS lap_number,
        ts AS date_start, CASE WHEN event_id % 37 = 0 THEN NULL ELSE value END AS lap_duration,
        CASE WHEN event_id % 11 = 0 THEN NULL ELSE value * 2 END AS i1_speed, event_type = 'signup' AS is_pit_out_lap
        FROM {events} WHERE event_type IN ('purchase', 'signup', 'error')"""),
    "stints": (("laps",), """SELECT session_key, driver_number, stint_number, min(lap_number) AS lap_start,
        max(lap_number) - CASE WHEN driver_number % 9 = 0 THEN 2 ELSE 0 END AS lap_end,
        CASE (driver_number + stint_number) % 4 WHEN 0 THEN 'SOFT' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'HARD' ELSE 'WET' END AS compound,
        CASE WHEN driver_number % 6 = 0 THEN NULL ELSE (driver_number + stint_number) % 4 END AS tyre_age_at_start
        FROM (SELECT *, CAST(floor((lap_number - 1) / 12.0) AS BIGINT) + 1 AS stint_number FROM {laps}) x
        WHERE driver_number % 13 <> 0 GROUP BY session_key, driver_number, stint_number"""),
    "weather": (("events",), """SELECT user_id % 10 AS session_key, ts AS date, 15 + value % 20 AS air_temperature, 20 + value % 40 AS track_temperature,
        value % 100 AS humidity, 950 + value % 100 AS pressure, value % 50 AS wind_speed, CAST(CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS rainfall
        FROM {events} WHERE event_type = 'view' AND user_id % 10 <> 9"""),
    "position": (("events",), """SELECT user_id % 10 AS session_key, user_id AS driver_number, ts AS date, 1 + event_id % 20 AS position
        FROM {events} WHERE event_type = 'click' AND user_id % 14 <> 0"""),
    "drivers": (("events",), """SELECT DISTINCT user_id % 10 AS session_key, user_id AS driver_number,
        concat('Driver ', CAST(user_id AS STRING)) AS full_name, concat('Team ', CAST(user_id % 5 AS STRING)) AS team_name FROM {events}"""),
    "sessions": (("events",), """SELECT DISTINCT user_id % 10 AS session_key, 2024 + user_id % 2 AS year,
        CASE WHEN user_id % 2 = 0 THEN 'Race' ELSE 'Qualifying' END AS session_type, 100 + user_id % 10 AS circuit_key FROM {events}"""),
    "results": (("events",), """SELECT session_key, driver_number, CAST(row_number() OVER (PARTITION BY session_key ORDER BY n DESC, driver_number) AS BIGINT) AS position
        FROM (SELECT user_id % 10 AS session_key, user_id AS driver_number, count(*) AS n FROM {events} WHERE user_id % 8 <> 0 GROUP BY 1, 2) x"""),
    "grid": (("events",), """SELECT session_key, driver_number, CAST(row_number() OVER (PARTITION BY session_key ORDER BY s, driver_number) AS BIGINT) AS position
        FROM (SELECT user_id % 10 AS session_key, user_id AS driver_number, min(event_id) AS s FROM {events} WHERE user_id % 7 <> 0 GROUP BY 1, 2) x"""),
    "intervals": (("events",), """SELECT user_id % 10 AS session_key, user_id AS driver_number, ts AS date,
        CASE event_id % 5 WHEN 0 THEN '+1 LAP' WHEN 1 THEN 'nan' WHEN 2 THEN '' WHEN 3 THEN ' 12.5 ' ELSE '301' END AS gap_to_leader FROM {events}"""),
    "car_data": (("lineitem",), """SELECT l_orderkey % 10 AS session_key, l_suppkey AS driver_number, CAST(l_linenumber AS BIGINT) AS lap_number,
        CAST(l_quantity * 9 AS DOUBLE) AS Speed, CAST(l_discount * 1000 AS DOUBLE) AS Throttle, CAST(l_extendedprice / 5 AS DOUBLE) AS RPM,
        CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS Brake, CAST(l_quantity AS INT) % 8 + 1 AS nGear FROM {lineitem}"""),
    "signals": (("lineitem",), """SELECT CASE WHEN l_orderkey % 37 = 0 THEN NULL ELSE CAST(l_extendedprice AS DOUBLE) / 100 END AS lap_duration, CAST(l_quantity AS DOUBLE) * 5 + l_linenumber AS i1_speed,
        CAST(l_extendedprice AS DOUBLE) / CAST(l_quantity AS DOUBLE) AS i2_speed, CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE CAST(l_discount AS DOUBLE) * 1000 + CAST(l_tax AS DOUBLE) * 100 END AS st_speed,
        20 + CAST(l_quantity AS DOUBLE) / 3 + l_suppkey % 5 AS duration_sector_1, 25 + CAST(l_tax AS DOUBLE) * 90 + l_orderkey % 3 AS duration_sector_2, 30 + CAST(l_extendedprice AS DOUBLE) / 4000 + l_partkey % 7 AS duration_sector_3
        FROM {lineitem}"""),
    "overlapping": (("stints",), """SELECT session_key, driver_number, stint_number * 2 AS stint_number, lap_start, lap_end,
        CASE WHEN stint_number % 3 = 0 THEN NULL ELSE compound END AS compound, tyre_age_at_start FROM {stints}
        UNION ALL SELECT session_key, driver_number, stint_number * 2 + 1, lap_start + 4, lap_end + 4, 'HARD',
        CASE WHEN stint_number % 2 = 0 THEN 3 END FROM {stints} WHERE driver_number % 2 = 0"""),
    "raw_laps": (("events",), """SELECT CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST(user_id % 10 AS STRING) END AS session_key, concat(CAST(user_id AS STRING), '.0') AS driver_number,
        CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS STRING) AS lap_number,
        CASE event_id % 17 WHEN 0 THEN 'soon' WHEN 1 THEN '' ELSE CAST(ts AS STRING) END AS date_start,
        CASE WHEN event_id % 19 = 0 THEN 'abc' WHEN event_id % 29 = 0 THEN 'NaN' ELSE concat(' ', CAST(CAST(event_id % 700 AS BIGINT) AS STRING), '.25') END AS lap_duration,
        CASE event_id % 6 WHEN 0 THEN 'True' WHEN 1 THEN 'false' WHEN 2 THEN '1' WHEN 3 THEN '0' WHEN 4 THEN '1.0' END AS is_pit_out_lap,
        CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'a' END AS segments_sector_1
        FROM {events} UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM {events} WHERE event_id % 50 = 0"""),
    "raw_car": (("events",), """SELECT CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id END AS driver_number, event_id AS sample,
        CASE WHEN event_id % 7 = 0 THEN 'never' WHEN event_id % 2 = 0 THEN concat('0 days 00:0', CAST(event_id % 6 AS STRING), ':1', CAST(event_id % 10 AS STRING), '.5')
          ELSE concat('01:2', CAST(event_id % 6 AS STRING), ':3', CAST(event_id % 10 AS STRING)) END AS Time,
        concat(CAST(event_id % 500 AS STRING), '') AS Speed, CASE WHEN event_id % 11 = 0 THEN 'x' ELSE CAST(ts AS STRING) END AS Date FROM {events}"""),
    "samples": (("events",), """SELECT user_id % 10 AS session_key, user_id AS driver_number, ts AS date,
        value * 3 AS Speed, value AS Throttle, CASE WHEN event_id % 6 = 0 THEN NULL ELSE value * 20 END AS X FROM {events}"""),
}


def needed(names: tuple[str, ...]) -> list[str]:
    """The views that the names stand on, in an order in which they can be made."""
    out: list[str] = []
    for name in names:
        if name in VIEWS:
            out += [x for x in [*needed(VIEWS[name][0]), name] if x not in out]
    return out


def sql(names: tuple[str, ...], body: str) -> str:
    """body with the views before it."""
    views = [f"{n} AS ({VIEWS[n][1].format(**{t: t for t in VIEWS[n][0]})})" for n in needed(names)]
    head = f"WITH {', '.join(views)} " if views else ""
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"{head.rstrip()}, {body[5:]}" if head else body
    return head + body


class Tables:
    """The base tables and views of a folder, as DataFrames by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in VIEWS:
            raise AttributeError(name)
        inputs, text = VIEWS[name]
        return self.spark.sql(text, **{t: getattr(self, t) for t in inputs})
