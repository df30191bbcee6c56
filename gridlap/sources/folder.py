"""From a folder of raw files to the analysis tables, in one call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from gridlap.operators import cleaning, features
from gridlap.sources import endpoints

# Fixed values of the data: the columns of each endpoint's files, in the order of the files.
SCHEMAS = {
    "sessions": "session_key long, session_type string, session_name string, date_start timestamp, date_end timestamp, meeting_key long, circuit_key long, circuit_short_name string, country_key long, country_code string, country_name string, location string, gmt_offset string, year long, is_cancelled boolean",
    "drivers": "driver_number long, session_key long, meeting_key long, full_name string, name_acronym string, team_name string, team_colour string, country_code string, headshot_url string",
    "session_results": "session_key long, driver_number long, date timestamp, position long, meeting_key long, status string",
    "laps": "session_key long, meeting_key long, driver_number long, lap_number long, lap_duration double, duration_sector_1 double, duration_sector_2 double, duration_sector_3 double, i1_speed double, i2_speed double, st_speed double, segments_sector_1 string, segments_sector_2 string, segments_sector_3 string, is_pit_out_lap string, date_start timestamp",
    "weather": "date timestamp, session_key long, meeting_key long, air_temperature double, track_temperature double, humidity double, pressure double, rainfall double, wind_direction double, wind_speed double",
    "stints": "session_key long, meeting_key long, driver_number long, stint_number long, compound string, lap_start long, lap_end long, tyre_age_at_start long",
    "starting_grid": "position long, driver_number long, lap_duration double, meeting_key long, session_key long",
    "intervals": "date timestamp, session_key long, meeting_key long, driver_number long, gap_to_leader string, interval string",
    "position": "date timestamp, session_key long, meeting_key long, driver_number long, position long",
    "car_data": "Date string, Time string, Speed double, RPM double, Throttle double, Brake double, DRS double, nGear double, X double, Y double, Z double, driver_number long, session_key long, lap_number long, compound string",
    "location": "Date string, X double, Y double, Z double, driver_number long, session_key long, lap_number long, compound string",
}


def schema(endpoint: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[endpoint])


def read_all(spark: SparkSession, root: str) -> dict[str, endpoints.Endpoint]:
    """Every endpoint below root: <endpoint>/**/*.{csv,parquet}, and a flat file <endpoint>.{csv,parquet} beside the folders."""
    return {name: endpoints.scan(spark, root, name, schema(name), legacy=[f"{root}/{name}.csv", f"{root}/{name}.parquet"]) for name in SCHEMAS}


def clean_folder(spark: SparkSession, root: str, path: str) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """Read and clean all endpoints below root and write them below path: the tables, the summary, and what couldn't be read.

    Endpoints without any file are left out, so that results and grid are derived from position where they are missing.
    """
    read = read_all(spark, root)
    there = {k: e.rows for k, e in read.items() if any(endpoints.list_files(spark, f"{root}/{k}", kind) for kind in ("csv", "parquet")) or any(endpoints.exists(spark, f"{root}/{k}.{kind}") for kind in ("csv", "parquet"))}
    problems = None
    for e in read.values():
        problems = e.problems if problems is None else problems.unionByName(e.problems)
    if not there:
        raise ValueError(f"no endpoint has files below {root}")
    tables, summary = cleaning.clean_to(there, path)
    return tables, summary, problems


def build_base(spark: SparkSession, root: str, path: str) -> DataFrame:
    """The driver-session table of a folder of raw files; cleaned tables go below path. Without drivers there is none."""
    tables, _, _ = clean_folder(spark, root, path)
    if "drivers" not in tables:
        raise ValueError("the base table needs drivers")
    found = lambda name: tables[name] if name in tables else spark.createDataFrame([], schema(name))
    return features.base_table(*(found(n) for n in ("drivers", "sessions", "starting_grid", "session_results", "weather", "laps", "stints")))
