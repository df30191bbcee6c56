"""The eleven table cleaners. Each is a function of a DataFrame; steps whose columns are missing are skipped."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridlap.functions import coerce
from gridlap.operators import order, rows, store
from gridlap.operators.rolling import KEYS, outlier_flag

# Fixed values of the data.
SESSION_TYPES = ("Race", "Sprint", "Qualifying", "Sprint Shootout", "Sprint Qualifying")
COMPOUNDS = ("SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET")
DEFAULT_HEADSHOT = "https://media.formula1.com/d_driver_fallback_image.png"
SPEEDS = ("i1_speed", "i2_speed", "st_speed")
SECTORS = ("duration_sector_1", "duration_sector_2", "duration_sector_3")
SEGMENTS = ("segments_sector_1", "segments_sector_2", "segments_sector_3")
# Fixed values of the data.
WEATHER_BOUNDS = {"air_temperature": (-30, 60), "track_temperature": (-10, 80), "humidity": (0, 100), "pressure": (800, 1100), "wind_speed": (0, 200), "wind_direction": (0, 360), "rainfall": (0, 1)}


def _each(df: DataFrame, names: Sequence[str], rule: Callable[[Column], Column]) -> DataFrame:
    """The rule on those columns that exist. A column that has the wanted type already isn't read as text again."""
    kinds = dict(df.dtypes)
    numeric = [c for c in rows.present(df, names) if kinds[c] in ("int", "bigint", "smallint", "tinyint", "float", "double") or kinds[c].startswith("decimal")]
    if rule in (coerce.to_number, coerce.to_integer) and numeric:
        kind = "double" if rule is coerce.to_number else "bigint"
        df = df.withColumns({c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).try_cast(kind)) for c in numeric})
        names = [c for c in names if c not in numeric]
    if rule is coerce.to_utc:
        timed = [c for c in rows.present(df, names) if kinds[c].startswith("timestamp")]
        df = df.withColumns({c: F.col(c).cast("timestamp") for c in timed})
        names = [c for c in names if c not in timed]
    return df.withColumns({c: rule(F.col(c)) for c in rows.present(df, names)})


def _keep(df: DataFrame, name: str, rule: Callable[[Column], Column]) -> DataFrame:
    return df.where(rule(F.col(name))) if name in df.columns else df


def clean_sessions(df: DataFrame) -> DataFrame:
    df = _keep(rows.drop_empty_rows(df), "session_type", lambda c: c.isin(*SESSION_TYPES))
    df = _each(_each(df, ("date_start", "date_end"), coerce.to_utc), ("year", "session_key", "circuit_key"), coerce.to_integer)
    df = rows.drop_empty_columns(df, ["circuit_short_name"])
    df = df.fillna("Unknown", rows.present(df, ("circuit_short_name", "location", "country_name", "gmt_offset")))
    return rows.first_come(df, ["session_key"])


def clean_drivers(df: DataFrame) -> DataFrame:
    df = _each(rows.drop_empty_rows(df), KEYS, coerce.to_integer)
    df = _each(df, ("full_name", "name_acronym", "team_name", "country_code"), coerce.clean_text)
    df = _each(df, ("headshot_url",), lambda c: F.when(c.isNull() | (c == ""), F.lit(DEFAULT_HEADSHOT)).otherwise(c))
    return rows.first_come(df, KEYS)


def clean_session_results(df: DataFrame) -> DataFrame:
    df = _each(rows.drop_empty_rows(df), (*KEYS, "position"), coerce.to_integer)
    df = _each(_keep(df, "position", lambda c: coerce.in_range_or_null(c, 1, 25)), ("status",), coerce.clean_text)
    return rows.first_come(rows.drop_null_keys(df, KEYS), KEYS)


def clean_starting_grid(df: DataFrame) -> DataFrame:
    df = _each(_each(rows.drop_empty_rows(df), (*KEYS, "position"), coerce.to_integer), ("lap_duration",), coerce.to_number)
    return rows.first_come(rows.drop_null_keys(_keep(df, "position", lambda c: coerce.in_range_or_null(c, 1, 25)), KEYS), KEYS)


def impute(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS, scope: Sequence[str] = ("session_key",)) -> DataFrame:
    """A null becomes its group's median, else the scope's, else stays. An empty scope means the whole table.

    df is written once to the shared folder; medians of groups and of the whole are found from there, however large a group is.
    """
    found = rows.present(df, columns)
    if not found:
        return df
    df = store.cut(df)
    for i, by in enumerate((list(keys), list(scope))):
        names = {c: f"_m{i}_{c}" for c in found}
        if by:
            medians = order.exact_quantiles_by(df, by, found, [0.5], written=True)
            df = df.join(medians.select(*by, *(F.col(c)[0].alias(m) for c, m in names.items())), by, "left")
        else:
            df = df.withColumns({names[c]: F.lit(m).cast("double") for c, (m,) in order.exact_quantiles(df, found, (0.5,)).items()})
    return df.withColumns({c: F.coalesce(c, f"_m0_{c}", f"_m1_{c}") for c in found}).drop(*(f"_m{i}_{c}" for i in (0, 1) for c in found))


def clean_laps(df: DataFrame, scope: Sequence[str] = ("session_key",)) -> DataFrame:
    """The outlier flag and the medians see every lap in range, those too that later steps drop."""
    df = _each(_each(rows.drop_empty_rows(df), (*KEYS, "lap_number"), coerce.to_integer), ("lap_duration", *SPEEDS, *SECTORS), coerce.to_number)
    if "lap_duration" in df.columns:
        df = df.where(F.col("lap_duration").between(30, 600))
        if not set(KEYS) - set(df.columns):
            df = df.withColumn("is_outlier_lap", outlier_flag("lap_duration"))
    df = _each(df, SPEEDS, lambda c: coerce.null_outside(c, 0, 400))
    df = impute(df, (*SPEEDS, *SECTORS), scope=scope)
    df = df.fillna("", rows.present(df, SEGMENTS))
    if "date_start" in df.columns:
        df = _each(df, ("date_start",), coerce.to_utc).where("date_start is not null")
    return rows.drop_null_keys(_each(df, ("is_pit_out_lap",), coerce.to_bool), (*KEYS, "lap_number"))


def clean_weather(df: DataFrame) -> DataFrame:
    df = _each(_each(rows.drop_empty_rows(df), ("session_key", *WEATHER_BOUNDS), coerce.to_number), ("date",), coerce.to_utc)
    df = _each(df, ("session_key",), lambda c: c.cast("long")).where("date is not null")
    for c, (low, high) in WEATHER_BOUNDS.items():
        df = _each(df, (c,), lambda x, low=low, high=high: coerce.null_outside(x, low, high))
    df = store.cut(df)  # the medians take passes over it
    medians = order.exact_quantiles(df, rows.present(df, tuple(WEATHER_BOUNDS)), (0.5,))
    df = df.withColumns({c: F.coalesce(c, F.lit(m).cast("double")) for c, (m,) in medians.items()})
    return rows.drop_null_keys(df, ("session_key",))


def clean_stints(df: DataFrame) -> DataFrame:
    df = _each(rows.drop_empty_rows(df), (*KEYS, "stint_number", "lap_start", "lap_end", "tyre_age_at_start"), coerce.to_integer)
    if {"lap_start", "lap_end"} <= set(df.columns):
        df = df.where("lap_end >= lap_start")
    df = _each(df, ("compound",), lambda c: coerce.one_of(c, COMPOUNDS))
    keys = (*KEYS, "stint_number")
    return rows.first_come(rows.drop_null_keys(df, keys), keys)


def clean_intervals(df: DataFrame) -> DataFrame:
    df = _each(_each(rows.drop_empty_rows(df), KEYS, coerce.to_integer), ("date",), coerce.to_utc).where("date is not null")
    for c in rows.present(df, ("gap_to_leader", "interval")):
        lapped = coerce.is_lapped(F.col(c))
        gap = coerce.null_outside(coerce.to_number(F.when(~lapped, F.col(c))), high=300)
        df = df.withColumns({f"{c}_lapped": lapped, c: gap})
    return rows.drop_null_keys(df, KEYS)


def clean_position(df: DataFrame) -> DataFrame:
    df = _each(_each(rows.drop_empty_rows(df), (*KEYS, "position"), coerce.to_integer), ("date",), coerce.to_utc).where("date is not null")
    return rows.drop_null_keys(_keep(df, "position", lambda c: coerce.in_range_or_null(c, 1, 25)), KEYS)


def clean_car_data(df: DataFrame) -> DataFrame:
    df = _each(rows.drop_empty_rows(df), ("Speed", "RPM", "Throttle", "Brake", "DRS", "nGear", "X", "Y", "Z"), coerce.to_number)
    df = _keep(df, "Speed", lambda c: coerce.in_range_or_null(c, 0, 400))
    df = _each(_each(df, ("RPM",), lambda c: coerce.null_outside(c, 0, 20000)), ("Throttle",), lambda c: coerce.null_outside(c, 0, 100))
    return rows.drop_null_keys(_each(_each(df, ("Time",), coerce.to_seconds), ("Date",), coerce.to_utc), ("driver_number",))


def clean_location(df: DataFrame) -> DataFrame:
    df = _each(rows.drop_empty_rows(df), ("X", "Y", "Z"), coerce.to_number)
    if "Date" in df.columns:
        df = _each(df, ("Date",), coerce.to_utc).where("Date is not null")
    return rows.drop_null_keys(df, ("driver_number",))


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "sessions": clean_sessions, "drivers": clean_drivers, "session_results": clean_session_results, "laps": clean_laps, "weather": clean_weather, "stints": clean_stints,
    "starting_grid": clean_starting_grid, "intervals": clean_intervals, "position": clean_position, "car_data": clean_car_data, "location": clean_location,
}
#: Other names under which a table's files may lie.
ALIASES = {"session_result": "session_results"}


def clean_all(tables: dict[str, DataFrame], derive: bool = True) -> dict[str, DataFrame]:
    """All cleaners, and results and grid derived from position where they are missing. Readers' columns go."""
    named = {ALIASES.get(k, k): v for k, v in tables.items()}
    out = {k: CLEANERS[k](v) for k, v in named.items() if k in CLEANERS}
    if derive and "position" in out:
        out.setdefault("session_results", derive_from_position(out["position"], last=True))
        out.setdefault("starting_grid", derive_from_position(out["position"], last=False))
    return {k: df.drop(*rows.META) for k, df in out.items()}


def derive_from_position(position: DataFrame, last: bool) -> DataFrame:
    """Each driver's last (or first) known value of every column by date; the columns may come from different rows."""
    pick = F.max_by if last else F.min_by
    values = [c for c in position.columns if c not in (*KEYS, *rows.META)]
    made = [pick(c, F.when(F.col(c).isNotNull(), F.struct("date", *rows.present(position, [rows.INGEST_ORDER])))).alias(c) for c in values]
    return position.groupBy(*KEYS).agg(*made)


def clean_to(tables: dict[str, DataFrame], path: str, derive: bool = True) -> tuple[dict[str, DataFrame], DataFrame]:
    """Clean all tables (see clean_all) and write them below path; the tables as written, and their summary.

    Rows are counted while they are written: a table is landed in the shared folder, from which its cleaner takes as many
    passes as it needs, so its source is read once. A table without a cleaner is landed and skipped.
    """
    came, landed = {}, {}
    for name, df in tables.items():
        came[name] = Observation(f"raw {name}")
        landed[name] = store.cut(df.observe(came[name], F.count(F.lit(1)).alias("n")))
    written, stays = {}, {}
    for name, df in clean_all(landed, derive).items():
        stays[name] = Observation(f"clean {name}")
        df.observe(stays[name], F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/{name}")
        written[name] = df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}")
    known = {ALIASES.get(k, k): k for k in tables}
    rows_ = []
    for name in [*known, *(k for k in written if k not in known)]:
        raw = came[known[name]].get["n"] if name in known else 0
        clean = stays[name].get["n"] if name in written else 0
        status = "skipped" if name not in written else "ok" if name in known else "derived"
        rows_.append((name, raw, clean, raw - clean if name in known else 0, status))
    spark = next(iter(tables.values())).sparkSession
    return written, spark.createDataFrame(rows_, "file string, raw_rows long, clean_rows long, dropped long, status string")


def cleaning_summary(raw: dict[str, DataFrame], clean: dict[str, DataFrame]) -> DataFrame:
    """file, raw_rows, clean_rows, dropped, status for each table: one count each, unioned."""
    frames = []
    for name, df in raw.items():
        counts = df.agg(F.count("*").alias("raw_rows"))
        done = clean[name].agg(F.count("*").alias("clean_rows")) if name in clean else counts.select(F.lit(None).cast("long").alias("clean_rows"))
        both = counts.crossJoin(done)
        frames.append(both.select(F.lit(name).alias("file"), "raw_rows", F.coalesce("clean_rows", F.lit(0)).alias("clean_rows"), (F.col("raw_rows") - F.coalesce("clean_rows", F.lit(0))).alias("dropped"), F.when(F.col("clean_rows").isNull(), "skipped").otherwise("ok").alias("status")))
    return rows.union_by_name(frames)
