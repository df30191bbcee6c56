"""Lap features and the two analysis tables: one row per driver and lap, one per driver and session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlap.functions import coerce
from gridlap.operators import aggregates, joins, order, rows, store
from gridlap.operators.rolling import KEYS, lagged, rolling_features

LAP = (*KEYS, "lap_number")
#: Laps after which a compound usually gives way (fixed values).
CLIFF_DEFAULTS = {"SOFT": 22, "MEDIUM": 33, "HARD": 45, "INTERMEDIATE": 20, "WET": 15, "UNKNOWN": 30}
WEATHER = ("air_temperature", "track_temperature", "humidity", "rainfall", "wind_speed")
SESSION_META = ("year", "session_type", "circuit_key", "circuit_short_name", "country_name", "date_start", "date_end")


def tyre_laps(laps: DataFrame, stints: DataFrame) -> DataFrame:
    """Laps with the stints that cover them (see joins.range_join) and the raw tyre age."""
    taken = ("stint_number", "compound", "lap_start", "lap_end", "tyre_age_at_start")
    joined = joins.range_join(laps, stints.select(*KEYS, *taken), KEYS, "lap_number", "lap_start", "lap_end")
    return joined.withColumn("tyre_age", F.col("lap_number") - F.col("lap_start") + F.coalesce("tyre_age_at_start", F.lit(0)))


def pace_by_age(tyre: DataFrame, width: int = 2, top: int = 60) -> DataFrame:
    """compound, bin, median_lap, change: median lap by tyre age, and its change from the previous bin that has laps."""
    binned = tyre.withColumn("bin", coerce.right_closed_bin(F.col("tyre_age"), width, top)).where("bin is not null and compound is not null")
    medians = order.exact_quantiles_by(binned, ["compound", "bin"], ["lap_duration"], [0.5]).select("compound", "bin", F.col("lap_duration")[0].alias("median_lap")).where("median_lap is not null")
    return medians.withColumn("change", F.col("median_lap") / F.lag("median_lap").over(Window.partitionBy("compound").orderBy("bin")) - 1)


def learn_cliffs(laps: DataFrame, stints: DataFrame, least_laps: int = 50, least_bins: int = 5, rise: float = 0.01, tyre: DataFrame | None = None) -> DataFrame:
    """compound, cliff: the first age bin whose pace rises by more than 1 %, blended 60:40 with the default, at least 5.

    Compounds with too few laps or bins, or without such a rise, keep the default; 0.6 and 0.4 are taken as written.
    tyre: what tyre_laps gives, where it is there already.
    """
    tyre = (tyre_laps(laps, stints) if tyre is None else tyre).where("lap_duration is not null and compound is not null")
    enough = tyre.groupBy("compound").agg(F.count("*").alias("n")).where(F.col("n") >= least_laps).select("compound")
    pace = pace_by_age(tyre)
    found = pace.groupBy("compound").agg(F.count("*").alias("bins"), F.min(F.when(F.col("change") > rise, F.col("bin"))).alias("learned")).where(F.col("bins") >= least_bins).join(enough, "compound")
    defaults = laps.sparkSession.createDataFrame(list(CLIFF_DEFAULTS.items()), "compound string, domain long")
    both = defaults.join(found.select("compound", "learned"), "compound", "left")
    blend = F.greatest(F.lit(5), (0.6 * F.col("learned") + 0.4 * F.col("domain")).cast("long"))
    return both.select("compound", F.when(F.col("learned").isNotNull(), blend).otherwise(F.col("domain")).cast("long").alias("cliff"))


def stint_features(laps: DataFrame, stints: DataFrame, cliffs: DataFrame, tyre: DataFrame | None = None) -> DataFrame:
    """Each lap's first known value of every column of its covering stints, its tyre age, and the laps until the compound's cliff.

    cliffs has a row a compound, a handful at most. tyre: what tyre_laps gives, where it is there already.
    """
    covered = (tyre_laps(laps, stints) if tyre is None else tyre).drop("tyre_age")
    whole = Window.partitionBy(*LAP).orderBy("stint_number").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = ("compound", "lap_start", "lap_end", "tyre_age_at_start")
    tyre = rows.first_per_key(covered.withColumns({c: F.first(c, ignorenulls=True).over(whole) for c in own}), LAP, ["stint_number"])
    age = F.col("lap_number") - F.col("lap_start") + F.coalesce("tyre_age_at_start", F.lit(0))
    named = F.upper(F.coalesce("compound", F.lit("UNKNOWN")))
    out = tyre.withColumns({"current_tyre_age": coerce.clip(age, low=0), "_named": named})
    out = out.join(F.broadcast(cliffs.select(F.col("compound").alias("_named"), F.col("cliff").alias("_cliff"))), "_named", "left")
    out = out.withColumn("compound_cliff", F.coalesce("_cliff", F.lit(CLIFF_DEFAULTS["UNKNOWN"])))
    out = out.withColumn("laps_until_cliff", coerce.clip(F.col("compound_cliff") - F.col("current_tyre_age"), low=0))
    return out.withColumn("is_past_cliff", coerce.flag(F.col("current_tyre_age") > F.col("compound_cliff"))).drop("_cliff", "_named", "lap_start", "lap_end", "tyre_age_at_start")


def weather_features(laps: DataFrame, weather: DataFrame, group_rows: int | None = joins.GROUP_ROWS) -> DataFrame:
    """The weather nearest to a lap's start, and the track's change since the session's first reading."""
    found = rows.present(weather, WEATHER)
    base = weather.groupBy("session_key").agg(F.min_by("track_temperature", "date").alias("_base"))
    near = joins.as_of(laps, weather, ["session_key"], "date_start", "date", found, "nearest", tie=found, group_rows=group_rows)
    return near.join(base, "session_key", "left").withColumn("track_temp_evolution", F.round(F.col("track_temperature") - F.col("_base"), 2)).drop("_base")


def position_features(laps: DataFrame, position: DataFrame, group_rows: int | None = joins.GROUP_ROWS) -> DataFrame:
    """The last known position at a lap's start, its flags, and the places won since the lap before."""
    known = position.select(*KEYS, "date", F.col("position").alias("current_position"))
    out = joins.as_of(laps, known, KEYS, "date_start", "date", ["current_position"], "backward", tie=["current_position"], group_rows=group_rows)
    p = F.col("current_position")
    w = Window.partitionBy(*KEYS).orderBy("date_start", "lap_number")
    return out.withColumns({"is_leading": coerce.flag(p == 1), "is_top3": coerce.flag(p <= 3), "is_top10": coerce.flag(p <= 10), "position_gain_lap": F.lag(p).over(w) - p})


def targets(df: DataFrame, results: DataFrame) -> DataFrame:
    final = rows.first_come(results, KEYS).select(*KEYS, F.col("position").alias("final_position"), *rows.present(results, ["status"]))
    p = F.col("final_position")
    return df.join(final, list(KEYS), "left").withColumns({"target_win": coerce.flag(p == 1), "target_podium": coerce.flag(p.between(1, 3)), "target_top10": coerce.flag(p.between(1, 10))})


EXEMPT = ("session_key", "driver_number", "lap_number", "circuit_key", "year", "stint_number", "compound_cliff")
EXEMPT_PREFIXES = ("target_", "is_", "rolling_", "laps_")


def winsorize(df: DataFrame, low: float = 0.01, high: float = 0.99, exempt: Sequence[str] = EXEMPT, approximate: bool = False) -> DataFrame:
    """Numeric columns within their quantiles.

    df is written once to the shared folder, as its quantiles are found in passes over it (see order.exact_quantiles).
    approximate takes one pass, with a rank error of 1 in 10,000.
    """
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    names = [c for c, t in df.dtypes if (t in numeric or t.startswith("decimal")) and c not in exempt and not c.startswith(EXEMPT_PREFIXES)]
    if not names:
        return df
    df = store.cut(df)
    if approximate:
        row = df.agg(*(F.percentile_approx(F.col(c).cast("double"), [low, high], order.ACCURACY).alias(c) for c in names)).first()
        bounds = {c: row[c] for c in names}
    else:
        bounds = order.exact_quantiles(df, names, (low, high))
    double = {c: F.col(c).cast("double") for c in names}
    return df.withColumns({c: coerce.clip(double[c], *bounds[c]) if bounds[c] and bounds[c][0] is not None else double[c] for c in names})


def lap_master(laps: DataFrame, sessions: DataFrame, drivers: DataFrame, stints: DataFrame, weather: DataFrame, position: DataFrame, results: DataFrame, car_data: DataFrame | None = None) -> DataFrame:
    """The lap table: look-ups, stints, rolling, weather, position, targets, lagged telemetry, winsorized, one row a lap."""
    df = joins.look_up(laps, sessions.select("session_key", *rows.present(sessions, SESSION_META)), ["session_key"])
    df = joins.look_up(df, drivers.select(*KEYS, *rows.present(drivers, ("full_name", "name_acronym", "team_name"))), KEYS)
    tyre = store.cut(tyre_laps(df, stints))  # learned from, and built on
    df = stint_features(df, stints, learn_cliffs(laps, stints, tyre=tyre), tyre)
    df = position_features(weather_features(rolling_features(df), weather), position)
    df = targets(df, results)
    if car_data is not None:
        df = df.join(lagged_telemetry(car_data), list(LAP), "left")
    return winsorize(df)  # stint_features left one row a lap, and no join since has more than one row a key


def lagged_telemetry(car_data: DataFrame) -> DataFrame:
    tele = aggregates.telemetry_by_lap(car_data)
    return lagged(tele, [c for c in tele.columns if c not in LAP])


def base_table(drivers: DataFrame, sessions: DataFrame, grid: DataFrame, results: DataFrame, weather: DataFrame, laps: DataFrame, stints: DataFrame) -> DataFrame:
    """The driver-session table: drivers with session, grid, result and the weather, lap and stint summaries."""
    df = joins.look_up(drivers, sessions, ["session_key"])
    df = df.join(rows.first_come(grid, KEYS).select(*KEYS, F.col("position").alias("grid_position")), list(KEYS), "left")
    df = targets(df, results)
    df = df.join(aggregates.weather_by_session(weather), "session_key", "left")
    df = df.join(aggregates.laps_by_driver(laps), list(KEYS), "left").join(aggregates.stints_by_driver(stints), list(KEYS), "left")
    return rows.first_per_key(df, KEYS, sorted(drivers.columns))
