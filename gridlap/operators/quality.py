"""Data-quality checks as issue rows: file, severity, check, message."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlap.operators import joins, order, rows, store

SCHEMA = "file string, severity string, check string, message string"
# Fixed values of the data: required columns and keys of the tables, and ranges, that a validation looks at.
REQUIRED = {"sessions": ["session_key"], "drivers": ["session_key", "driver_number"], "laps": ["session_key", "driver_number", "lap_number"], "weather": ["session_key"], "stints": ["session_key", "driver_number"], "position": ["session_key", "driver_number"], "session_results": ["session_key", "driver_number"], "starting_grid": ["session_key", "driver_number"]}
KEYS = REQUIRED | {"stints": ["session_key", "driver_number", "stint_number"], "position": ["session_key", "driver_number", "date"]}
RANGES = [("laps", "lap_duration", 30, 600), ("position", "position", 1, 25), ("session_results", "position", 1, 25), ("starting_grid", "position", 1, 25)]


def _issue(df: DataFrame, file: str, severity: Column | str, check: str, message: Column, condition: Column) -> DataFrame:
    severity = F.lit(severity) if isinstance(severity, str) else severity
    return df.where(condition).select(F.lit(file).alias("file"), severity.alias("severity"), F.lit(check).alias("check"), message.alias("message"))


def required_columns(spark: SparkSession, df: DataFrame, file: str, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    return spark.createDataFrame([(file, "error", "required_columns", f"Missing required columns: {missing}")] if missing else [], SCHEMA)


def duplicate_count(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """n: rows beyond the first of their key; null keys are keys. Counted by key, so no key's rows meet in one place."""
    return df.groupBy(*key).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n"))


def duplicate_key(df: DataFrame, file: str, key: Sequence[str]) -> DataFrame | None:
    if set(key) - set(df.columns):
        return None
    return _issue(duplicate_count(df, key), file, "warning", "duplicate_key", F.format_string(f"Found %d duplicate rows for key={list(key)}", "n"), F.col("n") > 0)


def table_counts(df: DataFrame, ranges: Sequence[tuple[str, float, float]] = ()) -> DataFrame:
    """column, span, n, row_count: one pass gives each column's nulls (no span) and its values out of a span; a null column has the row count alone."""
    looks = [(c, None, F.col(f"`{c}`").isNull()) for c in df.columns] + [(c, f"[{a}, {b}]", ~F.col(c).between(a, b)) for c, a, b in ranges if c in df.columns]
    row = df.agg(F.count("*").alias("all"), *(F.count_if(bad).alias(f"n{i}") for i, (_, _, bad) in enumerate(looks)))
    cell = lambda c, span, n: F.struct(F.lit(c).cast("string").alias("column"), F.lit(span).cast("string").alias("span"), n.alias("n"), F.col("all").alias("row_count"))
    cells = [cell(c, span, F.col(f"n{i}")) for i, (c, span, _) in enumerate(looks)]
    return row.select(F.inline(F.array(*cells, cell(None, None, F.lit(0).cast("long")))))


def null_shares(df: DataFrame) -> DataFrame:
    """column, nulls, row_count, share: one pass over all columns."""
    share = F.when(F.col("row_count") > 0, F.col("n") / F.col("row_count")).otherwise(0.0)
    return table_counts(df).where("column is not null").select("column", F.col("n").alias("nulls"), "row_count", share.alias("share"))


def most_missing(df: DataFrame, n: int = 20) -> DataFrame:
    """column, pct, status: the n columns with the greatest shares of nulls."""
    top = null_shares(df).select("column", (100 * F.col("share")).alias("pct")).orderBy(F.desc("pct"), "column").limit(n)
    return top.withColumn("status", F.when(F.col("pct") > 20, "drop").when(F.col("pct") > 5, "watch").otherwise("ok"))


def counted_issues(df: DataFrame, file: str, ranges: Sequence[tuple[str, float, float]] = ()) -> DataFrame:
    """No rows at all, nulls and values out of range, from one aggregate. A table without rows counts as missing."""
    nulls = F.col("column").isNotNull() & F.col("span").isNull() & (F.col("n") > 0)
    empty = F.col("column").isNull() & (F.col("row_count") == 0)
    beyond = F.col("span").isNotNull() & (F.col("n") > 0)
    share = F.col("n") / F.nullif(F.col("row_count"), F.lit(0))
    message = F.when(empty, "File missing").when(nulls, F.format_string("Column %s has %d nulls (%.1f%%)", "column", "n", 100 * share)).otherwise(F.format_string("Column %s has %d values outside %s", "column", "n", "span"))
    check = F.when(empty, "file_exists").when(nulls, "missing_values").otherwise("range")
    return table_counts(df, ranges).where(empty | nulls | beyond).select(F.lit(file).alias("file"), F.when(nulls & (share > 0.5), "error").otherwise("warning").alias("severity"), check.alias("check"), message.alias("message"))


def orphan_sessions(df: DataFrame, sessions: DataFrame, file: str) -> DataFrame:
    n = joins.orphans(df.where("session_key is not null"), sessions, ["session_key"]).agg(F.count_distinct("session_key").alias("n"))
    return _issue(n, file, "error", "consistency", F.format_string("Found data for %d session(s) not present in sessions", "n"), F.col("n") > 0)


def validate(tables: dict[str, DataFrame], keys: dict[str, list[str]] = KEYS, expected: Sequence[str] = ()) -> DataFrame:
    """All issues of the tables, as one lazy union: one pass a table, and one more for its key and its sessions. Tables that
    are expected and aren't among them are missing files."""
    spark = next(iter(tables.values())).sparkSession
    found: list[DataFrame | None] = [spark.createDataFrame([(name, "warning", "file_exists", "File missing") for name in expected if name not in tables], SCHEMA)]
    for name, df in tables.items():
        found.append(counted_issues(df, name, [(c, a, b) for t, c, a, b in RANGES if t == name]))
        if name in keys:
            found += [required_columns(df.sparkSession, df, name, REQUIRED.get(name, keys[name])), duplicate_key(df, name, keys[name])]
        if name in ("drivers", "laps", "weather") and "sessions" in tables:
            found.append(orphan_sessions(df, tables["sessions"], name))
    return reduce(DataFrame.unionByName, [f for f in found if f is not None])


def by_severity(issues: DataFrame) -> DataFrame:
    return issues.groupBy("severity").agg(F.count("*").alias("n"))


def table_summary(df: DataFrame, name: str, drop_above: float = 0.2) -> DataFrame:
    """One row: rows, columns, columns with any null, candidates for dropping, overall null share."""
    s = null_shares(df)
    return s.agg(F.max("row_count").alias("row_count"), F.count("*").alias("col_count"), F.count_if(F.col("nulls") > 0).alias("cols_any_null"), F.count_if(F.col("share") > drop_above).alias("drop_candidates"), (100 * F.avg("share")).alias("null_pct")).select(F.lit(name).alias("file"), "*")


def parse_shares(df: DataFrame, file: Column, column: str, kind: str) -> DataFrame:
    """For each file: the shares of values that are present, and that read as the type."""
    return df.groupBy(file.alias("file")).agg(F.avg(F.col(column).isNotNull().cast("int")).alias("present"), F.avg(F.col(column).try_cast(kind).isNotNull().cast("int")).alias("parsed"))


def schema_alignment(files: dict[str, DataFrame]) -> DataFrame:
    """file, row_count, column, issue, expected, got: what differs from the first file that has rows: extra and missing columns, and types."""
    first, out = None, []
    for name, df in files.items():
        own = dict(df.dtypes)
        counted = df.agg(F.count("*").alias("row_count")).where("row_count > 0")
        if first is None:
            if df.isEmpty():
                continue
            first = own
            continue
        found = [(c, "extra", None, own[c]) for c in own if c not in first] + [(c, "missing", first[c], None) for c in first if c not in own] + [(c, "type", first[c], own[c]) for c in own if first.get(c, own[c]) != own[c]]
        text = lambda x: F.lit(x).cast("string")
        if found:
            rows_ = F.array(*(F.struct(text(c).alias("column"), text(i).alias("issue"), text(a).alias("expected"), text(b).alias("got")) for c, i, a, b in found))
            out.append(counted.select(F.lit(name).alias("file"), "row_count", F.inline(rows_)))
    if out:
        return reduce(DataFrame.unionByName, out)
    return next(iter(files.values())).sparkSession.createDataFrame([], "file string, row_count long, column string, issue string, expected string, got string")


def duplicate_report(df: DataFrame, file: str, key: Sequence[str]) -> DataFrame:
    """file, row_count, full_row_dups, full_dup_pct, key_cols, key_dups: rows beyond the first of equal rows, and of equal keys (null without any key column).

    Rows are counted by row and these counts by key, so equal rows meet as one.
    """
    found = rows.present(df, key)
    per_row = df.groupBy(*(F.col(f"`{c}`") for c in df.columns)).agg(F.count("*").alias("n"))
    per_key = per_row.groupBy(*found).agg(F.sum("n").alias("n"), F.count("*").alias("kinds"))
    total = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.coalesce(F.sum("kinds"), F.lit(0)).alias("kinds"), F.count_if(F.col("n") > 0).alias("keys"))
    dups = F.col("row_count") - F.col("kinds")
    pct = F.when(F.col("row_count") > 0, F.round(100 * dups / F.col("row_count"), 2)).otherwise(0.0)
    return total.select(F.lit(file).alias("file"), "row_count", dups.alias("full_row_dups"), pct.alias("full_dup_pct"), F.lit(str(found)).alias("key_cols"), (F.col("row_count") - F.col("keys") if found else F.lit(None).cast("long")).alias("key_dups"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")]


def negatives(df: DataFrame) -> DataFrame:
    """column, n, pct, least of the numeric columns with negative values."""
    names = numeric_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, n long, pct double, least double")
    row = df.agg(F.count("*").alias("_rows"), *(F.struct(F.count_if(F.col(c) < 0).alias("n"), F.min(F.col(c).cast("double")).alias("least")).alias(c) for c in names))
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c)["n"].alias("n"), (100 * F.col(c)["n"] / F.col("_rows")).alias("pct"), F.col(c)["least"].alias("least")) for c in names))
    return row.select(F.inline(cells)).where("n > 0")


def blanks(df: DataFrame) -> DataFrame:
    names = [c for c, t in df.dtypes if t == "string"]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, n long")
    row = df.agg(*(F.count_if(F.trim(c) == "").alias(c) for c in names))
    return row.unpivot([], names, "column", "n").where("n > 0")


def _value_counts(df: DataFrame) -> DataFrame:
    """column, value (as text), n: how often each column has each value; null is one."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in df.columns]
    if not cells:
        return df.sparkSession.createDataFrame([], "column string, value string, n long")
    return df.select(F.inline(F.array(*cells))).groupBy("column", "value").agg(F.count("*").alias("n"))


def frequent_values(df: DataFrame, share: float) -> DataFrame:
    """column, value (as text), n, row_count: the values, null among them, that fill at least the share of a column.

    A sketch of frequent items a column, of bounded size and merged over all tasks in one pass, names every value that may fill it
    (1 / share of them at most); these are then counted exactly. No value but these leaves its task.
    """
    text = df.select(*(F.col(f"`{c}`").cast("string").alias(f"_{i}") for i, c in enumerate(df.columns)))
    schema = "column string, value string, n long, row_count long"
    if not df.columns:
        return df.sparkSession.createDataFrame([], schema)
    named = text.freqItems(text.columns, support=max(1e-4, min(1.0, share * 0.5))).first()
    looks = [(c, v, F.col(f"_{i}").eqNullSafe(F.lit(v).cast("string"))) for i, c in enumerate(df.columns) for v in sorted(set(named[i]), key=lambda v: (v is not None, v))]
    if not looks:
        return df.sparkSession.createDataFrame([], schema)
    row = text.agg(F.count(F.lit(1)).alias("all"), *(F.count_if(same).alias(f"n{k}") for k, (_, _, same) in enumerate(looks)))
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.lit(v).cast("string").alias("value"), F.col(f"n{k}").alias("n"), F.col("all").alias("row_count")) for k, (c, v, _) in enumerate(looks)))
    return row.select(F.inline(cells)).where((F.col("n") > 0) & (F.col("n") >= share * F.col("row_count")))


def dominant_values(df: DataFrame, share: float = 0.99) -> DataFrame:
    """column, value, share of columns of which one value (null counts) fills at least the share; of two that fill as much the greater one."""
    top = frequent_values(df, share).groupBy("column").agg(F.max_by("value", F.struct("n", F.coalesce("value", F.lit("")))).alias("value"), F.max("n").alias("most"), F.max("row_count").alias("all_rows"))
    return top.select("column", "value", (F.col("most") / F.col("all_rows")).alias("share"))


def unique_profile(df: DataFrame, sample: int = 5) -> DataFrame:
    """column, dtype, n_unique, nulls, null_pct, likely_type, and samples: a few least values as text."""
    per_value = _value_counts(df)
    ranked = rows.first_n_per_group(per_value.where("value is not null"), ["column"], ["value"], sample).groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("samples"))
    counts = per_value.groupBy("column").agg(F.count("value").alias("n_unique"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"), F.sum("n").alias("row_count"))
    types = df.sparkSession.createDataFrame(df.dtypes, "column string, dtype string")
    kind = F.when(F.col("n_unique") == F.col("row_count"), "ID/Key").when(F.col("n_unique") < 30, "Categorical").when(F.col("dtype") == "string", "High-card text").otherwise("Numeric")
    return counts.join(types, "column").join(ranked, "column", "left").select("column", "dtype", "n_unique", "nulls", F.round(100 * F.col("nulls") / F.col("row_count"), 2).alias("null_pct"), kind.alias("likely_type"), F.array_join("samples", ",").alias("samples"))


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column, n, n_unique, top, freq, mean, std, least, q1, q2, q3, most: moments of numeric columns in one
    pass and their exact quartiles in a few; distinct values, the most frequent one (the least of several) and how often it comes, of the others, counted by value."""
    columns = list(columns or df.columns)
    numeric = [c for c in columns if c in numeric_columns(df)]
    words = [c for c in columns if c not in numeric]
    names = ("mean", "std", "least", "q1", "q2", "q3", "most")
    out = []
    if numeric:
        x = lambda c: F.col(c).cast("double")
        df = store.cut(df.select(*(f"`{c}`" for c in columns)))  # the quartiles take passes over it
        quartiles = order.exact_quantiles(df, numeric, (0.25, 0.5, 0.75))
        fs = lambda c: F.struct(F.count(c).alias("n"), F.avg(c).cast("double").alias("mean"), F.stddev_samp(x(c)).alias("std"), F.min(x(c)).alias("least"), *(F.lit(v).cast("double").alias(k) for k, v in zip(names[3:6], quartiles[c], strict=True)), F.max(x(c)).alias("most"))
        row = df.agg(*(fs(c).alias(c) for c in numeric))
        cells = F.array(*(F.struct(F.lit(c).alias("column"), *(F.col(c)[k].alias(k) for k in ("n", *names))) for c in numeric))
        out.append(row.select(F.inline(cells)).withColumns({"n_unique": F.lit(None).cast("long"), "top": F.lit(None).cast("string"), "freq": F.lit(None).cast("long")}))
    if words:
        known = _value_counts(df.select(*words)).where("value is not null")
        some = known.groupBy("column").agg(F.sum("n").alias("n"), F.count("*").alias("n_unique"), F.max("n").alias("freq"))
        top = known.join(some.select("column", F.col("freq").alias("n")), ["column", "n"]).groupBy("column").agg(F.min("value").alias("top"))
        every = df.sparkSession.createDataFrame([(c,) for c in words], "column string")
        out.append(every.join(some.join(top, "column"), "column", "left").withColumns({"n": F.coalesce("n", F.lit(0)), "n_unique": F.coalesce("n_unique", F.lit(0)), **{k: F.lit(None).cast("double") for k in names}}))
    return reduce(DataFrame.unionByName, out).select("column", "n", "n_unique", "top", "freq", *names)


def time_columns(df: DataFrame, least: float = 0.8) -> DataFrame:
    """column, parsed: the text columns named like a time, and the share of their values that read as one."""
    named = [c for c, t in df.dtypes if t == "string" and any(w in c.lower() for w in ("date", "time", "start", "end", "created", "updated"))]
    if not named:
        return df.sparkSession.createDataFrame([], "column string, parsed double, convert boolean")
    row = df.agg(*(F.avg(F.when(F.col(c).isNotNull(), F.try_to_timestamp(c).isNotNull().cast("int"))).alias(c) for c in named))
    return row.unpivot([], named, "column", "parsed").withColumn("convert", F.coalesce(F.col("parsed") > least, F.lit(False)))


def recommendations(df: DataFrame) -> DataFrame:
    """column, action: drop or impute by null share, low variance, negative values; and full-row duplicates (column null)."""
    s = null_shares(df)
    out = s.where("nulls > 0").select("column", F.when(F.col("share") > 0.2, "drop").otherwise("impute").alias("action"))
    out = out.unionByName(dominant_values(df).select("column", F.lit("low variance").alias("action")))
    out = out.unionByName(negatives(df).select("column", F.lit("negative").alias("action")))
    return out.unionByName(duplicate_report(df, "", []).where("full_row_dups > 0").select(F.lit(None).cast("string").alias("column"), F.lit("duplicates").alias("action")))
