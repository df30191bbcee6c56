"""Row clean-up: filters, de-duplication, projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The names that df has: a missing column means that a step is skipped."""
    return [n for n in names if n in df.columns]


#: Where a table has this column, it says in which order rows came.
INGEST_ORDER = "_ingest_order"
#: Columns that the readers add; they are no values of a row.
META = ("_source_endpoint", "_source_file", INGEST_ORDER)


def drop_empty_rows(df: DataFrame) -> DataFrame:
    values = [c for c in df.columns if c not in META]
    return df.dropna("all", subset=values) if values else df


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    found = present(df, keys)
    return df.dropna(subset=found) if found else df


def drop_empty_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Without those of the columns that have no value at all; one pass over the named columns. An empty table keeps them."""
    found = present(df, names)
    if not found:
        return df
    counts = df.agg(F.count("*").alias("_rows"), *(F.count(c).alias(c) for c in found)).first()
    return df.drop(*(c for c in found if counts[c] == 0)) if counts["_rows"] else df


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row a key, the first by order; null keys are a key of their own."""
    found = present(df, keys)
    w = Window.partitionBy(*found).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def first_come(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a key: the first that came, or without a known order (the readers of sources.endpoints make one) the first by
    all columns that have an order, so that it is always the same one."""
    return first_per_key(df, keys, present(df, [INGEST_ORDER]) or _ordered(df)).drop(*META)


def _ordered(df: DataFrame) -> list[Column]:
    """All columns by name, maps as their sorted entries."""
    entries = lambda c: F.array_sort(F.map_entries(F.col(f"`{c}`")))
    return [entries(f.name) if f.dataType.typeName() == "map" else F.col(f"`{f.name}`") for f in sorted(df.schema, key=lambda f: f.name)]


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.lower() for c in df.columns))


def rows_at_maximum(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows whose value is the greatest, of all or within each group; an aggregate is joined back, no row is ordered."""
    best = df.groupBy(*by).agg(F.max(value).alias("_best"))
    joined = df.join(best, list(by)) if by else df.crossJoin(F.broadcast(best))
    return joined.where(F.col(value) == F.col("_best")).drop("_best")


def stable_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """At most n rows, those with the smallest hashes of their keys: the same rows however df is partitioned."""
    return df.orderBy(F.xxhash64(F.lit(seed), *keys), *keys).limit(n)


def first_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def most_frequent(df: DataFrame, by: Sequence[str], n: int = 1) -> DataFrame:
    """The n groups with most rows, and their row count; equal counts in order of the key."""
    return df.groupBy(*by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *by).limit(n)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows; columns that a frame lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
