"""Reading endpoint folders and writing tables."""

from __future__ import annotations

import re
import uuid
import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridlap.operators import rows
from gridlap.sources import endpoints


def read_endpoint(spark: SparkSession, root: str, endpoint: str, schema: StructType, kind: str | None = None, legacy: Sequence[str] = ()) -> DataFrame:
    """All rows of the files below root/endpoint, and of legacy files where they exist, by column name (see endpoints.scan, which also tells what couldn't be read)."""
    return endpoints.scan(spark, root, endpoint, schema, (kind,) if kind else ("csv", "parquet"), legacy).rows


def read_differing(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """CSV files of differing columns, unioned by name, one scan a distinct header; every value is text."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        groups.setdefault(endpoints.csv_header(spark, path), []).append(path)
    return rows.union_by_name([spark.read.schema(", ".join(f"`{n}` string" for n in names)).option("header", True).csv(own) for names, own in groups.items()])


def not_ingested(listed: DataFrame, manifest: DataFrame, keys: Sequence[str] = ("endpoint", "year", "session_key")) -> DataFrame:
    return listed.join(manifest.select(*keys).distinct(), list(keys), "left_anti")


def select_sessions(sessions: DataFrame, names: Sequence[str], per_year: int | None = None) -> DataFrame:
    """Sessions of the given names; the first few of each year."""
    chosen = sessions.where(F.col("session_name").isin(*names))
    return rows.first_n_per_group(chosen, ["year"], ["date_start", "session_key"], per_year) if per_year else chosen


def ingest_log(sessions: DataFrame) -> DataFrame:
    """year, sessions: how many came for each year, and a row with a null year for all."""
    per_year = sessions.where("year is not null").groupBy("year").agg(F.count("*").alias("sessions"))
    return per_year.unionByName(sessions.agg(F.count("*").alias("sessions")).select(F.lit(None).cast(sessions.schema["year"].dataType).alias("year"), "sessions"))


def write_table(df: DataFrame, path: str, kind: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").partitionBy(*partition_by) if partition_by else df.write.mode("overwrite")
    if kind == "parquet":
        writer.option("compression", "zstd").parquet(path)
    elif kind == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(kind).save(path)


def rewrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace those partitions of the table at path that df has rows of; the others stay. Writing the same rows again changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*by).parquet(path)


def write_sessions(df: DataFrame, path: str, kind: str = "csv") -> None:
    """A file for each year and session, <path>/<year>/<session_key>.<kind>, as raw files come; the file of a session that is there already is replaced."""
    spark, staged = df.sparkSession, f"{path}.staged-{uuid.uuid4().hex}"
    dealt = df.withColumns({"_year": F.col("year"), "_session": F.col("session_key")}).repartition("year", "session_key")
    write_table(dealt, staged, kind, ["_year", "_session"])
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for found in fs.globStatus(hadoop.Path(f"{staged}/_year=*/_session=*/part-*")):
        year, session = re.search(r"_year=([^/]+)/_session=([^/]+)/", found.getPath().toString()).groups()
        place = hadoop.Path(f"{path}/{year}/{session}.{kind}")
        fs.mkdirs(place.getParent())
        fs.delete(place, False)
        fs.rename(found.getPath(), place)
    fs.delete(hadoop.Path(staged), True)


def write_both(df: DataFrame, path: str) -> DataFrame:
    """As Parquet, and from that as CSV, so that the table is computed once; gives the table as written. If Parquet can't
    be written there is a warning, and CSV is written from df."""
    try:
        write_table(df, f"{path}.parquet")
    except Exception as failed:  # noqa: BLE001  whatever the store says
        warnings.warn(f"Parquet save failed: {failed}", stacklevel=2)
        write_table(df, f"{path}.csv", "csv")
        return df.sparkSession.read.schema(df.schema).option("header", True).csv(f"{path}.csv")
    written = df.sparkSession.read.parquet(f"{path}.parquet")
    write_table(written, f"{path}.csv", "csv")
    return written


def run_metadata(df: DataFrame, target: str = "target_win", cliffs: DataFrame | None = None) -> DataFrame:
    """One row: row and column count, the target's rate, and the cliffs used by compound, to be written as JSON."""
    out = df.agg(F.count("*").alias("row_count"), F.avg(target).alias("win_rate")).withColumns({"col_count": F.lit(len(df.columns)), "built_at": F.current_timestamp()})
    if cliffs is None:
        return out
    used = cliffs.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("compound", "cliff")))).alias("tyre_cliffs_used"))  # a handful of compounds
    return out.crossJoin(F.broadcast(used))
