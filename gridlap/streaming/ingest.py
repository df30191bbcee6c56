"""Raw files into one table, each session once, whatever is sent again or breaks off."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gridlap.operators import rows
from gridlap.sources import endpoints, files

_FILES = "path string, modificationTime timestamp, length long, content binary"
_PLACE = r"/([^/]+)/([^/]+)\.(csv|parquet)$"
KEY = ("endpoint", "year", "session_key")


def keyed(paths: DataFrame, endpoint: str) -> DataFrame:
    """endpoint, year, session_key, kind, path of files <year>/<session_key>.<kind>."""
    part = lambda i: F.regexp_extract("path", _PLACE, i)
    return paths.where(F.col("path").rlike(_PLACE)).select(F.lit(endpoint).alias("endpoint"), part(1).alias("year"), part(2).alias("session_key"), part(3).alias("kind"), "path")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The sessions that are in the table, and the file that each came from."""
    kind = ", ".join(f"{k} string" for k in (*KEY, "kind", "path"))
    return spark.read.schema(kind).parquet(path) if endpoints.exists(spark, path) else spark.createDataFrame([], kind)


def take(batch: DataFrame, endpoint: str, schema: StructType, target: str, noted: str) -> None:
    """Bring the files of a batch (path) into the table at target, partitioned by _year and _session.

    A session that the manifest has is passed over; of several files of one session the first counts, CSV before Parquet.
    Rows are written before the manifest, each session as a whole, so a batch that broke off is simply taken again.
    """
    spark = batch.sparkSession
    fresh = files.not_ingested(rows.first_n_per_group(keyed(batch, endpoint), KEY, ("kind", "path"), 1), manifest(spark, noted), KEY)
    chosen = fresh.select(*KEY, "kind", "path").collect()  # the names of one batch's files, which the trigger bounds
    if not chosen:
        return
    listed = [(sorted(r.path for r in chosen if r.kind == kind), kind) for kind in ("csv", "parquet")]
    read = endpoints.scan_files(spark, listed, endpoint, schema).rows
    place = {name: F.regexp_extract("_source_file", _PLACE, i) for i, name in ((1, "_year"), (2, "_session"))}
    files.rewrite_partitions(read.withColumns(place), target, ("_year", "_session"))
    spark.createDataFrame([(r.endpoint, r.year, r.session_key, r.kind, r.path) for r in chosen], ", ".join(f"{k} string" for k in (*KEY, "kind", "path"))).coalesce(1).write.mode("append").parquet(noted)


def ingest(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, kind: str | None = None, endpoint: str | None = None, most_files: int = 1000) -> StreamingQuery:
    """Take the files <source>/<year>/<session_key>.{csv,parquet} that have come since the last run, and end.

    Columns go by name (see endpoints.scan). The checkpoint remembers files, the table <target>.manifest sessions: a session
    that comes again, in whatever file, isn't taken twice.
    """
    endpoint = endpoint or source.rstrip("/").rpartition("/")[2]
    listed = spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{kind}" if kind else "*.{csv,parquet}").option("maxFilesPerTrigger", most_files)
    paths = listed.load(source).select("path")
    each = lambda batch, _: take(batch, endpoint, schema, target, f"{target.rstrip('/')}.manifest")
    return paths.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
