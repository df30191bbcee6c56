"""Tables written once to the folder that all executors share, so that later steps neither recompute them nor carry their lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_CUT = "cut-"
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only in local mode, where there is one machine."""
    key = "spark.checkpoint.dir"
    found = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"set {key} to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='gridlap-shared-')}"
        spark.conf.set(key, found)
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df as written to the shared folder; the copy goes when the driver ends, or with clear()."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{_CUT}{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Remove what cut() has written in this driver: once no result that stands on it is to be read any more."""
    while _made:
        place = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
