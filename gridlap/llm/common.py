"""Reading the input tables, sharing values with tasks and mapping over Arrow batches."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlap.operators.store import cut as cut

#: ASCII white space as the word rule has it: space and \x09 to \x0D.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, through Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.Array) -> list[bytes | None]:
    """A batch's strings as bytes, without decoding them."""
    return column.cast(pa.large_binary()).to_pylist()


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of a schema; made on the driver, tasks get it ready."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str) -> DataFrame:
    """Apply make()'s function to each Arrow batch; it returns columns by name. make() runs once in each task."""
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                cols = one(batch.slice(start, 1024))
                yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def share(spark: SparkSession, value) -> Callable[[], object]:
    """A function for tasks that gives the value. It is broadcast as bytes that hold its classes too, so executors
    need no copy of this package (a plain broadcast would name the classes only)."""
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(shared.value)


#: A key with at least 1 in HOT of all rows is hot, so there are at most HOT of them; nor is one with fewer rows than LEAST_HOT.
HOT, LEAST_HOT = 1024, 256


def hot_from(rows: int) -> int:
    """The number of rows from which a key of a table with so many rows is hot."""
    return max(LEAST_HOT, -(-rows // HOT))


def look_up(rows: DataFrame, of: DataFrame, on: str, n: str, least: int) -> DataFrame:
    """rows with the further columns of `of`, which has one row for a key and in n the number of the key's rows (or more).

    A key's rows meet its row of `of` where they lie if it has `least` rows or more, by a broadcast; with `least` from
    hot_from, that is of at most HOT rows. So no task gathers the rows of a hot key. Rows whose key isn't in `of`, or null, go.
    """
    hot = F.broadcast(of.where(F.col(n) >= least).drop(n))
    rest = rows.join(hot.select(on), on, "left_anti").join(of.where(F.col(n) < least).drop(n), on)
    return rows.join(hot, on).unionByName(rest)


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that names made beside it can't clash with the table's own."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns])


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of all columns but maps, which have no hash."""
    return F.xxhash64(*[df[f"`{f.name}`"] for f in df.schema if "map<" not in f.dataType.simpleString()])


def keep(df: DataFrame, condition: Column) -> DataFrame:
    """The rows where the condition holds.

    A plain filter would be moved below the projection that made its inputs, and these computed anew at each use in
    it; an explode isn't.
    """
    return df.select(whole_row(df).alias("row"), F.explode(F.when(condition, F.array(F.lit(True))))).select("row.*")
