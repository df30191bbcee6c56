"""Endpoint folders: CSV and Parquet files of any columns, read by name, with what could not be read set apart.

The driver looks at each file's header or footer only, through Hadoop's file system and many at a time. Files with the
same columns are one scan, so a folder is as many scans as it has different headers, whatever the number of its files.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridlap.functions import coerce
from gridlap.operators import rows

PROBLEMS = "file string, problem string, detail string"
#: Texts that a CSV file has for a missing value (fixed values, as pandas reads them).
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
_BAD, _LOOKERS = "_bad_record", 32


@dataclass
class Endpoint:
    """rows: what was read, with the columns of rows.META; problems: file, problem (bad file, bad row, bad value), detail."""

    rows: DataFrame
    problems: DataFrame


@dataclass
class _Files:
    """Files of one kind by signature, those that can't be read, and how many rows a Parquet file says it has."""

    groups: dict[tuple[str, ...], list[str]] = field(default_factory=dict)
    bad: list[tuple[str, str]] = field(default_factory=list)
    sizes: list[tuple[str, int]] = field(default_factory=list)


def exists(spark: SparkSession, path: str) -> bool:
    """Through Hadoop's file system, so any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def list_files(spark: SparkSession, root: str, kind: str) -> list[str]:
    """The paths of the files of a kind below root, in order; Spark lists them, contents aren't read. Empty files are among them."""
    if not exists(spark, root):
        return []
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{kind}").load(root)
    return sorted(unquote(p) for p in listed.inputFiles())


def csv_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The column names of a CSV file; of equal names the later ones get a number, as pandas has it."""
    java, p = spark._jvm.java.io, spark._jvm.org.apache.hadoop.fs.Path(path)
    reader = java.BufferedReader(java.InputStreamReader(p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p), "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    names = next(csv.reader([(line or "").lstrip("﻿")]), [])
    if not names:
        raise ValueError("no columns")
    seen: dict[str, int] = {}
    out = []
    for i, name in enumerate(names):
        name = name or f"Unnamed: {i}"
        k = seen[name] = seen.get(name, -1) + 1
        out.append(f"{name}.{k}" if k else name)
    return tuple(out)


def parquet_footer(spark: SparkSession, path: str) -> tuple[str, int]:
    """A Parquet file's schema as text, and its number of rows."""
    jvm = spark._jvm
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), spark._jsc.hadoopConfiguration())
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        return reader.getFooter().getFileMetaData().getSchema().toString(), reader.getRecordCount()
    finally:
        reader.close()


def _looked_at(spark: SparkSession, paths: Sequence[str], kind: str) -> _Files:
    def look(path: str):
        try:
            return (csv_header(spark, path), None) if kind == "csv" else parquet_footer(spark, path)
        except Exception as failed:  # noqa: BLE001  whatever is wrong with the file, it is set apart and the others go on
            return failed, None

    found = _Files()
    with ThreadPoolExecutor(_LOOKERS) as pool:
        for path, (signature, size) in zip(paths, pool.map(look, paths), strict=True):
            if isinstance(signature, Exception):
                found.bad.append((path, (str(signature).strip().splitlines() or [type(signature).__name__])[0][:300]))
                continue
            found.groups.setdefault(signature if kind == "csv" else (signature,), []).append(path)
            if size is not None:
                found.sizes.append((path, size))
    return found


def _as(kind: str) -> Callable[[Column], Column]:
    if kind in ("bigint", "int", "smallint", "tinyint"):
        return lambda c: coerce.to_integer(c).cast(kind)
    if kind in ("double", "float"):
        return lambda c: coerce.to_number(c).cast(kind)
    return {"boolean": coerce.to_bool, "timestamp": coerce.to_utc, "string": lambda c: c}.get(kind, lambda c: c.try_cast(kind))


def _origin(endpoint: str, order: int, position: Column) -> list[Column]:
    """The columns of rows.META: endpoint, file, and a value that orders rows as the files have them."""
    file = F.col("_metadata.file_path")
    return [F.lit(endpoint).alias("_source_endpoint"), file.alias("_source_file"), F.struct(F.lit(order).alias("kind"), file.alias("file"), F.col("_metadata.file_block_start").alias("block"), position.alias("row")).alias(rows.INGEST_ORDER)]


def _one_form(path: Column) -> Column:
    """A path that begins with scheme:///, scheme:/ or none, in one form."""
    return F.url_decode(F.replace(F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:/+", "/"), F.lit("+"), F.lit("%2B")))


def _csv_rows(spark: SparkSession, names: Sequence[str], paths: Sequence[str], endpoint: str, order: int, missing: Sequence[str]) -> DataFrame:
    """All columns as text, the row as it stands where its number of fields is wrong, and rows.META."""
    schema = StructType([StructField(n, StringType()) for n in (*names, _BAD)])
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).option("columnPruning", False)
    # A file's rows come in order within a block, so a counter that only rises orders them.
    read = reader.option("escape", '"').csv(list(paths)).select("*", *_origin(endpoint, order, F.monotonically_increasing_id()))
    # Spark refuses to read a bad row's text alone, so another column is looked at with it.
    first = F.col(f"`{names[0]}`")
    told = F.coalesce(F.col(_BAD), F.when(F.length(first) < 0, first))
    return read.withColumn(_BAD, told).withColumns({n: F.when(~F.col(f"`{n}`").isin(*missing), F.col(f"`{n}`")) for n in names})


def _parquet_rows(spark: SparkSession, paths: Sequence[str], endpoint: str, order: int) -> DataFrame:
    read = spark.read.option("ignoreCorruptFiles", True).parquet(*paths)
    return read.select("*", F.lit(None).cast("string").alias(_BAD), *_origin(endpoint, order, F.col("_metadata.row_index")))


def scan(spark: SparkSession, root: str, endpoint: str, schema: StructType, kinds: Sequence[str] = ("csv", "parquet"), legacy: Sequence[str] = (), missing: Sequence[str] = MISSING) -> Endpoint:
    """All files below root/endpoint, CSV before Parquet, then those legacy files that exist; within a kind by path.

    Columns are found by name, whatever their order. Those of the schema get its types, others stay as they are; a
    column that no file has is absent, and one that some files have is null elsewhere. Without any readable file the
    table is empty and has the schema's columns.

    A file without a header or footer that can be read is left out and is one problem; so is a Parquet file that gives fewer
    rows than its footer says. A CSV row with too many or too few fields is left out and is one problem; a value that doesn't
    read as its type becomes null and is one problem.
    """
    listed = [*((list_files(spark, f"{root}/{endpoint}", k), k) for k in kinds), *((list_files(spark, p, kind), kind) for p in legacy for kind in [p.rpartition(".")[2]])]
    return scan_files(spark, listed, endpoint, schema, missing)


def scan_files(spark: SparkSession, listed: Sequence[tuple[Sequence[str], str]], endpoint: str, schema: StructType, missing: Sequence[str] = MISSING) -> Endpoint:
    """The files of (paths, csv or parquet), in this order; see scan."""
    found: list[tuple[_Files, str, int]] = []
    for order, (paths, kind) in enumerate(listed):
        kind = "csv" if kind == "csv" else "parquet"
        found.append((_looked_at(spark, paths, kind), kind, order))
    parts, kinds_of_parts = [], []
    for files, kind, order in found:
        for signature, paths in files.groups.items():
            kinds_of_parts.append((order, kind))
            parts.append(_csv_rows(spark, signature, paths, endpoint, order, missing) if kind == "csv" else _parquet_rows(spark, paths, endpoint, order))
    bad = [(path, "bad file", why) for files, _, _ in found for path, why in files.bad]
    problems = spark.createDataFrame(bad, PROBLEMS)
    if not parts:
        empty = spark.createDataFrame([], schema)
        order_type = "struct<kind: int, file: string, block: bigint, row: bigint>"
        return Endpoint(empty.withColumns({"_source_endpoint": F.lit(endpoint), "_source_file": F.lit(None).cast("string"), rows.INGEST_ORDER: F.lit(None).cast(order_type)}), problems)
    typed, logs = [], [problems]
    for part in parts:
        kinds_of = dict(part.dtypes)
        wanted = {f.name: f.dataType.simpleString() for f in schema if f.name in kinds_of}
        read = {n: (_as(k)(F.col(f"`{n}`")) if kinds_of[n] == "string" else F.col(f"`{n}`").try_cast(k)) for n, k in wanted.items() if k != kinds_of[n]}
        typed.append(part.where(F.col(_BAD).isNull()).withColumns(read).drop(_BAD))
        lost = F.array_compact(F.array(F.lit(None).cast("string"), *(F.when(F.col(f"`{n}`").isNotNull() & made.isNull(), F.concat(F.lit(f"{n}="), F.col(f"`{n}`").cast("string"))) for n, made in read.items())))
        said = F.when(F.col(_BAD).isNotNull(), F.array(F.struct(F.lit("bad row").alias("problem"), F.col(_BAD).alias("detail")))).otherwise(F.transform(lost, lambda x: F.struct(F.lit("bad value").alias("problem"), x.alias("detail"))))
        logs.append(part.select(F.col("_source_file").alias("file"), F.inline(said)))
    out = rows.union_by_name(typed)
    said = [x for files, _, _ in found for x in files.sizes]
    if said:
        # A count alone would come from the footers; the hash makes Spark read the values.
        readable = lambda p: F.count_if(F.xxhash64(*[F.col(f"`{c}`") for c, t in p.dtypes if c not in rows.META and "map<" not in t] or [F.lit(0)]) >= F.lit(-(1 << 63)))
        own = [p for p, (_, kind) in zip(parts, kinds_of_parts, strict=True) if kind == "parquet"]
        counted = rows.union_by_name([p.groupBy(_one_form(F.col("_source_file")).alias("at")).agg(readable(p).alias("n")) for p in own])
        expected = spark.createDataFrame(said, "file string, size long").withColumn("at", _one_form(F.col("file")))
        short = expected.join(counted, "at", "left").where(F.coalesce("n", F.lit(0)) < F.col("size"))
        logs.append(short.select("file", F.lit("bad file").alias("problem"), F.format_string("%d of %d rows", F.coalesce("n", F.lit(0)), F.col("size")).alias("detail")))
    names = [f.name for f in schema if f.name in out.columns]
    rest = [c for c in out.columns if c not in names and c not in rows.META]
    return Endpoint(out.select(*(f"`{c}`" for c in (*names, *rest)), *rows.META), rows.union_by_name(logs))


def read_records(spark: SparkSession, path: str, schema: StructType, endpoint: str = "") -> Endpoint:
    """JSON files: a list of records on one line or many, one record, or a record a line. A file is parsed whole.

    A document that isn't JSON, and a line that isn't, are one problem each; fields that don't read as their type are null.
    """
    docs = spark.read.text(path, wholetext=True).select(F.trim(F.regexp_replace("value", r"^﻿", "")).alias("value"), *_origin(endpoint, 0, F.lit(0).cast("long")))
    bad = StructType([*schema, StructField(_BAD, StringType())])
    # A list is one document, and so is what has a single line that begins with a brace: one record. Else each line is.
    lines = F.split("value", r"\r?\n")
    whole = F.col("value").startswith("[") | (F.size(F.filter(lines, lambda x: x.startswith("{"))) == 1)
    pieces = F.when(whole, F.array("value")).otherwise(F.filter(lines, lambda x: F.trim(x) != ""))
    each = docs.select("*", F.posexplode(pieces).alias("line", "piece"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    listed = F.from_json("piece", f"array<struct<{', '.join(f'`{f.name}`: {f.dataType.simpleString()}' for f in bad)}>>", options)
    one = F.from_json("piece", bad, options)
    broken = F.array(F.from_json(F.lit("{}"), bad, options).withField(_BAD, F.col("piece")))
    records = F.when(F.try_parse_json("piece").isNull(), broken).when(F.ltrim("piece").startswith("["), listed).otherwise(F.array(one))
    read = each.select(*[c for c in rows.META if c != rows.INGEST_ORDER], F.col(rows.INGEST_ORDER), "line", F.posexplode_outer(records).alias("at", "record")).where("record is not null")
    order = F.col(rows.INGEST_ORDER).withField("row", F.col("line") * F.lit(1 << 32) + F.col("at"))
    read = read.withColumn(rows.INGEST_ORDER, order)
    good = read.where(F.col(f"record.{_BAD}").isNull()).select(*(F.col(f"record.`{f.name}`").alias(f.name) for f in schema), *rows.META)
    problems = read.where(F.col(f"record.{_BAD}").isNotNull()).select(F.col("_source_file").alias("file"), F.lit("bad row").alias("problem"), F.col(f"record.{_BAD}").alias("detail"))
    return Endpoint(good, problems)
