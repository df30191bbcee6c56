"""Sharding by jump consistent hashing, in DataFrame expressions only.

A row's shard follows from its key and the shard count alone: a 64-bit linear congruential sequence, seeded by
the key, gives the jumps; the last jump below the count is the shard. With one more shard a row stays or moves
into the new one. No ring table is kept.

Defined cases: a null key goes where key 0 goes; a null text has no bytes (size 16, CRC 0); rows with equal keys share
a shard and get different slots; an empty table gives an empty result. Only the named columns are read, so other
columns and their names don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the generator.
MULTIPLIER, MODULUS = 2862933555777941757, 1 << 64
#: Bytes that a row counts besides its text.
ROW_BYTES = 16


def _next(state: Column) -> Column:
    wide = state.cast("decimal(20,0)") * F.lit(str(MULTIPLIER)).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")
    return (wide % F.lit(str(MODULUS)).cast("decimal(20,0)")).cast("decimal(20,0)")


def _top31(state: Column) -> Column:
    """The state's upper 31 bits."""
    return F.floor(state / F.lit(1 << 33)).cast("long")


def _unsigned(key: Column) -> Column:
    k = F.coalesce(key.cast("long"), F.lit(0)).cast("decimal(20,0)")
    return F.when(k < 0, k + F.lit(str(MODULUS)).cast("decimal(20,0)")).otherwise(k).cast("decimal(20,0)")


def jump(key: Column, shards: int) -> Column:
    """struct(shard, grown): the key's shard among `shards`, and among one more.

    Each jump goes strictly up, so `shards` + 1 steps always suffice; steps beyond the last jump only pass the state on.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")

    def step(acc: Column, _: Column) -> Column:
        state = F.when(acc["j"] <= shards, _next(acc["state"])).otherwise(acc["state"])
        at = F.greatest(acc["j"], acc["shard"])
        moved = F.struct(
            F.when(acc["j"] < shards, acc["j"]).otherwise(acc["shard"]).alias("shard"),
            F.when(acc["j"] <= shards, acc["j"]).otherwise(acc["grown"]).alias("grown"),
            F.when(acc["j"] <= shards, F.floor((at + 1) * F.lit(1 << 31) / (_top31(state) + 1)).cast("long")).otherwise(acc["j"]).alias("j"),
            state.alias("state"),
        )
        return F.when(acc["j"] > shards, acc).otherwise(moved)

    start = F.struct(F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("grown"), F.lit(0).cast("long").alias("j"), _unsigned(key).alias("state"))
    # Position 0 is every key's first stop.
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards + 2)), start, step, lambda acc: F.struct(acc["shard"].cast("int").alias("shard"), acc["grown"].cast("int").alias("grown")))


def shard_rows(df: DataFrame, key: str, text: str, shards: int, blocks: int = 256, run: int = 1 << 20) -> DataFrame:
    """key, size, text_crc32, law, shard, slot, grown_shard for each row of df.

    Slots count each shard's rows from 0 without gaps. Rows that agree in key, CRC and size are counted before the
    shuffle and are one entry; a shard's entries are dealt into `blocks` by further bits of the key's hash and the CRC, entries are ordered
    inside a block, and go on from the counts of the shard's earlier blocks. So neither a shard, nor a key that many
    rows have, is ordered in one task; an entry of more than `run` rows is written by several. Only these narrow
    columns are shuffled, never the text.
    """
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.octet_length(text).cast("long"), F.lit(0)).alias("bytes"), F.crc32(F.coalesce(text, F.lit(""))).alias("crc"))
    entries = rows.groupBy("key", "bytes", "crc").agg(F.count("*").alias("n"))
    placed = entries.select("key", "bytes", "crc", "n", jump(F.col("key"), shards).alias("at"), ((_top31(_next(_unsigned(F.col("key")))) + F.col("crc")) % blocks).cast("int").alias("block"))
    placed = placed.select("key", "bytes", "crc", "n", "at.*", "block")
    inside = F.sum("n").over(Window.partitionBy("shard", "block").orderBy("key", "crc", "bytes").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    earlier = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # at most `blocks` rows a shard
    offsets = placed.groupBy("shard", "block").agg(F.sum("n").alias("rows")).select("shard", "block", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"))
    counted = placed.withColumn("first", inside - F.col("n")).join(offsets, ["shard", "block"]).withColumn("first", F.col("first") + F.col("offset"))
    slots = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    some = counted.where(F.col("n") <= run).withColumn("slot", F.explode(slots(F.col("n")))).withColumn("slot", F.col("slot") + F.col("first"))
    runs = counted.where(F.col("n") > run).withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(run).cast("long"))))
    many = runs.repartition("key", "crc", "start").withColumn("slot", F.explode(slots(F.least(F.lit(run).cast("long"), F.col("n") - F.col("start"))))).withColumn("slot", F.col("slot") + F.col("first") + F.col("start")).drop("start")
    return some.unionByName(many).select(F.col("key").alias(key), (F.col("bytes") + ROW_BYTES).alias("size"), F.col("crc").alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot", F.col("grown").alias("grown_shard"))


def write_shards(df: DataFrame, key: str, shards: int, path: str, files_per_shard: int = 8) -> None:
    """Write df as Parquet under path/shard=N, each shard in up to `files_per_shard` files."""
    part = F.pmod(F.xxhash64(key), F.lit(files_per_shard))
    df.withColumn("shard", jump(F.col(key), shards)["shard"]).repartition(shards * files_per_shard, "shard", part).write.partitionBy("shard").parquet(path)
