from pyspark.sql import functions as F

from gridlap.llm import sharding


def walk(key, shards):
    state, last, at = key & ((1 << 64) - 1), -1, 0
    while at < shards:
        last = at
        state = (state * sharding.MULTIPLIER + 1) % (1 << 64)
        at = (last + 1) * (1 << 31) // ((state >> 33) + 1)
    return last


def test_jump_follows_the_walk_and_grows_only_into_the_new_shard(spark):
    df = spark.range(-500, 1500).unionByName(spark.createDataFrame([(2**63 - 1,), (-(2**63),)], "id long"))
    for n in (1, 2, 40):
        got = df.select("id", sharding.jump(F.col("id"), n).alias("a")).select("id", "a.*").collect()
        assert all((r.shard, r.grown) == (walk(r.id, n), walk(r.id, n + 1)) for r in got)
        assert all(r.grown in (r.shard, n) for r in got)


def test_slots_have_no_gaps_with_nulls_ties_and_other_columns(spark):
    rows = [(i % 50, "x" * (i % 7), 9) for i in range(300)] + [(None, None, 1), (None, "", 1), (3, "é", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int").withColumn("slot", F.lit(1))
    got = sharding.shard_rows(df, "doc_id", "text", 5, blocks=3).collect()
    assert len(got) == 303
    for s in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert {r["size"] for r in got if r.doc_id is None} == {16} and {r.text_crc32 for r in got if r.doc_id is None} == {0}
    assert 18 in {r["size"] for r in got if r.doc_id == 3}
    assert all(len({r.shard for r in got if r.doc_id == k}) == 1 for k in range(50))
    assert sharding.shard_rows(df.where("false"), "doc_id", "text", 5).count() == 0


def test_a_hot_key_and_repeated_rows_get_each_slot_once(spark):
    rows = [(None, f"t{i}") for i in range(400)] + [(7, "same")] * 333 + [(7, f"t{i}") for i in range(50)] + [(i, "x") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for run in (10, 1 << 20):
        got = sharding.shard_rows(df, "doc_id", "text", 6, blocks=16, run=run).collect()
        assert len(got) == len(rows) and sum(r.doc_id is None for r in got) == 400 and sum(r.doc_id == 7 for r in got) == 384
        for s in {r.shard for r in got}:
            slots = sorted(r.slot for r in got if r.shard == s)
            assert slots == list(range(len(slots)))


def test_writing_shards(spark, tmp_path):
    sharding.write_shards(spark.range(100), "id", 4, f"{tmp_path}/s", 2)
    got = spark.read.parquet(f"{tmp_path}/s")
    assert got.count() == 100 and all(walk(r.id, 4) == r.shard for r in got.collect())


def test_plan_is_native(spark, sf_dir):
    df = sharding.shard_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text", 40)
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
