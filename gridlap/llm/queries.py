"""The queries opN_<name>: each applies its operator to the whole of its table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlap.llm import bpe, collocations, decontaminate, language_id, lm_ctw, periodic_runs, quality_classifier, quality_rules, secrets, sharding, simhash, toxicity, url_filter
from gridlap.llm.common import table

SHARDS = 40
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def fold(folds: int) -> Column:
    """The fold of a doc_id: crc32 of its decimal text, by remainder; null counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), "doc_id", "text", SHARDS)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(found.fp).alias("fingerprint"), "component_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(toxicity.training_rows(docs, labels, "toxic", fold(5) != 0))
    return toxicity.score(docs, model).select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op9_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_ctw.score(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.fit(toxicity.training_rows(docs, labels, "quality", fold(3) != 1, quality_classifier.TRAIN_ROWS))
    return quality_classifier.score(docs, model).select("doc_id", (fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def planted_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text: the words of every tenth document (by crc32 of doc_id, h) become periodic from a place on; a null doc_id stays as it is.

    With n words and g = floor(h / 10), each word i >= a becomes word a + (i - a) % p, where a = g % n and p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    a = F.when(n > 0, (g % n).cast("int"))
    p = F.when(n > 0, (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    chosen = chosen.withColumn("a", a).withColumn("p", p)
    tail = n - F.col("a")
    period = F.slice("w", F.col("a") + 1, F.col("p"))
    repeated = F.slice(F.flatten(F.array_repeat(period, F.ceil(tail / F.col("p")).cast("int"))), F.lit(1), tail)
    made = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), repeated), " ")
    return chosen.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(planted_repeats(table(spark, sf_dir, "documents")))
    best = periodic_runs.strongest(F.col("runs"))
    lines = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    found = found.select("row.doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents")).drop("doc_id")


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(fold(4) != 2))
    return language_id.classify(docs.select("doc_id", "text"), model).select("row.doc_id", "lang_pred", "score", "rejected").withColumn("held_out", fold(4) == 2)


QUERIES = {"op1_sharding": op1_sharding, "op2_simhash": op2_simhash, "op3_quality_rules": op3_quality_rules, "op4_bpe": op4_bpe, "op5_decontaminate": op5_decontaminate, "op6_secrets": op6_secrets, "op7_toxicity": op7_toxicity, "op8_url_filter": op8_url_filter, "op9_ctw": op9_ctw, "op10_quality_classifier": op10_quality_classifier, "op11_periodic_runs": op11_periodic_runs, "op12_collocations": op12_collocations, "op13_language_id": op13_language_id}
