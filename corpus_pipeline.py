"""The corpus pipeline: classify, deduplicate, decontaminate, redact, encode.

Each stage takes (spark, docs, sf_dir) and works on every row that its predecessor kept; all but the last return the
columns of docs. Rows with a null doc_id are judged by their texts like any other; empty tables pass through all stages,
and further columns go along under any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlap.llm import bpe, decontaminate, near_copies, quality_classifier, secrets, toxicity
from gridlap.llm.common import cut, table
from gridlap.llm.queries import vocabulary_path

#: No SQL: the first stage learns a model and the others hash, search and encode. tests/llm holds them against brute force.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from all labels, doesn't reject."""
    labels = table(spark, sf_dir, "labels")
    model = quality_classifier.fit(toxicity.training_rows(docs, labels, "quality", F.lit(True), quality_classifier.TRAIN_ROWS))
    return quality_classifier.keep_good(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each class of texts with a five-word similarity of 0.8 or more; a null doc_id comes last."""
    return near_copies.deduplicate(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts; n_chars follows the text."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, their number, and digests of ids and decoded text."""
    return bpe.encoded(docs, vocabulary_path())


STAGES = [("quality classifier", keep_quality), ("near-duplicates", drop_near_copies), ("decontamination", drop_leaks), ("secrets", redact_secrets), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; what a stage kept is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
