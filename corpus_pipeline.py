"""Corpus preparation in stages; each takes (spark, docs, sf_dir) and returns a DataFrame.

``run`` chains the stages over ``documents``. All but the last return the columns of ``documents``:
the quality classifier and the quality rules drop the documents that they reject, near-dedup keeps
one document of each group, the secret scan blanks every span that it finds (``n_chars`` follows),
and packing returns the pieces of what is left with their places in the training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm import binpack, knn, minhash, rules, scratch, secrets
from barforge.llm.queries import BYTE_MODEL, learnt_labels, tokenizer_path

#: A document stays if the neighbours' vote for it is as high.
LEAST_SCORE = 0.7
#: Of the tokenizer, by which its workers stay small: executors are full by the last stage.
AT_ONCE, CHUNKS = 1 << 20, 150_000


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return knn.keep(docs, knn.fit(docs, learnt_labels(spark, sf_dir)), LEAST_SCORE)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs, size=5, threshold=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return binpack.pack(binpack.token_pieces(docs, tokenizer_path(BYTE_MODEL), end_id=2, tokens=1024, at_once=AT_ONCE, chunks=CHUNKS))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]
#: The classifier and the tokenizer are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
