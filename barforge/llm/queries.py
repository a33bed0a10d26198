"""Thin queries over the corpus operators, and their DuckDB counterparts where SQL can express them.

Each query reads its whole table. Null and empty texts, ties, repeated rows, empty tables and extra
columns have the results that the operator's docstring gives them; a query adds digests alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm import binpack, digest, idfile, knn, langid, minhash, oracles, pieces, rank_merge, rules, scratch, secrets
from barforge.llm.sources import id_text, read

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_MODEL = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near copies by shingles of two words, similarity 0.8; texts without words are classes of their own."""
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), size=2, threshold=80)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each text and of its edited text; a null text counts as empty, whose fingerprint is ""."""
    docs = read(spark, sf_dir, "documents")
    return digest.edits(docs, digest.Ranks.by_rarity(digest.histogram(id_text(docs))))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids by the library and the text they decode to, as digests; a null or empty text has none."""
    model = tokenizer_path(PIECE_MODEL)
    return pieces.encode(read(spark, sf_dir, "documents"), model, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id files written and read back; a null or empty text is its end id alone."""
    path = f"{scratch.shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    scratch.keep(spark, path)
    idfile.write(read(spark, sf_dir, "documents"), tokenizer_path(BYTE_MODEL), path, end_id=0)
    return idfile.documents(spark, path)


def op5_page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all pages, with a text model of all documents."""
    return langid.identify(read(spark, sf_dir, "pages"), langid.train(read(spark, sf_dir, "documents")))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of the rules; a null or empty text has 0 for each count and fails."""
    judged = rules.judge(read(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.col("__m")[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *counts, F.col("__base_failed").alias("base_failed"), (F.size("__failed") == 0).alias("kept"))


def op7_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places; a null or empty text is its end id alone."""
    pieces_of = binpack.token_pieces(read(spark, sf_dir, "documents"), tokenizer_path(BYTE_MODEL), end_id=2, tokens=1024)
    return binpack.pack(pieces_of, binpack.Capacity(tokens=1024))


def learnt_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality labels outside the held-out quarter."""
    return read(spark, sf_dir, "labels").where(~held_out()).select("doc_id", F.col("quality").alias("label"))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def op8_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes of the labelled neighbours for every text; 0 for an empty one."""
    docs = read(spark, sf_dir, "documents")
    scored = knn.score(docs, knn.fit(docs, learnt_labels(spark, sf_dir)))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every text; 0 of both for a null or empty one."""
    return rank_merge.count(read(spark, sf_dir, "documents"), tokenizer_path(PIECE_MODEL), limit=4096)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every text; none in a null or empty one."""
    found = secrets.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("__spans", lambda s: s["kind"] < len(secrets.BASE))
    of_kind = lambda k: F.filter("__spans", lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{r.kind}") for k, r in enumerate(secrets.BASE)]
    return found.select("doc_id", *counts, F.sha2(secrets.listed(base, secrets.RULES), 256).alias("base_sha256"), secrets.listed(F.col("__spans"), secrets.RULES).alias("spans"))


QUERIES = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_fingerprints": op2_fingerprints,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_token_files": op4_token_files,
    "op5_page_language": op5_page_language,
    "op6_quality_rules": op6_quality_rules,
    "op7_best_fit": op7_best_fit,
    "op8_quality_votes": op8_quality_votes,
    "op9_token_counts": op9_token_counts,
    "op10_secret_scan": op10_secret_scan,
}
ORACLES = {
    "op1_minhash_dedup": oracles.OP1,
    "op6_quality_rules": oracles.OP6,
    "op10_secret_scan": oracles.OP10,
}
