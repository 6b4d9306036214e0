"""From raw documents to encoded training text, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. The stages
before the last return the columns of ``documents``; the last adds the token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annonia.llm import bpe, decontaminate, minhash, quality, secrets
from annonia.llm.queries import table, tokenizer_path
from annonia.llm.store import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the line model keep."""
    field = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.kept(docs, field)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return minhash.distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets overwritten."""
    return secrets.mask_secrets(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, decoded again to prove the round trip."""
    coded = bpe.encode_decode(docs, *tokenizer_path())
    return coded.select("doc_id", "n_tokens", F.col("ids").alias("token_ids"), "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("byte-level BPE encoding and decoding", bpe_encoding),
]

#: The line model, the MinHash candidates and the merges are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
