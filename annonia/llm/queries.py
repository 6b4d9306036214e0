"""Queries of this subpackage over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, minhash, pieces, quality, repair, repeats, secrets, sharding, suffix_tree, trie, urls
from .oracle import ORACLE  # noqa: F401  (read by the entry module)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


#: A conversation whose texts hold the template's own control strings.
HARD_TURNS = [(-7, i, role, "\\### Assistant: </turn> ok") for i, role in enumerate(("user", "assistant"))]


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(HARD_TURNS, "conv_id long, turn long, role string, text string"))
    path, pattern = tokenizer_path()
    return chat.read_back(chat.format_conversations(rows, path, pattern), path, pattern).drop("n_tokens", "n_loss_tokens")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the links that were confirmed on the way depend on the order of comparison; the components don't
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("n_links")


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).drop("score")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), *tokenizer_path(), with_ids=False).drop("ids")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op7_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.scores(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(trie.rebuilt(trie.turn_arrays(table(spark, sf_dir, "conversations"))))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audited(repair.damaged(table(spark, sf_dir, "conversations")), "n")


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = tokenizer_path("piece_bpe_32k.model")
    return pieces.encode_decode(table(spark, sf_dir, "documents"), path, with_ids=False).drop("ids")


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (op1_chat, op2_minhash, op3_urls, op4_bpe, op5_secrets, op6_quality, op7_suffix_tree, op8_sharding, op9_decontaminate, op10_repeats, op11_prefix_trie, op12_repair, op13_sentencepiece)
}
