"""The registered queries of this subpackage, one for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captionlake.llm.chat import format_conversations, read_conversations, write_windows
from captionlake.llm.common import table
from captionlake.llm.ctw import score_documents
from captionlake.llm.decontam import decontaminate
from captionlake.llm.hostrules import host_quality
from captionlake.llm.langid import identify, learn
from captionlake.llm.oracle import ORACLES
from captionlake.llm.packing import concatenate_and_cut
from captionlake.llm.secretscan import BASE_PATTERNS, scan_secrets, spans_string
from captionlake.llm.simhash import near_duplicates
from captionlake.llm.simple8b import read_token_files, write_token_files
from captionlake.llm.suffix import remove_repeats


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(folds: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), learn(docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)))
    return found.select("row.doc_id", "lang_pred", "score").select("doc_id", held_out(5).alias("held_out"), "lang_pred", "score")


def op2_concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concatenate_and_cut(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), with_ids=False)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint")
    counts = [of(kind).alias(f"n_{kind}") for kind in BASE_PATTERNS]
    return found.select("doc_id", *counts, F.sha2(spans_string(F.col("base")), 256).alias("base_sha256"), spans_string(F.col("spans")).alias("spans"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = spark.sql("SELECT -1L AS conv_id, t AS turn, r AS role, '<|im_end|><|im_start|>assistant ok' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(control)
    return read_conversations(write_windows(format_conversations(turns, tokenizer_file("byte_bpe_50k.json"))))


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op8_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json")))


def op9_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    train = docs.where(~held_out(10))
    return score_documents(docs, train).select("doc_id", held_out(10).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_language_id, op2_concatenate_and_cut, op3_decontaminate, op4_secret_scan, op5_simhash, op6_chat_windows, op7_suffix_array, op8_simple8b, op9_context_tree, op10_host_quality)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
