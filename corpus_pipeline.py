"""A corpus pipeline over ``documents``: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captionlake.llm.common import materialize, spread, table
from captionlake.llm.decontam import decontaminate
from captionlake.llm.langid import identify, learn
from captionlake.llm.packing import concatenate_and_cut
from captionlake.llm.queries import tokenizer_file
from captionlake.llm.secretscan import redact, secret_spans
from captionlake.llm.simhash import keep_first

def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with no letter, and those less like every landmark than texts of known languages are.

    Null and blank texts have no letter. Rows are judged one by one, whatever their ids; very long texts are read whole.
    """
    model = learn(docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    return identify(docs, model).where("accepted").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near-duplicates, that with the least id.

    Rows without an id come last in their group, and go with it like others; rows with one id and unlike texts all stay.
    Null and blank texts are one group.
    """
    return keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item. Null texts hold none; rows are judged one by one, and long texts read whole."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).where("n_hit = 0").select("row.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark, and counts the characters anew; documents without one, null texts among them, stay as they are."""
    spans = F.when(F.col("text").isNotNull(), secret_spans(F.col("text"))["spans"])
    rows = spread(docs).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), spans.alias("spans"))
    some, text = F.size("spans") > 0, F.col("row.text")
    clean = rows.select("row", some.alias("some"), F.when(some, redact(text, F.col("spans"))).otherwise(text).alias("text"))
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("some"), F.length("text").cast("bigint")).otherwise(F.col("row.n_chars"))}
    return clean.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 token ids; a null text is its end id alone, and a long one goes over many sequences."""
    return concatenate_and_cut(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: SQL has no string kernel, SimHash or tokenizer; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that pass the stages; every stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
