"""Status documents of batches, as rows of files and chunks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from captionlake.functions.rows import each
from captionlake.operators.audit import REQUIRED
from captionlake.schemas import CHUNK_STATUS, DIAGNOSTICS, FILE_STATUS


def read_status(spark: SparkSession, path: str, pattern: str = "batch_status_*.json") -> DataFrame:
    """One row per document: ``batch``, ``raw``, and ``problem`` for what cannot be read (A0)."""
    docs = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True).select(F.col("_metadata.file_name").alias("batch"), F.trim("value").alias("raw"))
    return status_problems(docs)


def status_problems(docs: DataFrame) -> DataFrame:
    # of a document that is no list the files are what it needs a schema for
    parsed = F.try_parse_json("raw")
    is_list = F.startswith(F.trim("raw"), F.lit("["))
    shape = F.when(is_list, F.when(parsed.isNotNull(), "ARRAY")).otherwise(F.schema_of_variant(parsed))
    listed = F.startswith("_shape", F.lit("ARRAY")) | F.contains("_shape", F.lit("files: ARRAY"))
    problem = F.when(F.col("_shape").isNull(), "not JSON").when(~listed, "not a list").when(F.rlike("raw", F.lit(r'\A\s*(\[\s*\]|\{\s*"files"\s*:\s*\[\s*\]\s*\})\s*\z')), "empty")
    return docs.withColumn("_shape", shape).withColumn("problem", problem).drop("_shape")


def document_issues(docs: DataFrame) -> DataFrame:
    """A0 issues; such documents have no scores."""
    rows = docs.where("problem IS NOT NULL")
    severity = F.when(F.col("problem") == "empty", "WARN").otherwise("CRITICAL")
    return rows.select("batch", F.lit(None).cast("bigint").alias("file_id"), severity.alias("severity"), F.lit("A0").alias("check"), F.concat(F.lit("Batch status file: "), F.col("problem")).alias("msg"))


def _filled(json: Column) -> Column:
    """Whether a JSON value, as text, is anything but null, false, zero or empty."""
    return ~F.coalesce(F.regexp_replace(json, r"\s", ""), F.lit("")).isin("", "null", "[]", "{}", '""', "0", "false")


def _bound(value: Column, f) -> Column:
    """``f`` of a value that is computed once: Spark computes a plain expression as often as it occurs."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def chunk_errors(errors: Column, error: Column, model: Column) -> Column:
    """Errors of a chunk as (model, message), from a list of objects or texts, or a text; ``error`` counts where ``errors`` is empty."""
    message = lambda x: F.coalesce(F.get_json_object(x, "$.message"), x)
    is_object = lambda x: F.startswith(F.trim(x), F.lit("{"))
    # a text that is no object has no fields
    named = lambda x: F.coalesce(F.when(is_object(x), F.get_json_object(x, "$.model")), model)
    one = lambda x: F.struct(named(x).alias("model"), F.when(is_object(x), message(x)).otherwise(x).alias("message"))
    none = F.array().cast("array<string>")
    listed = lambda json: F.coalesce(F.when(F.startswith(F.trim(json), F.lit("[")), F.from_json(json, "array<string>")).when(json.isNotNull(), F.array(json)), none)
    json = F.when(_filled(errors), errors).when(_filled(error), error)
    return F.transform(F.when(errors.isNull() & error.isNull(), none).otherwise(_bound(json, listed)), one)


def file_facts(docs: DataFrame, problems: bool = False) -> DataFrame:
    """Rows for :func:`captionlake.operators.audit.audit_issues`; both list and ``{"files": [...]}`` documents.

    With ``problems`` also a row for each document that has one, with its ``batch`` and ``problem``, which is
    null for files: so one reading gives both, and whole documents, which can be long, need not be written.
    ``chunks_listed`` is false where ``chunks`` is there but no list; such a file, like one without
    chunks, has none. A chunk that is no object has ``is_object`` false and else nulls. An item that is
    no object lacks all fields.
    """
    is_list = F.startswith(F.col("raw"), F.lit("["))
    texts = F.when(is_list, F.from_json("raw", "array<string>")).otherwise(F.from_json("raw", "struct<files:array<string>>")["files"])
    kept = ["batch", "problem"] if problems else ["batch"]
    readable = F.when(F.col("problem").isNull(), texts)
    items = each(docs, readable.otherwise(F.array(F.lit(None).cast("string"))) if problems else readable, "item", *kept)
    keys = F.coalesce(F.json_object_keys("item"), F.array().cast("array<string>"))
    absent = F.array_except(F.array(*[F.lit(x) for x in REQUIRED]), keys)
    # what has a value is there: keys are looked at only where one lacks
    whole = reduce(Column.__and__, [F.col(f"f.{x}").isNotNull() for x in REQUIRED])
    rows = items.withColumn("f", F.from_json("item", FILE_STATUS)).select(*kept, F.when(whole, F.array().cast("array<string>")).otherwise(absent).alias("missing"), "f")
    listed = F.startswith(F.trim("f.chunks"), F.lit("["))
    elements = F.when(listed, F.from_json("f.chunks", "array<string>")).otherwise(F.array().cast("array<string>"))

    def read(text: Column) -> Column:
        is_object = F.coalesce(F.startswith(F.trim(text), F.lit("{")), F.lit(False))
        return F.struct(F.from_json(F.when(is_object, text), CHUNK_STATUS).alias("c"), is_object.alias("is_object"), text.alias("text"))

    def chunk(x: Column) -> Column:
        c = x["c"]
        fields = [c[n].alias(n) for n in ("chunk_id", "status", "model_used", "retry_count", "char_count", "elapsed_sec", "summary_preview")]
        has_id = c["chunk_id"].isNotNull() | F.coalesce(F.array_contains(F.json_object_keys(x["text"]), "chunk_id"), F.lit(False))
        return F.struct(*fields, x["is_object"].alias("is_object"), has_id.alias("has_id"), chunk_errors(c["errors"], c["error"], c["model_used"]).alias("errors"))

    read_chunks = F.transform(F.transform(elements, read), chunk)
    with_flag = F.transform(read_chunks, lambda c: c.withField("has_error", F.size(c["errors"]) > 0))
    has = lambda c: F.coalesce(c, F.lit(False))
    known = F.from_json("f.diagnostics", DIAGNOSTICS)
    return rows.select(
        *kept, "f.file_id", "f.filename_srt", "f.filename_mp3", "f.status", "f.last_updated", "f.retry_count", "f.total_chunks", "missing", with_flag.alias("chunks"), F.coalesce(listed, F.lit(True)).alias("chunks_listed"),
        "f.error_log", has(F.size("f.error_log") > 0).alias("has_error_log"), _filled(F.col("f.diagnostics")).alias("has_diagnostics"), _filled(known["summary"]).alias("has_summary"), known["models"].alias("models"),
    )


def initial_chunk_status(chunks: DataFrame) -> DataFrame:
    """(file_id, total_chunks, chunks) with every chunk pending and a preview."""
    one = F.struct("start_idx", F.col("chunk_id"), F.lit("pending").alias("status"), F.substring("text_content", 1, 100).alias("text_preview"))
    rows = chunks.groupBy("file_id").agg(F.array_sort(F.collect_list(one)).alias("chunks"))
    return rows.select("file_id", F.size("chunks").alias("total_chunks"), F.transform("chunks", lambda c: c.dropFields("start_idx")).alias("chunks"))
