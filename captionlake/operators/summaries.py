"""Carrying summaries through reruns: resume by content hash, retry merge, records, first-wins dedup, gates."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from captionlake.functions.text import strip
from captionlake.functions.vectors import is_valid_vector, zero_vector
from captionlake.operators.chunking import joined_text
from captionlake.schemas import FAILED, RECORD


class GateError(ValueError):
    """A fail-closed check refused a batch."""


def text_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def pending_chunks(chunks: DataFrame, completed: DataFrame) -> DataFrame:
    """Chunks with no done result for the same id and the same text (J03, P13); a changed text makes the result stale."""
    done = completed.where("status = 'done'").select("chunk_id", "source_text_hash").distinct()
    return chunks.withColumn("source_text_hash", text_hash(F.col("text_content"))).join(done, ["chunk_id", "source_text_hash"], "left_anti")


def reusable_results(chunks: DataFrame, completed: DataFrame) -> DataFrame:
    current = chunks.select("chunk_id", text_hash(F.col("text_content")).alias("source_text_hash"))
    return completed.where("status = 'done'").join(current, ["chunk_id", "source_text_hash"], "left_semi")


def finalize_checkpoint(*results: DataFrame) -> DataFrame:
    """Union by priority of the arguments; of each chunk the first occurrence by (priority, position) stays."""
    rows = [r.withColumn("_priority", F.lit(i)) for i, r in enumerate(results)]
    both = rows[0]
    for r in rows[1:]:
        both = both.unionByName(r, allowMissingColumns=True)
    return dedup_first(both, ["chunk_id"], ["_priority", "position"]).drop("_priority")


def dedup_first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def record_key(chunk_id: Column, file_name: Column, start_time: Column) -> Column:
    """The chunk id, or file name and start time where there is none."""
    return F.when(F.coalesce(chunk_id, F.lit("")) != "", chunk_id).otherwise(F.concat_ws("|", file_name, start_time))


def retry_merge(existing: DataFrame, retried: DataFrame, fields: list[str]) -> DataFrame:
    """Shallow update by chunk id: a field that the retry row names in ``present`` wins, even with null; other fields stay."""
    new = retried.select("chunk_id", "present", *[F.col(f).alias(f"_new_{f}") for f in fields])
    both = existing.join(new, "chunk_id", "full_outer")
    pick = lambda f: F.when(F.coalesce(F.array_contains("present", f), F.lit(False)), F.col(f"_new_{f}")).otherwise(F.col(f)).alias(f)
    return both.select("chunk_id", *[pick(f) for f in fields])


def select_retries(chunks: DataFrame, wanted: list[str]) -> DataFrame:
    """Chunks whose id is wanted; only if none is, those at the wanted positions."""
    by_id = chunks.where(F.col("chunk_id").isin(wanted))
    positions = [int(x) for x in wanted if x.lstrip("-").isdigit()]
    return chunks.where(F.col("position").isin(positions)) if by_id.isEmpty() else by_id


def embeddable(results: DataFrame) -> DataFrame:
    """Done results whose summary is not blank."""
    return results.where((F.col("status") == "done") & (strip(F.coalesce("summary", F.lit(""))) != ""))


def to_records(results: DataFrame, meta: DataFrame) -> DataFrame:
    """KB records from embedded results (with ``position`` and ``vector``) and per-file (title, participants)."""
    rows = results.join(meta.select("file_id", "title", F.col("participants").alias("_people")), "file_id", "left")
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    empty = F.array().cast("array<string>")
    return rows.select(
        F.coalesce(blank("chunk_id"), F.concat_ws("_", F.col("file_id").cast("string"), F.col("position").cast("string"))).alias("chunk_id"), "file_id",
        F.coalesce(blank("title"), F.concat(F.lit("id_"), F.col("file_id").cast("string"))).alias("file_name"), F.coalesce("start_time", F.lit("")).alias("start_time"), F.coalesce("end_time", F.lit("")).alias("end_time"),
        "summary", F.coalesce("text_content", F.lit("")).alias("text_content"), F.coalesce("tags", empty).alias("tags"), F.coalesce("_people", empty).alias("participants"), "vector", F.coalesce(blank("boundary_type"), F.lit("unknown")).alias("boundary_type"),
    )


def bypass_records(results: DataFrame, meta: DataFrame, dim: int) -> DataFrame:
    """Records of done results with zero vectors and no participants."""
    rows = results.where("status = 'done'").withColumn("vector", zero_vector(dim)).withColumn("boundary_type", F.coalesce("boundary_type", F.lit("summary")))
    return to_records(rows, meta.select("file_id", "title", F.array().cast("array<string>").alias("participants")))


def opening_text(entries: DataFrame, k: int) -> DataFrame:
    """The first ``k`` entries of each file, one a line: what participants are told from."""
    first = entries.withColumn("_k", F.row_number().over(Window.partitionBy("file_id").orderBy("idx"))).where(F.col("_k") <= k)
    return first.groupBy("file_id").agg(joined_text(F.col("idx"), F.col("text"), "\n").alias("opening"))


def record_violation(dim: int) -> Column:
    """The first rule that a record breaks, or null."""
    checks = [(F.col(c).isNull(), f"missing {c}") for c in RECORD.names]
    checks += [(F.exists(c, lambda x: x.isNull()), f"{c} must be strings") for c in ("tags", "participants")]
    checks += [(F.size("vector") != dim, f"vector must have {dim} numbers"), (~is_valid_vector(F.col("vector"), dim), "vector must be finite")]
    rule = F.when(checks[0][0], checks[0][1])
    for when, what in checks[1:]:
        rule = rule.when(when, what)
    return rule


def check_records(records: DataFrame, dim: int) -> DataFrame:
    """The records, if all are valid; else the first violation by position is raised."""
    require_columns(records, RECORD.names)
    bad = records.withColumn("_v", record_violation(dim)).where("_v IS NOT NULL")
    first = bad.orderBy("position" if "position" in records.columns else "chunk_id").select("chunk_id", "_v").first()
    if first:
        raise GateError(f"record {first[0]}: {first[1]}")
    return records


def require_columns(table: DataFrame, names: list[str]) -> None:
    """Further columns are allowed, and types are not compared."""
    missing = sorted(set(names) - set(table.columns))
    if missing:
        raise GateError(f"missing columns: {', '.join(missing)}")


def check_results(results: DataFrame) -> None:
    """No done chunk, or any failed one, blocks the next phase; other states do not."""
    done, failed = results.agg(F.count_if(F.col("status") == "done"), F.count_if(F.col("status").isin(FAILED))).first()
    if not done:
        raise GateError("no chunk is done")
    if failed:
        raise GateError(f"{failed} chunks failed")


def check_count(rows: DataFrame, expected: int) -> None:
    """V04, V05."""
    if (n := rows.count()) != expected:
        raise GateError(f"{n} rows instead of {expected}")


def check_not_empty(rows: DataFrame, what: str) -> None:
    """V08, V10, V11."""
    if rows.isEmpty():
        raise GateError(f"no {what}")


def check_json_array(text: str) -> list:
    """The elements of a JSON array; anything else is refused."""
    try:
        found = json.loads(text)
    except json.JSONDecodeError as e:
        raise GateError(f"not JSON: {e}") from e
    if not isinstance(found, list):
        raise GateError(f"a JSON array is wanted, not {type(found).__name__}")
    return found
