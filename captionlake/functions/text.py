"""Text expressions (F01-F25): trimming, SRT times, error normalisation, JSON in prose, ids and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_RANGE = r"(\d{2}:\d{2}:\d{2},\d{3})\s*-->\s*(\d{2}:\d{2}:\d{2},\d{3})"
#: Fixed values, in order: short numbers go before times and addresses, which therefore keep little of their shape.
ERROR_PATTERNS = [
    (r"/[\w/.\-]+", "/PATH"),
    (r"\b\d{1,5}\b", "ID"),
    (r"\d{4}-\d{2}-\d{2}[T\s]\d{2}:\d{2}:\d{2}", "TIMESTAMP"),
    (r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}", "IP"),
    (r"(?i)\b[0-9A-F]{8,}\b", "HASH"),
]


def strip(text: Column) -> Column:
    """Without white space (of any script) at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def srt_seconds(time: Column) -> Column:
    """``HH:MM:SS,mmm`` as seconds; null if malformed."""
    part = lambda i: F.regexp_extract(time, r"^(\d+):(\d{2}):(\d{2}),(\d{3})$", i).try_cast("double")
    return part(1) * 3600 + part(2) * 60 + part(3) + part(4) / 1000


def format_srt_time(seconds: Column) -> Column:
    ms = F.round(seconds * 1000).cast("bigint")
    unit = lambda size, n, w: F.lpad((F.floor(ms / size) % n).cast("string"), w, "0")
    return F.concat(F.lpad(F.floor(ms / 3_600_000).cast("string"), 2, "0"), F.lit(":"), unit(60_000, 60, 2), F.lit(":"), unit(1000, 60, 2), F.lit(","), F.lpad((ms % 1000).cast("string"), 3, "0"))


def normalize_error(message: Column) -> Column:
    """A message with ids, hashes, paths and the like replaced, cut to 150 characters."""
    for pattern, mark in ERROR_PATTERNS:
        message = F.regexp_replace(message, pattern, mark)
    return F.substring(message, 1, 150)


def first_json_object(text: Column, nested: bool = True) -> Column:
    """The text from the first to the last brace, or the first object without braces inside; null if none."""
    found = F.regexp_extract(text, r"(?s)\{.*\}" if nested else r"\{[^{}]*\}", 0)
    return F.when(found != "", found)


def ratio(done: Column, total: Column, scale: float = 1.0) -> Column:
    """``scale * done / total``, zero where there is nothing to divide by."""
    return F.when(total > 0, scale * done / total).otherwise(F.lit(0.0))


def per_second(amount: Column, elapsed: Column) -> Column:
    """Rounded half-even to one place; null where no time passed."""
    return F.when(elapsed > 0, F.bround(amount / elapsed, 1))


def chunk_id(file_id: Column, start: Column) -> Column:
    return F.concat_ws("_", file_id.cast("string"), start.cast("string"))


def chunk_suffix(chunk: Column) -> Column:
    return F.element_at(F.split(chunk, "_"), -1).try_cast("int")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"\.[^.]*$", "")


def parent_name(path: Column) -> Column:
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def utc_timestamp(text: Column) -> Column:
    """ISO time; no zone means UTC; null if malformed (sessions run in UTC)."""
    return F.try_to_timestamp(F.regexp_replace(text, "Z$", "+00:00"))


def age_seconds(then: Column, as_of: Column) -> Column:
    return (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(then.cast("timestamp"))) / F.lit(1e6)


def redact_secrets(message: Column, secrets: list[str]) -> Column:
    for secret in secrets:
        message = F.replace(message, F.lit(secret), F.lit("***REDACTED***"))
    return message


def resolve_path(template: Column, data_dir: str, root: str) -> Column:
    return F.replace(F.replace(template, F.lit("{SRT_DATA_DIR}"), F.lit(data_dir)), F.lit("{SRT_PROJECT_ROOT}"), F.lit(root))


def report_label(path: Column, file_id: Column) -> Column:
    """Label of a report by its file name: what follows its first two parts between underscores.

    A name of fewer than four parts, or whose rest is only the last part of the name without
    ``_test_report`` and the file's id, says nothing: ``unknown``.
    """
    parts = F.split(stem(path), "_")
    rest = F.array_join(F.slice(parts, 3, F.size(parts)), "_")
    name = F.replace(F.replace(stem(path), F.lit("_test_report"), F.lit("")), F.concat(F.lit("_"), file_id.cast("string")), F.lit(""))
    last = F.element_at(F.split(F.ltrim(name, F.lit("_")), "_"), -1)
    return F.when((F.size(parts) >= 4) & (rest != "") & (rest != last), rest).otherwise("unknown")


def round_robin(models: Column, k: Column) -> Column:
    return F.try_element_at(models, (k % F.size(models)).cast("int") + 1)


def grade(score: Column) -> Column:
    return F.when(score >= 90, "A").when(score >= 80, "B").when(score >= 70, "C").when(score >= 50, "D").otherwise("F")


def numbered_line(k: Column, start: Column, end: Column, text: Column) -> Column:
    return F.concat(F.lit("["), k.cast("string"), F.lit("] "), start, F.lit(" → "), end, F.lit(": "), text)


def preview(status: Column, summary: Column, errors: Column) -> Column:
    """First 100 characters of a done chunk's summary, or of a failed one's errors."""
    told = F.array_join(F.transform(errors, lambda e: F.concat(F.lit("["), e["model"], F.lit("] "), e["message"])), " | ")
    return F.when(status == "done", F.substring(summary, 1, 100)).when(status == "failed", F.substring(told, 1, 100))
