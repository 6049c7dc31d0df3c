"""Prompts as columns, and the calls that use them: summaries, participants, line flags and two judges.

A caller's ``ask`` (see :func:`captionlake.operators.hooks.chat_caller`) turns prompts into answers; what
comes back is the first JSON object of an answer, with null for whatever it lacks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captionlake.functions.text import first_json_object

#: The answers' fields and the highest score of each metric.
CHUNK_METRICS = {"boundary_coherence": 10, "boundary_correctness": 10, "noise_handling": 10}
FIDELITY_METRICS = {"factual_accuracy": 25, "completeness": 25, "neutrality": 25, "overall_quality": 25}
_MEANING = {
    "boundary_coherence": "the segment keeps to one subject and reads as connected speech",
    "boundary_correctness": "its first and last line are sensible places to cut",
    "noise_handling": "it was rightly kept, or rightly left out",
    "factual_accuracy": "everything in the summary is supported by the text; nothing is invented",
    "completeness": "the main points of the text are covered",
    "neutrality": "no interpretation, stance or judgement is added",
    "overall_quality": "all of the above taken together",
}


def _said(value: Column | str, default: str = "") -> Column:
    return F.coalesce((F.col(value) if isinstance(value, str) else value).cast("string"), F.lit(default))


def _scale(metrics: dict[str, int]) -> str:
    lines = "\n".join(f"- {name} (0 to {top}): {_MEANING[name]}" for name, top in metrics.items())
    shape = ", ".join(f'"{name}": {{"score": 0, "reason": ""}}' for name in metrics)
    return f"Rate each of these:\n{lines}\nAnswer with one JSON object: {{{shape}, "


def chunk_judge_prompt(left: Column, right: Column) -> Column:
    """Prompt for a segment's judge from its columns and its boundary structs (label, cosine): status, times, size, ends and text."""
    end = lambda name, b: F.concat(F.lit(f"{name}: "), _said(b["label"], "-"), F.lit(" (cosine "), _said(b["cosine"], "-"), F.lit(")\n"))
    status = F.when(F.coalesce(F.col("dropped"), F.lit(False)), "left out").otherwise("kept")
    return F.concat(
        F.lit("Judge one segment of a transcript, as it was cut by an algorithm.\nStatus: "), status, F.lit("\nTime: "), _said("start_time"), F.lit(" → "), _said("end_time"),
        F.lit("\nLines: "), _said("entry_count"), F.lit("\nKind of boundary: "), _said("boundary_type"), F.lit("\n"), end("Left end", left), end("Right end", right),
        F.lit("\nText:\n"), _said("text_content"), F.lit("\n\n" + _scale(CHUNK_METRICS) + '"total_score": 0, "note": ""}'),
    )


def fidelity_prompt(text: Column, summary: Column, model: Column) -> Column:
    """Prompt for the judge of a summary against its text."""
    return F.concat(
        F.lit("Judge whether a summary is true to its text.\nText:\n"), _said(text), F.lit("\n\nSummary (by "), _said(model, "?"), F.lit("):\n"), _said(summary),
        F.lit("\n\n" + _scale(FIDELITY_METRICS) + '"total_score": 0, "hallucinated_content": [], "missing_key_points": [], "note": ""}'),
    )


def summary_prompt(text: Column) -> Column:
    return F.concat(F.lit('Summarise this part of a transcript and give tags. Answer with one JSON object: {"summary": "", "tags": []}\n\n'), _said(text))


def participants_prompt(opening: Column) -> Column:
    return F.concat(F.lit('Who speaks in this opening of a programme? Name hosts and guests, not people who are only talked about. Answer with one JSON object: {"participants": []}\n\n'), _said(opening))


def line_flag_prompt(window: Column) -> Column:
    """Prompt over a window's numbered lines."""
    return F.concat(
        F.lit("Some lines of these subtitles may make no sense, or be garbled by wrong words. Fillers, repeats and broken sentences are normal.\n\n"), _said(window),
        F.lit('\n\nAnswer with one JSON object, by line number: {"flagged_entries": {"3": {"severity": "major or minor", "issue": ""}}}'),
    )


def _schema(metrics: dict[str, int], more: str) -> str:
    return ", ".join(f"{m} struct<score:double,reason:string>" for m in metrics) + ", total_score double, " + more


CHUNK_JUDGEMENT = _schema(CHUNK_METRICS, "note string")
FIDELITY_JUDGEMENT = _schema(FIDELITY_METRICS, "hallucinated_content array<string>, missing_key_points array<string>, note string")


def parsed(answer: Column, schema: str) -> Column:
    """The first JSON object in an answer as a struct; null if there is none."""
    return F.from_json(first_json_object(answer), schema)


def _asked(rows: DataFrame, ask, prompt: Column, key: Column, schema: str) -> DataFrame:
    """``rows`` with ``_a`` (answer, model, retries, error), ``_j`` (the parsed answer) and ``error``."""
    told = rows.withColumn("_a", ask(prompt, F.abs(F.xxhash64(key)) % 1_000_003)).withColumn("_j", parsed(F.col("_a.answer"), schema))
    return told.withColumn("error", F.coalesce("_a.error", F.when(F.col("_j").isNull(), "no object in the answer")))


def _judged(told: DataFrame, metrics: dict[str, int], keep: list[str]) -> DataFrame:
    return told.select(*keep, *[F.col(f"_j.{m}.score").alias(m) for m in metrics], F.col("_j.total_score").alias("total_score"), "error", F.col("_j.note").alias("note"))


def judge_chunks(segments: DataFrame, ask) -> DataFrame:
    """Scores of segments by the chunk judge: file_id, chunk_id, label where there is one, dropped, the metrics, total_score, error, note."""
    told = _asked(segments, ask, chunk_judge_prompt(F.col("left_boundary"), F.col("right_boundary")), F.col("chunk_id"), CHUNK_JUDGEMENT)
    return _judged(told, CHUNK_METRICS, [c for c in ("label", "file_id", "chunk_id", "dropped") if c in segments.columns])


def judge_fidelity(segments: DataFrame, ask) -> DataFrame:
    """Scores of summaries by the fidelity judge, with what it found invented and missing."""
    told = _asked(segments, ask, fidelity_prompt(F.col("text_content"), F.col("summary"), F.col("model_used")), F.col("chunk_id"), FIDELITY_JUDGEMENT)
    keep = [c for c in ("label", "file_id", "chunk_id", "model_used") if c in segments.columns]
    rows = told.withColumns({c: F.coalesce(F.col(f"_j.{c}"), F.array().cast("array<string>")) for c in ("hallucinated_content", "missing_key_points")})
    return _judged(rows, FIDELITY_METRICS, [*keep, "hallucinated_content", "missing_key_points"])


def find_participants(chunks: DataFrame, ask, first: int = 3) -> DataFrame:
    """(file_id, participants) from the first chunks of each file, by ``start_idx``; a failed call gives none."""
    few = chunks.groupBy("file_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("start_idx", "text_content"))), 1, first).alias("c"))
    opening = few.select("file_id", F.array_join(F.transform("c", lambda x: x["text_content"]), "\n").alias("opening"))
    told = _asked(opening, ask, participants_prompt(F.col("opening")), F.col("file_id").cast("string"), "participants array<string>")
    return told.select("file_id", F.coalesce("_j.participants", F.array().cast("array<string>")).alias("participants"))


def flag_lines(windows: DataFrame, ask) -> DataFrame:
    """Flags of windows (with ``prompt``, their numbered lines, and whatever names them): line_no, severity, issue, model; one row a flagged line.

    A line number that is no number fails the whole answer, as one without an object does: no flags.
    """
    told = _asked(windows, ask, line_flag_prompt(F.col("prompt")), F.col("prompt"), "flagged_entries map<string,struct<severity:string,issue:string>>")
    flags = F.map_entries("_j.flagged_entries")
    good = F.forall(F.map_keys("_j.flagged_entries"), lambda k: F.rlike(k, F.lit(r"^\s*[+-]?\d+\s*$")))
    rows = told.select(*windows.columns, F.col("_a.model").alias("model"), F.explode(F.when(good, flags)).alias("e"))
    return rows.select(*windows.columns, "model", F.trim("e.key").alias("line_no"), "e.value.severity", "e.value.issue")
