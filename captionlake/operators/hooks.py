"""Callers' models as pandas UDFs: embeddings in batches, chat answers as JSON, and protection of both."""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captionlake.operators.prompts import parsed
from captionlake.operators.resilience import Breaker, BreakerParams

#: What a caller's embedding client does: one vector for each text, in order; anything else is a failure.
EmbedBatch = Callable[[list[str]], Sequence[Sequence[float]]]


def checked_batch(call: EmbedBatch, texts: list[str], dim: int) -> list[list[float]] | None:
    """The vectors of a batch; none if the call fails, or gives another number of vectors or of numbers."""
    try:
        vectors = [list(map(float, v)) for v in call(texts)]
    except Exception:
        return None
    return vectors if len(vectors) == len(texts) and all(len(v) == dim for v in vectors) else None


def embed_halving(call: EmbedBatch, texts: list[str], dim: int) -> list[list[float] | None]:
    """A failed batch is tried again in halves, down to single texts; those that fail alone have no vector."""
    if not texts:
        return []
    vectors = checked_batch(call, texts, dim)
    if vectors is not None:
        return vectors
    if len(texts) == 1:
        return [None]
    half = len(texts) // 2
    return embed_halving(call, texts[:half], dim) + embed_halving(call, texts[half:], dim)


def batch_embedder(call: EmbedBatch, dim: int, batch: int = 64):
    """A pandas UDF over texts; null texts are not sent."""

    @F.pandas_udf("array<float>")
    def embed(texts: pd.Series) -> pd.Series:
        out: list = [None] * len(texts)
        sent = [i for i, t in enumerate(texts) if t is not None]
        for at in range(0, len(sent), batch):
            some = sent[at : at + batch]
            for i, v in zip(some, embed_halving(call, [texts.iloc[i] for i in some], dim)):
                out[i] = v
        return pd.Series(out)

    return embed


def backoff(attempt: int, base: float = 1.0) -> float:
    """Seconds to wait after an attempt, from 0."""
    return base * 2.0**attempt


#: Breakers of this Python worker, by the id that a caller was made with.
_breakers: dict[str, Breaker] = {}


def chat_caller(call: Callable[[str, str], str], models: list[str], attempts: int = 3, wait: float = 1.0, breaker: BreakerParams | None = None):
    """A pandas UDF (prompt, key) to (answer, model, retries, error): each attempt takes the next model, starting by key.

    With ``breaker``, each Python worker stops calling for a while after failures, over all its batches, and lets
    only so many calls through when it tries again, as :class:`Breaker` says.
    """
    name = uuid.uuid4().hex

    @F.pandas_udf("answer string, model string, retries int, error string")
    def ask(prompts: pd.Series, keys: pd.Series) -> pd.DataFrame:
        guard = _breakers.setdefault(name, Breaker(breaker)) if breaker else None
        rows = []
        for prompt, key in zip(prompts, keys):
            error, model, n, answer = None, None, 0, None
            for n in range(attempts):
                model = models[(int(key) + n) % len(models)]
                if guard and not guard.admits(time.monotonic()):
                    error = "circuit open"
                    break
                try:
                    answer, error = call(model, prompt), None
                except Exception as e:  # noqa: BLE001
                    error = str(e)[:500]
                if guard:
                    guard.call(time.monotonic(), error is None)
                if error is None:
                    break
                if n + 1 < attempts:
                    time.sleep(backoff(n, wait))
            rows.append((answer, model, n, error))
        return pd.DataFrame(rows, columns=["answer", "model", "retries", "error"])

    return ask


SUMMARY = "summary string, tags array<string>"


def summarize_chunks(chunks: DataFrame, ask, prompt: Column) -> DataFrame:
    """Summarised chunks: ``status`` done if the answer has a summary, else failed with the error."""
    asked = chunks.withColumn("_a", ask(prompt, F.abs(F.xxhash64("chunk_id")) % 1_000_003))
    told = asked.withColumn("_j", parsed(F.col("_a.answer"), SUMMARY))
    done = F.col("_a.error").isNull() & (F.coalesce(F.col("_j.summary"), F.lit("")) != "")
    error = F.coalesce("_a.error", F.when(~done, "no summary in the answer"))
    return told.select(
        *chunks.columns, F.when(done, F.col("_j.summary")).alias("summary"), F.when(done, F.col("_j.tags")).alias("tags"), F.when(done, "done").otherwise("failed").alias("status"), F.col("_a.model").alias("model_used"), F.col("_a.retries").alias("retry_count"),
        F.when(~done, F.array(F.struct(F.col("_a.model").alias("model"), error.alias("message")))).otherwise(F.array().cast("array<struct<model:string,message:string>>")).alias("errors"), F.sha2("text_content", 256).alias("source_text_hash"), F.length("text_content").alias("char_count"),
    )


def stress_batches(call: EmbedBatch, texts: list[str], dim: int, sizes: Sequence[int] = (2, 8, 16, 32, 64, 128)) -> list[dict]:
    """Mean latency and throughput of an embedding client by batch size."""
    out = []
    for size in sizes:
        times, failed = [], 0
        for at in range(0, len(texts), size):
            start = time.perf_counter()
            failed += checked_batch(call, texts[at : at + size], dim) is None
            times.append(time.perf_counter() - start)
        total = math.fsum(times)
        out.append({"batch_size": size, "latency_ms": 1000 * total / max(len(times), 1), "throughput_per_sec": len(texts) / total if total else 0.0, "failed_batches": failed})
    return out
