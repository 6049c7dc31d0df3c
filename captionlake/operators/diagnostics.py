"""Per-model performance and errors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from captionlake.functions.text import per_second, ratio
from captionlake.schemas import FAILED


def model_performance(chunks: DataFrame) -> DataFrame:
    """Audit view over (model_used, status, char_count, elapsed_sec, retry_count): time counts for done chunks only."""
    done, fail = F.col("status") == "done", F.col("status").isin(FAILED)
    rows = chunks.groupBy(F.coalesce("model_used", F.lit("?")).alias("model")).agg(
        F.count_if(done).alias("success"), F.count_if(fail).alias("fail"), F.coalesce(F.sum("char_count"), F.lit(0)).cast("bigint").alias("total_chars"),
        F.coalesce(F.sum(F.when(done, F.col("elapsed_sec"))), F.lit(0.0)).alias("total_elapsed"), F.coalesce(F.sum("retry_count"), F.lit(0)).cast("bigint").alias("retries"),
    )
    rate = F.bround(ratio(F.col("success"), F.col("success") + F.col("fail"), 100.0), 1)
    return rows.select("*", rate.alias("success_rate"), per_second(F.col("total_chars"), F.col("total_elapsed")).alias("chars_per_sec"))


def model_diagnostics(chunks: DataFrame, errors: DataFrame) -> DataFrame:
    """Pipeline view: characters and time over all chunks; each error is charged to its own model on top of failed chunks (A10)."""
    done = F.col("status") == "done"
    used = chunks.groupBy(F.col("model_used").alias("model")).agg(
        F.count_if(done).alias("success"), F.count_if(F.col("status").isin(FAILED)).alias("failed_chunks"), F.sum("char_count").cast("bigint").alias("chars"),
        F.sum("elapsed_sec").alias("elapsed"), F.sum(F.when(done, F.col("char_count"))).cast("bigint").alias("done_chars"), F.sum(F.when(done, F.col("elapsed_sec"))).alias("done_elapsed"),
    )
    charged = errors.groupBy("model").agg(F.count("*").alias("n_errors"))
    both = used.join(charged, "model", "full_outer").fillna(0, ["success", "failed_chunks", "n_errors", "chars", "elapsed", "done_chars", "done_elapsed"])
    fail = F.col("failed_chunks") + F.col("n_errors")
    return both.select(
        "model", "success", fail.alias("fail"), F.bround(ratio(F.col("success"), F.col("success") + fail, 100.0), 1).alias("success_rate"),
        per_second(F.col("chars"), F.col("elapsed")).alias("cps_overall"), per_second(F.col("done_chars"), F.col("done_elapsed")).alias("cps_actual"),
    )


def top_errors(errors: DataFrame, top: int = 5, width: int = 120) -> DataFrame:
    """The most frequent messages of each model, cut to ``width``; ties by message."""
    counted = errors.select("model", F.substring("message", 1, width).alias("message")).groupBy("model", "message").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("model").orderBy(F.col("n").desc(), "message"))
    return counted.withColumn("place", place).where(F.col("place") <= top)


def top_failed_models(performance: DataFrame) -> DataFrame:
    """Models with failures, most first; ties by name."""
    return performance.where("fail > 0").orderBy(F.col("fail").desc(), "model")


def run_summary(records: DataFrame, elapsed_sec: float) -> DataFrame:
    """Records, characters of summaries and characters a second."""
    rows = records.agg(F.count("*").alias("records"), F.coalesce(F.sum(F.length("summary")), F.lit(0)).cast("bigint").alias("total_chars"))
    return rows.select("*", F.lit(elapsed_sec).alias("elapsed_sec"), per_second(F.col("total_chars"), F.lit(elapsed_sec)).alias("chars_per_sec"))


def run_stats(results: DataFrame) -> DataFrame:
    """One row of a run over chunk results (status, model_used, errors as (model, message)): chunks, done and failed ones, done ones by model, and errors by their first 80 characters."""
    failed = F.col("status").isin(FAILED)
    totals = results.agg(F.count("*").alias("total_chunks"), F.count_if(F.col("status") == "done").alias("success"), F.count_if(failed).alias("failed"))
    models = results.where("status = 'done'").groupBy(F.coalesce("model_used", F.lit("?")).alias("k")).agg(F.count("*").alias("v"))
    said = results.select(F.explode("errors").alias("e")).groupBy(F.substring("e.message", 1, 80).alias("k")).agg(F.count("*").alias("v"))
    # models are configured, and messages are cut to what a document can list
    listed = lambda rows, name: rows.orderBy(F.col("v").desc(), "k").limit(1000).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias(name))
    return totals.join(listed(models, "model_stats")).join(listed(said, "error_distribution"))
