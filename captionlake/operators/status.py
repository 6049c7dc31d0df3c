"""The file state machine and its analytics: transitions, timeouts, slots, histograms, progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from captionlake.config import WatchParams
from captionlake.functions.text import age_seconds, normalize_error, ratio
from captionlake.operators.ordered import mean_of_last, place, running
from captionlake.schemas import ACTIVE, FAILED, NEXT_PHASE, QUEUED, TRANSITIONS


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv]), key)


def transition_verdict(current: Column, wanted: Column) -> Column:
    """``same``, ``accepted`` or ``refused`` for one wanted transition."""
    allowed = F.array_contains(F.split(F.coalesce(_lookup({k: ",".join(v) for k, v in TRANSITIONS.items()}, current), F.lit("")), ","), wanted)
    return F.when(current == wanted, "same").when(wanted.isin(FAILED), "accepted").when(allowed, "accepted").otherwise("refused")


def apply_transition(files: DataFrame, params: WatchParams = WatchParams()) -> DataFrame:
    """New status and retry count from (status, wanted, retry_count, all_processed, all_failed).

    ``failed_permanent`` is held back while all chunks are processed and not all failed for good;
    a failed file that goes back to ``undone`` counts a retry and is failed for good at the limit.
    """
    verdict = transition_verdict(F.col("status"), F.col("wanted"))
    held = (F.col("wanted") == "failed_permanent") & F.col("all_processed") & ~F.col("all_failed")
    again = (F.col("status") == "failed") & (F.col("wanted") == "undone")
    retries = F.when(again, F.col("retry_count") + 1).otherwise(F.col("retry_count"))
    new = F.when(held | (verdict == "refused"), F.col("status")).when(again & (retries >= params.max_retries), "failed_permanent").otherwise(F.col("wanted"))
    return files.select("*", verdict.alias("verdict"), new.alias("new_status"), retries.alias("new_retry_count"))


def state_transitions(events: DataFrame) -> DataFrame:
    """(file_id, seq, status, previous, verdict) of status events (file_id, ts, seq, status), by order of time."""
    order = Window.partitionBy("file_id").orderBy("ts", "seq")
    rows = events.withColumn("previous", F.lag("status").over(order)).where("previous IS NOT NULL")
    return rows.select("file_id", "seq", "status", "previous", transition_verdict(F.col("previous"), F.col("status")).alias("verdict"))


def latest_status(events: DataFrame) -> DataFrame:
    """Each file's last event: the current state by one aggregation, without a sort."""
    return events.groupBy("file_id").agg(F.max_by(F.struct("status", "ts"), F.struct("ts", "seq")).alias("s")).select("file_id", "s.status", F.col("s.ts").alias("last_updated"))


def status_histogram(files: DataFrame, first: int = 5) -> DataFrame:
    """Files by status with the smallest ids of each (A06, O06). Counts are combined, and ids cut, before they are shuffled."""
    nth = F.row_number().over(Window.partitionBy("status").orderBy("file_id"))
    few = files.select("status", "file_id").withColumn("k", nth).where(F.col("k") <= first)
    named = few.groupBy("status").agg(F.array_join(F.array_sort(F.collect_list("file_id")).cast("array<string>"), ",").alias("first_ids"))
    counted = files.groupBy("status").agg(F.count("*").alias("n"))
    named = named.withColumnRenamed("status", "_status")
    return counted.join(named, F.col("status").eqNullSafe(F.col("_status")), "left").drop("_status")


def success_rate(files: DataFrame) -> DataFrame:
    """Done files over all, in percent."""
    rows = files.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "done").alias("done"))
    return rows.select("total", "done", F.bround(ratio(F.col("done"), F.col("total"), 100.0), 2).alias("success_pct"))


def stuck_files(files: DataFrame, as_of: Column, params: WatchParams = WatchParams()) -> DataFrame:
    """Active files that nobody owns, older than the limit: they go back to undone without a retry (T03). ``owner``, if there is one, names who works on a file."""
    age = age_seconds(F.col("last_updated"), as_of)
    free = F.col("owner").isNull() if "owner" in files.columns else F.lit(True)
    rows = files.where(F.col("status").isin(ACTIVE) & free).withColumn("age_sec", age).where(F.col("age_sec") > params.stuck_sec)
    return rows.withColumn("new_status", F.lit("undone"))


def watchdog(files: DataFrame, as_of: Column, params: WatchParams = WatchParams()) -> DataFrame:
    """Timeouts of (status, last_updated, retry_count): any state at work that is old goes back with a retry, or fails for good.

    Where files have an ``error_log``, a timeout is added to it as ``new_error_log``.
    """
    watched = ~F.col("status").isin("undone", "done", "failed_permanent", *QUEUED)
    age = age_seconds(F.col("last_updated"), as_of)
    old = F.coalesce(watched & (age >= params.stuck_sec), F.lit(False))
    retries = F.col("retry_count") + F.when(old, 1).otherwise(0)
    new = F.when(old & (retries >= params.max_retries), "failed_permanent").when(old, "undone").otherwise(F.col("status"))
    columns = ["*", old.alias("timed_out"), new.alias("new_status"), retries.alias("new_retry_count")]
    if "error_log" in files.columns:
        entry = F.struct(F.date_format(as_of.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("time"), F.col("status").alias("from_status"), F.format_string("timeout in '%s' after %ss", "status", F.floor(age).cast("string")).alias("error"), F.lit(None).cast("string").alias("used_model"))
        log = F.coalesce("error_log", F.array().cast(files.schema["error_log"].dataType))
        columns.append(F.when(old, F.array_append(log, entry)).otherwise(log).alias("new_error_log"))
    return files.select(*columns)


def next_phase(status: Column) -> Column:
    """The phase a file waits for; null if none."""
    return _lookup(NEXT_PHASE, status)


def slot_allocation(waiting: DataFrame, slots: int) -> DataFrame:
    """First come, first served: (phase, file_id, arrival) with place in line and whether it gets a slot."""
    return place(waiting, ["phase"], ["arrival", "file_id"]).withColumn("granted", F.col("place") <= slots)


def retry_candidates(chunks: DataFrame, params: WatchParams = WatchParams()) -> DataFrame:
    """Failed chunks with retries left."""
    return chunks.where((F.col("status") == "failed") & (F.coalesce("retry_count", F.lit(0)) < params.max_retries))


def chunk_retry_outcome(chunks: DataFrame) -> DataFrame:
    """After attempts (status, retry_count, attempts, succeeded): new chunk status and count, and whether the whole file failed for good."""
    new = F.when(F.col("succeeded"), "done").otherwise("failed_permanent")
    count = F.col("retry_count") + F.when(F.col("succeeded"), 1).otherwise(F.col("attempts"))
    rows = chunks.withColumn("new_status", new).withColumn("new_retry_count", count)
    return rows.withColumn("file_failed", F.every(F.col("new_status") == "failed_permanent").over(Window.partitionBy("file_id")))


def consecutive_failures(events: DataFrame, limit: int = 3) -> DataFrame:
    """Running count of failures per key that warns and starts anew at the limit."""
    rows = running(events, ["key"], ["ts", "seq"], {"_n": F.col("failed").cast("bigint")})
    return rows.withColumn("failures", F.col("_n") % limit).withColumn("warned", F.col("failed") & (F.col("_n") % limit == 0)).drop("_n")


def progress(chunks: DataFrame) -> DataFrame:
    """Files and chunks done, failed and in all."""
    files = chunks.groupBy("file_id").agg(F.every(F.col("status") == "done").alias("done"), F.some(F.col("status").isin(FAILED)).alias("failed"), F.count_if(F.col("status") == "done").alias("ok"), F.count_if(F.col("status").isin(FAILED)).alias("bad"), F.count("*").alias("n"))
    return files.agg(F.count_if("done").alias("files_done"), F.count_if("failed").alias("files_failed"), F.count("*").alias("files"), F.sum("ok").alias("chunks_done"), F.sum("bad").alias("chunks_failed"), F.sum("n").alias("chunks"))


def progress_by_model(chunks: DataFrame, top: int = 3) -> DataFrame:
    """Per model the chunks done and failed, and the most frequent messages of its errors by count, then text (A23). ``chunks`` have model_used, status and errors (array of texts)."""
    model = F.coalesce("model_used", F.lit("?")).alias("model")
    counted = chunks.groupBy(model).agg(F.count_if(F.col("status") == "done").alias("success"), F.count_if(F.col("status").isin(FAILED)).alias("fail"))
    said = chunks.select(model, F.explode("errors").alias("message")).groupBy("model", "message").agg(F.count("*").alias("n"))
    nth = F.row_number().over(Window.partitionBy("model").orderBy(F.col("n").desc(), "message"))
    few = said.withColumn("k", nth).where(F.col("k") <= top).groupBy("model").agg(F.array_sort(F.collect_list(F.struct("k", "message", "n"))).alias("_t"))
    texts = F.transform("_t", lambda x: F.concat_ws(" x", x["message"], x["n"].cast("string")))
    return counted.join(few, "model", "left").select("model", "success", "fail", F.coalesce(texts, F.array().cast("array<string>")).alias("top_errors"))


def throughput_delta(snapshots: DataFrame) -> DataFrame:
    """Chunks a minute since the snapshot before, per series of (series, ts, done); zero if no time passed."""
    order = Window.partitionBy("series").orderBy("ts")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    minutes = (micros - F.lag(micros).over(order)) / F.lit(60e6)
    delta = F.col("done") - F.lag("done").over(order)
    rate = F.when(minutes > 0.016, delta / minutes).otherwise(F.lit(0.0))
    return snapshots.select("series", "ts", "done", F.coalesce(delta, F.lit(0)).alias("delta"), F.coalesce(rate, F.lit(0.0)).alias("per_minute"))


def health_metrics(calls: DataFrame, last: int = 100) -> DataFrame:
    """Per key the running success and error rates and the mean of the last hundred latencies."""
    rows = running(calls, ["key"], ["ts", "seq"], {"_k": F.lit(1).cast("bigint"), "_ok": F.when(F.col("failed"), 0).otherwise(1).cast("bigint")})
    ok = F.col("_ok") / F.col("_k")
    rows = mean_of_last(rows, ["key"], "_k", "latency_ms", "mean_latency_ms", last)
    return rows.select(*calls.columns, ok.alias("success_rate"), (1 - ok).alias("error_rate"), "mean_latency_ms")


def error_patterns(errors: DataFrame, top: int = 10) -> DataFrame:
    """Normalised messages by count; ties by name."""
    return errors.select(normalize_error(F.col("message")).alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "pattern").limit(top)
