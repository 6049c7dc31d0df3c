"""Queries of the core operators over the driver's tables, each with its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captionlake.config import ChunkParams
from captionlake.functions import text as fx
from captionlake.functions.vectors import is_valid_vector
from captionlake.operators import audit, chunking, diagnostics, evaluation, quality, resilience, status, summaries
from captionlake.plans import bindings as b
from captionlake.plans.registry import QUERIES, SQL, query
from captionlake.schemas import TRANSITIONS
from captionlake.sources.manifest import preflight
from captionlake.sources.srt import parse_srt, write_srt
from captionlake.sources.tables import merge_upsert
from captionlake.workspace import materialize

#: Smart merge over the embeddings: windows of three, wide bands, short distances.
MERGE = ChunkParams(window_size=3, min_sentences=4, high_pct=0.3, low_pct=0.05)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)


def _load() -> None:
    """Register the queries of the other modules."""
    from captionlake.plans import audit_queries, gate_queries, source_queries  # noqa: F401


# --- sources and windows -------------------------------------------------------------------------

_CLOCK = "printf('%02d:%02d:%02d,000', (3 * idx + {k}) // 3600, ((3 * idx + {k}) // 60) % 60, (3 * idx + {k}) % 60)"


@query(f"""WITH {b.LINES}, kept AS (SELECT * FROM lines WHERE regexp_matches(text, '[^\\x00-\\x20]'))
SELECT file_id, CAST(row_number() OVER (PARTITION BY file_id ORDER BY idx) - 1 AS INTEGER) AS idx, {_CLOCK.format(k=0)} AS start_time, {_CLOCK.format(k=3)} AS end_time,
  trim(text, ' ') AS text, CAST(3 * idx AS DOUBLE) AS start_sec FROM kept""")
def srt_parse(spark, d):
    entries = b.lines(spark, d).where(F.rlike("text", F.lit(r"[^\x00-\x20]")))
    clock = lambda k: fx.format_srt_time(F.col("idx") * 3 + k)
    blobs = write_srt(entries.select("file_id", "idx", clock(0).alias("start_time"), clock(3).alias("end_time"), "text"))
    return parse_srt(blobs).select("*", fx.srt_seconds(F.col("start_time")).alias("start_sec"))


@query(f"""WITH {b.LINES}, w AS (SELECT file_id, idx, list(text) OVER (PARTITION BY file_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS l FROM lines)
SELECT file_id, idx AS i, array_to_string(l, ' ') AS text FROM w WHERE len(l) = 5""")
def sliding_windows(spark, d):
    return chunking.sliding_windows(b.lines(spark, d), 5)


_PAIRS = f"""{b.VECTORS}, ahead AS (SELECT file_id, i, v, lead(v, 3) OVER (PARTITION BY file_id ORDER BY i) AS nv FROM vectors),
pairs AS (SELECT file_id, i, CAST(i + 3 AS INTEGER) AS pos, list_cosine_similarity(v, nv) AS similarity, 1 - list_cosine_similarity(v, nv) AS strength FROM ahead WHERE nv IS NOT NULL)"""


@query(f"WITH {_PAIRS} SELECT file_id, i, pos, round(similarity, 6) AS similarity, round(strength, 6) AS strength FROM pairs")
def window_similarity(spark, d):
    return chunking.window_similarity(b.vectors(spark, d), 3).select("file_id", "i", "pos", F.round("similarity", 6).alias("similarity"), F.round("strength", 6).alias("strength"))


_RANKED = f"""{_PAIRS}, numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY file_id ORDER BY strength DESC, i) AS INTEGER) AS rank, count(*) OVER (PARTITION BY file_id) AS n_pairs FROM pairs),
cuts AS (SELECT *, greatest(1, CAST(floor(n_pairs * CAST(0.05 AS DOUBLE)) AS BIGINT)) AS low_cut, greatest(1, CAST(floor(n_pairs * CAST(0.3 AS DOUBLE)) AS BIGINT)) AS high_cut FROM numbered),
ranked AS (SELECT *, CASE WHEN rank <= low_cut THEN 'absolute' WHEN rank <= high_cut THEN 'candidate' ELSE 'none' END AS band,
  max(CASE WHEN rank = least(low_cut, n_pairs - 1) + 1 THEN strength END) OVER (PARTITION BY file_id) AS threshold,
  round_even(rank / n_pairs * 100, 1) AS strength_pct FROM cuts)"""


def _ranked(spark, d):
    return chunking.rank_breaks(chunking.window_similarity(b.vectors(spark, d), 3), MERGE)


def _vector_sizes(spark, d):
    """Entries behind the vectors: windows of three end two entries after the last begins."""
    return b.vectors(spark, d).groupBy("file_id").agg((F.count("*") + 2).cast("int").alias("n"))


@query(f"WITH {_RANKED} SELECT file_id, pos, rank, low_cut, high_cut, band, round(threshold, 6) AS threshold, strength_pct FROM ranked")
def break_rank_bands(spark, d):
    return _ranked(spark, d).select("file_id", "pos", "rank", "low_cut", "high_cut", "band", F.round("threshold", 6).alias("threshold"), "strength_pct")


_BREAKS = f"""{_RANKED}, vsizes AS (SELECT file_id, CAST(count(*) + 2 AS INTEGER) AS n FROM vectors GROUP BY file_id),
picked AS (SELECT file_id, list(pos ORDER BY pos) FILTER (WHERE band = 'absolute') AS absolute, list([pos] ORDER BY rank DESC) FILTER (WHERE band = 'candidate') AS pending FROM ranked GROUP BY file_id),
chosen AS (SELECT p.file_id, n, list_sort(list_reduce(list_prepend(list_concat([0, n], absolute), coalesce(pending, [])),
  lambda l, c: CASE WHEN c[1] - list_max(list_filter(l, lambda x: x <= c[1])) >= 4 AND list_min(list_filter(l, lambda x: x > c[1])) - c[1] >= 4 THEN list_append(l, c[1]) ELSE l END)) AS breaks
  FROM picked p JOIN vsizes s ON p.file_id = s.file_id)"""


@query(f"WITH {_BREAKS} SELECT file_id, n, array_to_string(breaks, ',') AS breaks FROM chosen")
def smart_merge_breaks(spark, d):
    found = chunking.choose_breaks(_ranked(spark, d), _vector_sizes(spark, d), MERGE)
    return found.select("file_id", "n", F.array_join(F.col("breaks").cast("array<string>"), ",").alias("breaks"))


_SEGMENTS = f"""{_BREAKS}, cut AS (SELECT file_id, n, unnest(breaks) AS start_idx FROM chosen), spans AS (SELECT * FROM (SELECT file_id, n, start_idx, lead(start_idx) OVER (PARTITION BY file_id ORDER BY start_idx) AS end_idx FROM cut) WHERE end_idx IS NOT NULL),
thresholds AS (SELECT file_id, max(threshold) AS threshold FROM ranked GROUP BY file_id),
segments AS (SELECT s.file_id, start_idx, end_idx, CAST(end_idx - start_idx AS INTEGER) AS entry_count, t.threshold,
  CASE WHEN start_idx = 0 THEN '檔案起點' ELSE coalesce(CAST(l.strength_pct AS VARCHAR) || '%', '-') END AS left_label, CASE WHEN end_idx = n THEN '檔案終點' ELSE coalesce(CAST(r.strength_pct AS VARCHAR) || '%', '-') END AS right_label,
  round_even(l.strength, 4) AS left_strength, round_even(r.strength, 4) AS right_strength
  FROM spans s JOIN thresholds t ON s.file_id = t.file_id LEFT JOIN ranked l ON l.file_id = s.file_id AND l.pos = s.start_idx LEFT JOIN ranked r ON r.file_id = s.file_id AND r.pos = s.end_idx)"""


def _segments(spark, d):
    return chunking.cut_segments(_ranked(spark, d), _vector_sizes(spark, d), MERGE)


@query(f"WITH {_SEGMENTS} SELECT CAST(file_id AS VARCHAR) || '_' || CAST(start_idx AS VARCHAR) AS chunk_id, start_idx, end_idx, entry_count, left_label, right_label, left_strength, right_strength FROM segments")
def smart_merge_segments(spark, d):
    return _segments(spark, d).select(
        fx.chunk_id(F.col("file_id"), F.col("start_idx")).alias("chunk_id"), "start_idx", "end_idx", "entry_count", F.col("left_boundary.label").alias("left_label"), F.col("right_boundary.label").alias("right_label"),
        F.col("left_boundary.strength").alias("left_strength"), F.col("right_boundary.strength").alias("right_strength"),
    )


_NOISE = f"""{_SEGMENTS}, noise AS (SELECT *, CASE WHEN entry_count <= 2 THEN 'noise_too_short (<= 2 lines)'
  WHEN entry_count = 3 AND coalesce(left_strength, 0) >= threshold AND coalesce(right_strength, 0) >= threshold THEN 'noise_weak_links (both ends below strong threshold)' END AS drop_reason FROM segments)"""


@query(f"WITH {_NOISE} SELECT file_id, start_idx, entry_count, drop_reason IS NOT NULL AS dropped, drop_reason FROM noise")
def noise_filter(spark, d):
    return chunking.noise_filter(_segments(spark, d), MERGE).select("file_id", "start_idx", "entry_count", "dropped", "drop_reason")


@query(f"""WITH {_NOISE} SELECT file_id, count(*) AS n_chunks, min(entry_count) AS min_size, max(entry_count) AS max_size, round_even(avg(entry_count), 2) AS mean_size, round_even(median(entry_count), 2) AS median_size
FROM noise WHERE drop_reason IS NULL GROUP BY file_id""")
def chunk_size_stats(spark, d):
    return chunking.chunk_size_stats(chunking.noise_filter(_segments(spark, d), MERGE))


# --- quality -------------------------------------------------------------------------------------

_WINDOWS = f"""{b.SIZES}, strided AS (SELECT file_id, n, unnest(generate_series(0, n - 1, 5)) AS s FROM sizes),
windows AS (SELECT file_id, CAST(s AS INTEGER) AS window_start, CAST(least(10, n - s) AS INTEGER) AS num_entries FROM strided WHERE least(10, n - s) >= 5
UNION ALL SELECT file_id, 0, CAST(least(n, 15) AS INTEGER) FROM sizes WHERE n > 10
UNION ALL SELECT file_id, CAST(n - 15 AS INTEGER), 15 FROM sizes WHERE n > 15)"""


@query(f"WITH {_WINDOWS} SELECT file_id, window_start, num_entries FROM windows")
def quality_windows(spark, d):
    return quality.quality_windows(b.sizes(spark, d))


_COVERAGE = f"{_WINDOWS}, coverage AS (SELECT l.file_id, l.idx, count(w.window_start) AS coverage FROM lines l LEFT JOIN windows w ON l.file_id = w.file_id AND l.idx >= w.window_start AND l.idx < w.window_start + w.num_entries GROUP BY l.file_id, l.idx)"


@query(f"WITH {_COVERAGE} SELECT file_id, idx, coverage FROM coverage")
def line_coverage(spark, d):
    sizes = b.sizes(spark, d)
    return quality.line_coverage(quality.quality_windows(sizes), sizes)


_VOTES = f"{b.FLAGS}, votes AS (SELECT file_id, group_label, window_start, line_no, severity, issue FROM (SELECT *, row_number() OVER (PARTITION BY file_id, group_label, window_start, line_no ORDER BY severity <> 'major', model) AS k FROM flags) WHERE k = 1)"


@query(f"WITH {b.LINES}, {_VOTES} SELECT file_id, group_label, window_start, line_no, severity, issue FROM votes")
def vote_merge(spark, d):
    return quality.merge_votes(b.flags(spark, d))


_ABSOLUTE = f"{_VOTES}, placed AS (SELECT v.*, v.window_start + CAST(line_no AS INTEGER) - 1 AS idx FROM votes v JOIN windows w ON v.file_id = w.file_id AND v.window_start = w.window_start WHERE CAST(line_no AS INTEGER) BETWEEN 1 AND w.num_entries)"


def _placed(spark, d):
    return quality.absolute_flags(quality.merge_votes(b.flags(spark, d)), quality.quality_windows(b.sizes(spark, d)))


@query(f"""WITH {_WINDOWS}, {_ABSOLUTE} SELECT file_id, group_label, CAST(idx AS INTEGER) AS idx, count(*) AS flags, count(*) FILTER (WHERE severity = 'major') AS majors,
CASE WHEN count(*) >= 2 OR count(*) FILTER (WHERE severity = 'major') >= 1 THEN 'problem' ELSE 'questionable' END AS verdict FROM placed GROUP BY file_id, group_label, idx""")
def flag_rollup(spark, d):
    return quality.flag_rollup(_placed(spark, d))


@query(f"""WITH {_COVERAGE}, {_ABSOLUTE}, flagged AS (SELECT file_id, idx, count(*) AS flagged FROM placed GROUP BY file_id, idx),
shares AS (SELECT c.file_id, c.idx, coverage, coalesce(flagged, 0) AS flagged, CASE WHEN coverage > 0 THEN coalesce(flagged, 0) / (coverage * 3) ELSE 0.0::DOUBLE END AS consensus FROM coverage c LEFT JOIN flagged f ON c.file_id = f.file_id AND c.idx = f.idx)
SELECT file_id, idx, coverage, flagged, round(consensus, 9) AS consensus, CASE WHEN consensus < CAST(0.2 AS DOUBLE) THEN 'clean' WHEN consensus < CAST(0.6 AS DOUBLE) THEN 'questionable' ELSE 'problem' END AS class FROM shares""")
def consensus(spark, d):
    sizes = b.sizes(spark, d)
    coverage = quality.line_coverage(quality.quality_windows(sizes), sizes)
    return quality.consensus(_placed(spark, d), coverage, 3).withColumn("consensus", F.round("consensus", 9))


@query(f"WITH {b.CHUNKS} SELECT model_used AS model, count(*) AS calls, round(sum(elapsed_sec), 4) AS total_elapsed, round(avg(elapsed_sec), 6) AS avg_elapsed FROM chunks GROUP BY model_used")
def model_latency(spark, d):
    found = quality.model_latency(b.chunk_facts(spark, d).select(F.col("model_used").alias("model"), F.col("elapsed_sec").alias("elapsed")))
    return found.select("model", "calls", F.round("total_elapsed", 4).alias("total_elapsed"), F.round("avg_elapsed", 6).alias("avg_elapsed"))


# --- status --------------------------------------------------------------------------------------


@query(f"""WITH {b.LATEST}, k AS (SELECT *, row_number() OVER (PARTITION BY status ORDER BY file_id) AS k FROM latest)
SELECT status, count(*) AS n, string_agg(CAST(file_id AS VARCHAR), ',' ORDER BY file_id) FILTER (WHERE k <= 5) AS first_ids FROM k GROUP BY status""")
def status_histogram(spark, d):
    return status.status_histogram(status.latest_status(b.status_events(spark, d)))


@query(f"WITH {b.CHUNKS} SELECT count(*) AS total, count(*) FILTER (WHERE status = 'done') AS done, round_even(100.0::DOUBLE * count(*) FILTER (WHERE status = 'done') / count(*), 2) AS success_pct FROM chunks")
def success_rate(spark, d):
    return status.success_rate(b.chunk_facts(spark, d))


_ALLOWED = ", ".join(f"('{k}', '{v}')" for k, vs in TRANSITIONS.items() for v in vs)


@query(f"""WITH {b.STATUS_EVENTS}, allowed(a, b) AS (VALUES {_ALLOWED}), steps AS (SELECT file_id, seq, status, lag(status) OVER (PARTITION BY file_id ORDER BY ts, seq) AS previous FROM status_events)
SELECT file_id, seq, status, previous, CASE WHEN previous = status THEN 'same' WHEN status IN ('failed', 'failed_permanent') THEN 'accepted' WHEN x.a IS NOT NULL THEN 'accepted' ELSE 'refused' END AS verdict
FROM steps LEFT JOIN allowed x ON x.a = previous AND x.b = status WHERE previous IS NOT NULL""")
def state_transitions(spark, d):
    return status.state_transitions(b.status_events(spark, d))


@query(f"""WITH {b.LATEST} SELECT file_id, status, round((epoch_us({b.AS_OF}) - epoch_us(last_updated)) / 1000000, 3) AS age_sec, 'undone' AS new_status FROM latest
WHERE status IN ('chunking', 'summarizing', 'embedding', 'db_inserting') AND (epoch_us({b.AS_OF}) - epoch_us(last_updated)) / 1000000 > 600""")
def stuck_files(spark, d):
    found = status.stuck_files(status.latest_status(b.status_events(spark, d)), b.as_of(spark, d))
    return found.select("file_id", "status", F.round("age_sec", 3).alias("age_sec"), "new_status")


@query(f"""WITH {b.LATEST}, old AS (SELECT file_id, status, file_id % 4 AS retry_count, status IN ('chunking', 'summarizing', 'failed') AND (epoch_us({b.AS_OF}) - epoch_us(last_updated)) / 1000000 >= 600 AS timed_out FROM latest)
SELECT file_id, status, timed_out, CASE WHEN timed_out AND retry_count + 1 >= 3 THEN 'failed_permanent' WHEN timed_out THEN 'undone' ELSE status END AS new_status, retry_count + CASE WHEN timed_out THEN 1 ELSE 0 END AS new_retry_count FROM old""")
def watchdog_timeouts(spark, d):
    files = status.latest_status(b.status_events(spark, d)).withColumn("retry_count", F.col("file_id") % 4)
    return status.watchdog(files, b.as_of(spark, d)).select("file_id", "status", "timed_out", "new_status", "new_retry_count")


@query(f"""WITH {b.LATEST}, r AS (SELECT file_id, status, 'undone' AS wanted, file_id % 4 AS retry_count FROM latest)
SELECT file_id, status, CASE WHEN status = 'undone' THEN 'same' WHEN status IN ('chunking', 'queueing_1', 'summarizing', 'failed') THEN 'accepted' ELSE 'refused' END AS verdict,
CASE WHEN status = 'failed' AND retry_count + 1 >= 3 THEN 'failed_permanent' ELSE 'undone' END AS new_status, retry_count + CASE WHEN status = 'failed' THEN 1 ELSE 0 END AS new_retry_count FROM r""")
def transition_outcome(spark, d):
    files = status.latest_status(b.status_events(spark, d)).select("file_id", "status", F.lit("undone").alias("wanted"), (F.col("file_id") % 4).alias("retry_count"), F.lit(False).alias("all_processed"), F.lit(False).alias("all_failed"))
    return status.apply_transition(files).select("file_id", "status", "verdict", "new_status", "new_retry_count")


@query("""WITH w AS (SELECT event_type AS phase, event_id AS file_id, ts AS arrival, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS place FROM events)
SELECT phase, file_id, CAST(place AS INTEGER) AS place, place <= 3 AS granted FROM w""")
def slot_allocation(spark, d):
    waiting = b.table(spark, d, "events").select(F.col("event_type").alias("phase"), F.col("event_id").alias("file_id"), F.col("ts").alias("arrival"))
    return status.slot_allocation(waiting, 3).drop("arrival").withColumn("place", F.col("place").cast("int"))


@query(f"WITH {b.CHUNKS} SELECT file_id, chunk_id, retry_count FROM chunks WHERE status = 'failed' AND retry_count < 3")
def retry_candidates(spark, d):
    return status.retry_candidates(b.chunk_facts(spark, d)).select("file_id", "chunk_id", "retry_count")


@query(f"WITH {b.LATEST} SELECT file_id, status, CASE status WHEN 'undone' THEN 'chunking' WHEN 'queueing_1' THEN 'summarizing' WHEN 'queueing_2' THEN 'embedding' WHEN 'queueing_3' THEN 'db_inserting' END AS phase FROM latest")
def phase_next(spark, d):
    return status.latest_status(b.status_events(spark, d)).select("file_id", "status", status.next_phase(F.col("status")).alias("phase"))


@query(f"""WITH {b.CHUNKS}, f AS (SELECT file_id, bool_and(status = 'done') AS done, bool_or(status = 'failed') AS failed, count(*) FILTER (WHERE status = 'done') AS ok, count(*) FILTER (WHERE status = 'failed') AS bad, count(*) AS n FROM chunks GROUP BY file_id)
SELECT count(*) FILTER (WHERE done) AS files_done, count(*) FILTER (WHERE failed) AS files_failed, count(*) AS files, CAST(sum(ok) AS BIGINT) AS chunks_done, CAST(sum(bad) AS BIGINT) AS chunks_failed, CAST(sum(n) AS BIGINT) AS chunks FROM f""")
def progress_rollup(spark, d):
    return status.progress(b.chunk_facts(spark, d))


@query("""WITH h AS (SELECT date_trunc('hour', ts) AS ts, event_type AS series, count(*) AS n FROM events GROUP BY 1, 2), s AS (SELECT series, ts, CAST(sum(n) OVER (PARTITION BY series ORDER BY ts) AS BIGINT) AS done FROM h)
SELECT series, ts, done, coalesce(done - lag(done) OVER w, 0) AS delta, coalesce(round((done - lag(done) OVER w) / ((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 60000000), 9), 0) AS per_minute FROM s WINDOW w AS (PARTITION BY series ORDER BY ts)""")
def throughput_delta(spark, d):
    from pyspark.sql.window import Window

    hourly = b.table(spark, d, "events").groupBy(F.date_trunc("hour", "ts").alias("ts"), F.col("event_type").alias("series")).agg(F.count("*").alias("n"))
    snapshots = hourly.select("series", "ts", F.sum("n").over(Window.partitionBy("series").orderBy("ts")).alias("done"))
    return status.throughput_delta(snapshots).withColumn("per_minute", F.round("per_minute", 9))


@query("""WITH c AS (SELECT user_id AS key, ts, event_id AS seq, event_type = 'error' AS failed FROM events), n AS (SELECT *, sum(CAST(failed AS INTEGER)) OVER (PARTITION BY key ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM c)
SELECT key, seq, failed, CAST(k % 3 AS BIGINT) AS failures, failed AND k % 3 = 0 AS warned FROM n""")
def failure_accumulator(spark, d):
    calls = b.table(spark, d, "events").select(F.col("user_id").alias("key"), "ts", F.col("event_id").alias("seq"), (F.col("event_type") == "error").alias("failed"))
    return status.consecutive_failures(calls).select("key", "seq", "failed", F.col("failures").cast("bigint").alias("failures"), "warned")


@query("""WITH c AS (SELECT event_type AS key, ts, event_id AS seq, user_id % 7 = 0 AS failed, value AS latency_ms FROM events)
SELECT key, seq, round(avg(CASE WHEN failed THEN 0.0 ELSE 1.0 END) OVER (PARTITION BY key ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 9) AS success_rate,
round(avg(latency_ms) OVER (PARTITION BY key ORDER BY ts, seq ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) + 1e-7, 4) AS mean_latency_ms FROM c""")
def health_metrics(spark, d):
    calls = b.table(spark, d, "events").select(F.col("event_type").alias("key"), "ts", F.col("event_id").alias("seq"), (F.col("user_id") % 7 == 0).alias("failed"), F.col("value").alias("latency_ms"))
    return status.health_metrics(calls).select("key", "seq", F.round("success_rate", 9).alias("success_rate"), F.round(F.col("mean_latency_ms") + 1e-7, 4).alias("mean_latency_ms"))


_PATTERNS = "message"
for _pattern, _mark in fx.ERROR_PATTERNS:
    _flags = "gi" if _pattern.startswith("(?i)") else "g"
    _PATTERNS = f"regexp_replace({_PATTERNS}, '{_pattern.removeprefix('(?i)')}', '{_mark}', '{_flags}')"


@query(f"""WITH e AS (SELECT 'HTTP 502 from ' || url || ' after ' || CAST(page_id * 37 AS VARCHAR) || ' ms' AS message FROM pages), p AS (SELECT substr({_PATTERNS}, 1, 150) AS pattern FROM e)
SELECT pattern, count(*) AS n FROM p GROUP BY pattern ORDER BY n DESC, pattern LIMIT 10""")
def error_patterns(spark, d):
    message = F.concat(F.lit("HTTP 502 from "), F.col("url"), F.lit(" after "), (F.col("page_id") * 37).cast("string"), F.lit(" ms"))
    return status.error_patterns(b.table(spark, d, "pages").select(message.alias("message")))


# --- diagnostics and audit -----------------------------------------------------------------------


@query(f"""WITH {b.CHUNKS}, m AS (SELECT model_used AS model, count(*) FILTER (WHERE status = 'done') AS success, count(*) FILTER (WHERE status = 'failed') AS fail, CAST(sum(char_count) AS BIGINT) AS total_chars, sum(CASE WHEN status = 'done' THEN elapsed_sec END) AS total_elapsed, CAST(sum(retry_count) AS BIGINT) AS retries FROM chunks GROUP BY model_used)
SELECT model, success, fail, total_chars, round(total_elapsed, 4) AS total_elapsed, retries, round_even(100.0::DOUBLE * success / (success + fail), 1) AS success_rate, round_even(total_chars / total_elapsed, 1) AS chars_per_sec FROM m""")
def model_performance(spark, d):
    return diagnostics.model_performance(b.chunk_facts(spark, d)).withColumn("total_elapsed", F.round("total_elapsed", 4))


_ERRORS = "errors AS (SELECT 'm' || CAST((event_id + 1) % 5 AS VARCHAR) AS model, 'timeout after ' || CAST(user_id % 9 AS VARCHAR) || ' s' AS message FROM events WHERE event_type = 'error')"


def _errors(spark, d):
    e = b.table(spark, d, "events").where("event_type = 'error'")
    return e.select(F.concat(F.lit("m"), ((F.col("event_id") + 1) % 5).cast("string")).alias("model"), F.concat(F.lit("timeout after "), (F.col("user_id") % 9).cast("string"), F.lit(" s")).alias("message"))


@query(f"""WITH {b.CHUNKS}, {_ERRORS}, u AS (SELECT model_used AS model, count(*) FILTER (WHERE status = 'done') AS success, count(*) FILTER (WHERE status = 'failed') AS bad, sum(char_count) AS chars, sum(elapsed_sec) AS elapsed, sum(CASE WHEN status = 'done' THEN char_count END) AS dc, sum(CASE WHEN status = 'done' THEN elapsed_sec END) AS de FROM chunks GROUP BY model_used),
c AS (SELECT model, count(*) AS n FROM errors GROUP BY model)
SELECT coalesce(u.model, c.model) AS model, coalesce(success, 0) AS success, coalesce(bad, 0) + coalesce(n, 0) AS fail, round_even(100.0::DOUBLE * success / (success + bad + coalesce(n, 0)), 1) AS success_rate, round_even(chars / elapsed, 1) AS cps_overall, round_even(dc / de, 1) AS cps_actual
FROM u FULL JOIN c ON u.model = c.model""")
def model_diagnostics(spark, d):
    return diagnostics.model_diagnostics(b.chunk_facts(spark, d), _errors(spark, d))


@query(f"""WITH {_ERRORS}, c AS (SELECT model, substr(message, 1, 120) AS message, count(*) AS n FROM errors GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY n DESC, message) AS place FROM c)
SELECT model, message, n, CAST(place AS INTEGER) AS place FROM k WHERE place <= 5""")
def top_errors(spark, d):
    return diagnostics.top_errors(_errors(spark, d))


@query(f"""WITH {b.CHUNKS} SELECT file_id, chunk_id, model_used, status, count(*) FILTER (WHERE status = 'done') OVER w AS model_success, count(*) FILTER (WHERE status = 'failed') OVER w AS model_fail, CAST(sum(char_count) OVER w AS BIGINT) AS model_chars FROM chunks WINDOW w AS (PARTITION BY file_id, model_used)""")
def file_audit_detail(spark, d):
    return audit.file_audit_detail(b.chunk_facts(spark, d))


def audit_inputs(spark, d):
    """Status rows of made-up batch files: a user is a file, its events are chunks."""
    latest = status.latest_status(b.status_events(spark, d))
    chunk = F.struct(F.col("chunk_id").cast("string").alias("chunk_id"), "status", "model_used", "retry_count", (F.col("chunk_id") % 3 == 0).alias("has_error"))
    chunks = b.chunk_facts(spark, d).groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct(F.col("chunk_id").alias("o"), chunk.alias("c")))).alias("s"))
    rows = latest.join(chunks, "file_id")
    missing = F.when(F.col("file_id") % 17 == 0, F.array(F.lit("retry_count"))).otherwise(F.array().cast("array<string>"))
    return rows.select(
        F.concat(F.lit("b"), (F.col("file_id") % 3).cast("string")).alias("batch"), "file_id", F.when(F.col("file_id") % 19 == 0, "odd").otherwise(F.col("status")).alias("status"),
        F.date_format("last_updated", "yyyy-MM-dd'T'HH:mm:ss").alias("last_updated"), (F.col("file_id") % 5).alias("retry_count"), (F.size("s") + F.when(F.col("file_id") % 13 == 0, 1).otherwise(0)).cast("bigint").alias("total_chunks"), missing.alias("missing"),
        F.transform("s", lambda x: x["c"]).alias("chunks"), (F.col("file_id") % 2 == 0).alias("has_error_log"), F.lit(False).alias("has_diagnostics"), F.lit(False).alias("has_summary"), F.lit(None).cast("map<string,struct<success:bigint,fail:bigint>>").alias("models"),
    )


_AUDIT = f"""{b.LATEST}, {b.CHUNKS}, files AS (SELECT 'b' || CAST(file_id % 3 AS VARCHAR) AS batch, file_id, CASE WHEN file_id % 19 = 0 THEN 'odd' ELSE status END AS status, file_id % 5 AS retry_count, (epoch_us({b.AS_OF}) - epoch_us(date_trunc('second', last_updated))) / 1000000 AS age FROM latest),
fc AS (SELECT 'b' || CAST(c.file_id % 3 AS VARCHAR) AS batch, c.* FROM chunks c), bm AS (SELECT batch, model_used, count(*) FILTER (WHERE status = 'done') AS ok, count(*) FILTER (WHERE status = 'failed') AS bad FROM fc GROUP BY 1, 2), bo AS (SELECT batch, sum(ok) AS ok, sum(bad) AS bad FROM bm GROUP BY 1),
issues AS (
SELECT batch, file_id, 'ERROR' AS severity, 'A1' AS "check" FROM files WHERE file_id % 17 = 0
UNION ALL SELECT batch, file_id, 'ERROR', 'A2' FROM files WHERE status = 'odd'
UNION ALL SELECT batch, file_id, CASE WHEN age > 600 THEN 'ERROR' ELSE 'WARN' END, 'B2' FROM files WHERE status IN ('chunking', 'summarizing') AND age > 420
UNION ALL SELECT batch, file_id, 'WARN', 'B3' FROM files WHERE age > 1200
UNION ALL SELECT batch, file_id, 'WARN', 'C4' FROM files WHERE status = 'failed' AND file_id % 2 <> 0
UNION ALL SELECT batch, file_id, 'ERROR', 'D1' FROM files WHERE file_id % 13 = 0
UNION ALL SELECT batch, file_id, 'WARN', 'D3' FROM files WHERE retry_count > 3
UNION ALL SELECT batch, file_id, 'WARN', 'C1' FROM fc WHERE status = 'failed' AND chunk_id % 3 <> 0
UNION ALL SELECT batch, file_id, 'WARN', 'C3' FROM fc WHERE status = 'failed' AND retry_count = 0
UNION ALL SELECT batch, NULL, 'WARN', 'E1' FROM bo WHERE bad > CAST(0.2 AS DOUBLE) * (ok + bad)
UNION ALL SELECT batch, NULL, 'ERROR', 'E2' FROM bm WHERE ok + bad >= 5 AND ok < CAST(0.5 AS DOUBLE) * (ok + bad)
UNION ALL SELECT batch, file_id, 'ERROR', 'F1' FROM files WHERE file_id % 10 = 9
UNION ALL SELECT DISTINCT x.batch, NULL, 'INFO', 'F2' FROM (SELECT DISTINCT batch FROM files) x, files m WHERE m.file_id % 10 <> 9 AND m.batch <> x.batch
)"""


def _audit_issues(spark, d):
    files = materialize(audit_inputs(spark, d), "audit-files")
    manifest = files.select("file_id").where("file_id % 10 <> 9")
    return files, audit.audit_issues(files, b.as_of(spark, d), manifest)


@query(f'WITH {_AUDIT} SELECT batch, coalesce(file_id, -1) AS file_id, severity, "check", count(*) AS n FROM issues GROUP BY ALL')
def audit_issues(spark, d):
    return _audit_issues(spark, d)[1].groupBy("batch", F.coalesce("file_id", F.lit(-1)).alias("file_id"), "severity", "check").agg(F.count("*").alias("n"))


@query(f"""WITH {_AUDIT}, letters AS (SELECT DISTINCT batch, unnest(['A', 'B', 'C', 'D', 'E', 'F']) AS letter FROM files), c AS (SELECT batch, substr("check", 1, 1) AS letter, count(*) AS n, count(*) FILTER (WHERE "check" = 'B2' AND severity = 'ERROR') AS stuck, count(*) FILTER (WHERE "check" = 'C1') AS c1, count(*) FILTER (WHERE "check" = 'E1') AS e1, count(*) FILTER (WHERE "check" = 'E2') AS e2 FROM issues GROUP BY 1, 2),
facts AS (SELECT batch, count(*) AS files, count(*) FILTER (WHERE age <= 600) AS fresh FROM files GROUP BY 1), fails AS (SELECT batch, count(*) FILTER (WHERE status = 'failed') AS failed FROM fc GROUP BY 1)
SELECT l.batch, l.letter, CAST(CASE l.letter WHEN 'A' THEN greatest(0, 100 - 10 * coalesce(n, 0)) WHEN 'B' THEN greatest(0, 100 - 30 * coalesce(stuck, 0) - CASE WHEN fresh * 2 < files THEN 20 ELSE 0 END)
WHEN 'C' THEN round(greatest(0, CASE WHEN failed > 0 THEN 100.0::DOUBLE * (failed - coalesce(c1, 0)) / failed ELSE 100 END - 10), 6) WHEN 'E' THEN greatest(0, 100 - 20 * coalesce(e1, 0) - 15 * coalesce(e2, 0)) ELSE 100 END AS DOUBLE) AS score, coalesce(n, 0) AS issue_count
FROM letters l LEFT JOIN c ON l.batch = c.batch AND l.letter = c.letter JOIN facts f ON l.batch = f.batch JOIN fails x ON l.batch = x.batch""")
def audit_scores(spark, d):
    files, issues = _audit_issues(spark, d)
    return audit.audit_scores(files, issues, b.as_of(spark, d)).withColumn("score", F.round("score", 6))


@query("""WITH batch AS (SELECT doc_id AS file_id FROM labels), manifest AS (SELECT doc_id AS file_id FROM documents WHERE doc_id % 50 <> 3), lacking AS (SELECT file_id FROM manifest WHERE file_id NOT IN (SELECT file_id FROM batch) ORDER BY file_id LIMIT 10)
SELECT 'F1' AS "check", file_id, 'file_id ' || CAST(file_id AS VARCHAR) || ' not found in master_file_manifest' AS msg FROM batch WHERE file_id NOT IN (SELECT file_id FROM manifest)
UNION ALL SELECT 'F2', NULL, 'Files in manifest but not in this batch: [' || (SELECT string_agg(CAST(file_id AS VARCHAR), ', ' ORDER BY file_id) FROM lacking) || ']...'""")
def cross_file_check(spark, d):
    blank = {"batch": "'b'", "status": "'undone'", "last_updated": "'2026-01-01T00:00:00'", "retry_count": "0L", "total_chunks": "0L", "missing": "CAST(array() AS array<string>)", "chunks": "CAST(array() AS array<struct<chunk_id:string,status:string,model_used:string,retry_count:bigint,has_error:boolean>>)", "has_error_log": "true", "has_diagnostics": "true", "has_summary": "false", "models": "CAST(null AS map<string,struct<success:bigint,fail:bigint>>)"}
    batch = b.table(spark, d, "labels").select(F.col("doc_id").alias("file_id"), *[F.expr(v).alias(k) for k, v in blank.items()])
    manifest = b.table(spark, d, "documents").where("doc_id % 50 <> 3").select(F.col("doc_id").alias("file_id"))
    found = audit.audit_issues(batch, F.lit("2026-01-01 00:00:00").cast("timestamp"), manifest)
    return found.where("check LIKE 'F%'").select("check", "file_id", "msg")


# --- summaries -----------------------------------------------------------------------------------


@query("""WITH c AS (SELECT CAST(doc_id AS VARCHAR) AS chunk_id, sha256(text) AS h FROM documents), done AS (SELECT CAST(doc_id AS VARCHAR) AS chunk_id, sha256(CASE WHEN doc_id % 7 = 0 THEN text || '!' ELSE text END) AS h FROM documents WHERE doc_id % 3 = 0)
SELECT c.chunk_id, c.h AS source_text_hash FROM c LEFT JOIN done ON c.chunk_id = done.chunk_id AND c.h = done.h WHERE done.chunk_id IS NULL""")
def pending_chunks(spark, d):
    docs = b.table(spark, d, "documents")
    chunks = docs.select(F.col("doc_id").cast("string").alias("chunk_id"), F.col("text").alias("text_content"))
    old = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    completed = docs.where("doc_id % 3 = 0").select(F.col("doc_id").cast("string").alias("chunk_id"), F.lit("done").alias("status"), summaries.text_hash(old).alias("source_text_hash"))
    return summaries.pending_chunks(chunks, completed).select("chunk_id", "source_text_hash")


@query("""WITH t AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 0), s AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderkey % 2 = 0)
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s)""")
def upsert_merge(spark, d):
    orders = b.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    source = orders.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("X")).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return merge_upsert(orders.where("o_orderkey % 3 <> 0"), source, "o_orderkey").withColumn("o_totalprice", F.round("o_totalprice", 2))


@query("""WITH t AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 0), s AS (SELECT * FROM orders WHERE o_custkey % 2 = 0)
SELECT o_orderkey, o_custkey FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) AND o_custkey NOT IN (SELECT o_custkey FROM s) UNION ALL SELECT o_orderkey, o_custkey FROM s""")
def upsert_replace(spark, d):
    orders = b.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return merge_upsert(orders.where("o_orderkey % 3 <> 0"), orders.where("o_custkey % 2 = 0"), "o_orderkey", "o_custkey")


@query("""WITH e AS (SELECT CAST(doc_id AS VARCHAR) AS chunk_id, 'failed' AS status, 'old' AS summary FROM documents WHERE doc_id % 2 = 0), r AS (SELECT CAST(doc_id AS VARCHAR) AS chunk_id, 'done' AS status, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE 'new' END AS summary, doc_id % 5 = 0 AS silent FROM documents WHERE doc_id % 3 = 0)
SELECT coalesce(e.chunk_id, r.chunk_id) AS chunk_id, CASE WHEN r.chunk_id IS NOT NULL THEN r.status ELSE e.status END AS status, CASE WHEN r.chunk_id IS NOT NULL AND NOT silent THEN r.summary ELSE e.summary END AS summary FROM e FULL JOIN r ON e.chunk_id = r.chunk_id""")
def retry_merge(spark, d):
    docs = b.table(spark, d, "documents")
    key = F.col("doc_id").cast("string").alias("chunk_id")
    old = docs.where("doc_id % 2 = 0").select(key, F.lit("failed").alias("status"), F.lit("old").alias("summary"))
    present = F.when(F.col("doc_id") % 5 == 0, F.array(F.lit("status"))).otherwise(F.array(F.lit("status"), F.lit("summary")))
    new = docs.where("doc_id % 3 = 0").select(key, present.alias("present"), F.lit("done").alias("status"), F.when(F.col("doc_id") % 9 != 0, "new").alias("summary"))
    return summaries.retry_merge(old, new, ["status", "summary"])


@query("SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) WHERE k = 1")
def dedup_first(spark, d):
    return summaries.dedup_first(b.table(spark, d, "documents"), ["text"], ["doc_id"]).select("doc_id", "source")


@query("""WITH r AS (SELECT doc_id, quality, text FROM documents JOIN labels USING (doc_id))
SELECT CAST(doc_id AS VARCHAR) || '_0' AS chunk_id, doc_id AS file_id, 'id_' || CAST(doc_id AS VARCHAR) AS file_name, substr(text, 1, 40) AS summary, 'unknown' AS boundary_type FROM r WHERE quality = 1 AND regexp_matches(substr(text, 1, 40), '[^\\x00-\\x20]')""")
def record_projection(spark, d):
    rows = b.table(spark, d, "documents").join(b.table(spark, d, "labels"), "doc_id")
    results = rows.select(F.lit("").alias("chunk_id"), F.col("doc_id").alias("file_id"), F.lit(0).alias("position"), F.when(F.col("quality") == 1, "done").otherwise("pending").alias("status"), F.substring("text", 1, 40).alias("summary"), F.col("text").alias("text_content"), F.lit(None).cast("string").alias("start_time"), F.lit(None).cast("string").alias("end_time"), F.lit(None).cast("array<string>").alias("tags"), F.lit(None).cast("array<float>").alias("vector"), F.lit(None).cast("string").alias("boundary_type"))
    meta = rows.select(F.col("doc_id").alias("file_id"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("array<string>").alias("participants"))
    return summaries.to_records(summaries.embeddable(results), meta).select("chunk_id", "file_id", "file_name", "summary", "boundary_type")


@query("""WITH k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations)
SELECT conv_id AS file_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS opening FROM k WHERE k <= 3 GROUP BY conv_id""")
def participants_opening(spark, d):
    turns = b.table(spark, d, "conversations").select(F.col("conv_id").alias("file_id"), F.col("turn").alias("idx"), F.concat("role", F.lit(": "), "text").alias("text"))
    return summaries.opening_text(turns, 3)


_BROKEN = "CASE WHEN vec_id % 11 = 0 THEN list_append(CAST(embedding AS DOUBLE[])[1:63], CAST('nan' AS DOUBLE)) WHEN vec_id % 13 = 0 THEN CAST(embedding AS DOUBLE[])[1:63] WHEN vec_id % 17 = 0 THEN list_append(CAST(embedding AS DOUBLE[])[1:63], NULL) ELSE CAST(embedding AS DOUBLE[]) END"


@query(f"WITH v AS (SELECT vec_id, {_BROKEN} AS v FROM embeddings) SELECT vec_id, len(v) = 64 AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AS valid FROM v")
def record_validation(spark, d):
    v, head = F.col("embedding"), F.slice("embedding", 1, 63)
    broken = F.when(F.col("vec_id") % 11 == 0, F.array_append(head, F.lit(float("nan")).cast("float"))).when(F.col("vec_id") % 13 == 0, head).when(F.col("vec_id") % 17 == 0, F.array_append(head, F.lit(None).cast("float"))).otherwise(v)
    return b.table(spark, d, "embeddings").select("vec_id", is_valid_vector(broken, 64).alias("valid"))


@query("""SELECT event_id, CAST(json_extract_string(regexp_extract('Answer: ' || props || ' ok {' , '\\{[^{}]*\\}'), '$.k') AS BIGINT) AS k FROM events""")
def json_extract_first(spark, d):
    said = F.concat(F.lit("Answer: "), "props", F.lit(" ok {"))
    return b.table(spark, d, "events").select("event_id", F.get_json_object(fx.first_json_object(said, nested=False), "$.k").cast("bigint").alias("k"))


@query("SELECT doc_id, CASE WHEN quality = 1 THEN substr(text, 1, 100) ELSE substr('[m] ' || lang || ' | [m] ' || source, 1, 100) END AS preview FROM documents JOIN labels USING (doc_id)")
def status_preview(spark, d):
    rows = b.table(spark, d, "documents").join(b.table(spark, d, "labels"), "doc_id")
    errors = F.array(F.struct(F.lit("m").alias("model"), F.col("lang").alias("message")), F.struct(F.lit("m").alias("model"), F.col("source").alias("message")))
    return rows.select("doc_id", fx.preview(F.when(F.col("quality") == 1, "done").otherwise("failed"), F.col("text"), errors).alias("preview"))


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 'failed_permanent' ELSE 'undone' END AS status, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS retry_count,
CASE WHEN o_orderkey % 7 = 0 THEN 'missing srt' WHEN o_orderkey % 11 = 0 THEN 'missing mp3' END AS error FROM orders""")
def manifest_preflight(spark, d):
    files = b.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 7 != 0).alias("has_srt"), (F.col("o_orderkey") % 11 != 0).alias("has_mp3"))
    return preflight(files).select("id", "status", "retry_count", "error")


# --- evaluation and sweeps -----------------------------------------------------------------------

_JUDGED = "judged AS (SELECT l_returnflag AS label, l_orderkey * 10 + l_linenumber AS chunk, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS a, l_discount * 100 AS b, l_tax * 100 AS c, CASE WHEN l_partkey % 20 = 0 THEN 'timeout' END AS error FROM lineitem)"


def _judged(spark, d):
    li = b.table(spark, d, "lineitem")
    return li.select(F.col("l_returnflag").alias("label"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("chunk"), F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("a"), (F.col("l_discount") * 100).alias("b"), (F.col("l_tax") * 100).alias("c"), F.when(F.col("l_partkey") % 20 == 0, "timeout").alias("error"))


@query(f"""WITH {_JUDGED} SELECT label, count(*) AS n, round(avg(coalesce(a, 0)), 6) AS avg_a, round(avg(b), 6) AS avg_b, round(avg(c), 6) AS avg_c, round(avg(coalesce(a, 0) + b + c), 6) AS avg_total FROM judged WHERE error IS NULL GROUP BY label""")
def judge_scores(spark, d):
    found = evaluation.judge_scores(_judged(spark, d), ["a", "b", "c"])
    return found.select("label", "n", *[F.round(f"avg_{m}", 6).alias(f"avg_{m}") for m in ("a", "b", "c", "total")])


@query(f"""WITH {_JUDGED}, v AS (SELECT label, chunk, coalesce(a, 0) AS v FROM judged WHERE error IS NULL), hi AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY v DESC, chunk) AS k, row_number() OVER (PARTITION BY label ORDER BY v, chunk) AS j FROM v)
SELECT h.label, h.chunk AS best, h.v AS best_value, l.chunk AS worst, l.v AS worst_value FROM (SELECT * FROM hi WHERE k = 1) h JOIN (SELECT * FROM hi WHERE j = 1) l ON h.label = l.label""")
def best_worst(spark, d):
    return evaluation.best_and_worst(_judged(spark, d).where("error IS NULL"), F.coalesce("a", F.lit(0.0)), "chunk")


@query("SELECT doc_id, label, w FROM documents, (VALUES ('base', 3), ('wide', 5), ('narrow', 2)) AS c(label, w)")
def sweep_grid(spark, d):
    configs = spark.sql("SELECT * FROM VALUES ('base', 3), ('wide', 5), ('narrow', 2) AS c(label, w)")
    return evaluation.sweep_grid(b.table(spark, d, "documents").select("doc_id"), configs)


_SWEEP = """base AS (SELECT vec_id, label AS file_id, 'base' AS label, CAST(vec_id AS VARCHAR) AS chunk_id, vec_id % 3 = 0 AS dropped FROM embeddings WHERE vec_id % 5 <> 0), other AS (SELECT vec_id, label AS file_id, 'wide' AS label, CAST(vec_id AS VARCHAR) AS chunk_id, vec_id % 4 = 0 AS dropped FROM embeddings WHERE vec_id % 7 <> 0)"""


def _sweep(spark, d):
    e = b.table(spark, d, "embeddings").select("vec_id", F.col("label").alias("file_id"), F.col("vec_id").cast("string").alias("chunk_id"))
    base = e.where("vec_id % 5 <> 0").select("file_id", "chunk_id", F.lit("base").alias("label"), (F.col("vec_id") % 3 == 0).alias("dropped"))
    return base.unionByName(e.where("vec_id % 7 <> 0").select("file_id", "chunk_id", F.lit("wide").alias("label"), (F.col("vec_id") % 4 == 0).alias("dropped")))


@query(f"""WITH {_SWEEP} SELECT 'wide' AS label, coalesce(o.file_id, b.file_id) AS file_id, coalesce(o.chunk_id, b.chunk_id) AS chunk_id, CASE WHEN b.chunk_id IS NULL AND NOT o.dropped THEN 'new_kept' WHEN b.chunk_id IS NULL THEN 'new_dropped' WHEN o.chunk_id IS NULL THEN 'gone' WHEN NOT b.dropped AND o.dropped THEN 'kept_to_dropped' WHEN b.dropped AND NOT o.dropped THEN 'dropped_to_kept' ELSE 'same' END AS change
FROM other o FULL JOIN base b ON o.file_id = b.file_id AND o.chunk_id = b.chunk_id""")
def sweep_diff(spark, d):
    return evaluation.sweep_diff(_sweep(spark, d), "base")


@query(f"""WITH {_SWEEP}, r AS (SELECT * FROM base UNION ALL SELECT * FROM other), c AS (SELECT file_id, label, count(*) FILTER (WHERE NOT dropped) AS kept FROM r GROUP BY 1, 2)
SELECT file_id, coalesce(max(CASE WHEN label = 'base' THEN CAST(kept AS VARCHAR) END), '-') AS base, coalesce(max(CASE WHEN label = 'wide' THEN CAST(kept AS VARCHAR) END), '-') AS wide, '-' AS failed FROM c GROUP BY file_id""")
def param_pivot(spark, d):
    kept = _sweep(spark, d).groupBy("file_id", "label").agg(F.count_if(~F.col("dropped")).alias("kept"))
    return evaluation.pivot_table(kept, "file_id", "label", "kept", ["base", "wide", "failed"])


@query("SELECT doc_id, source FROM documents ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 20")
def sample_n(spark, d):
    return evaluation.sample_rows(b.table(spark, d, "documents").select("doc_id", "source"), "doc_id", 20)


@query()
def breaker_fold(spark, d):
    e = b.table(spark, d, "events")
    calls = e.select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at_sec"), (F.col("value") * 25).alias("latency_ms"), (F.col("event_type") != "error").alias("ok"))
    return resilience.replay_calls(calls)


@query(f"""WITH {b.CHUNKS}, m AS (SELECT model_used AS model, count(*) FILTER (WHERE status = 'failed') AS fail FROM chunks GROUP BY model_used) SELECT model, fail FROM m WHERE fail > 0""")
def top_failed_models(spark, d):
    return diagnostics.top_failed_models(diagnostics.model_performance(b.chunk_facts(spark, d))).select("model", "fail")


@query(f"""WITH {_WINDOWS} SELECT w.file_id, w.window_start, w.num_entries, string_agg('[' || CAST(l.idx - w.window_start + 1 AS VARCHAR) || '] a → b: ' || l.text, chr(10) ORDER BY l.idx) AS prompt
FROM windows w JOIN lines l ON l.file_id = w.file_id AND l.idx >= w.window_start AND l.idx < w.window_start + w.num_entries GROUP BY w.file_id, w.window_start, w.num_entries""")
def window_prompts(spark, d):
    entries = b.lines(spark, d).select("file_id", "idx", F.lit("a").alias("start_time"), F.lit("b").alias("end_time"), "text")
    return quality.window_prompt(quality.quality_windows(b.sizes(spark, d)), entries)


@query(f"""WITH {_WINDOWS}, g(group_label, model) AS (VALUES ('g1', 'm1'), ('g1', 'm2'), ('g2', 'm1')) SELECT file_id, group_label, model, count(*) AS calls FROM windows, g GROUP BY file_id, group_label, model""")
def review_grid(spark, d):
    groups = spark.sql("SELECT * FROM VALUES ('g1', 'm1'), ('g1', 'm2'), ('g2', 'm1') AS g(group_label, model)")
    return quality.review_grid(quality.quality_windows(b.sizes(spark, d)), groups).groupBy("file_id", "group_label", "model").agg(F.count("*").alias("calls"))


@query(f"""WITH {b.CHUNKS}, r AS (SELECT file_id, chunk_id, retry_count, chunk_id % 2 = 0 AS ok FROM chunks WHERE status = 'failed' AND retry_count < 3)
SELECT file_id, chunk_id, CASE WHEN ok THEN 'done' ELSE 'failed_permanent' END AS new_status, retry_count + CASE WHEN ok THEN 1 ELSE 2 END AS new_retry_count, bool_and(NOT ok) OVER (PARTITION BY file_id) AS file_failed FROM r""")
def chunk_retry_outcome(spark, d):
    tried = status.retry_candidates(b.chunk_facts(spark, d)).select("file_id", "chunk_id", "retry_count", (F.col("chunk_id") % 2 == 0).alias("succeeded"), F.lit(2).alias("attempts"))
    return status.chunk_retry_outcome(tried).select("file_id", "chunk_id", "new_status", "new_retry_count", "file_failed")


@query("""WITH r AS (SELECT doc_id FROM labels WHERE quality = 1) SELECT CAST(doc_id AS VARCHAR) || '_0' AS chunk_id, 'id_' || CAST(doc_id AS VARCHAR) AS file_name, 'summary' AS boundary_type, 8 AS dim, 0.0::DOUBLE AS total FROM r""")
def bypass_records(spark, d):
    rows = b.table(spark, d, "labels").where("quality = 1")
    results = rows.select(F.col("doc_id").alias("file_id"), F.concat_ws("_", F.col("doc_id").cast("string"), F.lit("0")).alias("chunk_id"), F.lit(0).alias("position"), F.lit("done").alias("status"), *[F.lit(None).cast("string").alias(c) for c in ("start_time", "end_time", "summary", "text_content", "boundary_type")], F.lit(None).cast("array<string>").alias("tags"))
    made = summaries.bypass_records(results, rows.select(F.col("doc_id").alias("file_id"), F.lit(None).cast("string").alias("title")), 8)
    return made.select("chunk_id", "file_name", "boundary_type", F.size("vector").alias("dim"), F.aggregate("vector", F.lit(0.0), lambda s, x: s + x).alias("total"))


@query("""SELECT count(*) AS records, CAST(sum(length(text)) AS BIGINT) AS total_chars, 8.0::DOUBLE AS elapsed_sec, round_even(sum(length(text)) / 8.0::DOUBLE, 1) AS chars_per_sec FROM documents""")
def run_summary(spark, d):
    return diagnostics.run_summary(b.table(spark, d, "documents").select(F.col("text").alias("summary")), 8.0)


@query("""WITH s AS (SELECT DISTINCT regexp_replace(url, '^https?://', '') AS path FROM pages), k AS (SELECT path, row_number() OVER (ORDER BY path) - 1 AS id FROM s)
SELECT id, regexp_extract(path, '[^/]*$') AS filename_srt FROM k""")
def manifest_ids(spark, d):
    from captionlake.sources.manifest import build_manifest

    paths = b.table(spark, d, "pages").select(F.regexp_replace("url", "^https?://", "").alias("path")).distinct()
    return build_manifest(paths).select("id", "filename_srt")
