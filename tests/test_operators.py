"""Quality, status, audit, summaries, evaluation and resilience operators, with hand-made cases."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from captionlake.functions import text as fx
from captionlake.functions.vectors import cosine, is_valid_vector
from captionlake.operators import audit, diagnostics, evaluation, quality, resilience, status, summaries
from captionlake.schemas import RECORD, STATES, TRANSITIONS

WINDOWS = {3: [], 4: [], 5: [(0, 5)], 10: [(0, 10), (5, 5)], 12: [(0, 10), (5, 7), (0, 12)], 15: [(0, 10), (5, 10), (10, 5), (0, 15)], 16: [(0, 10), (5, 10), (10, 6), (0, 15), (1, 15)], 20: [(0, 10), (5, 10), (10, 10), (15, 5), (0, 15), (5, 15)], 23: [(0, 10), (5, 10), (10, 10), (15, 8), (0, 15), (8, 15)]}


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_quality_windows_and_coverage(spark):
    sizes = spark.createDataFrame([(n, n) for n in [0, *WINDOWS]], "file_id bigint, n int")
    windows = quality.quality_windows(sizes)
    got = {}
    for r in windows.collect():
        got.setdefault(r.file_id, []).append((r.window_start, r.num_entries))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in WINDOWS.items() if v}
    covered = quality.line_coverage(windows, sizes).groupBy("file_id").agg(F.count("*").alias("lines"), F.sum("coverage").alias("c")).collect()
    assert {r.file_id: (r.lines, r.c) for r in covered} == {n: (n, sum(w[1] for w in ws)) for n, ws in WINDOWS.items()}


def test_flags_and_consensus(spark):
    flags = spark.createDataFrame(
        [(1, "g", 0, "1", "m1", "minor", "a"), (1, "g", 0, "1", "m2", "major", "b"), (1, "g", 0, "x", "m1", "minor", "c"), (1, "g", 0, "11", "m1", "minor", "d"), (1, "g", 5, "1", "m1", "minor", "e"), (1, "h", 0, "6", "m1", "minor", "f")],
        "file_id bigint, group_label string, window_start int, line_no string, model string, severity string, issue string",
    )
    sizes = spark.createDataFrame([(1, 10), (2, 3)], "file_id bigint, n int")
    windows = quality.quality_windows(sizes)
    placed = quality.absolute_flags(quality.merge_votes(flags), windows)
    rolled = {(r.group_label, r.idx): (r.flags, r.majors, r.verdict) for r in quality.flag_rollup(placed).collect()}
    assert rolled == {("g", 0): (1, 1, "problem"), ("g", 5): (1, 0, "questionable"), ("h", 5): (1, 0, "questionable")}
    found = {(r.file_id, r.idx): (r.consensus, r["class"]) for r in quality.consensus(placed, quality.line_coverage(windows, sizes), 2).collect()}
    assert found[1, 0] == (0.5, "questionable") and found[1, 5] == (0.5, "questionable") and found[1, 1] == (0.0, "clean") and found[2, 0] == (0.0, "clean")
    sized = quality.absolute_flags(quality.merge_votes(flags.withColumn("num_entries", F.lit(12))))
    assert sized.count() == 4 and sized.where("idx = 10").count() == 1
    entries = spark.createDataFrame([(1, 0, "a"), (1, 5, "b")], "file_id bigint, idx int, text string")
    listing = {r.idx: (r.g, r.h) for r in quality.consensus_listing(placed, entries, ["g", "h"]).collect()}
    assert listing == {0: ("major:b", "(未標記)"), 5: ("minor:e", "minor:f")}


def test_text_functions(spark):
    lit = F.lit
    assert one(spark, fx.normalize_error(lit("2026-05-01T10:11:12 host 10.0.0.1 id 42 at /a/b.srt deadbeef01"))) == "ID-ID-01T10:ID:ID host ID.ID.ID.ID id ID at /PATH HASH"
    assert one(spark, fx.strip(lit("　\t a b \n"))) == "a b"
    assert one(spark, fx.srt_seconds(lit("01:02:03,450"))) == 3723.45 and one(spark, fx.srt_seconds(lit("x"))) is None
    assert one(spark, fx.format_srt_time(lit(3723.45))) == "01:02:03,450"
    assert one(spark, fx.first_json_object(lit('a {"x": {"y": 1}} b'))) == '{"x": {"y": 1}}' and one(spark, fx.first_json_object(lit("none"))) is None
    assert one(spark, fx.first_json_object(lit('{"a": 1} {"b": 2}'), nested=False)) == '{"a": 1}'
    assert one(spark, fx.per_second(lit(9.0), lit(4.0))) == 2.2 and one(spark, fx.per_second(lit(9.0), lit(0.0))) is None
    assert one(spark, fx.chunk_suffix(lit("12_345"))) == 345
    assert (one(spark, fx.stem(lit("/a/b.c.srt"))), one(spark, fx.parent_name(lit("/a/x/b.srt"))), one(spark, fx.base_name(lit("/a/b.srt")))) == ("b.c", "x", "b.srt")
    assert one(spark, fx.utc_timestamp(lit("2026-05-01T10:11:12Z"))) == one(spark, fx.utc_timestamp(lit("2026-05-01T10:11:12"))) and one(spark, fx.utc_timestamp(lit("soon"))) is None
    assert one(spark, fx.redact_secrets(lit("key abc123 abc123"), ["abc123"])) == "key ***REDACTED*** ***REDACTED***"
    label = lambda name, i: one(spark, fx.report_label(lit(name), lit(i)))
    assert (label("/r/0_test_report_20260513_123228.json", 0), label("/r/a_b.json", 1), label("x_y_z_9.json", 3)) == ("report_20260513_123228", "unknown", "z_9")
    assert one(spark, fx.round_robin(F.array(lit("a"), lit("b")), lit(3))) == "b"
    assert [one(spark, fx.grade(lit(s))) for s in (95, 85, 75, 55, 10)] == list("ABCDF")
    assert one(spark, fx.resolve_path(lit("{SRT_DATA_DIR}/x"), "/d", "/r")) == "/d/x"


def test_vector_functions(spark):
    a = lambda *v: F.array(*[F.lit(x).cast("float") for x in v])
    assert math.isclose(one(spark, cosine(a(1.0, 0.0), a(1.0, 1.0))), 0.5**0.5)
    assert one(spark, cosine(a(0.0, 0.0), a(1.0, 1.0))) == 0 and one(spark, cosine(F.lit(None).cast("array<float>"), a(1.0))) is None
    good = [one(spark, is_valid_vector(v, 2)) for v in (a(1.0, 2.0), a(1.0), a(1.0, float("nan")), a(1.0, float("inf")), F.array(F.lit(1.0).cast("float"), F.lit(None).cast("float")), F.lit(None).cast("array<float>"))]
    assert good == [True, False, False, False, False, False]


def test_transitions(spark):
    rows = [(a, b, 0, False, False) for a in STATES for b in STATES]
    table = spark.createDataFrame(rows, "status string, wanted string, retry_count int, all_processed boolean, all_failed boolean")
    for r in status.apply_transition(table).collect():
        want = "same" if r.status == r.wanted else "accepted" if r.wanted in ("failed", "failed_permanent") or r.wanted in TRANSITIONS[r.status] else "refused"
        assert r.verdict == want and r.new_status == (r.status if want == "refused" else r.wanted)
    cases = [("failed", "undone", 2, False, False), ("failed", "undone", 1, False, False), ("embedding", "failed_permanent", 0, True, False), ("embedding", "failed_permanent", 0, True, True)]
    got = status.apply_transition(spark.createDataFrame(cases, table.schema)).collect()
    assert [(r.new_status, r.new_retry_count) for r in got] == [("failed_permanent", 3), ("undone", 2), ("embedding", 0), ("failed_permanent", 0)]


def test_timeouts(spark):
    now = dt.datetime(2026, 1, 1, 12)
    rows = [(i, s, now - dt.timedelta(seconds=age), n) for i, (s, age, n) in enumerate([("chunking", 600, 0), ("chunking", 601, 2), ("queueing_1", 9999, 0), ("failed", 700, 0), ("done", 9999, 0), ("undone", 9999, 0), ("embedding", 10, 0)])]
    files = spark.createDataFrame(rows, "file_id bigint, status string, last_updated timestamp, retry_count int")
    got = {r.file_id: (r.timed_out, r.new_status, r.new_retry_count) for r in status.watchdog(files, F.lit(now)).collect()}
    assert got[0] == (True, "undone", 1) and got[1] == (True, "failed_permanent", 3) and got[3][0] and not any(got[i][0] for i in (2, 4, 5, 6))
    assert [r.file_id for r in status.stuck_files(files, F.lit(now)).collect()] == [1]


def test_slots_progress_and_retries(spark):
    waiting = spark.createDataFrame([("p", 1, 5), ("p", 2, 3), ("p", 3, 3), ("q", 9, 1)], "phase string, file_id bigint, arrival int")
    assert {(r.phase, r.file_id): (r.place, r.granted) for r in status.slot_allocation(waiting, 2).collect()} == {("p", 2): (1, True), ("p", 3): (2, True), ("p", 1): (3, False), ("q", 9): (1, True)}
    chunks = spark.createDataFrame([(1, "a", True, 0, 1), (1, "b", False, 1, 2), (2, "c", False, 0, 3)], "file_id bigint, chunk_id string, succeeded boolean, retry_count int, attempts int")
    got = {r.chunk_id: (r.new_status, r.new_retry_count, r.file_failed) for r in status.chunk_retry_outcome(chunks).collect()}
    assert got == {"a": ("done", 1, False), "b": ("failed_permanent", 3, False), "c": ("failed_permanent", 3, True)}


def audit_row(**changes):
    row = {"batch": "b", "file_id": 1, "status": "done", "last_updated": "2026-01-01T12:00:00", "retry_count": 0, "total_chunks": 0, "missing": [], "chunks": [], "has_error_log": True, "has_diagnostics": True, "has_summary": True, "models": None}
    return {**row, **changes}


AUDIT = "batch string, file_id bigint, status string, last_updated string, retry_count bigint, total_chunks bigint, missing array<string>, chunks array<struct<chunk_id:string,status:string,model_used:string,retry_count:bigint,has_error:boolean>>, has_error_log boolean, has_diagnostics boolean, has_summary boolean, models map<string,struct<success:bigint,fail:bigint>>"


def chunk(i, s="done", m="m", n=0, e=False):
    return {"chunk_id": i, "status": s, "model_used": m, "retry_count": n, "has_error": e}


def test_audit(spark):
    rows = [
        audit_row(file_id=1, missing=["chunks"], status="odd"),
        audit_row(file_id=2, status="chunking", last_updated="2026-01-01T11:40:00"),
        audit_row(file_id=3, status="chunking", last_updated="2026-01-01T11:52:00"),
        audit_row(file_id=4, last_updated="soon", has_summary=False),
        audit_row(file_id=5, has_diagnostics=False, has_summary=False),
        audit_row(file_id=6, status="failed", has_error_log=False, total_chunks=3, has_summary=False, chunks=[chunk("a", "failed", None), chunk("a"), chunk(None, "weird", "m", 9)]),
        audit_row(file_id=7, total_chunks=6, chunks=[chunk(str(i), "failed", "bad", 1, True) for i in range(5)] + [chunk("9")], models={"bad": {"success": 0, "fail": 5}, "m": {"success": 2, "fail": 0}}),
    ]
    files = spark.createDataFrame(rows, AUDIT)
    now = F.lit(dt.datetime(2026, 1, 1, 12))
    issues = audit.audit_issues(files, now, spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 6, 50, 51)], "file_id bigint"))
    got = sorted((r.check, r.file_id, r.severity) for r in issues.collect() if r.file_id is not None)
    assert got == sorted([
        ("A1", 1, "ERROR"), ("A2", 1, "ERROR"), ("B2", 2, "ERROR"), ("B2", 3, "WARN"), ("A3", 4, "WARN"), ("B1", 4, "WARN"), ("B4", 5, "WARN"), ("C4", 6, "WARN"), ("C1", 6, "WARN"), ("C2", 6, "WARN"),
        ("C3", 6, "WARN"), ("D2", 6, "ERROR"), ("A4", 6, "WARN"), ("A4", 6, "WARN"), ("D3", 6, "WARN"), ("D4", 6, "WARN"), ("C5", 7, "WARN"), ("F1", 7, "ERROR"),
    ])
    assert sorted((r.check, r.msg) for r in issues.collect() if r.file_id is None) == [("E1", "Overall failure rate is 75.0% (6/8)"), ("E2", "Model 'bad' success rate is 0.0% (0/5)"), ("F2", "Files in manifest but not in this batch: [50, 51]...")]
    scores = {r.letter: r.score for r in audit.audit_scores(files, issues, now).collect()}
    assert (scores["A"], scores["B"], scores["D"], scores["E"], scores["F"]) == (50, 70, 100, 65, 100) and math.isclose(scores["C"], 100 * 5 / 6)
    total = audit.overall_score(spark.createDataFrame([(x,) for x in (90.0, 50.0)], "score double")).first()
    assert tuple(total) == (70.0, 10)


def test_diagnostics(spark):
    chunks = spark.createDataFrame([("m", "done", 100, 4.0, 1), ("m", "failed", 50, 9.0, 2), ("n", "done", 10, 0.0, 0), (None, "pending", None, None, None)], "model_used string, status string, char_count bigint, elapsed_sec double, retry_count bigint")
    got = {r.model: (r.success, r.fail, r.total_chars, r.total_elapsed, r.retries, r.success_rate, r.chars_per_sec) for r in diagnostics.model_performance(chunks).collect()}
    assert got == {"m": (1, 1, 150, 4.0, 3, 50.0, 37.5), "n": (1, 0, 10, 0.0, 0, 100.0, None), "?": (0, 0, 0, 0.0, 0, 0.0, None)}
    errors = spark.createDataFrame([("m", "x"), ("z", "y")], "model string, message string")
    told = {r.model: (r.success, r.fail, r.success_rate, r.cps_overall, r.cps_actual) for r in diagnostics.model_diagnostics(chunks.where("model_used IS NOT NULL"), errors).collect()}
    assert told["m"] == (1, 2, 33.3, 11.5, 25.0) and told["z"] == (0, 1, 0.0, None, None)


def test_resume_and_merge(spark):
    chunks = spark.createDataFrame([("a", "new text"), ("b", "same")], "chunk_id string, text_content string")
    import hashlib

    done = spark.createDataFrame([("a", "done", hashlib.sha256(b"old text").hexdigest()), ("b", "done", hashlib.sha256(b"same").hexdigest())], "chunk_id string, status string, source_text_hash string")
    assert [r.chunk_id for r in summaries.pending_chunks(chunks, done).collect()] == ["a"]
    assert [r.chunk_id for r in summaries.reusable_results(chunks, done).collect()] == ["b"]
    old = spark.createDataFrame([("a", "failed", "keep"), ("b", "failed", "lose")], "chunk_id string, status string, summary string")
    new = spark.createDataFrame([("a", ["status"], "done", None), ("b", ["status", "summary"], "done", None), ("c", ["status"], "done", None)], "chunk_id string, present array<string>, status string, summary string")
    assert {r.chunk_id: (r.status, r.summary) for r in summaries.retry_merge(old, new, ["status", "summary"]).collect()} == {"a": ("done", "keep"), "b": ("done", None), "c": ("done", None)}
    first = spark.createDataFrame([("a", 0, "x"), ("a", 1, "y")], "chunk_id string, position int, v string")
    both = summaries.finalize_checkpoint(first, spark.createDataFrame([("a", 0, "z"), ("b", 0, "w")], first.schema))
    assert {r.chunk_id: r.v for r in both.collect()} == {"a": "x", "b": "w"}
    some = spark.createDataFrame([("7_0", 0), ("7_9", 1)], "chunk_id string, position int")
    assert [r.position for r in summaries.select_retries(some, ["7_9"]).collect()] == [1] and [r.chunk_id for r in summaries.select_retries(some, ["0"]).collect()] == ["7_0"]


def record(**changes):
    row = {"chunk_id": "1_0", "file_id": 1, "file_name": "f", "start_time": "s", "end_time": "e", "summary": "x", "text_content": "t", "tags": ["a"], "participants": [], "vector": [0.1, 0.2, 0.3], "boundary_type": "semantic"}
    return {**row, **changes}


def test_gates(spark):
    frame = lambda *rows: spark.createDataFrame(list(rows), RECORD)
    assert summaries.check_records(frame(record()), 3).count() == 1
    for bad, what in ((record(vector=[0.1, float("nan"), 1.0]), "finite"), (record(vector=[0.1]), "3 numbers"), (record(summary=None), "missing summary"), (record(tags=["a", None]), "tags")):
        with pytest.raises(summaries.GateError, match=what):
            summaries.check_records(frame(record(), bad), 3)
    with pytest.raises(summaries.GateError, match="vector"):
        summaries.require_columns(frame(record()).drop("vector"), RECORD.names)
    results = lambda *s: spark.createDataFrame([(x,) for x in s], "status string")
    summaries.check_results(results("done", "pending"))
    for s in (("pending",), ("done", "failed")):
        with pytest.raises(summaries.GateError):
            summaries.check_results(results(*s))
    with pytest.raises(summaries.GateError):
        summaries.check_count(results("done"), 2)
    with pytest.raises(summaries.GateError):
        summaries.check_not_empty(results(), "chunks")


def test_evaluation(spark):
    rows = spark.createDataFrame([("a", 1, 5.0, 3.0, None), ("a", 2, None, 9.0, None), ("a", 3, 9.0, 9.0, "timeout"), ("b", 4, 1.0, 1.0, None)], "label string, chunk bigint, x double, y double, error string")
    got = {r.label: (r.n, r.avg_x, r.avg_y, r.avg_total) for r in evaluation.judge_scores(rows, ["x", "y"]).collect()}
    assert got == {"a": (2, 2.5, 6.0, 8.5), "b": (1, 1.0, 1.0, 2.0)}
    best = {r.label: (r.best, r.worst) for r in evaluation.best_and_worst(rows, F.col("y"), "chunk").collect()}
    assert best == {"a": (2, 1), "b": (4, 4)}
    seg = spark.createDataFrame([("base", 1, c, d) for c, d in (("1_0", False), ("1_5", True), ("1_9", False))] + [("w", 1, c, d) for c, d in (("1_0", True), ("1_5", False), ("1_7", True))], "label string, file_id bigint, chunk_id string, dropped boolean")
    assert {r.chunk_id: r.change for r in evaluation.sweep_diff(seg, "base").collect()} == {"1_0": "kept_to_dropped", "1_5": "dropped_to_kept", "1_7": "new_dropped", "1_9": "gone"}
    assert {r.chunk_id for r in evaluation.sweep_diff(seg, "failed").where("change = 'new_kept'").collect()} == {"1_0", "1_9", "1_5"}
    table = evaluation.pivot_table(spark.createDataFrame([("w", "a", 1), ("v", "b", 2)], "p string, l string, n int"), "p", "l", "n", ["a", "b"]).orderBy("p")
    assert [tuple(r) for r in table.collect()] == [("v", "-", "2"), ("w", "1", "-")] and evaluation.render(table).startswith("p | a | b")
    configs = evaluation.resolve_configs([{"label": "x", "models": ["m"], "chunking": {"w": 3}}, {"label": "y", "base": {"chunking": {"w": 9, "k": 1}}, "chunking": {"k": 2}}], {"w": 5})
    assert configs == [{"label": "x", "models": ["m"], "chunking": {"w": 3}}, {"label": "y", "models": ["m"], "chunking": {"w": 9, "k": 2}}]
    assert evaluation.sample_rows(rows, "chunk", 2).count() == 2
    found = spark.createDataFrame([("a", 1, ["p", "q"]), ("a", 0, ["r"])], "label string, position int, f array<string>")
    assert evaluation.listed_findings(found, "f", 2).first().asDict() == {"label": "a", "n": 3, "first": ["r", "p"]}


def test_breaker_and_throttle(spark):
    b = resilience.Breaker(resilience.BreakerParams())
    assert [b.call(t, ok)[0] for t, ok in [(0, False), (1, True), (2, False), (3, False), (4, False), (5, False)]] == ["closed"] * 5 + ["open"]
    assert b.call(10, True) == ("open", False) and b.call(35, True) == ("half_open", True) and b.call(36, True)[0] == "half_open" and b.call(37, True) == ("closed", True)
    t = resilience.Throttle(resilience.RateParams())
    assert [t.call(10, True) for _ in range(9)] == [10.0] * 9 and t.call(10, True) == 12.0 and t.call(10, False) == 6.0
    calls = [(k, i, float(i), 10.0, i % 3 != k) for k in (0, 1) for i in range(30)]
    got = resilience.replay_calls(spark.createDataFrame(calls, "key bigint, seq bigint, at_sec double, latency_ms double, ok boolean")).collect()
    for k in (0, 1):
        b, t = resilience.Breaker(resilience.BreakerParams()), resilience.Throttle(resilience.RateParams())
        want = []
        for _, i, at, ms, ok in (c for c in calls if c[0] == k):
            state, through = b.call(at, ok)
            want.append((i, state, through, t.call(ms, ok) if through else t.rate))
        assert sorted((r.seq, r.state, r.let_through, r.rate) for r in got if r.key == k) == want


def test_adaptive_rate_of_keys_with_many_calls(spark, tmp_path):
    """Of one key's 400 calls the first 150 are slow: the mean is of all so far, as in the SQL, not of the last hundred."""
    import duckdb

    from captionlake.plans import gate_queries
    from captionlake.plans.registry import SQL

    start = dt.datetime(2026, 1, 1)
    rows = [(i, start + dt.timedelta(seconds=i), 7, "click", 100.0 if i < 150 else i % 10 / 8) for i in range(400)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    got = sorted(map(tuple, gate_queries.adaptive_rate(spark, str(tmp_path)).collect()))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert got == sorted(db.sql(SQL["adaptive_rate"]).fetchall())
    assert {r[2] for r in got[150:260]} == {1.0} and got[-1][2] == 50.0
    last = resilience.Throttle(resilience.RateParams(good_ms=1200.0))
    assert [last.call(r[4] * 25, True) for r in rows][259] == 50.0
