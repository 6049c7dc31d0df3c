"""Model hooks and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from captionlake.operators import hooks
from captionlake.sources import reports


def test_embedding_in_halves(spark):
    def call(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("no")
        if texts == ["short"]:
            return []
        return [[float(len(t)), 1.0] for t in texts]

    got = hooks.embed_halving(call, ["a", "bad", "ccc"], 2)
    assert got == [[1.0, 1.0], None, [3.0, 1.0]] and hooks.embed_halving(call, [], 2) == []
    assert hooks.checked_batch(lambda t: [[1.0]], ["a", "b"], 1) is None and hooks.checked_batch(lambda t: [[1.0]], ["a"], 2) is None
    rows = spark.createDataFrame([(0, "a"), (1, None), (2, "bad"), (3, "dddd")], "i int, text string")
    out = rows.select("i", hooks.batch_embedder(call, 2, 3)("text").alias("v")).orderBy("i").collect()
    assert [r.v for r in out] == [[1.0, 1.0], None, None, [4.0, 1.0]]
    assert [r["batch_size"] for r in hooks.stress_batches(call, ["x"] * 9, 2, (2, 4))] == [2, 4] and hooks.backoff(3) == 8


def test_chat(spark):
    def call(model, prompt):
        if model == "m0" or "never" in prompt:
            raise RuntimeError(f"{model} down")
        return f'Sure: {{"summary": "{prompt[:3]}", "tags": ["t"]}} done'

    chunks = spark.createDataFrame([("1_0", "hello"), ("1_5", "never"), ("1_9", "again")], "chunk_id string, text_content string")
    ask = hooks.chat_caller(call, ["m0", "m1"], attempts=2, wait=0.0)
    got = {r.chunk_id: r for r in hooks.summarize_chunks(chunks, ask, F.col("text_content")).collect()}
    assert (got["1_0"].status, got["1_0"].summary, got["1_0"].tags, got["1_0"].model_used) == ("done", "hel", ["t"], "m1") and got["1_9"].char_count == 5
    assert got["1_5"].status == "failed" and got["1_5"].summary is None and "down" in got["1_5"].errors[0].message


def test_reports(spark, tmp_path):
    kind = "file_id bigint, chunk_id string, start_time string, end_time string, dropped boolean, drop_reason string, summary string, text_content string, left_boundary struct<label:string>, right_boundary struct<label:string>"
    rows = [(1, "1_5", "b", "c", True, "short", None, "t", ("2%",), ("-",)), (1, "1_0", "a", "b", False, None, "s", "t", ("start",), ("2%",)), (2, "2_0", "a", "b", False, None, "", "t", ("start",), ("end",))]
    segments = spark.createDataFrame(rows, kind)
    reports.write_stage(segments, str(tmp_path), "chunks")
    reports.write_stage(segments.where("file_id = 2"), str(tmp_path), "chunks")
    assert reports.read_stage(spark, str(tmp_path), "chunks").count() == 3
    assert [r.line for r in reports.segment_listing(segments).where("file_id = 1").collect()] == ["  1_0 a - b [start | 2%]", "x 1_5 b - c [2% | -] short"]
    documents = reports.run_document(segments, "base")
    assert {(r.file_id, r.total_kept, r.total_discarded, r.segments[0].chunk_id) for r in documents.collect()} == {(1, 1, 1, "1_0"), (2, 1, 0, "2_0")}
    reports.write_json(documents, str(tmp_path / "reports"))
    read = reports.read_reports(spark, str(tmp_path / "reports"))
    assert read.count() == 3 and read.first().folder == "reports" and reports.fidelity_segments(read).count() == 1
    reports.drop_stages(spark, str(tmp_path), ["chunks"])
    assert not (tmp_path / "chunks").exists()
    issues = spark.createDataFrame([("b", 1, "WARN", "A2", "x"), ("b", 1, "ERROR", "D1", "y")], "batch string, file_id bigint, severity string, check string, msg string")
    scores = spark.createDataFrame([("b", "A", 90.0, 1), ("b", "B", 100.0, 0)], "batch string, letter string, score double, issue_count bigint")
    files = spark.createDataFrame([("b", 1, "failed_permanent"), ("b", 2, "done"), ("b", 3, "failed_permanent")], "batch string, file_id bigint, status string")
    document = reports.audit_document(files, issues, scores).first()
    assert (document.files, document.overall, document.exit_code, [i.check for i in document.issues]) == (3, 95.0, 0, ["D1", "A2"])
    assert {(r.file_id, r.kind) for r in reports.alert_rows(files).collect()} == {(1, "failed"), (3, "failed"), (None, "critical")}
    histogram = spark.createDataFrame([("done", 1)], "status string, n int")
    assert reports.error_document(histogram, spark.createDataFrame([(1, 1)], "total int, done int"), histogram.selectExpr("status AS pattern", "n")).count() == 1
