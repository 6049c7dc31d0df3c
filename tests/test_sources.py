"""Sources, versioned tables, streaming, and the query registry with its oracles."""

from __future__ import annotations

import datetime as dt
import json
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from captionlake.config import AuditParams, WatchParams
from captionlake.functions.rows import each
from captionlake.operators.audit import audit_issues, audit_scores, overall_score, tally_scores
from captionlake.operators.summaries import GateError
from captionlake.plans import audit_queries
from captionlake.plans.registry import SQL
from captionlake.schemas import RECORD
from captionlake.sources import manifest as mf
from captionlake.sources.srt import parse_srt, read_srt, write_srt
from captionlake.sources.status import document_issues, file_facts, initial_chunk_status, read_status, status_problems
from captionlake.sources.tables import VersionedTable, load_records, merge_upsert, write_backup
from captionlake.streaming.watch import event_stream, idle_files, upsert_stream, windowed_counts

SF = "/root/testdata/sf0.001"


def srt_of(spark, content, **more):
    rows = parse_srt(spark.createDataFrame([(1, content)], "file_id bigint, content string"), **more).orderBy("idx").collect()
    return [(r.idx, r.start_time, r.end_time, r.text) for r in rows]


def test_srt_edges(spark):
    t = "00:00:0{} --> 00:00:0{}"
    times = [(f"00:00:0{i},000", f"00:00:0{i + 1},500") for i in range(5)]
    line = lambda i: f"{times[i][0]} --> {times[i][1]}"
    assert srt_of(spark, f"1\r\n{line(0)}\r\nhello\r\n  there \r\n\r\n2\r\n{line(1)}\r\nworld\r\n") == [(0, *times[0], "hello there"), (1, *times[1], "world")]
    assert srt_of(spark, f"{line(0)}\nlost\nkept") == [(0, *times[0], "kept")] and srt_of(spark, f"{line(0)}\nlost\nkept", strict=False) == [(0, *times[0], "lost kept")]
    assert srt_of(spark, f"{line(0)}\nlost") == [(0, *times[0], "")]
    assert srt_of(spark, f"﻿1\n{line(0)}\nx\n\n2\n{line(1)}\ny") == [(0, *times[1], "y")]
    assert srt_of(spark, f"1\n{line(0)}\na\n \n2\n{line(1)}\nb") == [(0, *times[0], f"a 2 {line(1)} b")]
    assert srt_of(spark, f"1\nbad\nx\n\n2\n{line(1)}\ny\n\n3") == [(0, *times[1], "y")]
    assert srt_of(spark, "") == [] and srt_of(spark, " \n\n ") == [] and t


def test_srt_files(spark, tmp_path):
    body = "1\n00:00:00,000 --> 00:00:01,000\n{}\n"
    (tmp_path / "a.srt").write_text(body.format("漢字"), encoding="utf-8")
    (tmp_path / "b.srt").write_bytes(body.format("漢字").encode("big5"))
    (tmp_path / "c.srt").write_bytes(b"")
    (tmp_path / "c.txt").write_text("no")
    rows = read_srt(spark, str(tmp_path))
    assert {r.file_id: r.text for r in rows.collect()} == {0: "漢字", 1: "漢字"}
    assert parse_srt(write_srt(rows)).count() == 2
    with pytest.raises(Exception, match="too large"):
        read_srt(spark, str(tmp_path), max_bytes=10).collect()


def test_manifest(spark, tmp_path):
    for name in ("b.srt", "b.mp3", "a.srt", "a.mp3", "c.srt"):
        (tmp_path / name).write_bytes(b"x")
    pairs, alone = mf.scan_pairs(mf.list_files(spark, str(tmp_path), "*.srt"), mf.list_files(spark, str(tmp_path), "*.mp3"))
    table = mf.build_manifest(pairs)
    assert [(r.id, r.filename_srt, r.filename_mp3) for r in table.orderBy("id").collect()] == [(0, "a.srt", "a.mp3"), (1, "b.srt", "b.mp3")] and alone.count() == 1
    mf.write_manifest(table, str(tmp_path / "m"))
    assert mf.read_manifest(spark, str(tmp_path / "m" / "*.json")).count() == 2
    (tmp_path / "list.json").write_text(json.dumps([{"file_id": 5, "file_path": "/x/y.srt", "filename_srt": "y.srt"}]))
    assert mf.lookup(mf.read_manifest(spark, str(tmp_path / "list.json")), 5).first().path_srt == "/x/y.srt"
    with pytest.raises(GateError):
        mf.lookup(table, 9)
    assert [r.id for r in mf.batch_range(table, 1, 5).collect()] == [1]
    assert (mf.expand_ids("3-5"), mf.expand_ids("5-3"), mf.expand_ids("7")) == ([3, 4, 5], [], [7])
    flags = spark.createDataFrame([(1, True, True), (2, False, True), (3, True, False)], "id int, has_srt boolean, has_mp3 boolean")
    assert [(r.status, r.retry_count) for r in mf.preflight(flags).orderBy("id").collect()] == [("undone", 0), ("failed_permanent", 1), ("failed_permanent", 1)]


def test_status_documents(spark, tmp_path):
    item = {"file_id": 1, "status": "done", "last_updated": "2026-01-01T00:00:00", "retry_count": 0, "total_chunks": 1, "chunks": [{"chunk_id": "1_0", "status": "done", "model_used": "m", "retry_count": 0, "errors": []}], "diagnostics": {"summary": {"records": 1}, "models": {"m": {"success": 1, "fail": 0}}}}
    short = {"file_id": 2, "status": "undone", "last_updated": None}
    for name, text in (("1", json.dumps([item, short])), ("2", json.dumps({"files": [item]})), ("3", "[{"), ("4", "[]"), ("5", '{"x": 1}')):
        (tmp_path / f"batch_status_{name}.json").write_text(text)
    docs = read_status(spark, str(tmp_path))
    assert {r.batch[13]: r.problem for r in docs.collect()} == {"1": None, "2": None, "3": "not JSON", "4": "empty", "5": "not a list"}
    assert {r.batch[13]: r.severity for r in document_issues(docs).collect()} == {"3": "CRITICAL", "4": "WARN", "5": "CRITICAL"}
    facts = file_facts(docs)
    got = {(r.batch[13], r.file_id): r for r in facts.collect()}
    assert set(got) == {("1", 1), ("1", 2), ("2", 1)} and sorted(got["1", 2].missing) == ["chunks", "retry_count"] and got["1", 1].models["m"].success == 1
    checks = {(r.batch[13], r.file_id, r.check) for r in audit_issues(facts, F.lit(dt.datetime(2026, 1, 1))).collect()}
    assert ("1", 2, "A1") in checks and ("1", 2, "A3") in checks and ("2", None, "F0") in checks and not any(c for c in checks if c[1] == 1)
    chunks = spark.createDataFrame([(1, 5, "1_5", "y" * 200), (1, 0, "1_0", "x")], "file_id bigint, start_idx int, chunk_id string, text_content string")
    row = initial_chunk_status(chunks).first()
    assert row.total_chunks == 2 and [c.chunk_id for c in row.chunks] == ["1_0", "1_5"] and len(row.chunks[1].text_preview) == 100


def record(chunk, summary, file_id=1, **more):
    return {"chunk_id": chunk, "file_id": file_id, "file_name": "f", "start_time": chunk, "end_time": "e", "summary": summary, "text_content": "t", "tags": [], "participants": [], "vector": [1.0, 0.0], "boundary_type": "semantic", **more}


def test_versioned_upsert(spark, tmp_path):
    frame = lambda *rows: spark.createDataFrame(list(rows), RECORD)
    table = VersionedTable(spark, str(tmp_path / "kb"))
    with pytest.raises(GateError):
        table.read()
    load_records(table, frame(record("1_0", "old"), record("1_5", "gone"), record("2_0", "other", 2)), 2)
    load_records(table, frame(record("1_0", "new"), record("1_0", "again")), 2)
    got = {r.chunk_id: r.summary for r in table.read().collect()}
    assert set(got) == {"1_0", "2_0"} and got["1_0"] in ("new", "again") and table.version() == 2
    load_records(table, frame(record("1_0", got["1_0"])), 2)
    assert {r.chunk_id: r.summary for r in table.read().collect()} == got and load_records(table, frame(), 2) == 3
    with pytest.raises(GateError, match="finite"):
        load_records(table, frame(record("9_0", "x", vector=[1.0, float("inf")])), 2)
    with pytest.raises(Exception):
        table.write(frame(record("3_0", "late")), expected=1)
    kept = merge_upsert(frame(record("a", "1"), record("b", "2")), frame(record("a", "3")))
    assert {r.chunk_id: r.summary for r in kept.collect()} == {"a": "3", "b": "2"}
    write_backup(table.read(), str(tmp_path / "backup"))
    assert "vector" not in spark.read.json(str(tmp_path / "backup")).columns


def test_streaming(spark, tmp_path):
    rows = [(i % 4, dt.datetime(2026, 1, 1) + dt.timedelta(seconds=30 * i), "done" if i % 3 else "failed") for i in range(200)] + [(9, dt.datetime(2026, 1, 2), "done")]
    events = spark.createDataFrame(rows, "file_id bigint, ts timestamp, status string")
    events.write.parquet(str(tmp_path / "in"))
    stream = lambda: event_stream(spark, str(tmp_path / "in"), events.schema)
    table = VersionedTable(spark, str(tmp_path / "latest"))
    for _ in range(2):  # a second run finds nothing new
        upsert_stream(stream(), table, "file_id", str(tmp_path / "ck"), once=True).awaitTermination()
    last = {r.file_id: (r.ts, r.status) for r in table.read().collect()}
    assert last == {k: max((t, s) for f, t, s in rows if f == k) for k in {r[0] for r in rows}}
    for name, make in (("counts", windowed_counts), ("idle", lambda s: idle_files(s, WatchParams(stuck_sec=600)))):
        q = make(stream()).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
    assert spark.sql("SELECT sum(n) AS n FROM counts").first().n == 200
    assert {(r.file_id, r.n) for r in spark.sql("SELECT file_id, n FROM idle").collect()} == {(k, 50) for k in range(4)}


def oracle_rows(rows):
    clean = lambda v: None if v is None or v != v else round(v, 6) + 0.0 if isinstance(v, float) else v
    return sorted((tuple(map(clean, r)) for r in rows), key=repr)


def test_queries_equal_their_oracles(spark):
    import duckdb

    from captionlake.plans import queries as core

    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    found, sql = core.queries(), core.oracle_sql()
    assert set(sql) <= set(found) and set(found) - set(sql) == {"breaker_fold"}
    for name, f in found.items():
        got = f(spark, SF)
        if name in sql:
            want = con.execute(sql[name])
            columns = [c[0] for c in want.description]
            assert sorted(columns) == sorted(got.columns), name
            assert oracle_rows(got.select(*columns).collect()) == oracle_rows(want.fetchall()), name
        else:
            assert got.count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_core_does_without_the_training_data_package(tmp_path):
    """Nothing outside it imports the subpackage."""
    code = "import sys; sys.modules['captionlake.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') for k in q) and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True)


def orders_and_lines(spark, folder, orders):
    spark.createDataFrame([(i,) for i in orders], "o_orderkey bigint").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(i, k) for i in orders for k in range(1, i % 4 + 1)], "l_orderkey bigint, l_linenumber int").write.parquet(f"{folder}/lineitem.parquet")


def test_documents_are_parsed_once(spark, tmp_path):
    """Spark pushes what it infers from an explode below the parser's projections; reading then grows with each time a column is named."""
    orders_and_lines(spark, tmp_path, range(40))
    found = audit_queries.audit_file_reports(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") <= 8
    db = duckdb.connect()
    for name in ("orders", "lineitem"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert sorted(map(tuple, found.collect())) == sorted(db.sql(SQL["audit_file_reports"]).fetchall())


def test_each_keeps_null_elements(spark):
    rows = spark.createDataFrame([(1, [5, None]), (2, []), (3, None)], "k int, a array<int>")
    assert sorted(map(tuple, each(rows, "a", "x", "k").collect()), key=str) == [(1, 5), (1, None)]


def test_shapes_of_errors(spark, tmp_path):
    """Chunk errors as objects, texts, an empty list with a text, and blank; an id that is null is there."""
    errors = [{"errors": [{"model": "a", "message": "x"}, "y", {"message": "z"}]}, {"errors": "one"}, {"errors": [], "error": "two"}, {"errors": " ", "error": {"model": "b", "message": "w"}}, {"error": ""}, {}]
    chunks = [{"chunk_id": None, "model_used": "m", **e} for e in errors] + ["no object", {"status": "done"}]
    (tmp_path / "batch_status_1.json").write_text(json.dumps([{"file_id": 1, "chunks": chunks}, None, 7]))
    facts = sorted(file_facts(read_status(spark, str(tmp_path))).collect(), key=lambda r: len(r.missing))
    assert [r.file_id for r in facts] == [1, None, None] and [len(r.missing) for r in facts] == [3, 5, 5]
    assert [[tuple(e) for e in c.errors] for c in facts[0].chunks] == [[("a", "x"), ("m", "y"), ("m", "z")], [("m", "one")], [("m", "two")], [("b", "w")], [], [], [], []]
    assert [c.has_id for c in facts[0].chunks] == [True] * 6 + [False] * 2 and [c.is_object for c in facts[0].chunks] == [True] * 6 + [False, True]


def test_documents_do_not_grow_with_the_orders(spark, tmp_path, monkeypatch):
    """More orders are more documents of the same batches, and the score over all of them is the SQL's."""
    orders_and_lines(spark, tmp_path, range(97 * 5))
    monkeypatch.setattr(audit_queries, "_IN_ONE", 2)
    docs = audit_queries.status_documents(spark, str(tmp_path)).where("batch NOT LIKE '%\\_x.json' AND batch NOT LIKE '%\\_y.json' AND batch NOT LIKE '%\\_z.json'")
    sizes = [(r.batch, len(x["files"] if isinstance(x := json.loads(r.raw), dict) else x)) for r in docs.collect()]
    assert len({b for b, _ in sizes}) == 97 and max(n for _, n in sizes) == 2 and sum(n for _, n in sizes) == 97 * 5
    db = duckdb.connect()
    for name in ("orders", "lineitem"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert list(map(tuple, audit_queries.audit_overall(spark, str(tmp_path)).collect())) == db.sql(SQL["audit_overall"]).fetchall()


def test_audit_writes_no_whole_documents(spark, tmp_path, monkeypatch):
    """A page of whole documents takes a hundred times the longest; files and problems are written instead, and all issues are the SQL's."""
    orders_and_lines(spark, tmp_path, range(97 * 2))
    written, write = [], audit_queries.materialize
    monkeypatch.setattr(audit_queries, "materialize", lambda df, label: (written.append(df.columns), write(df, label))[1])
    found = audit_queries.audit_documents(spark, str(tmp_path)).collect()
    assert written and not any("raw" in columns for columns in written)
    db = duckdb.connect()
    for name in ("orders", "lineitem"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert sorted(map(tuple, found), key=str) == sorted(db.sql(SQL["audit_documents"]).fetchall(), key=str)


def test_files_and_problems_in_one_reading(spark):
    docs = status_problems(spark.createDataFrame([("a", '[{"file_id": 1}, null]'), ("b", "[{"), ("c", '{"x": 1}'), ("d", "[ ]"), ("e", '{"files": [{"file_id": 2}]}')], "batch string, raw string"))
    rows = file_facts(docs, problems=True)
    assert sorted(map(tuple, rows.select("batch", "problem", "file_id").collect()), key=str) == [("a", None, 1), ("a", None, None), ("b", "not JSON", None), ("c", "not a list", None), ("d", "empty", None), ("e", None, 2)]
    plain = rows.where("problem IS NULL").drop("problem")
    assert plain.columns == file_facts(docs).columns and sorted(map(str, plain.collect())) == sorted(map(str, file_facts(docs).collect()))


def test_overall_score_without_whole_documents(spark, tmp_path, monkeypatch):
    """The score comes from one written table of files and problems, and equals the SQL's."""
    orders_and_lines(spark, tmp_path, range(97))
    written, write = [], audit_queries.materialize
    monkeypatch.setattr(audit_queries, "materialize", lambda df, label: (written.append(df.columns), write(df, label))[1])
    found = audit_queries.audit_overall(spark, str(tmp_path)).collect()
    assert len(written) == 1 and "problem" in written[0] and "raw" not in written[0]
    db = duckdb.connect()
    for name in ("orders", "lineitem"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert list(map(tuple, found)) == db.sql(SQL["audit_overall"]).fetchall()


def test_overall_score_writes_counts_only(spark, tmp_path, monkeypatch):
    """No file is written on the way to the score, only counts; the scores from them are those from issues."""
    orders_and_lines(spark, tmp_path, range(97 * 3))
    written, write = [], audit_queries.materialize
    monkeypatch.setattr(audit_queries, "materialize", lambda df, label: (written.append(write(df, label)), written[-1])[1])
    found = audit_queries.audit_overall(spark, str(tmp_path)).collect()
    assert [t.columns for t in written] == [["batch", "problem", "what", "of", "n"]]
    assert {(r.problem, r.what, r.of, r.n) for r in written[0].where("problem IS NOT NULL").collect()} == {("not JSON", "A0", "CRITICAL", 1), ("empty", "A0", "WARN", 1), ("not a list", "A0", "CRITICAL", 1)}
    rows = write(file_facts(status_problems(audit_queries.status_documents(spark, str(tmp_path))), problems=True), "test")
    files, as_of, clamp = rows.where("problem IS NULL").drop("problem"), F.lit(dt.datetime(2026, 1, 1)), AuditParams(fix_clamp=True)
    issues = write(audit_issues(files, as_of), "test")
    crossed = issues.where("check LIKE 'F%'")
    for params in (AuditParams(), clamp):
        by_issues, by_counts = audit_scores(files, issues, as_of, params), tally_scores(written[0], params, crossed)
        assert sorted(map(tuple, by_issues.collect())) == sorted(map(tuple, by_counts.collect()))
    assert list(map(tuple, overall_score(tally_scores(written[0])).collect())) == [(r.overall, r.exit_code) for r in found]
    with pytest.raises(ValueError):
        tally_scores(written[0], clamp)
