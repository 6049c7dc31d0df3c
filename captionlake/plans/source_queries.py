"""Sources and sinks by a round trip through files in the shared folder, each against its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captionlake.config import WatchParams
from captionlake.operators import diagnostics, hooks, prompts, status, summaries
from captionlake.operators.summaries import GateError
from captionlake.plans import bindings as b
from captionlake.plans.gate_queries import _ask, rows_of
from captionlake.plans.registry import query
from captionlake.schemas import RECORD
from captionlake.sources import manifest, reports, srt, tables
from captionlake.sources import status as documents
from captionlake.streaming import watch
from captionlake.workspace import fresh_path, materialize


def write_files(rows: DataFrame, folder: str) -> None:
    """(name, content): a file for each row, through Spark's file systems; few and small ones, as tests write them."""
    spark = rows.sparkSession
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for r in rows.collect():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{r['name']}")
        out = path.getFileSystem(conf).create(path, True)
        out.write(bytes(r["content"]))
        out.close()


def _files(spark, d) -> DataFrame:
    """Forty documents as subtitle files of three lines, every third in Big5, every fourth with Windows line ends."""
    docs = b.table(spark, d, "documents").where("doc_id < 40").select("doc_id")
    t = lambda k: F.lit(f"00:00:0{k},000 --> 00:00:0{k + 1},500")
    text = F.concat_ws("\n", F.lit("1"), t(0), F.concat(F.lit("行 "), F.col("doc_id").cast("string")), F.lit(""), F.lit("2"), F.lit("no time"), F.lit("lost"), F.lit(""), F.lit("3"), t(2), F.lit("second"), F.lit("  line "))
    ends = F.when(F.col("doc_id") % 4 == 0, F.replace(text, F.lit("\n"), F.lit("\r\n"))).otherwise(text)
    utf8 = F.encode(ends, "UTF-8")
    # the character's two bytes in Big5
    body = F.when(F.col("doc_id") % 3 == 0, F.unhex(F.replace(F.hex(utf8), F.lit("E8A18C"), F.lit("A6E6")))).otherwise(utf8)
    return docs.select("doc_id", F.concat(F.lpad(F.col("doc_id").cast("string"), 3, "0"), F.lit(".srt")).alias("name"), body.alias("content"))


@query("""WITH f AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS file_id FROM documents WHERE doc_id < 40)
SELECT file_id, 0 AS idx, '00:00:00,000' AS start_time, '00:00:01,500' AS end_time, '行 ' || CAST(doc_id AS VARCHAR) AS text FROM f UNION ALL SELECT file_id, 1, '00:00:02,000', '00:00:03,500', 'second line' FROM f""")
def srt_files(spark, d):
    """Subtitle files in UTF-8 and Big5, in order of path, with a block that has no time."""
    folder = fresh_path(spark, "srt")
    write_files(_files(spark, d).select("name", "content"), folder)
    return srt.read_srt(spark, folder)


@query("SELECT 'refused' AS said")
def srt_too_large(spark, d):
    """A file above the limit fails the query, a missing folder is an error."""
    folder = fresh_path(spark, "srt")
    write_files(_files(spark, d).select("name", "content").limit(2), folder)
    said = []
    for path, limit in ((folder, 10), (f"{folder}-none", 10_000)):
        try:
            srt.read_srt(spark, path, limit).collect()
        except Exception as e:  # noqa: BLE001
            said.append("too large" in str(e) or "does not exist" in str(e))
    return rows_of(spark, "said string", [("refused" if said == [True, True] else str(said),)])


@query("""WITH f AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS id FROM documents WHERE doc_id < 40 AND doc_id % 5 <> 0), n AS (SELECT *, lpad(CAST(doc_id AS VARCHAR), 3, '0') AS s FROM f)
SELECT 'entry' AS what, id, s || '.srt' AS filename_srt, s || '.mp3' AS filename_mp3 FROM n UNION ALL SELECT 'alone', count(*) FILTER (WHERE doc_id % 5 = 0), NULL, NULL FROM documents WHERE doc_id < 40
UNION ALL SELECT 'found', id, s || '.srt', NULL FROM n WHERE id = 3 UNION ALL SELECT 'range', id, s || '.srt', NULL FROM n WHERE id BETWEEN 30 AND 90 UNION ALL SELECT 'unknown id', NULL, NULL, NULL""")
def manifest_round_trip(spark, d):
    """Files with a sound file of the same name become a manifest, which is written and read."""
    folder = fresh_path(spark, "media")
    few = b.table(spark, d, "documents").where("doc_id < 40").select("doc_id", F.lpad(F.col("doc_id").cast("string"), 3, "0").alias("s"))
    names = few.select(F.concat("s", F.lit(".srt")).alias("name")).unionByName(few.where("doc_id % 5 <> 0").select(F.concat("s", F.lit(".mp3")).alias("name")))
    write_files(names.select("name", F.encode(F.lit("x"), "UTF-8").alias("content")), folder)
    pairs, alone = manifest.scan_pairs(manifest.list_files(spark, folder, "*.srt"), manifest.list_files(spark, folder, "*.mp3"))
    path = fresh_path(spark, "manifest")
    manifest.write_manifest(manifest.build_manifest(pairs), path)
    table = manifest.read_manifest(spark, f"{path}/*.json")
    none = F.lit(None).cast("string")
    row = lambda rows, what, mp3=none: rows.select(F.lit(what).alias("what"), "id", "filename_srt", mp3.alias("filename_mp3"))
    try:
        manifest.lookup(table, 99_999)
        unknown = []
    except GateError:
        unknown = [("unknown id", None, None, None)]
    kinds = "what string, id bigint, filename_srt string, filename_mp3 string"
    out = row(table, "entry", F.col("filename_mp3")).unionByName(row(manifest.lookup(table, 3), "found")).unionByName(row(manifest.batch_range(table, 30, 90), "range"))
    return out.unionByName(alone.agg(F.count("*").alias("id")).select(F.lit("alone").alias("what"), "id", none.alias("filename_srt"), none.alias("filename_mp3"))).unionByName(rows_of(spark, kinds, unknown))


@query("SELECT 'b.json' AS latest, 'z' AS by_name")
def latest_report(spark, d):
    """Of equal times the last by name; files by their own times."""
    import time

    folder = fresh_path(spark, "reports")
    for name in ("c.json", "b.json"):
        write_files(rows_of(spark, "name string, content binary", [(name, bytearray(b"{}"))]), folder)
        time.sleep(1.1)  # times of files are in seconds in some stores
    write_files(rows_of(spark, "name string, content binary", [("d.txt", bytearray(b"{}"))]), folder)
    found = manifest.latest_file(spark, folder, "*.json")
    ties = manifest.latest(rows_of(spark, "path string, at int", [("a", 1), ("z", 2), ("y", 2)]))
    return ties.select(F.lit(found.rsplit("/", 1)[1]).alias("latest"), F.col("path").alias("by_name"))


@query("""SELECT 'batch_status_' || CAST(o_orderkey % 3 AS VARCHAR) || '.json' AS batch, o_orderkey AS file_id, CASE WHEN o_orderkey % 2 = 0 THEN 'done' ELSE 'undone' END AS status FROM orders WHERE o_orderkey % 50 = 0 UNION ALL SELECT 'batch_status_9.json', NULL, 'not JSON'""")
def status_files(spark, d):
    """Status documents by name, in both shapes, one that is broken and a file of another name."""
    item = F.to_json(F.struct(F.col("o_orderkey").alias("file_id"), F.when(F.col("o_orderkey") % 2 == 0, "done").otherwise("undone").alias("status")))
    docs = b.table(spark, d, "orders").where("o_orderkey % 50 = 0").groupBy((F.col("o_orderkey") % 3).alias("k")).agg(F.array_join(F.collect_list(item), ",").alias("t"))
    text = F.when(F.col("k") == 1, F.concat(F.lit('{"files":['), "t", F.lit("]}"))).otherwise(F.concat(F.lit("["), "t", F.lit("]")))
    folder = fresh_path(spark, "status")
    write_files(docs.select(F.concat(F.lit("batch_status_"), F.col("k").cast("string"), F.lit(".json")).alias("name"), F.encode(text, "UTF-8").alias("content")), folder)
    write_files(rows_of(spark, "name string, content binary", [("batch_status_9.json", bytearray(b"[{")), ("other.json", bytearray(b"[]"))]), folder)
    found = documents.read_status(spark, folder)
    good = documents.file_facts(found).select("batch", "file_id", "status")
    return good.unionByName(found.where("problem IS NOT NULL").select("batch", F.lit(None).cast("bigint").alias("file_id"), F.col("problem").alias("status")))


@query("""WITH c AS (SELECT conv_id AS file_id, turn AS start_idx, CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS chunk_id, text FROM conversations)
SELECT file_id, count(*) AS total_chunks, string_agg(chunk_id || ':pending:' || CAST(least(length(text), 100) AS VARCHAR), ',' ORDER BY start_idx) AS chunks FROM c GROUP BY file_id""")
def initial_status(spark, d):
    """Every chunk of a file pending, with a preview of its text."""
    chunks = b.table(spark, d, "conversations").select(F.col("conv_id").alias("file_id"), F.col("turn").alias("start_idx"), F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("chunk_id"), F.col("text").alias("text_content"))
    one = F.transform("chunks", lambda c: F.concat_ws(":", c["chunk_id"], c["status"], F.length(c["text_preview"]).cast("string")))
    return documents.initial_chunk_status(chunks).select("file_id", F.col("total_chunks").cast("bigint").alias("total_chunks"), F.array_join(one, ",").alias("chunks"))


@query("""SELECT 'chunks' AS stage, conv_id AS file_id, 'new ' || text AS text FROM conversations WHERE conv_id % 2 = 0 UNION ALL SELECT 'chunks', conv_id, text FROM conversations WHERE conv_id % 2 <> 0 UNION ALL SELECT 'meta', conv_id, 'title' FROM (SELECT DISTINCT conv_id FROM conversations) UNION ALL SELECT 'records', NULL, 'gone'""")
def stage_tables(spark, d):
    """Stages by file; a run for some files replaces theirs only; finished stages are removed."""
    path = fresh_path(spark, "stages")
    rows = b.table(spark, d, "conversations").select(F.col("conv_id").alias("file_id"), "text")
    reports.write_stage(rows, path, "chunks")
    reports.write_stage(rows.where("file_id % 2 = 0").withColumn("text", F.concat(F.lit("new "), "text")), path, "chunks")
    reports.write_stage(rows.select("file_id").distinct().withColumn("text", F.lit("title")), path, "meta")
    reports.write_stage(rows, path, "records")
    reports.drop_stages(spark, path, ["records"])
    gone = [("records", None, "gone")] if not reports.path_exists(spark, f"{path}/records") else []
    stage = lambda name: reports.read_stage(spark, path, name).select(F.lit(name).alias("stage"), F.col("file_id").cast("bigint").alias("file_id"), "text")
    return stage("chunks").unionByName(stage("meta")).unionByName(rows_of(spark, "stage string, file_id bigint, text string", gone))


@query("""WITH p AS (SELECT doc_id, length('Summarise this part of a transcript and give tags. Answer with one JSON object: {"summary": "", "tags": []}' || chr(10) || chr(10) || coalesce(text, '')) AS n FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS chunk_id, CASE WHEN n % 11 <> 0 AND n % 7 <> 0 THEN 'done' ELSE 'failed' END AS status, 1 + CASE WHEN n % 11 <> 0 AND n % 7 <> 0 THEN 0 ELSE 1 END AS asked FROM p""")
def checkpointed_run(spark, d):
    """Parts are added as they finish; a second run asks again for failed chunks only."""
    path = fresh_path(spark, "checkpoint")
    chunks = materialize(b.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), F.col("text").alias("text_content")), "chunks")
    summarize = lambda part: hooks.summarize_chunks(part, _ask(), prompts.summary_prompt(F.col("text_content")))
    for _ in range(2):
        last = reports.summarize_checkpointed(chunks, path, summarize, part_rows=max(1, chunks.count() // 3))
    asked = spark.read.parquet(path).groupBy("chunk_id").agg(F.count("*").cast("int").alias("asked"))
    return last.select("chunk_id", "status").join(asked, "chunk_id")


@query("SELECT 'no chunks: nothing to summarise' AS said, 1 AS zero_chunk_errors")
def zero_chunks(spark, d):
    """Without chunks the statistics are written, and the run is refused."""
    path = fresh_path(spark, "checkpoint")
    nothing = b.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), F.col("text").alias("text_content")).limit(0)
    try:
        reports.summarize_checkpointed(nothing, path, lambda part: part)
        said = "accepted"
    except GateError as e:
        said = str(e)
    stats = spark.read.json(f"{path}.stats")
    return stats.select(F.lit(said).alias("said"), F.col("error_distribution.ZERO_CHUNKS_ERROR").cast("int").alias("zero_chunk_errors"))


def _kb(spark, d, summary: str, where: str) -> DataFrame:
    """Records of documents: a file has five."""
    text = lambda c: F.col(c).cast("string")
    return b.table(spark, d, "documents").where(where).select(
        F.concat_ws("_", F.floor(F.col("doc_id") / 5).cast("string"), text("doc_id")).alias("chunk_id"), F.floor(F.col("doc_id") / 5).alias("file_id"), F.concat(F.lit("name "), F.floor(F.col("doc_id") / 5).cast("string"), F.lit(".srt")).alias("file_name"),
        text("doc_id").alias("start_time"), text("doc_id").alias("end_time"), F.lit(summary).alias("summary"), F.coalesce("text", F.lit("")).alias("text_content"), F.array(F.lit("t")).alias("tags"), F.array().cast("array<string>").alias("participants"),
        F.array(F.lit(1.0).cast("float"), F.lit(0.0).cast("float")).alias("vector"), F.lit("semantic").alias("boundary_type"), F.col("doc_id").alias("position"),
    )


@query("""SELECT 'table' AS what, CAST(doc_id // 5 AS VARCHAR) || '_' || CAST(doc_id AS VARCHAR) AS chunk_id, CASE WHEN (doc_id // 5) % 2 = 0 THEN 'new' ELSE 'old' END AS summary FROM documents WHERE (doc_id // 5) % 2 <> 0 OR doc_id % 2 = 0
UNION ALL SELECT 'backup', CAST(doc_id // 5 AS VARCHAR) || '_' || CAST(doc_id AS VARCHAR), CAST(doc_id // 5 AS VARCHAR) || '_name ' || CAST(doc_id // 5 AS VARCHAR) FROM documents WHERE (doc_id // 5) % 2 <> 0 OR doc_id % 2 = 0
UNION ALL SELECT 'versions', NULL, '2' UNION ALL SELECT 'empty batch', NULL, '2' UNION ALL SELECT 'bad record', NULL, 'refused'""")
def records_table(spark, d):
    """First of equal keys wins, batches replace their files' records, a lost writer is in nobody's way."""
    table = tables.VersionedTable(spark, fresh_path(spark, "kb"), wait_sec=0.01)
    tables.load_records(table, _kb(spark, d, "old", "true"), 2)
    # what a writer leaves that is lost before the pointer moves, and one that holds the lock no more
    _kb(spark, d, "lost", "true").drop("position").write.parquet(f"{table.path}/v2-lost")
    table._put("LOCK", "lost", False)
    table.lock_sec = -1.0
    changed = _kb(spark, d, "new", "(doc_id div 5) % 2 = 0 AND doc_id % 2 = 0")
    doubled = changed.unionByName(changed.withColumn("summary", F.lit("again")).withColumn("position", F.col("position") + 1_000_000))
    table_version = tables.load_records(table, doubled, 2)
    table.vacuum()
    unchanged = tables.load_records(table, changed.limit(0), 2)
    try:
        tables.load_records(table, changed.withColumn("vector", F.array(F.lit(1.0).cast("float"))), 2)
        refused = "accepted"
    except GateError:
        refused = "refused"
    path = fresh_path(spark, "backup")
    tables.write_backup(table.read(), path)
    backup = spark.read.json(path)
    if "vector" in backup.columns or set(RECORD.names) - set(table.read().columns):
        refused = "columns"
    out = table.read().select(F.lit("table").alias("what"), "chunk_id", "summary").unionByName(backup.select(F.lit("backup").alias("what"), "chunk_id", F.col("backup").alias("summary")))
    said = [("versions", None, str(table_version)), ("empty batch", None, str(unchanged)), ("bad record", None, refused)]
    return out.unionByName(rows_of(spark, "what string, chunk_id string, summary string", said))


@query("""SELECT * FROM (VALUES ('none', 1, 0), ('done', 2, 3), ('late writer', 2, 3)) AS v(change, version, files)""")
def status_update(spark, d):
    """A caller's change of the rows, none at all, and one that meets another writer."""
    table = tables.VersionedTable(spark, fresh_path(spark, "status"), wait_sec=0.01)
    table.write(rows_of(spark, "file_id int, status string", [(i, "undone") for i in range(3)]))
    done = lambda: table.read().where("status = 'done'").count()
    said = [("none", table.update(lambda rows: None), done())]
    tried: list[int] = []

    def change(rows: DataFrame) -> DataFrame:
        tried.append(1)
        return rows.withColumn("status", F.lit("done"))

    said.append(("done", table.update(change), done()))
    try:
        table.write(table.read().limit(0), expected=1)
        late = "accepted"
    except GateError:
        late = "late writer"
    said.append((late, table.version(), done()))
    return rows_of(spark, "change string, version int, files int", said)


# --- reports -------------------------------------------------------------------------------------


def _segments(spark, d) -> DataFrame:
    e = b.table(spark, d, "embeddings")
    end = lambda k: F.struct(F.concat((F.col("vec_id") % k).cast("string"), F.lit("%")).alias("label"))
    return e.select(
        F.col("label").cast("bigint").alias("file_id"), F.concat_ws("_", F.col("label").cast("string"), F.col("vec_id").cast("string")).alias("chunk_id"), F.lpad((F.col("vec_id") % 90).cast("string"), 2, "0").alias("start_time"), F.lpad((F.col("vec_id") % 90 + 1).cast("string"), 2, "0").alias("end_time"),
        (F.col("vec_id") % 4 == 0).alias("dropped"), F.when(F.col("vec_id") % 4 == 0, "short").alias("drop_reason"), F.when(F.col("vec_id") % 3 != 0, "s").alias("summary"), F.when(F.col("vec_id") % 5 != 0, "t").otherwise("").alias("text_content"), end(7).alias("left_boundary"), end(9).alias("right_boundary"),
    )


_SEGMENT = "seg AS (SELECT CAST(label AS BIGINT) AS file_id, CAST(label AS VARCHAR) || '_' || CAST(vec_id AS VARCHAR) AS chunk_id, vec_id, lpad(CAST(vec_id % 90 AS VARCHAR), 2, '0') AS start_time, lpad(CAST(vec_id % 90 + 1 AS VARCHAR), 2, '0') AS end_time, vec_id % 4 = 0 AS dropped FROM embeddings)"


@query(f"""WITH {_SEGMENT} SELECT file_id, CASE WHEN dropped THEN 'x ' ELSE '  ' END || chunk_id || ' ' || start_time || ' - ' || end_time || ' [' || CAST(vec_id % 7 AS VARCHAR) || '% | ' || CAST(vec_id % 9 AS VARCHAR) || '%]' || CASE WHEN dropped THEN ' short' ELSE '' END AS line,
row_number() OVER (PARTITION BY file_id ORDER BY start_time, dropped, chunk_id) AS place FROM seg""")
def segment_listing(spark, d):
    """Kept and dropped segments by start, kept ones first."""
    from pyspark.sql.window import Window

    listed = materialize(reports.segment_listing(_segments(spark, d)).coalesce(1).withColumn("at", F.monotonically_increasing_id()), "listing")
    return listed.select("file_id", "line", F.row_number().over(Window.partitionBy("file_id").orderBy("at")).cast("bigint").alias("place"))


@query(f"""WITH {_SEGMENT} SELECT 'file ' || CAST(file_id AS VARCHAR) || ', wide: ' || CAST(count(*) FILTER (WHERE NOT dropped) AS VARCHAR) || ' kept, ' || CAST(count(*) FILTER (WHERE dropped) AS VARCHAR) || ' dropped' || chr(10) || string_agg(CASE WHEN dropped THEN 'x ' ELSE '  ' END || start_time || ' - ' || end_time || ' ' || chunk_id, chr(10) ORDER BY start_time, dropped, chunk_id) AS text, file_id FROM seg GROUP BY file_id""")
def run_report(spark, d):
    """The run's document as text."""
    few = _segments(spark, d).select("file_id", "chunk_id", "start_time", "end_time", "dropped")
    return reports.render_run(reports.run_document(few, "wide"))


@query(f"""WITH {_SEGMENT} SELECT file_id, 'report_wide' AS label, chunk_id, NOT dropped AND vec_id % 3 <> 0 AND vec_id % 5 <> 0 AS judged FROM seg""")
def report_readers(spark, d):
    """Run documents written as JSON and read back as segments with their labels; those fit for the fidelity judge."""
    folder = fresh_path(spark, "runs")
    document = reports.run_document(_segments(spark, d), "wide")
    named = document.select(F.concat(F.col("file_id").cast("string"), F.lit("_test_report_wide.json")).alias("name"), F.encode(F.to_json(F.struct("file_id", "label", "total_kept", "segments")), "UTF-8").alias("content"))
    write_files(named.unionByName(rows_of(spark, "name string, content binary", [("9_test_report_none.json", bytearray(b'{"file_id": 9}'))])), folder)
    found = materialize(reports.read_reports(spark, folder, multi_line=True), "segments")
    fit = reports.fidelity_segments(found).select("chunk_id").withColumn("judged", F.lit(True))
    return found.join(fit, "chunk_id", "left").select("file_id", "label", "chunk_id", F.coalesce("judged", F.lit(False)).alias("judged"))


@query(f"""WITH {b.LATEST}, f AS (SELECT file_id, 'b' || CAST(file_id % 3 AS VARCHAR) AS batch, CASE WHEN file_id % 7 = 0 OR (file_id % 3 = 1 AND file_id % 5 <> 0) THEN 'failed_permanent' ELSE 'done' END AS status FROM latest), s AS (SELECT batch, avg(CASE WHEN status = 'failed_permanent' THEN 1.0 ELSE 0.0 END) AS share FROM f GROUP BY 1)
SELECT batch, file_id, 'failed' AS kind FROM f WHERE status = 'failed_permanent' UNION ALL SELECT batch, NULL, 'critical' FROM s WHERE share > 0.5""")
def alerts(spark, d):
    """Files that failed for good, and batches with too many of them."""
    files = status.latest_status(b.status_events(spark, d)).select("file_id", F.concat(F.lit("b"), (F.col("file_id") % 3).cast("string")).alias("batch"), F.when((F.col("file_id") % 7 == 0) | ((F.col("file_id") % 3 == 1) & (F.col("file_id") % 5 != 0)), "failed_permanent").otherwise("done").alias("status"))
    path = fresh_path(spark, "alerts")
    reports.write_json(reports.alert_rows(files), path)
    return spark.read.schema("batch string, file_id bigint, kind string").json(path)


@query(f"""WITH {b.CHUNKS}, m AS (SELECT model_used AS model, count(*) FILTER (WHERE status = 'done') AS success, count(*) FILTER (WHERE status = 'failed') AS fail FROM chunks GROUP BY 1)
SELECT 'models' AS document, string_agg(model || ':' || CAST(success AS VARCHAR), ',' ORDER BY model) AS listed FROM m UNION ALL SELECT 'top failed', string_agg(model || ':' || CAST(fail AS VARCHAR), ',' ORDER BY fail DESC, model) FROM m WHERE fail > 0""")
def model_documents(spark, d):
    """A file's model diagnostics and the models that failed most, as documents."""
    found = materialize(diagnostics.model_performance(b.chunk_facts(spark, d)), "performance")
    path, failed = fresh_path(spark, "diagnostics"), fresh_path(spark, "failed")
    reports.write_json(reports.diagnostics_document(found, 7), path)
    reports.write_json(reports.failed_models_document(found), failed)
    listed = lambda rows, name, column, n: rows.select(F.lit(name).alias("document"), F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["model"], x[n].cast("string"))), ",").alias("listed"))
    return listed(spark.read.json(path).where("file_id = 7"), "models", "models", "success").unionByName(listed(spark.read.json(failed), "top failed", "top_failed_models", "fail"))


@query(f"""WITH {b.LATEST}, {b.CHUNKS} SELECT (SELECT string_agg(status || '=' || CAST(n AS VARCHAR), ',' ORDER BY status) FROM (SELECT status, count(*) AS n FROM latest GROUP BY 1)) AS by_status, (SELECT count(*) FROM latest) AS total, (SELECT count(*) FILTER (WHERE status = 'done') FROM latest) AS done, 1 AS patterns""")
def error_document(spark, d):
    """The histogram, the rate and the patterns in one document."""
    files = status.latest_status(b.status_events(spark, d))
    patterns = status.error_patterns(rows_of(spark, "message string", [("timeout after 12 s",), ("timeout after 9 s",)]))
    path = fresh_path(spark, "errors")
    reports.write_json(reports.error_document(status.status_histogram(files), status.success_rate(files), patterns), path)
    found = spark.read.json(path)
    return found.select(F.array_join(F.transform("by_status", lambda x: F.concat_ws("=", x["status"], x["n"].cast("string"))), ",").alias("by_status"), "total", "done", F.size("patterns").alias("patterns"))


@query("SELECT 6 AS scores, 'A' AS first_letter, 'CRITICAL,WARN,INFO,INFO' AS severities, 2 AS infos, 0 AS exit_code")
def audit_report(spark, d):
    """The audit as a summary, and its issues with the worst first."""
    files = rows_of(spark, "batch string, file_id bigint", [("b", 1)])
    scores = rows_of(spark, "batch string, letter string, score double, issue_count bigint", [("b", x, 95.0, 1) for x in "ABCDEF"])
    issues = rows_of(spark, "batch string, file_id bigint, severity string, check string, msg string", [("b", 1, "INFO", "F0", "x"), ("b", 1, "CRITICAL", "A0", "x"), ("b", 1, "WARN", "A2", "x"), ("b", 2, "INFO", "F0", "x")])
    path = fresh_path(spark, "audit")
    reports.write_audit(files, issues, scores, path)
    listed = spark.read.json(f"{path}/issues").select("severity", F.col("_metadata.file_name").alias("f"), F.monotonically_increasing_id().alias("at"))
    said = listed.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("f", "at", "severity"))), lambda x: x["severity"]), ",").alias("severities"))
    found = spark.read.json(f"{path}/summary").select(F.size("scores").alias("scores"), F.col("scores")[0]["letter"].alias("first_letter"), F.col("issue_counts.INFO").cast("int").alias("infos"), F.col("exit_code").cast("int").alias("exit_code"))
    return found.crossJoin(said)


# --- streams -------------------------------------------------------------------------------------


def _streamed(spark, d, make, kinds: str) -> DataFrame:
    """All that a stream over the events gives, in append mode, through files."""
    source, sink = fresh_path(spark, "events"), fresh_path(spark, "sink")
    events = b.status_events(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    # a last event far ahead moves the watermark over all others
    end = events.agg((F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts")).select(F.lit(-1).cast("bigint").alias("file_id"), "ts", F.lit(-1).cast("bigint").alias("seq"), F.lit("end").alias("status"))
    events.repartition(3).write.parquet(source)
    stream = lambda: make(watch.event_stream(spark, source, events.schema, files_per_trigger=10_000))
    run = lambda: stream().writeStream.format("parquet").option("path", f"{sink}/rows").option("checkpointLocation", f"{sink}/checkpoint").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    run()
    end.write.mode("append").parquet(source)
    run()
    return spark.read.schema(kinds).parquet(f"{sink}/rows")


@query(f"""WITH {b.STATUS_EVENTS} SELECT time_bucket(INTERVAL 6 HOURS, ts) AS start, status, count(*) AS n FROM status_events GROUP BY 1, 2""")
def event_windows(spark, d):
    """Events by time window as a stream, in two runs of one checkpoint."""
    found = _streamed(spark, d, lambda s: watch.windowed_counts(s, "6 hours", "1 day"), "start timestamp, end timestamp, status string, n bigint")
    return found.where("status <> 'end'").select(F.col("start").cast("timestamp_ntz").alias("start"), "status", "n")


@query(f"""WITH {b.STATUS_EVENTS}, g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY file_id ORDER BY ts) < INTERVAL 12 HOURS THEN 0 ELSE 1 END AS fresh FROM status_events), s AS (SELECT *, sum(fresh) OVER (PARTITION BY file_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT file_id, max(ts) + INTERVAL 12 HOURS AS idle_since, count(*) AS n FROM s GROUP BY file_id, k""")
def idle_sessions(spark, d):
    """T03 as a stream: sessions that end when a file has had no event for the timeout."""
    found = _streamed(spark, d, lambda s: watch.idle_files(s, WatchParams(stuck_sec=43_200), "1 day"), "file_id bigint, idle_since timestamp, status string, n bigint")
    return found.where("file_id >= 0").select("file_id", F.col("idle_since").cast("timestamp_ntz").alias("idle_since"), "n")


@query(f"""WITH {b.LATEST} SELECT file_id, status FROM latest""")
def streamed_state(spark, d):
    """The state of files kept by a stream; a batch that was lost half-way, and a second run, change nothing more."""
    source, table = fresh_path(spark, "events"), tables.VersionedTable(spark, fresh_path(spark, "state"), wait_sec=0.01)
    checkpoint = fresh_path(spark, "checkpoint")
    events = b.status_events(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartitionByRange(3, "ts", "seq").sortWithinPartitions("ts", "seq").write.parquet(source)
    events.limit(0).write.parquet(f"{table.path}/v1-lost")
    latest = lambda: watch.event_stream(spark, source, events.schema, files_per_trigger=10_000)
    for _ in range(2):
        watch.upsert_stream(latest(), table, "file_id", checkpoint, once=True, order=["ts", "seq"]).awaitTermination()
    return table.read().select("file_id", "status")


@query("SELECT doc_id AS file_id, coalesce(length(text), 0) AS n FROM documents")
def json_codec(spark, d):
    """nested rows to JSON text and back."""
    rows = b.table(spark, d, "documents").select(F.to_json(F.struct(F.col("doc_id").alias("file_id"), F.array(F.struct("text")).alias("chunks"))).alias("j"))
    back = rows.select(F.from_json("j", "struct<file_id:bigint,chunks:array<struct<text:string>>>").alias("r"))
    return back.select("r.file_id", F.coalesce(F.length(F.col("r.chunks")[0]["text"]), F.lit(0)).cast("bigint").alias("n"))


@query("SELECT label AS file_id, CAST(count(*) AS BIGINT) AS n FROM embeddings WHERE vec_id % 2 = 0 GROUP BY label")
def dropped_vectors(spark, d):
    """Rows without their vectors, and the count that a load is held against."""
    rows = b.table(spark, d, "embeddings").where("vec_id % 2 = 0").select(F.col("label").alias("file_id"), "vec_id", F.col("embedding").alias("vector"))
    left = rows.drop("vector")
    summaries.check_count(left, rows.count())
    return left.groupBy("file_id").agg(F.count("*").alias("n"))
