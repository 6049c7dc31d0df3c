"""The six audit dimensions as issue rows and scores per batch file (A-F), most of them one projection of a file."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from captionlake.config import AuditParams
from captionlake.functions.rows import each
from captionlake.functions.text import age_seconds, per_second, utc_timestamp
from captionlake.operators.ordered import place
from captionlake.schemas import ACTIVE, CHUNK_STATES, FAILED, STATES, TERMINAL

REQUIRED = ["file_id", "status", "last_updated", "retry_count", "chunks"]

#: The messages of issues.
MESSAGES = {
    "A1": "Missing required fields: {%s}",
    "A2 unknown": "Unknown file status: '%s",
    "A2 empty": "Empty file status",
    "A3 missing": "Missing last_updated",
    "A3 invalid": "Invalid timestamp: %s",
    "A4 list": "'chunks' is not a list",
    "A4 object": "chunks[%s] is not a dict",
    "A4 id": "chunks[%s] missing chunk_id",
    "A4 status": "chunks[%s] unknown status: '%s'",
    "B1": "Cannot compute last_updated age",
    "B2 stuck": "Stuck in '%s' for %ss (>%ss)",
    "B2 near": "Near-stuck in '%s' for %ss",
    "B3": "Non-terminal status '%s' untouched for %ss",
    "B4 summary": "Done but diagnostics.summary missing",
    "B4 block": "Done but missing diagnostics block",
    "C1": "chunks[%s] failed but has no error detail",
    "C2": "chunks[%s] failed but model_used is empty",
    "C3": "chunks[%s] failed but retry_count is 0",
    "C4": "File failed_permanent but error_log is empty",
    "C5": "Model '%s' diagnostics mismatch: diag(%s/%s) != actual(%s/%s)",
    "D1": "total_chunks=%s != len(chunks)=%s",
    "D2": "Duplicate chunk_id=%s",
    "D3 file": "File retry_count=%s exceeds max %s",
    "D3 chunk": "chunks[%s] retry_count=%s exceeds max %s",
    "D4": "Chunk status sum (%s+%s+%s) != total (%s)",
    "E1": "Overall failure rate is %s%% (%s/%s)",
    "E2": "Model '%s' success rate is %s%% (%s/%s)",
    "F0": "Master manifest not found at '%s', skipping cross-file check",
    "F1": "file_id %s not found in master_file_manifest",
    "F2": "Files in manifest but not in this batch: [%s]...",
}
#: Manifest ids that an F2 issue names.
NAMED = 10
Say = Callable[..., Column]


def _say(key: str, *values: Column | str) -> Column:
    return F.format_string(MESSAGES[key], *[(v if isinstance(v, Column) else F.lit(v)).cast("string") for v in values])


def _mute(key: str, *values: Column | str) -> Column:
    """In place of :func:`_say` where issues are only counted."""
    return F.lit(None).cast("string")


def _issue(severity: str | Column, check: str, msg: Column, when: Column | None = None) -> Column:
    """An issue as a struct, null where ``when`` does not hold."""
    found = F.struct((F.lit(severity) if isinstance(severity, str) else severity).alias("severity"), F.lit(check).alias("check"), msg.alias("msg"))
    return found if when is None else F.when(when, found)


def _file_issues(age: Column, params: AuditParams, say: Say) -> list[Column]:
    status, limit = F.col("status"), str(params.max_retries)
    blank, whole_age = F.coalesce(status, F.lit("")) == "", F.bround(age, 0).cast("bigint")
    total, n_chunks = F.coalesce("total_chunks", F.lit(0)), F.size("chunks")
    no_time = F.when(F.coalesce("last_updated", F.lit("")) == "", say("A3 missing")).otherwise(say("A3 invalid", F.col("last_updated")))
    stuck = age > params.stuck_sec
    names = F.array_join(F.transform(F.array_sort("missing"), lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", ")
    return [
        _issue("ERROR", "A1", say("A1", names), F.size("missing") > 0),
        _issue("ERROR", "A2", say("A2 unknown", status), ~blank & ~status.isin(STATES)),
        _issue("WARN", "A2", say("A2 empty"), blank),
        _issue("WARN", "A3", no_time, age.isNull()),
        _issue("ERROR", "A4", say("A4 list"), ~F.col("chunks_listed")),
        _issue("WARN", "B1", say("B1"), age.isNull()),
        _issue(F.when(stuck, "ERROR").otherwise("WARN"), "B2", F.when(stuck, say("B2 stuck", status, whole_age, str(params.stuck_sec))).otherwise(say("B2 near", status, whole_age)), status.isin(ACTIVE) & (age > params.warn_sec)),
        _issue("WARN", "B3", say("B3", F.coalesce(status, F.lit("")), whole_age), ~F.coalesce(status, F.lit("")).isin(TERMINAL) & (age > params.stale_sec)),
        _issue("WARN", "B4", F.when(F.col("has_diagnostics"), say("B4 summary")).otherwise(say("B4 block")), (status == "done") & age.isNotNull() & ~F.col("has_summary")),
        _issue("WARN", "C4", say("C4"), status.isin(FAILED) & ~F.col("has_error_log")),
        _issue("ERROR", "D1", say("D1", total, n_chunks), total != n_chunks),
        _issue("WARN", "D3", say("D3 file", F.col("retry_count"), limit), F.col("retry_count") > params.max_retries),
    ]


def _chunk_issues(c: Column, ci: Column, params: AuditParams, say: Say) -> list[Column]:
    status = F.coalesce(c["status"], F.lit(""))
    failed = c["is_object"] & status.isin(FAILED)
    return [
        _issue("ERROR", "A4", say("A4 object", ci), ~c["is_object"]),
        _issue("WARN", "A4", say("A4 id", ci), c["is_object"] & ~c["has_id"]),
        _issue("WARN", "A4", say("A4 status", ci, status), c["is_object"] & (status != "") & ~status.isin(CHUNK_STATES)),
        _issue("WARN", "C1", say("C1", ci), failed & ~F.coalesce(c["has_error"], F.lit(False))),
        _issue("WARN", "C2", say("C2", ci), failed & (F.coalesce(c["model_used"], F.lit("")) == "")),
        _issue("WARN", "C3", say("C3", ci), failed & (F.coalesce(c["retry_count"], F.lit(0)) == 0)),
        _issue("WARN", "D3", say("D3 chunk", ci, c["retry_count"], str(params.max_retries)), c["retry_count"] > params.max_retries),
    ]


def _duplicate_issues(say: Say) -> Column:
    """An issue for each chunk id but the first of its like, by a sort of the file's chunks."""
    ids = F.array_sort(F.filter(F.transform("chunks", lambda c, i: F.struct(c["chunk_id"].alias("id"), i.alias("i"))), lambda x: x["id"].isNotNull()))
    sorted_ids = F.transform(F.array(ids), lambda a: F.transform(a, lambda x, k: F.struct(x["id"].alias("id"), F.when(k > 0, F.get(a, k - 1)["id"]).alias("before"))))[0]
    return F.transform(F.filter(sorted_ids, lambda x: x["id"] == x["before"]), lambda x: _issue("ERROR", "D2", say("D2", x["id"])))


def _sum_issue(say: Say) -> Column:
    count = lambda test: F.size(F.filter("chunks", lambda c: test(F.coalesce(c["status"], F.lit("")))))
    done, failed, waiting = count(lambda s: s == "done"), count(lambda s: s.isin(FAILED)), count(lambda s: s.isin("pending", "undone"))
    return _issue("WARN", "D4", say("D4", done, failed, waiting, F.size("chunks")), done + failed + waiting != F.size("chunks"))


def _mismatch_issues(say: Say) -> Column:
    """What a file's diagnostics say of its models against its chunks; models in order of name."""
    named = F.transform(F.filter("chunks", lambda c: c["is_object"]), lambda c: F.struct(F.coalesce(c["model_used"], F.lit("?")).alias("m"), F.coalesce(c["status"], F.lit("")).alias("s")))
    models = F.array_sort(F.array_distinct(F.transform(F.filter(named, lambda x: (x["s"] == "done") | x["s"].isin(FAILED)), lambda x: x["m"])))

    def one(m: Column) -> Column:
        said, zero = F.try_element_at("models", m), F.lit(0).cast("bigint")
        told = F.struct(F.coalesce(said["success"], zero).alias("ok"), F.coalesce(said["fail"], zero).alias("bad"))
        count = lambda test: F.size(F.filter(named, lambda x: (x["m"] == m) & test(x["s"])))
        ok, bad = count(lambda s: s == "done"), count(lambda s: s.isin(FAILED))
        return _issue("WARN", "C5", say("C5", m, told["ok"], told["bad"], ok, bad), (told["ok"] != ok) | (told["bad"] != bad))

    return F.when(F.col("has_summary"), F.transform(models, one))


def _found(params: AuditParams, say: Say = _say) -> Column:
    """The issues of a file of dimensions A to D, from its columns and ``_age``."""
    blank = F.array().cast("array<struct<severity:string,check:string,msg:string>>")
    per_chunk = F.flatten(F.transform("chunks", lambda c, i: F.array(*_chunk_issues(c, i, params, say))))
    found = F.concat(F.array(*_file_issues(F.col("_age"), params, say), _sum_issue(say)), per_chunk, _duplicate_issues(say), F.coalesce(_mismatch_issues(say), blank))
    return F.filter(found, lambda x: x.isNotNull())


def _with_shapes(files: DataFrame) -> DataFrame:
    """``files`` with the columns and fields on shapes, where a caller leaves them out: all is as it should be."""
    names = files.schema["chunks"].dataType.elementType.names
    plain = F.transform("chunks", lambda c: F.struct(*[c[n].alias(n) for n in names], *([] if "is_object" in names else [F.lit(True).alias("is_object")]), *([] if "has_id" in names else [c["chunk_id"].isNotNull().alias("has_id")])))
    files = files.withColumn("chunks", F.coalesce(plain, F.array().cast(files.select(plain.alias("c")).schema["c"].dataType)))
    return files if "chunks_listed" in files.columns else files.withColumn("chunks_listed", F.lit(True))


def audit_issues(files: DataFrame, as_of: Column, manifest: DataFrame | None = None, params: AuditParams = AuditParams(), manifest_path: str = "") -> DataFrame:
    """Issues (batch, file_id, severity, check, msg) of file status rows.

    ``files``: batch, file_id, status, last_updated (ISO text), retry_count, total_chunks, missing (names
    of absent required fields), chunks (array of structs with chunk_id, status, model_used, retry_count,
    has_error; optionally is_object and has_id), has_error_log, has_diagnostics, has_summary, models (map
    of success/fail counts), optionally chunks_listed. ``manifest``: file_id; without it dimension F says
    only that it was skipped. Absent error detail counts as none.

    Dimensions A to D are one projection of each file; E is one aggregation, F two joins by file.
    """
    files = _with_shapes(files)
    aged = files.withColumn("_age", age_seconds(utc_timestamp(F.col("last_updated")), as_of))
    own = each(aged, _found(params), "x", "batch", "file_id").select("batch", "file_id", "x.*")
    nobody = F.lit(None).cast(files.schema["file_id"].dataType).alias("file_id")
    out = [own, _model_issues(files, params).select("batch", nobody, "x.*")]
    if manifest is None:
        out.append(files.groupBy("batch").agg(nobody, F.lit("INFO").alias("severity"), F.lit("F0").alias("check"), _say("F0", manifest_path).alias("msg")))
    else:
        known = manifest.select("file_id").where("file_id IS NOT NULL").distinct()
        strangers = files.where("file_id IS NOT NULL").join(known, "file_id", "left_anti")
        out.append(strangers.select("batch", "file_id", _issue("ERROR", "F1", _say("F1", F.col("file_id"))).alias("x")).select("batch", "file_id", "x.*"))
        out.append(_missing_from_batch(files, known).select("batch", nobody, "x.*"))
    return reduce(DataFrame.unionByName, out)


def _model_issues(files: DataFrame, params: AuditParams) -> DataFrame:
    chunks = each(files, "chunks", "c", "batch").where("c.is_object")
    status = F.coalesce("c.status", F.lit(""))
    return _rate_issues(chunks.groupBy("batch", F.coalesce("c.model_used", F.lit("?")).alias("m")).agg(F.count_if(status == "done").alias("ok"), F.count_if(status.isin(FAILED)).alias("bad")), params)


def _rate_issues(by_model: DataFrame, params: AuditParams) -> DataFrame:
    """Dimension E, from the chunks done (``ok``) and failed (``bad``) of each ``batch`` and model ``m``."""
    rows = by_model.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("m", "ok", "bad"))).alias("models"), F.sum("ok").alias("ok"), F.sum("bad").alias("bad"))
    total = lambda x: x["ok"] + x["bad"]
    pct = lambda n, of: F.bround(100 * n / F.greatest(of, F.lit(1)), 1).cast("string")
    whole = {"ok": F.col("ok"), "bad": F.col("bad")}
    e1 = _issue("WARN", "E1", _say("E1", pct(whole["bad"], total(whole)), whole["bad"], total(whole)), whole["bad"] > params.max_failure_rate * total(whole))
    e2 = lambda x: _issue("ERROR", "E2", _say("E2", x["m"], pct(x["ok"], total(x)), x["ok"], total(x)), (total(x) >= params.min_model_total) & (x["ok"] < params.min_model_success * total(x)))
    found = F.concat(F.array(e1), F.transform("models", e2))
    return rows.select("batch", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("x"))


def _missing_from_batch(files: DataFrame, known: DataFrame) -> DataFrame:
    """The first manifest ids that each batch lacks, as one issue per batch (F2).

    A batch of k files lacks ``NAMED`` of the first k + ``NAMED`` manifest ids, if it lacks so many, so
    each batch meets only these, by their place.
    """
    own = files.where("file_id IS NOT NULL").select("batch", "file_id").distinct()
    sizes = files.select("batch").distinct().join(own.groupBy("batch").agg(F.count("*").alias("k")), "batch", "left")
    asked = sizes.select("batch", F.explode(F.sequence(F.lit(1).cast("bigint"), F.coalesce("k", F.lit(0)) + NAMED)).alias("place"))
    lacking = asked.join(place(known, [], ["file_id"]), "place").join(own, ["batch", "file_id"], "left_anti")
    nth = F.row_number().over(Window.partitionBy("batch").orderBy("file_id"))
    first = lacking.withColumn("nth", nth).where(F.col("nth") <= NAMED).groupBy("batch").agg(F.array_join(F.array_sort(F.collect_list("file_id")).cast("array<string>"), ", ").alias("ids"))
    return first.select("batch", _issue("INFO", "F2", _say("F2", F.col("ids"))).alias("x"))


def audit_scores(files: DataFrame, issues: DataFrame, as_of: Column, params: AuditParams = AuditParams()) -> DataFrame:
    """(batch, letter, score, issue_count) of the six dimensions."""
    age = age_seconds(utc_timestamp(F.col("last_updated")), as_of)
    failed = F.coalesce(F.size(F.filter("chunks", lambda c: F.coalesce(c["status"], F.lit("")).isin(FAILED))), F.lit(0))
    facts = files.groupBy("batch").agg(F.count("*").alias("n"), F.count_if(age <= params.stuck_sec).alias("fresh"), F.sum(failed).alias("failed"), F.count_if("has_summary").alias("told"))
    return _scored(facts, issues.select("batch", "severity", "check", F.lit(1).cast("bigint").alias("n")), params)


def file_tallies(files: DataFrame, as_of: Column, params: AuditParams = AuditParams()) -> DataFrame:
    """(batch, problem, what, of, n): all that scores need of file status rows as counts, in one reading that keeps no file.

    ``files`` as for :func:`audit_issues`, optionally with ``problem`` (see :func:`captionlake.sources.status.file_facts`).
    ``what`` is a check of A to D (``of`` its severity), ``ok`` or ``bad`` (chunks of the model ``of``), or ``files``,
    ``fresh``, ``told`` and ``failed`` (chunks). A document with a problem is one A0 and nothing else.
    """
    files = files if "problem" in files.columns else files.withColumn("problem", F.lit(None).cast("string"))
    aged = _with_shapes(files).withColumn("_age", age_seconds(utc_timestamp(F.col("last_updated")), as_of))
    nothing = F.lit(None).cast("string")

    def tally(what: Column | str, of: Column, n: Column) -> Column:
        return F.struct((F.lit(what) if isinstance(what, str) else what).alias("what"), of.alias("of"), n.cast("bigint").alias("n"))

    status = lambda c: F.coalesce(c["status"], F.lit(""))
    ended = F.filter("chunks", lambda c: c["is_object"] & ((status(c) == "done") | status(c).isin(FAILED)))
    models = F.transform(ended, lambda c: tally(F.when(status(c) == "done", "ok").otherwise("bad"), F.coalesce(c["model_used"], F.lit("?")), F.lit(1)))
    facts = [("files", F.lit(1)), ("fresh", F.when(F.col("_age") <= params.stuck_sec, 1)), ("told", F.when(F.col("has_summary"), 1)), ("failed", F.size(F.filter("chunks", lambda c: status(c).isin(FAILED))))]
    own = F.filter(F.array(*[tally(what, nothing, n) for what, n in facts]), lambda x: x["n"] > 0)
    issues = F.transform(_found(params, _mute), lambda x: tally(x["check"], x["severity"], F.lit(1)))
    severity = F.when(F.col("problem") == "empty", "WARN").otherwise("CRITICAL")
    tallies = F.when(F.col("problem").isNull(), F.concat(own, issues, models)).otherwise(F.array(tally("A0", severity, F.lit(1))))
    return each(aged, tallies, "x", "batch", "problem").groupBy("batch", "problem", "x.what", "x.of").agg(F.sum("x.n").alias("n"))


def tally_scores(tallies: DataFrame, params: AuditParams = AuditParams(), crossed: DataFrame | None = None) -> DataFrame:
    """:func:`audit_scores` from :func:`file_tallies`.

    ``crossed``: issues of dimension F, which need the manifest. Without them F counts none; its score is 100
    whatever it finds unless ``params.fix_clamp``, which asks for them.
    """
    if params.fix_clamp and crossed is None:
        raise ValueError("with fix_clamp the score of F needs its issues")
    count = lambda what: F.coalesce(F.sum(F.when(F.col("what") == what, F.col("n"))), F.lit(0).cast("bigint"))
    facts = tallies.groupBy("batch").agg(count("files").alias("n"), *[count(x).alias(x) for x in ("fresh", "failed", "told")]).where("n > 0")
    ended = tallies.where(F.col("what").isin("ok", "bad")).groupBy("batch", F.col("of").alias("m")).agg(count("ok").alias("ok"), count("bad").alias("bad"))
    one = F.lit(1).cast("bigint").alias("n")
    issues = tallies.where(F.rlike("what", F.lit("^[A-D][0-9]$"))).select("batch", F.col("of").alias("severity"), F.col("what").alias("check"), "n")
    issues = issues.unionByName(_rate_issues(ended, params).select("batch", "x.severity", "x.check", one))
    return _scored(facts, issues if crossed is None else issues.unionByName(crossed.select("batch", "severity", "check", one)), params)


def _scored(facts: DataFrame, issues: DataFrame, params: AuditParams) -> DataFrame:
    """Scores from ``facts`` of batches and their ``issues``, ``n`` of a kind in a row."""
    letter = F.substring("check", 1, 1)
    those = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    counted = issues.groupBy("batch", letter.alias("letter")).agg(F.sum("n").alias("issue_count"), those((F.col("check") == "B2") & (F.col("severity") == "ERROR")).alias("stuck"), *[those(F.col("check") == x).alias(x.lower()) for x in ("C1", "E1", "E2")])
    rows = facts.withColumn("letter", F.explode(F.array(*[F.lit(x) for x in "ABCDEF"]))).join(counted, ["batch", "letter"], "left").fillna(0)
    n = F.col("issue_count")
    capture = F.when(F.col("failed") > 0, 100 * (F.col("failed") - F.col("c1")) / F.col("failed")).otherwise(F.lit(100.0))
    clamped = F.greatest(F.lit(0), 100 - 15 * n) if params.fix_clamp else F.lit(100)
    score = (
        F.when(F.col("letter") == "A", F.greatest(F.lit(0), 100 - 10 * n))
        .when(F.col("letter") == "B", F.greatest(F.lit(0), 100 - 30 * F.col("stuck") - F.when(F.col("fresh") * 2 < F.col("n"), 20).otherwise(0)))
        .when(F.col("letter") == "C", F.greatest(F.lit(0.0), capture - F.when(F.col("told") == 0, 10).otherwise(0)))
        .when(F.col("letter") == "E", F.greatest(F.lit(0), 100 - 20 * F.col("e1") - 15 * F.col("e2")))
        .otherwise(clamped)
    )
    return rows.select("batch", "letter", score.cast("double").alias("score"), n.cast("bigint").alias("issue_count"))


def overall_score(scores: DataFrame) -> DataFrame:
    """Mean of all scores to one place, and the exit code for it."""
    rows = scores.agg(F.bround(F.avg("score"), 1).alias("overall"))
    return rows.withColumn("exit_code", F.when(F.col("overall") >= 90, 0).when(F.col("overall") >= 70, 10).otherwise(20))


def order_issues(issues: DataFrame) -> DataFrame:
    rank = F.when(F.col("severity") == "CRITICAL", 0).when(F.col("severity") == "ERROR", 1).when(F.col("severity") == "WARN", 2).otherwise(3)
    return issues.orderBy(rank, "check", "batch", "file_id")


def file_audit_detail(chunks: DataFrame) -> DataFrame:
    """Chunks (file_id, chunk_id, model_used, status, char_count, elapsed_sec) with their file's statistics of the same model."""
    own = Window.partitionBy("file_id", "model_used")
    done = F.col("status") == "done"
    return chunks.select(
        "file_id", "chunk_id", "model_used", "status",
        F.count_if(done).over(own).alias("model_success"), F.count_if(F.col("status").isin(FAILED)).over(own).alias("model_fail"), F.sum("char_count").over(own).cast("bigint").alias("model_chars"),
    )


def file_reports(files: DataFrame, top: int = 5) -> DataFrame:
    """One row per file (as :func:`captionlake.sources.status.file_facts` gives them): its chunks with their first error and a preview, and its models.

    ``models`` are in order of name: success, fail, chars, chars_per_sec over done chunks' time (null without any), and
    their ``top`` messages of at most 120 characters by count, then text. ``failed_models`` names those with failures, most first.
    """
    one = F.transform("chunks", lambda c: F.struct(
        c["chunk_id"].alias("chunk_id"), F.coalesce(c["status"], F.lit("?")).alias("status"), F.coalesce(c["model_used"], F.lit("?")).alias("model_used"), F.coalesce(c["retry_count"], F.lit(0)).alias("retry_count"),
        F.get(c["errors"], F.lit(0)).alias("error"), F.substring(F.coalesce(c["summary_preview"], F.lit("")), 1, 80).alias("summary_preview"),
    ))
    rows = files.select("batch", "file_id", "status", one.alias("chunks"), F.transform("chunks", lambda c: F.struct(F.coalesce(c["model_used"], F.lit("?")).alias("m"), c["status"].alias("s"), c["char_count"].alias("n"), c["elapsed_sec"].alias("t"), c["errors"].alias("e"))).alias("_c"))
    names = F.array_sort(F.array_distinct(F.transform("_c", lambda c: c["m"])))

    def model(m: Column) -> Column:
        mine = F.filter("_c", lambda c: c["m"] == m)
        count = lambda test: F.size(F.filter(mine, test))
        chars = F.aggregate(mine, F.lit(0).cast("bigint"), lambda a, c: a + F.coalesce(c["n"], F.lit(0)))
        took = F.aggregate(F.filter(mine, lambda c: c["s"] == "done"), F.lit(0.0), lambda a, c: a + F.coalesce(c["t"], F.lit(0.0)))
        said = F.transform(F.flatten(F.transform(mine, lambda c: c["e"])), lambda e: F.substring(e["message"], 1, 120))
        counted = F.transform(F.array_distinct(said), lambda x: F.struct((-F.size(F.filter(said, lambda y: y == x))).alias("n"), x.alias("msg")))
        tops = F.transform(F.slice(F.array_sort(counted), 1, top), lambda x: F.struct(x["msg"].alias("msg"), (-x["n"]).alias("count")))
        return F.struct(m.alias("model"), count(lambda c: c["s"] == "done").alias("success"), count(lambda c: c["s"].isin(FAILED)).alias("fail"), chars.alias("chars"), per_second(chars, took).alias("chars_per_sec"), tops.alias("top_errors"))

    rows = rows.withColumn("models", F.transform(names, model))
    failed = F.array_sort(F.transform(F.filter("models", lambda x: x["fail"] > 0), lambda x: F.struct((-x["fail"]).alias("n"), x["model"].alias("model"))))
    return rows.select("batch", "file_id", "status", "chunks", "models", F.transform(failed, lambda x: x["model"]).alias("failed_models"))
