"""Line quality by model votes: windows, coverage, flags and consensus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captionlake.config import QualityParams
from captionlake.operators.evaluation import a_handful

#: Fixed value: what stands where a group flagged nothing.
UNFLAGGED = "(未標記)"


def quality_windows(sizes: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """(file_id, window_start, num_entries) from (file_id, n): strided windows while at least half full, then head and tail windows."""
    w, s = params.window, params.stride
    n = F.col("n")
    strided = sizes.where("n > 0").select("file_id", "n", F.explode(F.sequence(F.lit(0), n - 1, F.lit(s))).alias("window_start"))
    strided = strided.withColumn("num_entries", F.least(F.lit(w), n - F.col("window_start"))).where(F.col("num_entries") >= w // 2)
    head = sizes.where(n > w).select("file_id", "n", F.lit(0).alias("window_start"), F.least(n, F.lit(w + s)).alias("num_entries"))
    tail = sizes.where((n > w) & (n - w - s > 0)).select("file_id", "n", (n - w - s).alias("window_start"), F.lit(w + s).alias("num_entries"))
    columns = ["file_id", F.col("window_start").cast("int").alias("window_start"), F.col("num_entries").cast("int").alias("num_entries")]
    return strided.select(*columns).unionAll(head.select(*columns)).unionAll(tail.select(*columns))


def line_coverage(windows: DataFrame, sizes: DataFrame) -> DataFrame:
    """(file_id, idx, coverage) of every line: windows are spread to lines, so the range join is one by equal keys."""
    spread = windows.select("file_id", F.explode(F.sequence("window_start", F.col("window_start") + F.col("num_entries") - 1)).alias("idx"))
    counted = spread.groupBy("file_id", "idx").agg(F.count("*").alias("coverage"))
    lines = sizes.where("n > 0").select("file_id", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("idx"))
    return lines.join(counted, ["file_id", "idx"], "left").select("file_id", "idx", F.coalesce("coverage", F.lit(0).cast("bigint")).alias("coverage"))


def merge_votes(flags: DataFrame) -> DataFrame:
    """One flag per (file, group, window, line) of all models': any ``major`` wins, then the first model by name.

    Windows are told apart by ``num_entries`` too, where flags have it: two windows may start at one line.
    """
    pick = F.min_by(F.struct("severity", "issue"), F.struct((F.col("severity") != "major").alias("a"), F.col("model").alias("b")))
    key = ["file_id", "group_label", "window_start", *(c for c in ("num_entries",) if c in flags.columns), "line_no"]
    return flags.groupBy(*key).agg(pick.alias("p")).select(*key, "p.severity", "p.issue")


def absolute_flags(flags: DataFrame, windows: DataFrame | None = None) -> DataFrame:
    """Flags with ``idx`` from 1-based ``line_no`` strings in their window; numbers that are none or out of range go.

    Flags without ``num_entries`` belong to every one of ``windows`` with their start.
    """
    k = F.col("line_no").try_cast("int")
    rows = (flags if "num_entries" in flags.columns else flags.join(windows, ["file_id", "window_start"])).where((k >= 1) & (k <= F.col("num_entries")))
    return rows.withColumn("idx", F.col("window_start") + k - 1).drop("num_entries")


def flag_rollup(flags: DataFrame) -> DataFrame:
    """Per file, group and line: flags, major ones, and the verdict."""
    rows = flags.groupBy("file_id", "group_label", "idx").agg(F.count("*").alias("flags"), F.count_if(F.col("severity") == "major").alias("majors"))
    return rows.withColumn("verdict", F.when((F.col("flags") >= 2) | (F.col("majors") >= 1), "problem").otherwise("questionable"))


def consensus(flags: DataFrame, coverage: DataFrame, n_groups: int, params: QualityParams = QualityParams()) -> DataFrame:
    """Every line's share of the flags it could have got, and its class."""
    flagged = flags.groupBy("file_id", "idx").agg(F.count("*").alias("flagged"))
    rows = coverage.join(flagged, ["file_id", "idx"], "left").withColumn("flagged", F.coalesce("flagged", F.lit(0).cast("bigint")))
    share = F.when(F.col("coverage") > 0, F.col("flagged") / (F.col("coverage") * n_groups)).otherwise(F.lit(0.0))
    rows = rows.withColumn("consensus", share)
    return rows.withColumn("class", F.when(share < params.clean_below, "clean").when(share < params.questionable_below, "questionable").otherwise("problem"))


def model_latency(timings: DataFrame) -> DataFrame:
    """Per model: calls, total and mean seconds."""
    return timings.groupBy("model").agg(F.count("*").alias("calls"), F.sum("elapsed").alias("total_elapsed"), F.coalesce(F.avg("elapsed"), F.lit(0.0)).alias("avg_elapsed"))


def review_grid(windows: DataFrame, groups: DataFrame) -> DataFrame:
    """Every window with every (group, model): the calls to make (J13). ``groups`` is a handful of configured rows, which is checked."""
    return windows.crossJoin(F.broadcast(a_handful(groups)))


def window_prompt(windows: DataFrame, entries: DataFrame) -> DataFrame:
    """Windows with their numbered lines (F14), by equal keys over the lines they cover."""
    spread = windows.select("file_id", "window_start", "num_entries", F.posexplode(F.sequence("window_start", F.col("window_start") + F.col("num_entries") - 1)).alias("k", "idx"))
    from captionlake.functions.text import numbered_line
    from captionlake.operators.chunking import joined_text

    rows = spread.join(entries, ["file_id", "idx"])
    line = numbered_line(F.col("k") + 1, F.col("start_time"), F.col("end_time"), F.col("text"))
    return rows.groupBy("file_id", "window_start", "num_entries").agg(joined_text(F.col("k"), line, "\n").alias("prompt"))


def consensus_listing(flags: DataFrame, entries: DataFrame, groups: list[str]) -> DataFrame:
    """Per line the issues of each group, with a placeholder where a group said nothing."""
    said = flags.groupBy("file_id", "idx").pivot("group_label", groups).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "severity", "issue"))), "; "))
    said = said.select("file_id", "idx", *[F.coalesce(F.nullif(F.col(f"`{g}`"), F.lit("")), F.lit(UNFLAGGED)).alias(g) for g in groups])
    return entries.join(said, ["file_id", "idx"])


def group_report(flags: DataFrame, group: str) -> DataFrame:
    """Per file of one group: flagged lines, problems among them, and the lines as text in order."""
    rows = flag_rollup(flags.where(F.col("group_label") == group))
    line = F.struct("idx", F.concat_ws(" ", F.concat(F.lit("["), (F.col("idx") + 1).cast("string"), F.lit("]")), "verdict").alias("t"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["t"]), "\n")
    return rows.groupBy("file_id").agg(F.count("*").alias("lines"), F.count_if(F.col("verdict") == "problem").alias("problems"), listed.alias("report"))
