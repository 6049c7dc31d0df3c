"""Subtitle files into entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from captionlake.functions.text import TIME_RANGE, strip
from captionlake.operators.ordered import place

MAX_BYTES = 50 * 1024 * 1024


def decoded(content: Column) -> Column:
    """UTF-8, or Big5 where the bytes are not UTF-8 (resolved where the session allows Java charsets)."""
    return F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "Big5"))


def read_srt(spark: SparkSession, path: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Entries of all ``*.srt`` files below ``path``; ``file_id`` is their 0-based place by path.

    A file above ``max_bytes`` fails the query. Big5 needs a session flag while the plan is resolved;
    the session's own value is put back.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.srt").option("recursiveFileLookup", "true").load(path)
    size_ok = F.when(F.col("length") > max_bytes, F.raise_error(F.concat(F.lit("subtitle file too large: "), F.col("path")))).otherwise(F.col("content"))
    found = files.join(numbered(files.select("path")), "path")
    flag = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(flag, "false")
    spark.conf.set(flag, "true")
    try:
        texts = found.select("file_id", decoded(size_ok).alias("content"))
    finally:
        spark.conf.set(flag, before)
    return parse_srt(texts)


def numbered(paths: DataFrame) -> DataFrame:
    """(file_id, path) with 0-based ids in order of path."""
    return place(paths.select("path"), [], ["path"], "file_id").select((F.col("file_id") - 1).alias("file_id"), "path")


def parse_srt(files: DataFrame, strict: bool = True) -> DataFrame:
    """(file_id, idx, start_time, end_time, text) of (file_id, content).

    Blocks are parted by empty lines; those with fewer than two lines or without a time range go. The
    time is on the second line if the first is a number, else on the first. Text is what follows the
    second line even where there is no number line, unless ``strict`` is off.
    """
    text = strip(F.regexp_replace("content", r"\r\n?", "\n"))
    blocks = files.where(F.length(strip("content")) > 0).select("file_id", F.posexplode(F.split(text, r"\n\n+")).alias("block", "raw"))
    lines = blocks.select("file_id", "block", F.split(strip(F.col("raw")), r"\R").alias("lines")).where(F.size("lines") >= 2)
    is_number = F.rlike(strip(F.col("lines")[0]), F.lit(r"(?U)^\d+$"))
    timed = lines.withColumn("time", F.when(is_number, F.col("lines")[1]).otherwise(F.col("lines")[0]))
    timed = timed.where(F.rlike("time", F.lit(TIME_RANGE)))
    first = F.lit(3) if strict else F.when(is_number, 3).otherwise(2)
    body = F.filter(F.transform(F.slice("lines", first, F.size("lines")), strip), lambda x: x != "")
    idx = F.row_number().over(Window.partitionBy("file_id").orderBy("block")) - 1
    return timed.select("file_id", idx.alias("idx"), F.regexp_extract("time", TIME_RANGE, 1).alias("start_time"), F.regexp_extract("time", TIME_RANGE, 2).alias("end_time"), F.array_join(body, " ").alias("text"))


def write_srt(entries: DataFrame) -> DataFrame:
    """(file_id, content) in subtitle format from entries."""
    block = F.concat((F.col("idx") + 1).cast("string"), F.lit("\n"), F.col("start_time"), F.lit(" --> "), F.col("end_time"), F.lit("\n"), F.col("text"))
    ordered = F.array_sort(F.collect_list(F.struct("idx", block.alias("b"))))
    return entries.groupBy("file_id").agg(F.array_join(F.transform(ordered, lambda x: x["b"]), "\n\n").alias("content"))
