"""Manifests of subtitle and sound files, and the preflight of a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captionlake.functions.text import base_name, stem
from captionlake.operators.ordered import place
from captionlake.operators.summaries import GateError
from captionlake.sources.srt import numbered


def list_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Paths of files that are not empty; contents are pruned from the scan."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path")


def scan_pairs(subtitles: DataFrame, sounds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Subtitle paths with a sound file of the same stem, and those without."""
    keyed, have = subtitles.withColumn("stem", stem(F.col("path"))), sounds.select(stem(F.col("path")).alias("stem")).distinct()
    return keyed.join(have, "stem", "left_semi"), keyed.join(have, "stem", "left_anti")


def build_manifest(pairs: DataFrame) -> DataFrame:
    """(id, filename_srt, filename_mp3, path_srt, path_mp3) by sorted path."""
    rows = numbered(pairs.select("path"))
    sound = F.regexp_replace("path", r"\.srt$", ".mp3")
    return rows.select(F.col("file_id").alias("id"), base_name(F.col("path")).alias("filename_srt"), base_name(sound).alias("filename_mp3"), F.col("path").alias("path_srt"), sound.alias("path_mp3"))


def write_manifest(manifest: DataFrame, path: str) -> None:
    """One JSON document ``{total_count, files}``."""
    document = manifest.agg(F.count("*").alias("total_count"), F.array_sort(F.collect_list(F.struct("id", "filename_srt", "filename_mp3", "path_srt", "path_mp3"))).alias("files"))
    document.coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Both shapes: ``{"files": [{id, path_srt, ...}]}`` and a bare list of ``{file_id, file_path, ...}``."""
    kind = "array<struct<id:bigint,file_id:bigint,filename_srt:string,filename_mp3:string,path_srt:string,path_mp3:string,file_path:string,title:string>>"
    raw = spark.read.text(path, wholetext=True).select(F.trim("value").alias("value"))
    is_list = F.startswith(F.ltrim("value"), F.lit("["))
    files = F.when(is_list, F.from_json("value", kind)).otherwise(F.from_json("value", f"struct<files:{kind}>")["files"])
    rows = raw.select(F.explode(files).alias("f")).select("f.*")
    return rows.select(F.coalesce("id", "file_id").alias("id"), "filename_srt", "filename_mp3", F.coalesce("path_srt", "file_path").alias("path_srt"), "path_mp3", "title")


def lookup(manifest: DataFrame, file_id: int) -> DataFrame:
    """The first entry of an id; none is an error."""
    found = manifest.where(F.col("id") == file_id).limit(1)
    if found.isEmpty():
        raise GateError(f"file {file_id} is not in the manifest")
    return found


def batch_range(manifest: DataFrame, start: int, end: int) -> DataFrame:
    """Entries by position, both ends included."""
    return place(manifest, [], ["id"], "position").withColumn("position", F.col("position") - 1).where(F.col("position").between(start, end))


def latest_file(spark: SparkSession, path: str, pattern: str) -> str | None:
    """The path of the file below ``path`` that was changed last; of several the last by name; none if there is none."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", F.col("modificationTime").alias("at"))
    return latest(found).first()[0]


def latest(files: DataFrame) -> DataFrame:
    """The path with the greatest (at, path), as one row, null without files."""
    return files.agg(F.max_by("path", F.struct("at", "path")).alias("path"))


def expand_ids(spec: str) -> list[int]:
    """``"a-b"`` is a to b, nothing if b is smaller; a number is itself."""
    first, dash, last = spec.partition("-")
    return list(range(int(first), int(last) + 1)) if dash else [int(first)]


def preflight(files: DataFrame) -> DataFrame:
    """First status of (has_srt, has_mp3) files: a missing file fails for good with one retry counted."""
    missing = F.when(~F.col("has_srt"), "missing srt").when(~F.col("has_mp3"), "missing mp3")
    return files.select("*", F.when(missing.isNotNull(), "failed_permanent").otherwise("undone").alias("status"), F.when(missing.isNotNull(), 1).otherwise(0).alias("retry_count"), missing.alias("error"))
