"""Helpers that the training-data operators share: the shared work folder, written intermediate tables, bound sub-expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from captionlake.workspace import discard, materialize, shared_dir

__all__ = ["ASCII_SPACE", "SPACE_CLASS", "ascii_words", "discard", "let", "materialize", "shared_dir", "spread", "table"]

#: ASCII white space U+0020 and U+0009 to U+000D, the separators of "words" in most operators here.
ASCII_SPACE = " \t\n\x0b\f\r"
#: The same as a regular-expression class.
SPACE_CLASS = "[\\x20\\x09-\\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes that a scan is estimated at from which its rows are worth dealing out anew.
SPREAD_BYTES = 4 << 20


def spread(docs: DataFrame) -> DataFrame:
    """``docs``, dealt out by row where a plain scan has fewer partitions with rows than there are cores.

    One file with one row group is one task's work, however long its texts. Partitions' rows are counted
    from the files' footers, and only where there are at most four partitions a core; a larger scan, one
    of few bytes, and a plan that shuffles stay as they are.
    """
    spark = docs.sparkSession
    cores, plan = spark.sparkContext.defaultParallelism, docs._jdf.queryExecution()
    how = plan.executedPlan().toString()
    if "FileScan" not in how or "Exchange" in how or int(str(plan.optimizedPlan().stats().sizeInBytes())) < SPREAD_BYTES:
        return docs
    if plan.toRdd().getNumPartitions() > 4 * cores or docs.groupBy(F.spark_partition_id()).count().count() >= cores:
        return docs
    # a key of its own for each row: no sort, and the same rows after a lost executor
    return docs.withColumn("_row", F.monotonically_increasing_id()).repartition(4 * cores, "_row").drop("_row")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, even where ``body`` uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space, in order; null or blank text has none."""
    trimmed = F.btrim(text, F.lit(ASCII_SPACE))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, f"{SPACE_CLASS}+")).otherwise(F.array().cast("array<string>"))
