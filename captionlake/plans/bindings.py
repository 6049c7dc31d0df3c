"""The driver's tables as inputs of the core operators, in Spark and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CHUNK_STATUS_OF = {"view": "done", "click": "done", "purchase": "done", "signup": "pending", "error": "failed"}
FILE_STATUS_OF = {"signup": "undone", "view": "chunking", "click": "queueing_1", "purchase": "summarizing", "error": "failed"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(mapping: dict[str, str], column: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of documents as entries; an entry lasts three seconds."""
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("file_id"), F.posexplode(F.split("text", "\n")).alias("idx", "text"))
    return rows


LINES = "lines AS (SELECT doc_id AS file_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS idx, unnest(string_split(text, chr(10))) AS text FROM documents)"


def sizes(spark: SparkSession, d: str) -> DataFrame:
    return lines(spark, d).groupBy("file_id").agg(F.count("*").cast("int").alias("n"))


SIZES = f"{LINES}, sizes AS (SELECT file_id, CAST(count(*) AS INTEGER) AS n FROM lines GROUP BY file_id)"


def vectors(spark: SparkSession, d: str) -> DataFrame:
    i = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    return table(spark, d, "embeddings").select(F.col("label").alias("file_id"), i.alias("i"), F.col("embedding").alias("vector"))


VECTORS = "vectors AS (SELECT label AS file_id, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS INTEGER) AS i, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


def chunk_facts(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(
        F.col("user_id").alias("file_id"), F.col("event_id").alias("chunk_id"), "ts", F.expr(_case(CHUNK_STATUS_OF, "event_type")).alias("status"),
        F.concat(F.lit("m"), (F.col("event_id") % 5).cast("string")).alias("model_used"), F.get_json_object("props", "$.k").cast("bigint").alias("char_count"),
        F.col("value").alias("elapsed_sec"), (F.col("event_id") % 4).alias("retry_count"),
    )


CHUNKS = f"chunks AS (SELECT user_id AS file_id, event_id AS chunk_id, ts, {_case(CHUNK_STATUS_OF, 'event_type')} AS status, 'm' || CAST(event_id % 5 AS VARCHAR) AS model_used, CAST(json_extract_string(props, '$.k') AS BIGINT) AS char_count, value AS elapsed_sec, event_id % 4 AS retry_count FROM events)"


def status_events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("user_id").alias("file_id"), "ts", F.col("event_id").alias("seq"), F.expr(_case(FILE_STATUS_OF, "event_type")).alias("status"))


STATUS_EVENTS = f"status_events AS (SELECT user_id AS file_id, ts, event_id AS seq, {_case(FILE_STATUS_OF, 'event_type')} AS status FROM events)"
LATEST = f"{STATUS_EVENTS}, latest AS (SELECT file_id, status, ts AS last_updated FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY ts DESC, seq DESC) AS k FROM status_events) WHERE k = 1)"


def as_of(spark: SparkSession, d: str):
    """The last event's time: queries do not look at the clock."""
    return F.lit(table(spark, d, "events").agg(F.max("ts")).first()[0])


AS_OF = "(SELECT max(ts) FROM events)"


def flags(spark: SparkSession, d: str) -> DataFrame:
    """Made-up line flags of three groups with two models each, by arithmetic on line numbers."""
    rows = lines(spark, d).select("file_id", "idx").withColumn("g", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).withColumn("m", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = rows.where((F.col("file_id") * 7 + F.col("idx") * 13 + F.col("g") * 5 + F.col("m") * 3) % 11 < 3)
    severity = F.when((F.col("idx") + F.col("m")) % 4 == 0, "major").otherwise("minor")
    return rows.select("file_id", F.concat(F.lit("g"), F.col("g").cast("string")).alias("group_label"), F.concat(F.lit("m"), F.col("m").cast("string")).alias("model"), (F.floor(F.col("idx") / 5) * 5).cast("int").alias("window_start"), (F.col("idx") % 5 + 1).cast("string").alias("line_no"), severity.alias("severity"), F.concat(F.lit("i"), F.col("m").cast("string")).alias("issue"))


FLAGS = """raw_flags AS (SELECT file_id, idx, g, m FROM lines, (SELECT unnest([0, 1, 2]) AS g) AS gs, (SELECT unnest([0, 1]) AS m) AS ms WHERE (file_id * 7 + idx * 13 + g * 5 + m * 3) % 11 < 3),
flags AS (SELECT file_id, 'g' || CAST(g AS VARCHAR) AS group_label, 'm' || CAST(m AS VARCHAR) AS model, CAST(idx - idx % 5 AS INTEGER) AS window_start, CAST(idx % 5 + 1 AS VARCHAR) AS line_no, CASE WHEN (idx + m) % 4 = 0 THEN 'major' ELSE 'minor' END AS severity, 'i' || CAST(m AS VARCHAR) AS issue FROM raw_flags)"""
