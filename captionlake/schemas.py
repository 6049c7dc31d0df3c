"""Schemas of the engine's tables and the named state sets (fixed values of the file state machine)."""

from __future__ import annotations

from pyspark.sql import types as T

ENTRY = T.StructType([
    T.StructField("file_id", T.LongType()), T.StructField("idx", T.IntegerType()), T.StructField("start_time", T.StringType()),
    T.StructField("end_time", T.StringType()), T.StructField("text", T.StringType()),
])

RECORD = T.StructType([
    T.StructField("chunk_id", T.StringType()), T.StructField("file_id", T.LongType()), T.StructField("file_name", T.StringType()),
    T.StructField("start_time", T.StringType()), T.StructField("end_time", T.StringType()), T.StructField("summary", T.StringType()),
    T.StructField("text_content", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("participants", T.ArrayType(T.StringType())),
    T.StructField("vector", T.ArrayType(T.FloatType())), T.StructField("boundary_type", T.StringType()),
])

#: Status documents as they are read: what may have several shapes (``errors``, ``error``, ``chunks``, ``diagnostics``) stays JSON text first.
CHUNK_STATUS = "struct<chunk_id:string,status:string,model_used:string,retry_count:bigint,errors:string,error:string,char_count:bigint,elapsed_sec:double,summary_preview:string>"
ERROR_LOG = "array<struct<time:string,from_status:string,error:string,used_model:string>>"
FILE_STATUS = f"struct<file_id:bigint,filename_srt:string,filename_mp3:string,file_path:string,status:string,last_updated:string,retry_count:bigint,owner:string,error_log:{ERROR_LOG},total_chunks:bigint,chunks:string,diagnostics:string>"
DIAGNOSTICS = "struct<summary:string,models:map<string,struct<success:bigint,fail:bigint>>>"

#: Allowed next states of each state; every state may also move to itself, ``failed`` or ``failed_permanent``.
TRANSITIONS = {
    "undone": ["chunking"],
    "chunking": ["queueing_1", "summarizing", "undone"],
    "queueing_1": ["summarizing", "undone"],
    "summarizing": ["queueing_2", "embedding", "undone"],
    "queueing_2": ["embedding", "undone"],
    "embedding": ["queueing_3", "db_inserting", "undone"],
    "queueing_3": ["db_inserting", "undone"],
    "db_inserting": ["done", "undone"],
    "done": [],
    "failed": ["undone"],
    "failed_permanent": [],
}
STATES = list(TRANSITIONS)
ACTIVE = ["chunking", "summarizing", "embedding", "db_inserting"]
QUEUED = ["queueing_1", "queueing_2", "queueing_3"]
TERMINAL = ["done", "failed_permanent"]
FAILED = ["failed", "failed_permanent"]
CHUNK_STATES = ["pending", "processing", "done", "failed", "failed_permanent"]
NEXT_PHASE = {"undone": "chunking", "queueing_1": "summarizing", "queueing_2": "embedding", "queueing_3": "db_inserting"}
