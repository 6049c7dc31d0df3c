"""Packing by concatenating and cutting.

Pass one encodes every document once and writes its ids with two numbers: the input partition and
the ids before it in that partition. Partition totals, summed in order, give each partition's
global offset. Pass two cuts the one long sequence of ids at multiples of the length; a document
that crosses a cut leaves a boundary record on either side. Nothing is shuffled but the totals.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captionlake.llm.common import materialize, spread
from captionlake.llm.tokens import encoder, with_end

END_ID = 1

_IDS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("part", T.LongType()), T.StructField("before", T.LongType()), T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType())])
_PIECES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("ids", T.BinaryType())])


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every document (null text: empty) with the end id, as packed bytes, with the input partition and the ids before it there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, before = encoder(tokenizer_path), {}
        for batch in batches:
            for a, b, ids, counts in encode.units(batch.column(1)):
                ids, counts = with_end(ids, counts, END_ID)
                keys, parts = batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a)
                starts, ends, part = np.zeros(b - a, np.int64), np.cumsum(counts), parts[0].as_py()
                starts[:] = before.get(part, 0) + ends - counts
                before[part] = int(starts[-1] + counts[-1])
                out = [narrow(ids[e - n : e]) for n, e in zip(counts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([keys, parts, pa.array(starts), pa.array(counts), pa.array(out, pa.binary())], names=_IDS.names)

    read = spread(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")))
    return read.withColumn("part", F.spark_partition_id().cast("bigint")).mapInArrow(run, _IDS)


def narrow(ids: np.ndarray) -> bytes:
    """Two bytes an id if all are small enough, or else a zero byte and four bytes an id."""
    return ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 65_536 else b"\0" + ids.astype("<u4").tobytes()


def wide_ids(packed: bytes, n: int) -> np.ndarray:
    """Ids as unsigned 32-bit integers from what :func:`narrow` returned."""
    return np.frombuffer(packed, "<u2").astype("<u4") if len(packed) == 2 * n else np.frombuffer(packed, "<u4", offset=1)


def concatenate_and_cut(docs: DataFrame, tokenizer_path: str, length: int = 2048, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: document, place in it, place in the packed sequences, and the ids (packed bytes) if ``with_ids``.

    Every id, the end id of each document included, lies in exactly one piece. Sequences are full
    but for the last one. Null text gives the end id alone. Repeated rows and ids are packed as rows
    of their own, those without an id too, and very long texts go over many sequences. An empty table
    gives no pieces. Other columns, whatever their names, are not read. Order follows the input
    partitions; it is fixed once pass one is written, so lost executors cannot change it.
    """
    encoded = materialize(encode_documents(docs, tokenizer_path, id_col, text_col), "packing-ids")
    # one total for each input partition, 16 bytes each: summed in order on the driver, and known to every task
    totals = encoded.groupBy("part").agg(F.sum("n").alias("total")).orderBy("part").collect()
    sums = np.cumsum([0, *(r["total"] for r in totals)])
    shared = docs.sparkSession.sparkContext.broadcast({r["part"]: int(n) for r, n in zip(totals, sums)})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets = shared.value
        for rows in batches:
            for batch in (rows.slice(i, 512) for i in range(0, rows.num_rows, 512)):
                cols: list[list] = [[] for _ in _PIECES.names]
                for key, part, before, n, packed in zip(*(batch.column(c).to_pylist() for c in _IDS.names)):
                    ids, start, at = wide_ids(packed, n), 0, offsets[part] + before
                    while start < n:
                        sequence, offset = divmod(at + start, length)
                        took = min(length - offset, n - start)
                        raw = ids[start : start + took].tobytes()
                        for c, v in zip(cols, (key, start, took, zlib.crc32(raw), n, sequence, offset, raw if with_ids else None)):
                            c.append(v)
                        start += took
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if name == "ids" else pa.int64()) for c, name in zip(cols, _PIECES.names)], names=_PIECES.names)

    pieces = encoded.mapInArrow(cut, _PIECES)
    return pieces if with_ids else pieces.drop("ids")
