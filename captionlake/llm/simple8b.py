"""Token ids in word-aligned binary files (Simple-8b).

A file is a Parquet table whose rows are segments. A segment holds whole documents in ascending
order: their ids (values, not to be mixed up with token ids), their token counts, and a payload:

    4 bytes   magic "S8B1"
    uint64    number of token ids
    uint32    number of blocks of 256 ids (the last may hold fewer)
    uint32[]  index of each block's first word, and one past the last word
    uint64[]  words

A word's top four bits select how many ids it holds and of what width; selector 0 announces an
escape: the next word is one id of 64 bits. Every block starts at a word of its own, so blocks can be
read alone. Encoding and decoding work on all blocks of a segment at once.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from captionlake.llm.common import materialize
from captionlake.llm.tokens import encoder, with_end

MAGIC = b"S8B1"
BLOCK = 256
#: Fixed values of Simple-8b: ids in a word and bits of each, by selector. Selector 0 is the escape.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
#: Ids after which a segment ends, at the end of the unit of documents being encoded.
SEGMENT_IDS = 1 << 20
END_ID = 1
#: Segments whose offsets may be broadcast; with more they are joined by a shuffle.
BROADCAST_SEGMENTS = 500_000


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bit lengths of unsigned 64-bit integers."""
    high = (ids >> np.uint64(30)).astype(np.float64)
    return np.where(high > 0, 30 + np.frexp(high)[1], np.frexp((ids & np.uint64((1 << 30) - 1)).astype(np.float64))[1]).astype(np.uint8)


def encode(ids: np.ndarray) -> bytes:
    """The payload of some unsigned 64-bit ids."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    flat = np.zeros(blocks * BLOCK, np.uint64)
    flat[:n] = ids
    grid = flat.reshape(blocks, BLOCK)
    bits = _bits(flat).reshape(blocks, BLOCK)
    # the selector of the most ids that fit, for every place a word could start at; no word reaches beyond its block
    best = np.where(bits <= 60, 15, 0).astype(np.uint8)
    over = np.zeros((blocks, BLOCK + 1), np.int16)
    for s in range(14, 0, -1):
        np.cumsum(bits > WIDTHS[s], axis=1, out=over[:, 1:])
        fits = over[:, COUNTS[s] :] == over[:, : BLOCK + 1 - COUNTS[s]]
        best[:, : fits.shape[1]][fits] = s
        if not fits[: max(n // BLOCK, 1)].any():
            break  # more ids of fewer bits fit nowhere either
    at, alive = np.zeros(blocks, np.int64), np.arange(blocks)
    ends = np.full(blocks, BLOCK)
    if blocks and n % BLOCK:
        ends[-1] = n % BLOCK
    steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(alive):
        chosen = best[alive, at[alive]]
        steps.append((alive, at[alive].copy(), chosen))
        at[alive] += COUNTS[chosen]
        alive = alive[at[alive] < ends[alive]]
    block = np.concatenate([s[0] for s in steps]) if steps else np.zeros(0, np.int64)
    start = np.concatenate([s[1] for s in steps]) if steps else np.zeros(0, np.int64)
    chosen = np.concatenate([s[2] for s in steps]) if steps else np.zeros(0, np.uint8)
    order = np.lexsort((start, block))
    block, start, chosen = block[order], start[order], chosen[order]
    size = 1 + (chosen == 0)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for s in np.unique(chosen):
        of = np.flatnonzero(chosen == s)
        if s == 0:
            words[place[of] + 1] = grid[block[of], start[of]]
            continue
        word = np.full(len(of), int(s) << 60, np.uint64)
        for j in range(COUNTS[s] if WIDTHS[s] else 0):
            word |= grid[block[of], start[of] + j] << np.uint64(WIDTHS[s] * j)
        words[place[of]] = word
    index = np.append(np.searchsorted(block, np.arange(blocks)), len(block))
    index = np.append(place, len(words))[index].astype("<u4")
    return MAGIC + struct.pack("<QI", n, blocks) + index.tobytes() + words.astype("<u8").tobytes()


def decode(payload: bytes) -> np.ndarray:
    """The ids of a payload, as unsigned 64-bit integers."""
    if payload[:4] != MAGIC:
        raise ValueError("not a Simple-8b segment")
    n, blocks = struct.unpack_from("<QI", payload, 4)
    index = np.frombuffer(payload, "<u4", blocks + 1, 16).astype(np.int64)
    words = np.frombuffer(payload, "<u8", int(index[-1]), 16 + 4 * (blocks + 1))
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    # a word after an escape is data; of an unbroken run of words that look like escapes, every other one is
    looks = np.flatnonzero(selector == 0)
    i = 0
    while i < len(looks):
        w = looks[i]
        raw[w + 1] = True
        i += 2 if i + 1 < len(looks) and looks[i + 1] == w + 1 else 1
    selector = selector[~raw]
    body = words[~raw]
    owner = np.searchsorted(index, np.flatnonzero(~raw), "right") - 1
    count = COUNTS[selector]
    first = np.cumsum(count) - count
    before = np.append(first, count.sum())[np.searchsorted(owner, np.arange(blocks))] if blocks else first
    start = first - before[owner] if len(owner) else first
    out = np.zeros((blocks, BLOCK), np.uint64)
    for s in np.unique(selector):
        of = np.flatnonzero(selector == s)
        if s == 0:
            out[owner[of], start[of]] = words[np.flatnonzero(~raw)[of] + 1]
            continue
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        for j in range(COUNTS[s] if WIDTHS[s] else 0):
            out[owner[of], start[of] + j] = (body[of] >> np.uint64(WIDTHS[s] * j)) & mask
    return out.reshape(-1)[:n]


def write_token_files(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Tokenize all documents and write their ids in ascending order of ``id_col``; returns the written segments.

    Columns: ``part`` and ``seq`` (the order of segments), ``n_ids``, ``doc_ids`` and ``doc_tokens``
    (arrays), ``payload``. Null texts are empty; every document ends with the end id. Null ids come
    first; rows with the same id follow each other by the hash of their texts. Very long texts are
    encoded whole, as segments of their own. An empty table gives no segments. Other columns, whatever
    their names, are not read. Ranges are dealt by id, text hash and place in the input, so many rows of
    one id, and repeated rows, are split.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.xxhash64(text_col).alias("h"), F.monotonically_increasing_id().alias("row"))
    rows = rows.repartitionByRange(n, "doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "row").select("doc_id", "text", F.spark_partition_id().cast("bigint").alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_text, seq, part = encoder(tokenizer_path), 0, 0
        keys: list[pa.Array] = []
        sizes: list[np.ndarray] = []
        held: list[np.ndarray] = []
        total = 0

        def segment() -> pa.RecordBatch:
            ids, counts = np.concatenate(held), np.concatenate(sizes)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), values) for values in (pa.concat_arrays(keys), pa.array(counts))]
            cols = [pa.array([part], pa.int64()), pa.array([seq], pa.int64()), pa.array([len(ids)], pa.int64()), *lists, pa.array([encode(ids)], pa.binary())]
            return pa.RecordBatch.from_arrays(cols, names=["part", "seq", "n_ids", "doc_ids", "doc_tokens", "payload"])

        for batch in batches:
            for a, b, ids, counts in encode_text.units(batch.column(1)):
                ids, counts = with_end(ids, counts, END_ID)
                part = batch.column(2)[a].as_py()
                keys.append(batch.column(0).slice(a, b - a))
                sizes.append(counts)
                held.append(ids)
                total += len(ids)
                if total >= SEGMENT_IDS:
                    yield segment()
                    seq, keys, sizes, held, total = seq + 1, [], [], [], 0
        if keys:
            yield segment()

    return materialize(rows.mapInArrow(run, "part bigint, seq bigint, n_ids bigint, doc_ids array<bigint>, doc_tokens array<bigint>, payload binary"), "token-files")


def read_token_files(segments: DataFrame) -> DataFrame:
    """One row per document, read from the segments: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``."""
    # totals of parts, then of segments within a part: no task sees more than a part's segments
    sizes = segments.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("total"), F.count("*").alias("n"))
    parts = materialize(parts.select("part", "n", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("part_start")), "token-parts")
    within = sizes.select("part", "seq", (F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")).alias("within"))
    starts = within.join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("within")).alias("start"))
    few = (parts.agg(F.sum("n")).first()[0] or 0) <= BROADCAST_SEGMENTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, keys, sizes, payload in zip(*(batch.column(c) for c in ("start", "doc_ids", "doc_tokens", "payload"))):
                ids, n = decode(payload.as_py()).astype("<u4"), np.array(sizes.as_py(), np.int64)
                ends = np.cumsum(n)
                crcs = [zlib.crc32(ids[e - k : e].tobytes()) for k, e in zip(n.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([keys.values, pa.array(start.as_py() + ends - n), pa.array(n), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    placed = segments.join(F.broadcast(starts) if few else starts, ["part", "seq"]).select("start", "doc_ids", "doc_tokens", "payload")
    return placed.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
