"""Language-model scores: a word unigram base, and context-tree weighting over bytes.

A byte is eight binary decisions down a tree; each decision has a context tree over the bytes before
it, from no context to ``depth`` bytes. Every node holds a Krichevsky-Trofimov estimate, and nodes are
mixed over all depths with the weights that the training counts give them (half the node's own
estimate, half the product of its children, from the leaves up). Texts end with byte 255, which UTF-8
never uses; it also stands before the first.

Contexts are numbers with the nearest byte first, so a subtree is a run of sorted numbers. All contexts
of the training documents are counted, none is dropped; they are dealt into hash buckets by their nearest
``DEALT`` bytes, so each bucket weights its subtrees alone and only sums for contexts of one byte reach
the driver. A unit of documents asks the buckets for its distinct contexts and bytes, and their answers
meet the unit's text again.

Word counts are summed over all training documents in hash buckets. Words that fill a fixed share of
the corpus are few, so their counts are broadcast; the others meet the documents in their buckets,
where each unit of documents has sent its distinct words and where they occur.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captionlake.llm.common import discard, materialize, spread
from captionlake.llm.textkit import LOWER_BYTES, SPACED, Words, blocks_of, mix

#: Bytes of the longest context, unless a caller says otherwise; with the byte itself at most eight.
DEPTH = 5
#: Contexts that agree in so many nearest bytes are in one bucket.
DEALT = 2
END = 255
#: Bytes of text in a unit of documents, and documents in it at most.
UNIT_BYTES, UNIT_DOCS = 4 << 20, 1 << 16
#: Bytes of text whose contexts are held one by one; for each byte they and what sorts them take some 70.
RUN_BYTES = 1 << 18
#: A word is broadcast if it makes up one in this many training tokens, so no more than this many words are.
HEAD_WORDS = 100_000
END_TOKEN = np.uint64(0)
#: Distinct contexts that a task counts before it sends them.
HELD_CONTEXTS = 1 << 22


def merge_counts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(all_keys, kind="stable")
    all_keys = all_keys[order]
    first = np.flatnonzero(np.append(True, all_keys[1:] != all_keys[:-1])) if len(all_keys) else np.zeros(0, np.int64)
    return all_keys[first], np.add.reduceat(all_counts[order], first) if len(first) else all_counts


def contexts(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of every text and its end: ``depth`` bytes of context, the nearest first, and itself as one number, text by text; and each text's first place."""
    n, pad = len(offsets) - 1, depth + 1
    stream = np.full(len(data) + pad * n, END, np.uint8)
    stream[np.arange(len(data)) + np.repeat(pad * np.arange(n) + depth, np.diff(offsets))] = data  # ends before, one after each text
    codes = np.zeros(max(len(stream) - depth, 0), np.uint64)
    for back in [*range(1, depth + 1), 0]:
        codes <<= np.uint64(8)
        codes |= stream[depth - back : len(stream) - back]
    keep = np.ones(len(codes), bool)
    inner = (offsets[:-1] + pad * np.arange(n))[1:]
    for j in range(1, depth + 1):
        keep[inner - j] = False  # contexts across two texts
    return codes[keep], offsets[:-1] + np.arange(n)


def _runs(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts in runs of about ``RUN_BYTES``; a longer one is a run of its own."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = min(max(int(np.searchsorted(offsets, offsets[a] + RUN_BYTES, "right")) - 1, a + 1), n)
        yield data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def distinct_contexts(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct contexts of texts with their bytes, in order, and how often each occurs."""
    found = [np.unique(contexts(*run, depth)[0], return_counts=True) for run in _runs(data, offsets)]
    return merge_counts([codes for codes, _ in found], [n for _, n in found])


def unit_scores(data: np.ndarray, offsets: np.ndarray, depth: int, buckets: int, logs: dict[int, np.ndarray]) -> np.ndarray:
    """log10 probabilities of a unit's texts, from the ``logs`` of its distinct contexts in order in each bucket."""
    runs = []
    for run in _runs(data, offsets):
        codes, first = contexts(*run, depth)
        own, at = np.unique(codes, return_inverse=True)
        runs.append((own, at.astype(np.uint32), first))
    if not runs:
        return np.zeros(0)
    codes = np.unique(np.concatenate([own for own, _, _ in runs]))
    each = np.zeros(len(codes))
    for j, of in enumerate(_dealt(codes, buckets, depth)):
        if len(of):
            each[of] = logs[j]
    return np.concatenate([np.add.reduceat(each[np.searchsorted(codes, own)][at], first) for own, at, first in runs])


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x > 0, by Stirling's series after a shift of eight."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def _shorter(codes: np.ndarray) -> np.ndarray:
    """Contexts without their farthest byte; the last byte (a byte or a node of its tree) stays."""
    return ((codes >> 16) << 8) | (codes & 255)


Level = list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def weigh(codes: np.ndarray, counts: np.ndarray, depth: int, least: int, below: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[dict[int, Level], tuple[np.ndarray, np.ndarray]]:
    """Trees of sorted contexts of ``depth`` bytes and their bytes, up to contexts of ``least`` bytes.

    By depth and bit: sorted nodes (context and place in the byte's tree), the estimates of a one, and
    the share of the own estimate in the mixture. Also the nodes one byte shorter than ``least`` and the
    sums of the logs of their children, which is what ``below`` passes to the tree above.
    """
    levels: dict[int, Level] = {}
    for d in range(depth, least - 1, -1):
        if d < depth:
            codes, counts = merge_counts([_shorter(codes)], [counts])
        levels[d], above = [], []
        byte = codes & 255
        for bit in range(8):
            node = (codes - byte) | (byte >> (8 - bit)) | (1 << bit)  # in order, as bytes are
            first = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else np.zeros(0, np.int64)
            up = counts * ((byte >> (7 - bit)) & 1).astype(np.int64)
            ones, both = (np.add.reduceat(x, first).astype(float) if len(first) else np.zeros(0) for x in (up, counts))
            keys = node[first]
            own = _log_gamma(both - ones + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(both + 1) - math.log(math.pi)
            if below is None:
                weighted, share = own, np.ones(len(own))
            else:
                mine = (below[0] & 255) >> bit == 1
                kids = np.bincount(np.searchsorted(keys, below[0][mine]), below[1][mine], len(keys))
                weighted = math.log(0.5) + np.logaddexp(own, kids)
                share = np.exp(math.log(0.5) + own - weighted)
            levels[d].append((keys, (ones + 0.5) / (both + 1), share))
            above.append((_shorter(keys), weighted))
        parents, at = np.unique(np.concatenate([x[0] for x in above]), return_inverse=True)
        below = parents, np.bincount(at, np.concatenate([x[1] for x in above]), len(parents))
    return levels, below


@dataclass
class ContextTree:
    """Probabilities of bytes after contexts of up to ``depth`` bytes."""

    levels: dict[int, Level]
    depth: int

    @classmethod
    def of(cls, codes: np.ndarray, counts: np.ndarray, depth: int = DEPTH) -> ContextTree:
        """The model of counts by context and byte (sorted codes); without counts every decision has probability one half."""
        return cls(weigh(codes.astype(np.uint64), counts, depth, 0)[0], depth)

    def logs(self, codes: np.ndarray) -> np.ndarray:
        """log10 of the probability of the last byte of each code after its other bytes."""
        total, byte = np.zeros(len(codes)), codes & 255
        for bit in range(8):
            node, p = (byte >> (8 - bit)) | (1 << bit), np.full(len(codes), 0.5)
            for d in range(self.depth, -1, -1):
                keys, estimates, share = self.levels[d][bit]
                if len(keys):
                    key = ((codes >> (8 * (self.depth - d + 1))) << 8) | node
                    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    w = share[at]
                    p = np.where(keys[at] == key, w * estimates[at] + (1 - w) * p, 0.5)
            total += np.log10(np.where((byte >> (7 - bit)) & 1, p, 1 - p))
        return total

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """log10 probabilities of texts, their ends included."""
        codes, first = contexts(data, offsets, self.depth)
        distinct, at = np.unique(codes, return_inverse=True)
        return np.add.reduceat(self.logs(distinct)[at], first) if len(first) else np.zeros(0)


def _squeeze(values: np.ndarray) -> bytes:
    """Numbers byte by byte, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unsqueeze(packed: bytes, dtype: type) -> np.ndarray:
    n, size = int.from_bytes(packed[:8], "little"), np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(packed[8:], size * n, "zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers of at least 0 as differences, compressed; sorted ones get small."""
    kept = values.view(f"u{values.itemsize}")
    return _squeeze(np.diff(kept, prepend=kept.dtype.type(0)))


def _unpack(packed: bytes, dtype: type = np.uint64) -> np.ndarray:
    steps = _unsqueeze(packed, dtype)
    kept = steps.view(f"u{steps.itemsize}")
    return np.cumsum(kept, dtype=kept.dtype).view(dtype)


def _units(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for at in range(0, len(column), UNIT_DOCS):
        for a, b, data, offsets in blocks_of(column.slice(at, UNIT_DOCS), UNIT_BYTES):
            yield at + a, at + b, data, offsets


def _split(keys: np.ndarray, buckets: int) -> list[np.ndarray]:
    """For each bucket the places of its keys, in order."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return np.split(order, np.cumsum(np.bincount(bucket, minlength=buckets))[:-1])


def _dealt(codes: np.ndarray, buckets: int, depth: int) -> list[np.ndarray]:
    """For each bucket the places of its contexts, in order."""
    return _split(mix(codes >> (8 * (depth - min(DEALT, depth) + 1))), buckets)


def unit_rows(data: np.ndarray, offsets: np.ndarray, unit: int, head_keys: np.ndarray, head_counts: np.ndarray, buckets: int, depth: int) -> tuple[list[tuple], np.ndarray]:
    """Rows (bucket, unit, x, y, z) of a unit, its text in bucket -1, and the number of words of each text. What lies between ends with the call, not with the next unit."""
    data = np.frombuffer(data.tobytes().translate(LOWER_BYTES), np.uint8)
    words = Words(data, offsets, SPACED)
    n_docs, weight = len(offsets) - 1, np.log10(head_counts + 0.1)
    keys = np.concatenate([words.hashes, np.full(n_docs, END_TOKEN)])
    owner = np.concatenate([words.texts, np.arange(n_docs)])
    keys, which = np.unique(keys, return_inverse=True)
    pairs, times = np.unique(which.astype(np.int64) * n_docs + owner, return_counts=True)
    word, doc = pairs // n_docs, pairs % n_docs
    at = np.minimum(np.searchsorted(head_keys, keys), max(len(head_keys) - 1, 0))
    is_head = head_keys[at] == keys if len(head_keys) else np.zeros(len(keys), bool)
    own = is_head[word]
    sums = np.bincount(doc[own], times[own] * weight[at[word[own]]], n_docs)
    known = np.bincount(doc[own], times[own], n_docs)
    text = pa.compress(data, "zstd", asbytes=True)
    rows = [(-1, unit, text, sums.tobytes(), known.astype(np.int64).tobytes())]
    codes = distinct_contexts(data, offsets, depth)[0]
    rows += [(buckets + i, unit, _pack(codes[of]), None, None) for i, of in enumerate(_dealt(codes, buckets, depth)) if len(of)]
    # the other words: distinct ones of the unit, how many places each has, then documents and times (split at 255)
    word, doc, times = word[~own], doc[~own], times[~own]
    for i, of in enumerate(_split(keys[word], buckets) if len(word) else []):
        if len(of):
            w, d, t = word[of], doc[of], times[of]
            split = (t + 254) // 255
            w, d = np.repeat(w, split), np.repeat(d, split)
            t = np.minimum(255, np.repeat(t, split) - 255 * (np.arange(len(w)) - np.repeat(np.cumsum(split) - split, split)))
            distinct_words, places = np.unique(w, return_counts=True)
            d = _pack(d.astype("<u2"))
            rows.append((i, unit, _pack(keys[distinct_words]), _squeeze(places.astype("<u4")), len(d).to_bytes(4, "little") + d + _squeeze(t.astype(np.uint8))))
    return rows, words.counts


def count_training(train: DataFrame, buckets: int, depth: int) -> DataFrame:
    """Counts of words and, in buckets from ``buckets`` on, of contexts: one row per bucket with sorted ``keys`` and ``counts`` as bytes (packed for contexts).

    Contexts are summed over a task before they are sent, or over ``HELD_CONTEXTS`` of them, and like
    words they are split among the buckets.
    """

    def sent(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2))], names=["bucket", "keys", "counts"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list] = ([], [])
        limit = 0  # contexts held before they are merged

        def contexts_held() -> pa.RecordBatch:
            codes, n = merge_counts(*held)
            return sent([(buckets + i, _pack(codes[at]), _pack(n[at])) for i, at in enumerate(_dealt(codes, buckets, depth)) if len(at)])

        for batch in batches:
            for a, b, data, offsets in _units(batch.column(0)):
                data = np.frombuffer(data.tobytes().translate(LOWER_BYTES), np.uint8)
                keys, counts = np.unique(np.append(Words(data, offsets, SPACED).hashes, END_TOKEN), return_counts=True)
                counts[np.searchsorted(keys, END_TOKEN)] += b - a - 1
                yield sent([(i, keys[at].tobytes(), counts[at].astype("<u4").tobytes()) for i, at in enumerate(_split(keys, buckets)) if len(at)])
                for kept, new in zip(held, distinct_contexts(data, offsets, depth)):
                    kept.append(new)
                if sum(map(len, held[0])) > max(limit, 1 << 20):
                    codes, n = merge_counts(*held)
                    held, limit = ([codes], [n]), 2 * len(codes)
                    if len(codes) > HELD_CONTEXTS:
                        yield contexts_held()
                        held, limit = ([], []), 0
        yield contexts_held()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        size: dict[int, int] = {}

        def out(bucket: int) -> pa.RecordBatch:
            keys, counts = merge_counts(*held.pop(bucket))
            return sent([(bucket, keys.tobytes(), counts.astype("<i8").tobytes()) if bucket < buckets else (bucket, _pack(keys), _pack(counts))])

        for batch in batches:
            for bucket, keys, counts in zip(*(batch.column(i) for i in range(3))):
                bucket = bucket.as_py()
                for other in [b for b in held if b != bucket]:
                    yield out(other)
                kept, sums = held.setdefault(bucket, ([], []))
                if bucket < buckets:
                    kept.append(np.frombuffer(keys.as_py(), np.uint64))
                    sums.append(np.frombuffer(counts.as_py(), "<u4").astype(np.int64))
                else:
                    kept.append(_unpack(keys.as_py()))
                    sums.append(_unpack(counts.as_py(), np.int64))
                size[bucket] = size.get(bucket, 0) + len(kept[-1])
                if len(kept) > 1 and size[bucket] > max(1 << 20, 2 * len(kept[0])):
                    k, c = merge_counts(kept, sums)
                    held[bucket], size[bucket] = ([k], [c]), len(k)
        for bucket in list(held):
            yield out(bucket)

    schema = "bucket int, keys binary, counts binary"
    dealt = train.mapInArrow(read, schema).repartitionById(buckets, "bucket").sortWithinPartitions("bucket")
    return materialize(dealt.mapInArrow(merge, schema), "lm-counts")


def _head(counts: DataFrame, buckets: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, n in zip(batch.column(0), batch.column(1)):
                n = np.frombuffer(n.as_py(), "<i8")
                at = np.flatnonzero(n >= least)
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys.as_py(), np.int64)[at]), pa.array(n[at])], names=["h", "n"])

    rows = counts.where(F.col("bucket") < buckets).select("keys", "counts").mapInArrow(frequent, "h bigint, n bigint").collect()
    keys, n = np.array([r["h"] for r in rows], np.int64).view(np.uint64), np.array([r["n"] for r in rows], np.int64)
    order = np.argsort(keys)
    return keys[order], n[order]


def _top(counts: DataFrame, buckets: int, depth: int) -> dict[int, Level]:
    """The tree of contexts shorter than those that buckets share out: of one byte and none. A bucket sends counts and sums of logs of at most 2 ** 16 contexts and bytes each."""
    dealt = min(DEALT, depth)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, n in zip(batch.column(0), batch.column(1)):
                codes, n = _unpack(keys.as_py()), _unpack(n.as_py(), np.int64)
                _, (nodes, logs) = weigh(codes, n, depth, dealt)
                codes, n = merge_counts([((codes >> (8 * (depth + 2 - dealt))) << 8) | (codes & 255)], [n])
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (codes, n, nodes, logs)], names=["codes", "n", "nodes", "logs"])

    found = counts.where(F.col("bucket") >= buckets).select("keys", "counts").mapInArrow(sums, "codes binary, n binary, nodes binary, logs binary").collect()
    of = lambda name, dtype: [np.frombuffer(r[name], dtype) for r in found]
    codes, n = merge_counts(of("codes", np.uint64), of("n", np.int64))
    return weigh(codes, n, dealt - 1, 0, merge_counts(of("nodes", np.uint64), of("logs", np.float64)))[0]


def score_documents(docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``bits_per_byte`` of every row of ``docs``.

    Tokens are lower-cased (A-Z) words between ASCII white space and one end a text; the base score
    adds 0.1 to every count. ``score`` is the context tree's log10 probability of the text's bytes,
    lower-cased too, with the end. Null texts are empty. With nothing to train on, counts are zero
    and the context tree gives each decision one half. Rows are scored one by one, so repeated rows
    and ids, null ones too, get equal results; an empty table gives an empty one. Very long texts are
    scored whole, as units of their own. Other columns, whatever their names, are not read. ``depth``:
    1 to 7 bytes of context.
    """
    if not 1 <= depth <= 7:
        raise ValueError("depth must be 1 to 7")
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = count_training(spread(train.select(F.coalesce(text_col, F.lit("")).alias("text"))), buckets, depth)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [np.frombuffer(x.as_py(), "<i8") for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([int(x.sum()) for x in n], pa.int64()), pa.array([len(x) for x in n], pa.int64())], names=["n", "v"])

    summed = counts.where(F.col("bucket") < buckets).select("counts").mapInArrow(totals, "n bigint, v bigint").agg(F.sum("n"), F.sum("v")).first()
    total, distinct = summed[0] or 0, summed[1] or 0
    head = _head(counts, buckets, max(-(-total // HEAD_WORDS), 1))
    shared = spark.sparkContext.broadcast((head, _top(counts, buckets, depth)))
    id_type = docs.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_keys, head_counts = shared.value[0]
        for batch in batches:
            base = batch.column("unit").to_pylist()
            for a, b, data, offsets in _units(batch.column("text")):
                n_docs = b - a
                rows, n_words = unit_rows(data, offsets, base[a], head_keys, head_counts, buckets, depth)
                docs_out = pa.StructArray.from_arrays([batch.column("doc_id").slice(a, n_docs), pa.array(n_words + 1, pa.int64()), pa.array(np.diff(offsets).astype(np.int64))], names=["doc_id", "n_tokens", "bytes"])
                lists = pa.ListArray.from_arrays(pa.array([0, n_docs] + [n_docs] * (len(rows) - 1), pa.int32()), docs_out)
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (2, 3, 4)), lists], names=["bucket", "unit", "x", "y", "z", "docs"])

    rows = spread(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))).withColumn("unit", F.monotonically_increasing_id())
    units = materialize(rows.mapInArrow(read, f"bucket int, unit bigint, x binary, y binary, z binary, docs array<struct<doc_id:{id_type},n_tokens:bigint,bytes:bigint>>"), "lm-units")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of a bucket come before the units that ask for them."""
        known_keys, known_counts, current = np.zeros(0, np.uint64), np.zeros(0, np.int64), None
        nothing = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def tree_of(codes: np.ndarray, n: np.ndarray) -> tuple[ContextTree, np.ndarray, np.ndarray]:
            tree = ContextTree(weigh(codes, n, depth, min(DEALT, depth))[0] | shared.value[1], depth)
            return tree, codes, tree.logs(codes)

        for batch in batches:
            out = []
            for bucket, unit, x, y, z in zip(*(batch.column(i) for i in range(5))):
                bucket, unit, x, y, z = (v.as_py() for v in (bucket, unit, x, y, z))
                if bucket >= buckets:
                    if unit is None or bucket != current:
                        current = bucket
                        tree, seen, logs = tree_of(*((_unpack(x), _unpack(y, np.int64)) if unit is None else nothing))
                    if unit is not None:
                        codes = _unpack(x)
                        at = np.minimum(np.searchsorted(seen, codes), max(len(seen) - 1, 0))
                        new = seen[at] != codes if len(seen) else np.ones(len(codes), bool)
                        found = np.zeros(len(codes))
                        found[~new] = logs[at[~new]]
                        found[new] = tree.logs(codes[new])
                        out.append((unit, _squeeze(found.astype(np.float32)), None, bucket))
                    continue
                if unit is None:
                    known_keys, known_counts, current = np.frombuffer(x, np.uint64), np.frombuffer(y, "<i8"), bucket
                    continue
                if bucket != current:
                    known_keys, known_counts, current = known_keys[:0], known_counts[:0], bucket
                keys, places = _unpack(x), _unsqueeze(y, np.uint32)
                n = 4 + int.from_bytes(z[:4], "little")
                doc, times = _unpack(z[4:n], np.uint16), _unsqueeze(z[n:], np.uint8)
                at = np.minimum(np.searchsorted(known_keys, keys), max(len(known_keys) - 1, 0))
                c = np.where(known_keys[at] == keys, known_counts[at], 0) if len(known_keys) else np.zeros(len(keys), np.int64)
                each = np.repeat(c, places)
                out.append((unit, np.bincount(doc, times * np.log10(each + 0.1)).tobytes(), np.bincount(doc, np.where(each > 0, times, 0)).astype(np.int64).tobytes(), bucket))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), *(pa.array([r[i] for r in out], pa.binary()) for i in (1, 2)), pa.array([r[3] for r in out], pa.int32())], names=["unit", "sums", "known", "bucket"])

    asked = units.where(F.col("bucket") >= 0).select("bucket", "unit", "x", "y", "z")
    known = counts.select("bucket", F.lit(None).cast("bigint").alias("unit"), F.col("keys").alias("x"), F.col("counts").alias("y"), F.lit(None).cast("binary").alias("z"))
    partial = asked.unionByName(known).repartitionById(buckets, "bucket").sortWithinPartitions("bucket", F.col("unit").asc_nulls_first()).mapInArrow(add, "unit bigint, sums binary, known binary, bucket int")

    own = units.where(F.col("bucket") == -1).select("unit", F.col("y").alias("sums"), F.col("z").alias("known"), "bucket", F.col("x").alias("text"), "docs")
    log_all = math.log10(total + 0.1 * (distinct + 1))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a unit follow each other; the one with its documents comes last."""
        current, sums, known, logs = None, None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                unit, s, k, bucket = (batch.column(j)[i].as_py() for j in range(4))
                if unit != current:
                    current, sums, known, logs = unit, np.zeros(0), np.zeros(0, np.int64), {}
                if bucket >= buckets:
                    logs[bucket - buckets] = _unsqueeze(s, np.float32)
                    continue
                s, k = np.frombuffer(s), np.frombuffer(k, np.int64)
                if len(s) > len(sums):
                    sums, known = np.pad(sums, (0, len(s) - len(sums))), np.pad(known, (0, len(s) - len(known)))
                sums[: len(s)] += s
                known[: len(k)] += k
                mine = batch.column(5)[i]
                if mine.is_valid:
                    d = mine.values
                    n, size = (d.field(j).to_numpy(zero_copy_only=False) for j in (1, 2))
                    data = np.frombuffer(pa.decompress(batch.column(4)[i].as_py(), int(size.sum()), "zstd", asbytes=True), np.uint8)
                    score = unit_scores(data, np.append(0, np.cumsum(size)), depth, buckets, logs)
                    bits = -score / math.log10(2) / np.maximum(size, 1)
                    yield pa.RecordBatch.from_arrays([d.field(0), d.field(1), pa.array(known), pa.array(np.full(len(n), total), pa.int64()), pa.array(sums - n * log_all), pa.array(score), pa.array(bits)], names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    none = [F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("text", "docs")]
    joined = partial.select("*", *none).unionByName(own).repartition(buckets, "unit").sortWithinPartitions("unit", F.col("docs").isNotNull())
    return joined.mapInArrow(finish, f"doc_id {id_type}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double")
