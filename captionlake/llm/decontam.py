"""Benchmark decontamination as a prefix-filtered set join.

A document contains a window exactly only if it contains each of the window's shingles, so one
necessary shingle is enough to join on. Windows are made in tasks. The corpus is read once to count
the benchmark's shingles, each window's shingles are ordered by that rarity, and the rarest becomes
its join token together with its place in the window. A document with the token is a candidate at one
place only, which must leave room for the whole window (positional and length bounds); there the words
are compared.

Windows of a benchmark of common size are known to every task. Those of a larger one meet the
documents' candidates by a shuffle on the token; a bit table of bounded size keeps most other shingles
from being sent. Either way the corpus is read as often, whatever the benchmark's size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captionlake.llm.common import discard, materialize, spread
from captionlake.llm.textkit import ALPHANUMERIC, LOWER_BYTES, Words, blocks_of

#: Fixed pattern of words, over lower-cased UTF-8 bytes.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SHINGLE = 5
#: Distinct windows that are broadcast, and bytes of their words and items; more are joined by a shuffle.
MOST_WINDOWS, MOST_BYTES = 400_000, 64 << 20
_FILTER_BITS = 22
#: Bits of the table that goes before a shuffle, at most (as bytes: an eighth).
MOST_BITS = 27


def words_of(text: str) -> list[bytes]:
    return _WORD.findall(text.encode("utf-8", "replace").translate(LOWER_BYTES))


class _Lookup:
    """Sorted 64-bit keys behind a bit table, which most strangers do not pass."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.table = np.zeros(1 << _FILTER_BITS, bool)
        self.table[(keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` of known keys, and which keys they are."""
        at = np.flatnonzero(self.table[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        which = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        good = self.keys[which] == hashes[at]
        return at[good], which[good]


def window_table(benchmark: DataFrame, width: int) -> DataFrame:
    """Distinct windows of (item, text): ``words`` (joined by spaces), ``n`` of them, ``k`` words a shingle, hashes of ``shingles`` in order, and ``items`` (not null, in order)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1)):
                words = words_of(text.as_py() or "")
                if not words:
                    continue
                n = min(width, len(words))
                k = min(SHINGLE, n)
                data = np.frombuffer(b" ".join(words), np.uint8)
                grams = Words(data, np.array([0, len(data)]), ALPHANUMERIC).grams(k)[0].view(np.int64)
                ends = np.cumsum([len(w) + 1 for w in words]) - 1
                starts = np.append(0, ends[:-1] + 1)
                m = len(words) - n + 1
                raw = data.tobytes()
                for a in range(0, m, 4096):
                    b = min(a + 4096, m)
                    joined = [raw[starts[i] : ends[i + n - 1]].decode() for i in range(a, b)]
                    windowed = np.lib.stride_tricks.sliding_window_view(grams, n - k + 1)[a:b]
                    shingles = pa.ListArray.from_arrays(np.arange(0, windowed.size + 1, n - k + 1, dtype=np.int32), pa.array(np.ascontiguousarray(windowed).ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * (b - a), pa.string()), pa.array(joined, pa.string()), pa.array([n] * (b - a), pa.int32()), pa.array([k] * (b - a), pa.int32()), shingles], names=["item", "words", "n", "k", "shingles"])

    found = benchmark.mapInArrow(run, "item string, words string, n int, k int, shingles array<bigint>")
    return found.groupBy("words", "n", "k", "shingles").agg(F.array_sort(F.collect_set("item")).alias("items"))


@dataclass
class Windows:
    """Windows that every task knows, with the items that have them."""

    words: list[str]
    items: list[list[str]]
    lengths: np.ndarray
    #: for each shingle length: places of the windows, and the hashes of their shingles as a row each
    shingles: list[tuple[int, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, table: DataFrame) -> Windows:
        rows = table.toArrow()
        n, k = (rows.column(c).to_numpy() for c in ("n", "k"))
        shingles = rows.column("shingles").combine_chunks()
        flat, begin = shingles.flatten().to_numpy().view(np.uint64), np.cumsum(np.append(0, n - k + 1))
        groups = []
        for size in np.unique(n).tolist():
            at = np.flatnonzero(n == size)
            each = int(n[at[0]] - k[at[0]] + 1)
            groups.append((int(k[at[0]]), at, flat[begin[at][:, None] + np.arange(each)]))
        return cls(rows.column("words").to_pylist(), rows.column("items").to_pylist(), n, groups)

    def keys(self) -> dict[int, np.ndarray]:
        out: dict[int, np.ndarray] = {}
        for k, _, hashes in self.shingles:
            out[k] = np.unique(np.concatenate([out.get(k, np.zeros(0, np.uint64)), hashes.ravel()]))
        return out

    def prefixes(self, counts: dict[int, tuple[np.ndarray, np.ndarray]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By shingle length: the join tokens in order, the window of each and the token's place in it. Ties go to the first place. ``counts``: sorted hashes and how often each occurs."""
        out: dict[int, list] = {}
        for k, at, hashes in self.shingles:
            known, times = counts.get(k, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
            where = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
            n = np.where(known[where] == hashes, times[where], 0) if len(known) else np.zeros(hashes.shape, np.int64)
            rare = n.argmin(1)
            out.setdefault(k, []).append((hashes[np.arange(len(at)), rare], at, rare))
        joined = {k: tuple(np.concatenate([p[i] for p in parts]) for i in range(3)) for k, parts in out.items()}
        return {k: tuple(c[np.argsort(p[0], kind="stable")] for c in p) for k, p in joined.items()}


def _count_shingles(docs: DataFrame, keys: dict[int, np.ndarray], text_col: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By shingle length, the benchmark's shingles that occur in documents and how often they do in all of them."""
    shared = docs.sparkSession.sparkContext.broadcast({k: _Lookup(v) for k, v in keys.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {k: np.zeros(len(x.keys), np.int64) for k, x in shared.value.items()}
        for batch in batches:
            for _, _, data, offsets in blocks_of(batch.column(0)):
                words = Words(data, offsets, ALPHANUMERIC)
                for k, lookup in shared.value.items():
                    hashes, one_text = words.grams(k)
                    at, which = lookup.find(hashes)
                    totals[k] += np.bincount(which[one_text[at]], minlength=len(lookup.keys))
        for k, n in totals.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k), pa.int32()), pa.array(shared.value[k].keys[some].astype(np.int64)), pa.array(n[some])], names=["k", "h", "n"])

    counted = docs.select(text_col).mapInArrow(run, "k int, h bigint, n bigint").groupBy("k", "h").agg(F.sum("n").alias("n")).collect()  # at most the shingles of the windows that are broadcast
    out = {}
    for k in keys:
        rows = sorted((r["h"] % (1 << 64), r["n"]) for r in counted if r["k"] == k)
        out[k] = np.array([h for h, _ in rows], np.uint64), np.array([n for _, n in rows], np.int64)
    return out


_HITS = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("item_ids", T.ArrayType(T.StringType())), T.StructField("hit_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))]


def _join_known(docs: DataFrame, row_type: T.StructType, windows: Windows, counts: dict[int, tuple[np.ndarray, np.ndarray]], text_col: str) -> DataFrame:
    """``docs`` has ``row``; every task knows the windows."""
    prefixes = windows.prefixes(counts)
    shared = docs.sparkSession.sparkContext.broadcast(({k: (_Lookup(np.unique(p[0])), *p) for k, p in prefixes.items()}, windows.words, windows.items, windows.lengths))
    schema = T.StructType([T.StructField("row", row_type), *_HITS])

    def candidates(words: Words, k: int, lookup: _Lookup, tokens: np.ndarray, window: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) pairs that pass the bounds."""
        hashes, one_text = words.grams(k)
        at, which = lookup.find(hashes)
        at, which = at[one_text[at]], which[one_text[at]]
        lo, hi = np.searchsorted(tokens, lookup.keys[which]), np.searchsorted(tokens, lookup.keys[which], "right")
        each = hi - lo
        at = np.repeat(at, each)
        row = np.repeat(lo, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        return at - place[row], window[row]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, window_words, window_items, lengths = shared.value
        for batch in batches:
            n_words, n_hit, items, spans = [], [], [], []
            for a, b, data, offsets in blocks_of(batch.column(0).field(text_col)):
                words = Words(data, offsets, ALPHANUMERIC)
                marks, at_items = np.zeros(len(words.starts) + 1, np.int64), {}
                ends = words.first + words.counts
                for k, table in tables.items():
                    begin, window = candidates(words, k, *table)
                    size = lengths[window]
                    fits = (begin >= 0) & (begin + size <= len(words.starts))
                    begin, window, size = begin[fits], window[fits], size[fits]
                    fits = words.texts[begin] == words.texts[begin + size - 1] if len(begin) else fits[:0]
                    for p, w, n in zip(begin[fits].tolist(), window[fits].tolist(), size[fits].tolist()):
                        piece = data[words.starts[p] : words.ends[p + n - 1]].tobytes().translate(LOWER_BYTES)
                        if b" ".join(_WORD.findall(piece)) == window_words[w].encode():
                            marks[p] += 1
                            marks[p + n] -= 1
                            at_items.setdefault(int(words.texts[p]), set()).update(window_items[w])
                hit = np.cumsum(marks[:-1]) > 0
                for j in range(b - a):
                    own = hit[words.first[j] : ends[j]]
                    n_words.append(len(own))
                    n_hit.append(int(own.sum()))
                    items.append(sorted(at_items.get(j, ())))
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]]))) if n_hit[-1] else []
                    spans.append([{"start": int(s), "end": int(e)} for s, e in zip(edges[0::2], edges[1::2])])
            arrays = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["row", *[f.name for f in _HITS]])

    return docs.mapInArrow(run, schema)


def _bit_table(hashes: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """A packed bit table of the hashes (column ``h``) by their leading bits, and the number of these bits; tasks send the bits that they set."""
    bits = min(MOST_BITS, max(16, n.bit_length() + 3))
    set_bits = hashes.select(F.call_function("shiftrightunsigned", F.col("h"), F.lit(64 - bits)).cast("int").alias("b"))
    words = set_bits.groupBy((F.col("b") / 32768).cast("int").alias("w")).agg(F.collect_set(F.pmod("b", F.lit(32768)).cast("smallint")).alias("bits"))
    table = np.zeros(1 << (bits - 3), np.uint8)
    for row in words.toLocalIterator():  # a bit table's part of 4 KB at a time
        at = row["w"] * 32768 + np.array(row["bits"], np.int64)
        np.bitwise_or.at(table, at >> 3, (np.uint8(1) << (at & 7).astype(np.uint8)))
    return table, bits


def _passes(table: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    at = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return np.flatnonzero((table[at >> 3] >> (at & 7).astype(np.uint8)) & 1)


def _join_shuffled(docs: DataFrame, row_type: T.StructType, windows: DataFrame, width: int, text_col: str) -> DataFrame:
    """The same for windows that are too many to be known to every task."""
    spark = docs.sparkSession
    kinds = [r["k"] for r in windows.select("k").distinct().collect()]  # 1 to SHINGLE
    numbered = materialize(windows.withColumn("w", F.monotonically_increasing_id()), "decontam-windows")
    placed = numbered.select("w", "k", F.posexplode("shingles").alias("place", "h"))

    def filters(hashes: DataFrame) -> dict[int, tuple[np.ndarray, int]]:
        return {k: _bit_table(hashes.where(F.col("k") == k), hashes.where(F.col("k") == k).count()) for k in kinds}

    distinct = materialize(placed.select("k", "h").distinct(), "decontam-shingles")
    first = spark.sparkContext.broadcast(filters(distinct))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in blocks_of(batch.column(0)):
                words = Words(data, offsets, ALPHANUMERIC)
                for k, (table, bits) in first.value.items():
                    hashes, one_text = words.grams(k)
                    found, n = np.unique(hashes[one_text][_passes(table, bits, hashes[one_text])], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), k), pa.int32()), pa.array(found.view(np.int64)), pa.array(n)], names=["k", "h", "n"])

    counted = docs.select(F.col(f"row.`{text_col}`")).mapInArrow(count, "k int, h bigint, n bigint").groupBy("k", "h").agg(F.sum("n").alias("n"))
    ranked = placed.join(counted, ["k", "h"], "left").groupBy("w").agg(F.min_by(F.struct("h", "place"), F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place")).alias("t"))
    tokens = materialize(numbered.join(ranked, "w").select("w", "k", "n", "words", "items", "t.h", "t.place"), "decontam-tokens")
    second = spark.sparkContext.broadcast(filters(tokens.select("k", "h").distinct()))

    # rows get a number once, and their words are counted on the way
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [Words(data, offsets, ALPHANUMERIC).counts for _, _, data, offsets in blocks_of(batch.column(0).field(text_col))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.zeros(0, np.int64), *counts]))], names=["row", "uid", "n_words"])

    rows = docs.select("row", F.monotonically_increasing_id().alias("uid"))
    rows = materialize(rows.mapInArrow(number, T.StructType([*rows.schema, _HITS[0]])), "decontam-rows")

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids = batch.column(0).to_numpy()
            for a, b, data, offsets in blocks_of(batch.column(1)):
                words = Words(data, offsets, ALPHANUMERIC)
                ends = words.first + words.counts
                for k, (table, bits) in second.value.items():
                    hashes, one_text = words.grams(k)
                    at = _passes(table, bits, hashes)
                    at = at[one_text[at]]
                    own = words.texts[at]
                    lo, hi = np.maximum(at - width, words.first[own]), np.minimum(at + width, ends[own])
                    around = [b" ".join(_WORD.findall(data[words.starts[p] : words.ends[q - 1]].tobytes().translate(LOWER_BYTES))).decode() for p, q in zip(lo.tolist(), hi.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), k), pa.int32()), pa.array(hashes[at].view(np.int64)), pa.array(uids[a:b][own]), pa.array(at - words.first[own]), pa.array((at - lo).astype(np.int32)), pa.array(around, pa.string())],
                        names=["k", "h", "uid", "at", "before", "around"],
                    )

    asked = rows.select("uid", F.col(f"row.`{text_col}`").alias("text")).mapInArrow(candidates, "k int, h bigint, uid bigint, at bigint, before int, around string")
    # the tokens of a very common passage meet many candidates: adaptive execution splits these, as a token has few windows
    met = asked.join(tokens.select("k", "h", "n", "place", "words", "items"), ["k", "h"])
    begin, around = F.col("before") - F.col("place"), F.split("around", " ")
    fits = (begin >= 0) & (begin + F.col("n") <= F.size(around))
    same = F.array_join(F.slice(around, F.greatest(begin + 1, F.lit(1)), F.col("n")), " ") == F.col("words")
    hits = met.where(fits).where(same).select("uid", (F.col("at") - F.col("place")).alias("start"), (F.col("at") - F.col("place") + F.col("n")).alias("end"), "items")
    spans = hits.select("uid", "start", "end").distinct().groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s"))
    named = hits.select("uid", F.explode("items").alias("item")).distinct().groupBy("uid").agg(F.array_sort(F.collect_list("item")).alias("item_ids"))
    # spans of a document in order, those that touch as one: a span ends where the next begins beyond all ends before
    reach = F.aggregate("s", F.struct(F.lit(-1).cast("bigint").alias("end"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("out")), _joined, lambda x: x["out"])
    found = spans.select("uid", reach.alias("hit_spans")).join(named, "uid", "left")
    out = rows.join(found, "uid", "left").select("row", "n_words", F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), F.coalesce("hit_spans", F.array().cast(_HITS[3].dataType)).alias("hit_spans"))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])
    return out.select("row", "n_words", n_hit.alias("n_hit"), "item_ids", "hit_spans")


def _joined(state, span):
    """A fold over spans by start: touching ones become one."""
    grown = F.concat(F.slice(state["out"], 1, F.size(state["out"]) - 1), F.array(F.struct(F.element_at(state["out"], -1)["start"].alias("start"), F.greatest(state["end"], span["end"]).alias("end"))))
    return F.struct(F.greatest(state["end"], span["end"]).alias("end"), F.when(span["start"] <= state["end"], grown).otherwise(F.array_append(state["out"], span)).alias("out"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", most_windows: int = MOST_WINDOWS, most_bytes: int = MOST_BYTES) -> DataFrame:
    """Columns ``row`` (a struct of all input columns), ``n_words``, ``n_hit``, ``item_ids`` (strings, in order) and ``hit_spans`` (word intervals).

    A window is ``width`` consecutive words of an item; an item with fewer words, but not none, is
    one window. A word inside any occurrence of a window is hit. Null texts have no words; very long
    ones are read whole. Items of the same text and repeated item ids are each listed once; an item
    with a null id still hits words but is not listed. Documents may repeat, and each row has its own
    result; an empty table gives an empty result, and an empty benchmark hits nothing. Other columns,
    whatever their names, are passed on in ``row``. Up to ``most_windows`` distinct windows of
    ``most_bytes`` are broadcast; more are joined by a shuffle.
    """
    windows = materialize(window_table(benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")), width), "decontam-windows")
    items_size = F.aggregate("items", F.lit(0), lambda a, x: a + F.octet_length(x) + 8)
    n, size = windows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("words") + items_size), F.lit(0))).first()
    docs = spread(docs)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    if n <= most_windows and size <= most_bytes:
        known = Windows.of(windows)
        out = _join_known(rows, docs.schema, known, _count_shingles(docs, known.keys(), text_col) if n else {}, text_col)
        discard(windows)
        return out
    return _join_shuffled(rows, docs.schema, windows, width, text_col)
