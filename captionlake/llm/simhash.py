"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints that differ in at most three of 64 bits agree on all but three of any m blocks of bits,
so they meet in a bucket for one choice of m - 3 blocks. Within buckets, fingerprints are stored as
bit planes (word j of plane b holds bit b of 64 fingerprints). Distances of 64 pairs at a time are
counted by carry-save adders over the planes, and words in which every pair has passed the radius
are abandoned. Only edges that join components of a bucket leave it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captionlake.llm.common import materialize, spread
from captionlake.llm.graph import components
from captionlake.llm.textkit import LOWER_BYTES

SEED = 42
RADIUS = 3
#: Fingerprints of a bucket that one task compares. Larger buckets are split by further bits; what is larger still is dealt out in pairs of tiles of half this size.
TILE = 16_384
#: Rows of the table of oversized buckets that may be broadcast.
BROADCAST_BUCKETS = 100_000
#: Groups of up to this size are compared by shifting planes against themselves.
SMALL = 64
#: Bytes of a text taken at a time, up to the next white space.
PIECE = 4 << 20
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, width: int = 3) -> int:
    """The 64-bit fingerprint of a whole text as an unsigned integer; zero if it has no words."""
    from xxhash import xxh64_intdigest

    data = (text or "").encode("utf-8", "replace").translate(LOWER_BYTES)
    ones, n, kept, at = np.zeros(64, np.int64), 0, [], 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        words = kept + (data[at:end] if at or end < len(data) else data).split()
        at = end
        if len(words) >= width:
            joined = b" ".join(words)
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(sizes + 1) - 1
            starts = ends - sizes
            hashes = np.array([xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())], np.uint64)
            n += len(hashes)
            for i in range(0, len(hashes), 1 << 14):
                ones += np.unpackbits(hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        kept = words[len(words) - width + 1 :] if len(words) >= width else words
    if not n and kept:
        return xxh64_intdigest(b" ".join(kept), SEED)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]) if n else 0


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (a struct of all columns), ``uid`` (a number of its own for each row) and ``fp`` (the fingerprint as a signed 64-bit integer)."""
    rows = spread(docs).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("uid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(0).field(text_col)], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], names=["row", "uid", "fp"])

    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("fp", T.LongType())]))


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes: row b, bit i of the whole row, is bit b of fingerprint i."""
    bits = np.zeros((-(-len(fps) // 64) * 64, 64), np.uint8)
    bits[: len(fps)] = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


class Counter:
    """Carry-save counters of many distances at once: ``ones``, ``twos``, and ``over`` once a count has reached four."""

    def __init__(self, shape: tuple[int, ...]):
        self.ones, self.twos, self.over = (np.zeros(shape, np.uint64) for _ in range(3))

    def add(self, differ: np.ndarray) -> None:
        carry = self.ones & differ
        self.ones ^= differ
        self.over |= self.twos & carry
        self.twos ^= carry

    def keep(self, words: np.ndarray) -> None:
        self.ones, self.twos, self.over = self.ones[..., words], self.twos[..., words], self.over[..., words]


def shifted_pairs(fps: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places within the radius and in the same group (``groups`` is sorted, none larger than ``SMALL``)."""
    left, right = [], []
    all_planes = planes(fps)
    nothing = np.zeros((64, 1), np.uint64)
    for d in range(1, SMALL):
        same = np.zeros(all_planes.shape[1] * 64, bool)
        same[: max(len(fps) - d, 0)] = groups[: len(fps) - d] == groups[d:] if d < len(fps) else False
        if not same.any():
            break
        mask = np.packbits(same, bitorder="little").view("<u8")
        words = np.flatnonzero(mask)
        padded = np.concatenate([all_planes, nothing], axis=1)
        here, after, mask = all_planes[:, words], padded[:, words + 1], mask[words]
        counter = Counter((len(words),))
        for b in range(64):
            counter.add(here[b] ^ ((here[b] >> np.uint64(d)) | (after[b] << np.uint64(64 - d))))
            if b % 8 == 7 and len(words):
                alive = np.flatnonzero(mask & ~counter.over)
                if len(alive) < len(words):
                    words, here, after, mask = words[alive], here[:, alive], after[:, alive], mask[alive]
                    counter.keep(alive)
        close = np.unpackbits((mask & ~counter.over).view(np.uint8), bitorder="little")
        at = np.flatnonzero(close)
        i = words[at // 64] * 64 + at % 64
        left.append(i)
        right.append(i + d)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def neighbours(fps: np.ndarray, queries: int = 128) -> np.ndarray:
    """A bit matrix: bit j of row i is set if fingerprints i and j are within the radius."""
    p = planes(fps)
    n, w = len(fps), p.shape[1]
    out = np.zeros((n, w), np.uint64)
    for q in range(0, n, queries):
        bits = np.unpackbits(fps[q : q + queries].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        fills = np.where(bits.astype(bool), _ONES, np.uint64(0))
        words = np.arange(w)
        counter, own = Counter((len(bits), w)), p
        for b in range(64):
            counter.add(own[b][None, :] ^ fills[:, b][:, None])
            if b % 8 == 7:
                alive = np.flatnonzero((counter.over != _ONES).any(0))
                if len(alive) < len(words):
                    words, own = words[alive], own[:, alive]
                    counter.keep(alive)
        out[q : q + queries, words] = ~counter.over
    if n % 64:
        out[:, -1] &= np.uint64((1 << (n % 64)) - 1)
    return out


def _roots_dense(fps: np.ndarray) -> np.ndarray:
    """For each fingerprint of one bucket, the first of its component."""
    near, roots = neighbours(fps), np.full(len(fps), -1)
    unseen = np.zeros(near.shape[1] * 64, np.uint8)
    unseen[: len(fps)] = 1
    unseen = np.packbits(unseen, bitorder="little").view("<u8").copy()
    for i in range(len(fps)):
        if roots[i] >= 0:
            continue
        front = np.array([i])
        while len(front):
            roots[front] = i
            for f in front:
                unseen[f // 64] &= ~(np.uint64(1) << np.uint64(f % 64))
            front = np.flatnonzero(np.unpackbits((np.bitwise_or.reduce(near[front], axis=0) & unseen).view(np.uint8), bitorder="little"))
    return roots


def _roots_small(fps: np.ndarray, groups: np.ndarray) -> np.ndarray:
    left, right = shifted_pairs(fps, groups)
    roots = np.arange(len(fps))
    while len(left):
        low = np.minimum(roots[left], roots[right])
        before = roots.copy()
        np.minimum.at(roots, left, low)
        np.minimum.at(roots, right, low)
        roots = roots[roots]
        if (roots == before).all():
            break
    return roots


def scheme(n: int) -> list[int]:
    """Masks of bits on which two linked fingerprints must agree for at least one mask; more of them, and longer, for more fingerprints."""
    blocks = next((m for m in (4, 5, 6, 7, 8) if n <= 4 << (64 * (m - RADIUS) // m)), 8)
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    return [sum(chosen) for chosen in combinations(parts, blocks - RADIUS)]


def open_parts(mask: int) -> list[int]:
    """Four masks that share out the bits beyond ``mask``, as signed numbers: of two linked fingerprints that agree on ``mask``, one leaves no difference."""
    bits = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(bits) * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    found = [sum(1 << b for b in bits[x:y]) for x, y in zip(cuts, cuts[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def _links(distinct: DataFrame, n: int, tile: int) -> DataFrame:
    """Edges between representatives (``fp``, ``rep``) that join the components within every bucket."""
    spark = distinct.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in scheme(n)]
    keys = distinct.select("rep", "fp", F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])).alias("k")).select("rep", "fp", "k.c", "k.key")

    def oversized(rows: DataFrame) -> tuple[DataFrame, int]:
        """Buckets of more than a tile with ``t``, the number of half tiles that they fill."""
        found = rows.groupBy("c", "key").agg(F.count("*").alias("n")).where(F.col("n") > tile)
        found = materialize(found.select("c", "key", F.ceil(F.col("n") / (tile // 2)).cast("int").alias("t")), "simhash-large")
        n = found.count()
        return (F.broadcast(found) if n <= BROADCAST_BUCKETS else found), n

    large, n_large = oversized(keys)
    if n_large:
        # the fingerprints of an oversized bucket agree on one of four parts of the bits that it leaves open
        parts_of = F.array(*[F.array(*[F.lit(x).cast("bigint") for x in open_parts(m)]) for m in masks])
        flagged = keys.join(large, ["c", "key"], "left")
        sub = F.transform(F.get(parts_of, F.col("c")), lambda m, i: F.xxhash64("key", i, F.col("fp").bitwiseAND(m)))
        keys = flagged.withColumn("split", F.col("t").isNotNull()).withColumn("key", F.explode(F.when(F.col("t").isNotNull(), sub).otherwise(F.array("key")))).drop("t")
        large, n_large = oversized(keys.where("split"))
        keys = keys.drop("split")
    if n_large:
        own = F.pmod(F.xxhash64("rep", "fp"), F.col("t")).cast("int")
        others = F.filter(F.sequence(F.lit(0), F.col("t") - 1), lambda j: j != F.col("own"))
        pairs = F.transform(others, lambda j: F.least(j, F.col("own")).cast("bigint") * (1 << 31) + F.greatest(j, F.col("own")))
        keys = keys.join(large, ["c", "key"], "left")
        keys = keys.withColumn("own", F.coalesce(own, F.lit(0))).withColumn("pair", F.explode(F.when(F.col("t").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(pairs)))
    else:
        keys = keys.withColumn("pair", F.lit(0).cast("bigint"))
    dealt = keys.select("c", "key", "pair", "fp", "rep").repartition(parts, "c", "key", "pair").sortWithinPartitions("c", "key", "pair", "fp")

    def edges(cols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Edges of complete groups; ``cols`` are c, key, pair, fp, rep."""
        new = np.ones(len(cols[0]), bool)
        new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])
        group = np.cumsum(new)
        size = np.bincount(group)[group]
        fps, reps = cols[3].view(np.uint64), cols[4]
        u, v = [], []
        some = np.flatnonzero((size > 1) & (size <= SMALL))
        if len(some):
            roots = some[_roots_small(fps[some], group[some])]
            u.append(reps[some])
            v.append(reps[roots])
        for g in np.unique(group[size > SMALL]):
            at = np.flatnonzero(group == g)
            u.append(reps[at])
            v.append(reps[at[_roots_dense(fps[at])]])
        if not u:
            return reps[:0], reps[:0]
        left, right = np.concatenate(u), np.concatenate(v)
        return left[left != right], right[left != right]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            last = [c[-1] for c in cols[:3]]
            open_from = len(cols[0]) - int(np.argmin(((cols[0] == last[0]) & (cols[1] == last[1]) & (cols[2] == last[2]))[::-1])) if not all((c == x).all() for c, x in zip(cols, last)) else 0
            if open_from == 0 and held and all(h[-1] == x for h, x in zip(held[-1][:3], last)):
                held.append(cols)  # the same group goes on
                continue
            done = [np.concatenate(c) for c in zip(*held, [c[:open_from] for c in cols])]
            held = [[c[open_from:] for c in cols]]
            if len(done[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in edges(done)], names=["u", "v"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in edges([np.concatenate(c) for c in zip(*held)])], names=["u", "v"])

    return dealt.mapInArrow(run, "u bigint, v bigint")


def _roots(distinct: DataFrame, tile: int) -> DataFrame:
    """``fp`` and ``root`` (the least fingerprint reachable over links) of distinct fingerprints."""
    roots = components(_links(distinct.select("fp", F.col("fp").alias("rep")), distinct.count(), tile))
    return distinct.select("fp").join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` (the smallest id reachable over links) of every row.

    Null and blank texts have fingerprint zero and are linked like any other. Equal fingerprints are
    one node, so copies cost nothing beyond their own row, and rows without an id link others too. A
    component has the least id of all its rows, or null if none has one. Repeated rows get equal
    results; rows of one id with unlike texts are apart. Texts of any length are read whole, in parts.
    An empty table gives an empty result. Ids must be 64-bit integers; other columns are not read.
    """
    found = fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).select("row.doc_id", "fp")
    found = materialize(found, "simhash-fingerprints")
    distinct = materialize(found.groupBy("fp").agg(F.min("doc_id").cast("bigint").alias("label")), "simhash-distinct")
    rooted = distinct.join(_roots(distinct, tile), "fp")
    least = rooted.groupBy("root").agg(F.min("label").alias("component_id"))
    of = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return found.join(of, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """One row of each component of near-duplicates, with all its columns: that with the least id (null: the last), then by the text's hash.

    Rows are told apart by their place, not by id: of rows with one id and unlike texts each stays,
    and copies without an id go like any other. Nulls, blank and long texts as in :func:`near_duplicates`;
    an empty table gives an empty one.
    """
    found = materialize(fingerprints(docs, text_col), "simhash-rows")
    place = F.struct(F.col(f"row.`{id_col}`").isNull().alias("none"), F.col(f"row.`{id_col}`").alias("id"), F.xxhash64(F.col(f"row.`{text_col}`")).alias("h"), "uid")
    distinct = materialize(found.groupBy("fp").agg(F.min(place).alias("first")), "simhash-distinct")
    kept = distinct.join(_roots(distinct, tile), "fp").groupBy("root").agg(F.min("first").alias("first")).select("first.uid")
    return found.join(kept, "uid", "left_semi").select("row.*")
