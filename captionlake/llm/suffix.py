"""Removal of long strings that occur in an earlier document, with a Burrows-Wheeler transform.

Every string of ``length`` bytes has a minimizer: of the 16-byte grams in it, the one with the least
hash. Equal strings have equal minimizers at equal places, so strings meet by gram. The strings of a
text with the same minimizer in a row make a piece of at most ``2 * length - 16`` bytes.

1. Texts are written once in units, a table bucketed by unit, which later steps read without a shuffle.
2. Grams meet in hash buckets as (gram, hash of the piece, document). A piece that an earlier document
   has as a whole is settled, and so is a gram of one document. What is left are the first documents
   of different pieces around one gram, where a copy begins, ends or was edited.
3. Their bytes meet by gram once more. Over each block of them, breadth-first backward extension on
   the Burrows-Wheeler transform derives common prefixes by increasing value and stops at ``length``:
   suffixes not parted by then begin with the same string, whose least document settles each. Around a
   gram with very many different pieces (a passage that a share of all documents has, each with its own
   text after it) strings meet one by one instead, by hash, after each unit has kept its least document
   of each; so no gram's pieces are one task's work.
4. Verdicts go back to the units, where covered bytes are removed.

Pieces are told apart by the 32 bits of the gram and 64 bits of the piece that no two share by chance in
a corpus of any size to come; strings around split grams by 128 bits.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captionlake.llm.common import materialize, shared_dir, spread
from captionlake.llm.textkit import mix

LENGTH = 50
GRAM = 16
UNIT_BYTES, UNIT_DOCS = 4 << 20, 1 << 16
#: Bytes hashed at a time; a longer text is taken in overlapping pieces of this size.
BLOCK = 1 << 17
#: Bytes of pieces that one transform takes; a gram's pieces are never parted.
TRANSFORM_BYTES = 1 << 18
#: Different pieces around a gram beyond which its strings meet one by one.
MOST_PIECES = 1024
#: Bytes of text for each bucket of grams at most; there are at least as many as shuffle partitions.
BUCKET_BYTES = 32 << 20
UNIQUE, SETTLED, OPEN, SPLIT = 0, 1, 2, 3
_SEPARATOR = 0xFF  # never in UTF-8
_NO_ID = np.iinfo(np.int64).max


# --- minimizers ----------------------------------------------------------------------------------


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    n = len(data) - GRAM + 1
    raw = np.ascontiguousarray(data)
    a, b = (np.ndarray((n,), "<u8", raw, at, (1,)) for at in (0, 8))
    h = a * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h += b
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


class Pieces:
    """Runs of strings with one minimizer in some texts: ``first`` and ``last`` starts (bytes), ``gram``, ``text``, ``start`` of the gram."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        self.data, self.length = data, length
        parts = [self._block(a, b, offsets) for a, b in self._blocks(offsets)]
        self.first, self.last, self.start, self.text, self.gram = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(5))

    def _blocks(self, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
        """Byte ranges: whole texts together, or overlapping parts of a long one."""
        i, n = 0, len(offsets) - 1
        while i < n:
            j = max(int(np.searchsorted(offsets, offsets[i] + BLOCK, "right")) - 1, i + 1)
            if offsets[j] - offsets[i] <= BLOCK:
                yield int(offsets[i]), int(offsets[j])
            else:
                step = BLOCK - self.length + 1
                for a in range(int(offsets[i]), int(offsets[j]) - self.length + 1, step):
                    yield a, min(a + BLOCK, int(offsets[j]))
            i = j

    def _block(self, a: int, b: int, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
        if b - a < self.length:
            return none
        hashes = _gram_hashes(self.data[a:b])
        place = np.arange(len(hashes), dtype=np.uint64)
        least = _sliding_min((hashes & ~np.uint64(BLOCK - 1)) | place, self.length - GRAM + 1)
        at = (least & np.uint64(BLOCK - 1)).astype(np.int64)
        i, j = int(np.searchsorted(offsets, a, "right")) - 1, int(np.searchsorted(offsets, b, "left"))
        sizes = np.minimum(offsets[i + 1 : j + 1], b) - np.maximum(offsets[i:j], a)
        # of each text, the starts of strings that end in it
        inside = np.repeat(np.tile([True, False], len(sizes)), np.stack([np.maximum(sizes - self.length + 1, 0), np.minimum(sizes, self.length - 1)], 1).ravel())
        starts = np.flatnonzero(inside[: len(at)])
        at = at[starts]
        text = np.repeat(np.arange(i, j), np.maximum(sizes - self.length + 1, 0))
        starts = starts + a
        if not len(starts):
            return none
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
        last = starts[np.append(new[1:], len(starts)) - 1]
        return starts[new], last, at[new] + a, text[new], hashes[at[new]]

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the pieces' bytes and of the gram's place in them."""
        size = self.last - self.first + self.length
        h = mix(size.astype(np.uint64) * np.uint64(128) + (self.start - self.first).astype(np.uint64))
        if not len(size):
            return h
        words = np.ndarray((len(self.data) - 7,), "<u8", np.ascontiguousarray(self.data), 0, (1,))
        for k in range(0, 2 * self.length - GRAM, 8):
            h = mix(h ^ words[self.first + np.minimum(k, size - 8)]) if k < self.length - 8 else np.where(k < size, mix(h ^ words[self.first + np.minimum(k, size - 8)]), h)
        return h


# --- the transform -------------------------------------------------------------------------------


def _rotations(text: np.ndarray) -> np.ndarray:
    """Places in the order of the 64 bytes that follow each, around the end."""
    n = len(text)
    around = np.concatenate([text, np.resize(text, 64)])
    keys = np.ndarray((n,), ">u8", around, 0, (1,)).astype(np.uint64)
    order = np.argsort(keys)
    for done in (8, 16, 32, 64):
        ranks = np.empty(n, np.uint64)
        ranks[order] = np.cumsum(np.concatenate([[False], keys[order][1:] != keys[order][:-1]]), dtype=np.uint64)
        if done == 64 or ranks[order[-1]] == n - 1:
            break
        keys = (ranks << np.uint64(32)) | np.roll(ranks, -done)
        order = np.argsort(keys)
    return order


def equal_prefixes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rotations of ``text`` in order, and whether each begins with other ``length`` bytes (at most 64) than the one before.

    Intervals of rotations with a common prefix are extended to the left byte by byte, all of one
    prefix length before the next; the first to end at a place gives the common prefix there.
    """
    n = len(text)
    order = _rotations(text)
    before = text[order - 1]
    by_byte = np.argsort(before, kind="stable")
    lf = np.empty(n, np.int32)
    lf[by_byte] = np.arange(n, dtype=np.int32)
    # the rows with the same byte before and after each row
    same = before[by_byte][1:] == before[by_byte][:-1]
    following, previous = np.full(n, n, np.int32), np.full(n, -1, np.int32)
    following[by_byte[:-1][same]] = by_byte[1:][same]
    previous[by_byte[1:][same]] = by_byte[:-1][same]
    parted = np.zeros(n + 1, bool)
    parted[0] = parted[n] = True
    lo, hi = np.array([0], np.int32), np.array([n], np.int32)
    for _ in range(length):
        size = hi - lo
        rows = np.repeat(lo - (np.cumsum(size, dtype=np.int32) - size), size) + np.arange(int(size.sum()), dtype=np.int32)
        begins = np.sort(lf[rows[previous[rows] < np.repeat(lo, size)]])
        ends = np.sort(lf[rows[following[rows] >= np.repeat(hi, size)]]) + 1
        fresh = ~parted[ends]
        lo, hi = begins[fresh], ends[fresh]
        parted[hi] = True
        if not len(lo):
            break
    return order, parted[:n]


def can_share(text: np.ndarray, begin: np.ndarray, size: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Whether a piece's gram, with half of what else a string takes on one side of it, is in another piece too.

    Every string around the gram (``at`` in the piece) has that on its left or on its right, so a piece
    without it shares no string. ``text`` holds all pieces and at least seven bytes more.
    """
    half = (length - GRAM) // 2
    words = np.ndarray((len(text) - 7,), "<u8", np.ascontiguousarray(text), 0, (1,))
    out = np.zeros(len(begin), bool)
    for first, last in ((begin + at - half, begin + at + GRAM), (begin + at, begin + at + GRAM + half)):
        whole = np.flatnonzero((first >= begin) & (last <= begin + size))
        h = np.zeros(len(whole), np.uint64)
        for k in range(0, GRAM + half, 8):
            h = mix(h ^ words[np.minimum(first[whole] + k, last[whole] - 8)])
        _, which, times = np.unique(h, return_inverse=True, return_counts=True)
        out[whole[times[which] > 1]] = True
    return out


def least_owners(pieces: list[bytes], owners: np.ndarray, length: int) -> list[np.ndarray]:
    """For every string of ``length`` bytes in every piece, the least owner of a piece that holds it."""
    sizes = np.array([len(p) for p in pieces])
    text = np.frombuffer(bytes([_SEPARATOR]).join(pieces) + bytes([_SEPARATOR]), np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    order, parted = equal_prefixes(text, length)
    piece = np.repeat(np.arange(len(sizes)), sizes + 1)[order]
    whole = order + length <= starts[piece] + sizes[piece]
    least = np.minimum.reduceat(np.where(whole, owners[piece], _NO_ID), np.flatnonzero(parted))
    out = np.empty(len(text), np.int64)
    out[order] = least[np.cumsum(parted) - 1]
    return [out[s : s + n - length + 1] for s, n in zip(starts.tolist(), sizes.tolist())]


# --- the distributed steps -----------------------------------------------------------------------


def _units(docs: DataFrame, buckets: int, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """A table bucketed by unit, and its name: ``unit``, ``bytes``, ``ids``, ``sizes`` (bytes of each text) and ``texts`` (all of them, compressed)."""
    spark = docs.sparkSession

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, ids, texts, size, n = 0, [], [], 0, 0

        def out() -> pa.RecordBatch:
            data = b"".join(texts)
            packed = pa.compress(data, codec="zstd", asbytes=True)
            lengths = np.fromiter(map(len, texts), "<u4", n).tobytes()
            keys = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.concat_arrays(ids))
            return pa.RecordBatch.from_arrays([pa.array([unit], pa.int64()), pa.array([len(data)], pa.int64()), keys, pa.array([lengths], pa.binary()), pa.array([packed], pa.binary())], names=["unit", "bytes", "ids", "sizes", "texts"])

        for rows in batches:
            for batch in (rows.slice(i, 256) for i in range(0, rows.num_rows, 256)):
                unit = unit if n else batch.column(2)[0].as_py()
                ids.append(batch.column(0))
                some = [t.as_py().encode() for t in batch.column(1)]
                texts += some
                size, n = size + sum(map(len, some)), n + len(some)
                if size >= UNIT_BYTES or n >= UNIT_DOCS - 256:
                    yield out()
                    ids, texts, size, n = [], [], 0, 0
        if n:
            yield out()

    rows = spread(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))).withColumn("row", F.monotonically_increasing_id())
    name = f"captionlake_units_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/captionlake/{name}"
    units = rows.mapInArrow(gather, "unit bigint, bytes bigint, ids array<bigint>, sizes binary, texts binary")
    units.write.bucketBy(buckets, "unit").sortBy("unit").option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name), name


def _open_unit(ids: pa.Scalar, sizes: pa.Scalar, texts: pa.Scalar, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Pieces]:
    """Document ids (the largest integer for null), bytes, offsets and pieces of a unit."""
    offsets = np.cumsum(np.concatenate([[0], np.frombuffer(sizes.as_py(), "<u4")]), dtype=np.int64)
    data = np.frombuffer(pa.decompress(texts.as_buffer(), int(offsets[-1]), codec="zstd", asbytes=True), np.uint8)
    keys = ids.values.fill_null(_NO_ID).to_numpy(zero_copy_only=False)
    return keys, data, offsets, Pieces(data, offsets, length)


def _split(keys: np.ndarray, buckets: int) -> list[np.ndarray]:
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    return np.split(np.argsort(bucket, kind="stable"), np.cumsum(np.bincount(bucket, minlength=buckets))[:-1])


def _verdicts(gram: np.ndarray, piece: np.ndarray, doc: np.ndarray, most: int) -> np.ndarray:
    """For each piece occurrence: its gram is in one document only, the piece is in an earlier one, or it is open (split where its gram has more than ``most`` pieces)."""
    out = np.zeros(len(gram), np.uint8)
    order = np.argsort(gram, kind="stable")
    g = gram[order]
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    size = np.diff(np.append(first, len(g)))
    order = order[np.repeat(size > 1, size)]
    if not len(order):
        return out
    order = order[np.lexsort((doc[order], piece[order], gram[order]))]
    g, p, d = gram[order], piece[order], doc[order]
    new_gram = np.concatenate([[True], g[1:] != g[:-1]])
    new_piece = new_gram | np.concatenate([[True], p[1:] != p[:-1]])
    grams, pieces = np.cumsum(new_gram) - 1, np.cumsum(new_piece) - 1
    at, at_piece = np.flatnonzero(new_gram), np.flatnonzero(new_piece)
    many_docs = np.minimum.reduceat(d, at) < np.maximum.reduceat(d, at)
    many_pieces = np.bincount(grams[at_piece])
    earlier = d[at_piece][pieces] < d
    still_open = np.where(many_pieces > most, SPLIT, OPEN)[grams]
    out[order] = np.where(earlier, SETTLED, np.where(many_docs[grams] & (many_pieces[grams] > 1), still_open, UNIQUE))
    return out


def _strings(data: np.ndarray, found: Pieces, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The strings of some pieces: where they start, their texts, and two 64-bit hashes of their bytes."""
    n = found.last[at] - found.first[at] + 1
    start = np.repeat(found.first[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    hashes = [np.full(len(start), seed, np.uint64) for seed in (0x243F6A8885A308D3, 0x13198A2E03707344)]
    if len(start):
        words = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), 0, (1,))
        for k in [*range(0, length - 8, 8), length - 8]:
            hashes = [mix(h ^ words[start + k]) for h in hashes]
    return start, np.repeat(found.text[at], n), *hashes


def _distinct(first: np.ndarray, second: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, the least ``doc`` of each, and which of them each row is."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(a) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    which = np.empty(len(a), np.int64)
    which[order] = np.cumsum(new) - 1
    return a[begin], b[begin], np.minimum.reduceat(doc[order], begin) if len(begin) else doc, which


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", most_pieces: int = MOST_PIECES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans`` (byte intervals) of every row.

    A byte is removed if a string of ``length`` (at least 24, at most 64) bytes over it also begins in
    a document with a smaller id. Null texts are empty. Rows with equal ids do not count against each
    other. A null id is larger than any; two of them are equal. An empty table gives an empty result.
    Texts of any length are taken whole, in overlapping parts. Other columns, whatever their names, are
    not read.
    """
    if not 24 <= length <= 64:
        raise ValueError("length must be 24 to 64")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    units, name = _units(docs, parts, id_col, text_col)
    n_buckets = max(parts, -(-(units.agg(F.sum("bytes")).first()[0] or 0) // bucket_bytes))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, ids, sizes, texts in zip(*(batch.column(c) for c in ("unit", "ids", "sizes", "texts"))):
                keys, _, _, found = _open_unit(ids, sizes, texts, length)
                piece, rows = found.hashes(), []
                for b, at in enumerate(_split(found.gram, n_buckets)):
                    if len(at):
                        some, doc = np.unique(found.text[at], return_inverse=True)
                        # within a bucket 32 bits of the gram do: strangers that meet are told apart by their pieces
                        rows.append((b, (found.gram[at] >> np.uint64(32)).astype("<u4").tobytes(), piece[at].tobytes(), doc.astype("<u2").tobytes(), keys[some].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([unit.as_py()] * len(rows), pa.int64()), *(pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 5))], names=["bucket", "unit", "gram", "piece", "doc", "ids"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            gram, piece = (np.concatenate([np.frombuffer(r[i], t) for r in held]) for i, t in ((2, "<u4"), (3, "<u8")))
            doc = np.concatenate([np.frombuffer(r[5], np.int64)[np.frombuffer(r[4], "<u2")] for r in held])
            codes = np.split(_verdicts(gram, piece, doc, most_pieces), np.cumsum([len(r[2]) // 4 for r in held])[:-1])
            return pa.RecordBatch.from_arrays([pa.array([r[1] for r in held], pa.int64()), pa.array([r[0] for r in held], pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary())], names=["unit", "bucket", "codes"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if held and row[0] != held[0][0]:
                    yield out()
                    held = []
                held.append(row)
        if held:
            yield out()

    asked = units.mapInArrow(grams, "bucket int, unit bigint, gram binary, piece binary, doc binary, ids binary")
    settled = asked.repartitionById(n_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(settle, "unit bigint, bucket int, codes binary")
    verdicts = materialize(settled, "repeats-verdicts").groupBy("unit").agg(F.collect_list(F.struct("bucket", "codes")).alias("codes"))

    def codes_of(found: Pieces, told: pa.Scalar) -> np.ndarray:
        codes, places = np.zeros(len(found.gram), np.uint8), _split(found.gram, n_buckets)
        for row in told.as_py() or []:
            codes[places[row["bucket"]]] = np.frombuffer(row["codes"], np.uint8)
        return codes

    def open_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, ids, sizes, texts, told in zip(*(batch.column(c) for c in ("unit", "ids", "sizes", "texts", "codes"))):
                keys, data, _, found = _open_unit(ids, sizes, texts, length)
                codes = codes_of(found, told)
                at = np.flatnonzero(codes == OPEN)
                rows = []
                for b, of in enumerate(_split(found.gram[at], n_buckets)):
                    if len(of):
                        some = at[of]
                        size = found.last[some] - found.first[some] + length
                        text = data[np.repeat(found.first[some] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
                        rows.append((b, (found.gram[some] >> np.uint64(32)).astype("<u4").tobytes(), some.astype("<u4").tobytes(), keys[found.text[some]].tobytes(), size.astype(np.uint8).tobytes(), (found.start - found.first)[some].astype(np.uint8).tobytes(), text.tobytes()))
                split = np.flatnonzero(codes == SPLIT)
                if len(split):
                    _, text, first, second = _strings(data, found, split, length)
                    first, second, least, _ = _distinct(first, second, keys[text])
                    rows += [(n_buckets + b, first[of].tobytes(), second[of].tobytes(), least[of].tobytes(), None, None, None) for b, of in enumerate(_split(first, n_buckets)) if len(of)]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([unit.as_py()] * len(rows), pa.int64()), *(pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 7))], names=["bucket", "unit", "gram", "place", "doc", "size", "at", "text"])

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def string_owners() -> pa.RecordBatch:
            """Of a bucket of strings: the least document of each, for each unit that asked."""
            first, second, doc = (np.concatenate([np.frombuffer(r[i], t) for r in held]) for i, t in ((2, np.uint64), (3, np.uint64), (4, np.int64)))
            _, _, least, which = _distinct(first, second, doc)
            told = np.split(least[which], np.cumsum([len(r[2]) // 8 for r in held])[:-1])
            return pa.RecordBatch.from_arrays([pa.array([r[1] for r in held], pa.int64()), pa.array([r[0] for r in held], pa.int32()), pa.array([None] * len(held), pa.binary()), pa.array([x.tobytes() for x in told], pa.binary())], names=["unit", "bucket", "place", "mask"])

        def out() -> Iterator[pa.RecordBatch]:
            if held[0][0] >= n_buckets:
                yield string_owners()
                return
            unit = np.concatenate([np.full(len(r[2]) // 4, r[1]) for r in held])
            gram, place, doc, size, at = (np.concatenate([np.frombuffer(r[i], t) for r in held]).astype(t if i == 2 else np.int64) for i, t in ((2, "<u4"), (3, "<u4"), (4, np.int64), (5, np.uint8), (6, np.uint8)))
            text = np.frombuffer(b"".join([*(r[7] for r in held), bytes(8)]), np.uint8)
            begin = np.cumsum(size) - size
            order = np.flatnonzero(can_share(text, begin, size, at, length))
            if not len(order):
                return
            order = order[np.argsort(gram[order], kind="stable")]
            # cuts between grams, about every TRANSFORM_BYTES
            filled = np.cumsum(size[order] + 1) // TRANSFORM_BYTES
            ends_gram = np.append(gram[order][1:] != gram[order][:-1], True)
            group = np.cumsum(np.append(False, ends_gram[:-1]))
            block = np.minimum.reduceat(filled, np.flatnonzero(np.append(True, ends_gram[:-1])))[group]
            masks = np.zeros(len(gram), np.uint64)
            for some in np.split(order, np.flatnonzero(np.diff(block)) + 1):
                least = least_owners([text[begin[i] : begin[i] + size[i]].tobytes() for i in some.tolist()], doc[some], length)
                for i, owners in zip(some.tolist(), least):
                    hit = np.flatnonzero(owners < doc[i])
                    if len(hit):
                        masks[i] = np.bitwise_or.reduce(np.uint64(1) << hit.astype(np.uint64))
            some = np.flatnonzero(masks)
            some = some[np.argsort(unit[some], kind="stable")]
            for of in np.split(some, np.flatnonzero(np.diff(unit[some])) + 1) if len(some) else []:
                yield pa.RecordBatch.from_arrays([pa.array([int(unit[of[0]])], pa.int64()), pa.array([held[0][0]], pa.int32()), pa.array([place[of].astype("<u4").tobytes()], pa.binary()), pa.array([masks[of].tobytes()], pa.binary())], names=["unit", "bucket", "place", "mask"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(8))):
                if held and row[0] != held[0][0]:
                    yield from out()
                    held = []
                held.append(row)
        if held:
            yield from out()

    opened = units.join(verdicts, "unit", "left").select("unit", "ids", "sizes", "texts", "codes").mapInArrow(open_pieces, "bucket int, unit bigint, gram binary, place binary, doc binary, size binary, at binary, text binary")
    found = opened.repartitionById(n_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(transform, "unit bigint, bucket int, place binary, mask binary")
    masks = materialize(found, "repeats-masks").groupBy("unit").agg(F.collect_list(F.struct("bucket", "place", "mask")).alias("masks"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for ids, sizes, texts, told, marked in zip(*(batch.column(c) for c in ("ids", "sizes", "texts", "codes", "masks"))):
                keys, data, offsets, found = _open_unit(ids, sizes, texts, length)
                edges = np.zeros(len(data) + 1, np.int32)

                def cover(first: np.ndarray, last: np.ndarray, edges: np.ndarray = edges) -> None:
                    np.add.at(edges, first, 1)
                    np.add.at(edges, last + length, -1)

                codes, marked = codes_of(found, told), marked.as_py() or []
                settled = codes == SETTLED
                cover(found.first[settled], found.last[settled])
                split = np.flatnonzero(codes == SPLIT)
                if len(split):
                    start, text, first, second = _strings(data, found, split, length)
                    first, _, least, which = _distinct(first, second, keys[text])
                    places = _split(first, n_buckets)
                    for row in marked:
                        if row["bucket"] >= n_buckets:
                            least[places[row["bucket"] - n_buckets]] = np.frombuffer(row["mask"], np.int64)
                    at = start[least[which] < keys[text]]
                    cover(at, at)
                for row in marked:
                    if row["bucket"] >= n_buckets:
                        continue
                    place, mask = np.frombuffer(row["place"], "<u4"), np.frombuffer(row["mask"], "<u8")
                    for k in range(length - GRAM + 1):
                        at = found.first[place[(mask >> np.uint64(k)) & np.uint64(1) > 0]] + k
                        cover(at, at)
                gone = np.cumsum(edges[:-1], dtype=np.int32) > 0
                out = []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    own = gone[a:b]
                    n = int(np.count_nonzero(own))
                    turns = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]]))).tolist() if n else []
                    kept = data[a:b][~own] if n else data[a:b]
                    out.append((b - a, n, len(turns) // 2, hashlib.sha256(kept.tobytes()).hexdigest(), [{"start": s, "end": e} for s, e in zip(turns[0::2], turns[1::2])]))
                yield pa.RecordBatch.from_arrays([ids.values, *(pa.array([r[i] for r in out], t) for i, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.int64()), (3, pa.string()), (4, spans_type)))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    told = units.join(verdicts, "unit", "left").join(masks, "unit", "left").select("ids", "sizes", "texts", "codes", "masks")
    out = told.mapInArrow(remove, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>")
    # the catalog forgets the table; its files, which the result is read from, stay in the shared folder
    spark.sql(f"DROP TABLE {name}")
    return out
