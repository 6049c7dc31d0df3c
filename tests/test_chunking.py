"""Smart merge against an independent reading of its rules."""

from __future__ import annotations

import math

import numpy as np
import pytest

from captionlake.config import ChunkParams, ConfigError
from captionlake.functions.vectors import hash_embedding
from captionlake.operators import chunking

ENTRY = "file_id bigint, idx int, start_time string, end_time string, text string"


def entries_of(spark, sizes):
    rows = [(f, i, f"s{i}", f"e{i}", f"t{i}") for f, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, ENTRY)


def plain_merge(n, vectors, p):
    """Kept and dropped (start, end) spans of one file, or None for a failure."""
    w = p.window_size
    if n < w:
        return [(0, n)], []
    if sum(v is not None for v in vectors) < 5:
        return None
    sims = []
    for i in range(len(vectors) - w):
        a, b = vectors[i], vectors[i + w]
        cos = 1.0 if a is None or b is None else float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))) if np.any(a) and np.any(b) else 0.0
        sims.append((1 - cos, i + w))
    if not sims:
        return [(0, n)], []
    ranked = sorted(sims, key=lambda s: -s[0])
    low, high = max(1, int(len(sims) * p.low_pct)), max(1, int(len(sims) * p.high_pct))
    threshold = ranked[min(low, len(sims) - 1)][0]
    breaks = {0, n} | {pos for _, pos in ranked[:low]}
    for _, pos in reversed(ranked[low:high]):
        if pos - max(b for b in breaks if b <= pos) >= p.min_sentences and min(b for b in breaks if b > pos) - pos >= p.min_sentences:
            breaks.add(pos)
    at = {pos: round(s, 4) for s, pos in sims}
    kept, dropped = [], []
    order = sorted(breaks)
    for a, b in zip(order, order[1:]):
        weak = b - a == p.noise_weak_len and at.get(a, 0.0) >= threshold and at.get(b, 0.0) >= threshold
        (dropped if b - a <= p.noise_drop_len or weak else kept).append((a, b))
    return kept, dropped


@pytest.mark.parametrize("params", [ChunkParams(), ChunkParams(3, 4, 0.3, 0.05), ChunkParams(1, 2, 0.5, 0.2, 1, 2), ChunkParams(4, 3, 0.1, 0.3)])
def test_smart_merge(spark, params):
    rng = np.random.default_rng(7)
    sizes = {f: n for f, n in enumerate([*range(13), 30, 61, 90, 200])}
    vectors, rows = {}, []
    for f, n in sizes.items():
        own = []
        for i in range(max(n - params.window_size + 1, 0)):
            v = rng.standard_normal(4)
            own.append(None if f % 3 == 1 and i % 5 == 2 else v * (0 if f % 4 == 2 and i % 7 == 3 else 1))
            rows.append((f, i, None if own[-1] is None else own[-1].tolist()))
        vectors[f] = own
    entries, table = entries_of(spark, sizes), spark.createDataFrame(rows, "file_id bigint, i int, vector array<double>")
    got = chunking.smart_merge(entries, table, params).collect()
    failed = {r.file_id for r in chunking.chunking_failures(entries, table, params).collect()}
    for f, n in sizes.items():
        own = [r for r in got if r.file_id == f]
        want = plain_merge(n, vectors[f], params) if n else ([], [])
        if want is None:
            assert not own and f in failed
            continue
        assert sorted((r.start_idx, r.end_idx) for r in own if not r.dropped) == want[0]
        assert sorted((r.start_idx, r.end_idx) for r in own if r.dropped) == want[1]
        for r in own:
            assert r.text_content == " ".join(f"t{i}" for i in range(r.start_idx, r.end_idx)) and (r.start_time, r.end_time) == (f"s{r.start_idx}", f"e{r.end_idx - 1}")
            assert r.chunk_id == f"{f}_{r.start_idx}" and (r.drop_reason is not None) == r.dropped
            if r.boundary_type == "semantic":
                assert r.left_boundary.boundary_side == ("left" if r.start_idx == 0 else "auto") and r.right_boundary.boundary_side == ("right" if r.end_idx == n else "auto")


def test_size_branches(spark):
    """Default window five: one chunk up to four lines and at nine, none from five to eight."""
    sizes = dict.fromkeys(range(13)) and {n: n for n in range(13)}
    entries = entries_of(spark, sizes)
    vectors = chunking.embed_windows(chunking.sliding_windows(entries, 5), hash_embedding(8))
    kinds = {}
    for r in chunking.smart_merge(entries, vectors).collect():
        kinds.setdefault(r.file_id, set()).add(r.boundary_type)
    assert kinds == {**{n: {"single_chunk"} for n in (1, 2, 3, 4, 9)}, **{n: {"semantic"} for n in (10, 11, 12)}}


def test_two_lines(spark):
    entries = spark.createDataFrame([(1, 0, "a", "b", "hello"), (1, 1, "b", "c", "world")], ENTRY)
    none = spark.createDataFrame([], "file_id bigint, i int, vector array<float>")
    row = chunking.smart_merge(entries, none).collect()
    assert [(r.chunk_id, r.text_content, r.entry_count) for r in row] == [("1_0", "hello world", 2)]
    assert chunking.smart_merge(entries.limit(0), none).count() == 0


def test_parameters_are_checked():
    for bad in ({"window_size": 0}, {"window_size": 21}, {"high_pct": 1.5}, {"min_sentences": 0}, {"noise_drop_len": -1}):
        with pytest.raises(ConfigError):
            ChunkParams(**bad)
    assert ChunkParams().overlay({"window_size": 7, "other": 1}).window_size == 7


def test_size_statistics(spark):
    rows = [(1, n, False) for n in (3, 4, 8)] + [(1, 1, True), (2, 5, False)]
    got = chunking.chunk_size_stats(spark.createDataFrame(rows, "file_id bigint, entry_count int, dropped boolean")).orderBy("file_id").collect()
    assert tuple(got[0]) == (1, 3, 3, 8, 5.0, 4.0) and math.isclose(got[1].mean_size, 5)
