"""Smart merge: ranked similarity breaks cut a file's entries into segments.

Everything is partitioned by file. The greedy admission of candidates is a fold over one short array
per file (at most ``high_pct`` of its windows), so the whole operator stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from captionlake.config import ChunkParams
from captionlake.functions.text import chunk_id
from captionlake.functions.vectors import cosine, strength

#: Labels of a file's ends, and reasons for dropping a segment.
FILE_START, FILE_END = "檔案起點", "檔案終點"
TOO_SHORT = "noise_too_short (<= {} lines)"
WEAK_LINKS = "noise_weak_links (both ends below strong threshold)"


def joined_text(idx: Column, text: Column, separator: str = " ") -> Column:
    """Aggregate: texts in order of ``idx``."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(idx.alias("i"), text.alias("t")))), lambda x: x["t"]), separator)


def sliding_windows(entries: DataFrame, width: int) -> DataFrame:
    """(file_id, i, text): every complete window of ``width`` entries joined by spaces."""
    frame = Window.partitionBy("file_id").orderBy("idx").rowsBetween(Window.currentRow, width - 1)
    rows = entries.withColumn("w", F.collect_list("text").over(frame)).where(F.size("w") == width)
    return rows.select("file_id", F.col("idx").alias("i"), F.array_join("w", " ").alias("text"))


def window_similarity(vectors: DataFrame, width: int) -> DataFrame:
    """Pairs of windows ``width`` apart in (file_id, i, vector): ``pos`` of the break between them, similarity and strength."""
    order = Window.partitionBy("file_id").orderBy("i")
    ahead = vectors.withColumn("next", F.lead("vector", width).over(order)).withColumn("has_next", F.lead("i", width).over(order).isNotNull())
    similarity = F.coalesce(cosine(F.col("vector"), F.col("next")), F.lit(1.0))
    return ahead.where("has_next").select("file_id", "i", (F.col("i") + width).alias("pos"), similarity.alias("similarity"), strength(similarity).alias("strength"))


def rank_breaks(pairs: DataFrame, params: ChunkParams, ndigits: int | None = None) -> DataFrame:
    """Adds rank, cuts, band (absolute, candidate, none), the strong threshold and the labels (W03-W06). ``ndigits``: rank on rounded strengths."""
    s = F.round("strength", ndigits) if ndigits is not None else F.col("strength")
    by_strength = Window.partitionBy("file_id").orderBy(s.desc(), "i")
    whole = Window.partitionBy("file_id")
    ranked = pairs.withColumn("rank", F.row_number().over(by_strength)).withColumn("n_pairs", F.count("*").over(whole))
    cut = lambda pct: F.greatest(F.lit(1), F.floor(F.col("n_pairs") * F.lit(pct)))
    ranked = ranked.withColumn("low_cut", cut(params.low_pct)).withColumn("high_cut", cut(params.high_pct))
    band = F.when(F.col("rank") <= F.col("low_cut"), "absolute").when(F.col("rank") <= F.col("high_cut"), "candidate").otherwise("none")
    after = F.when(F.col("rank") == F.least("low_cut", F.col("n_pairs") - 1) + 1, F.col("strength"))
    return ranked.select("*", band.alias("band"), F.max(after).over(whole).alias("threshold"), F.bround(F.col("rank") / F.col("n_pairs") * 100, 1).alias("strength_pct"))


def _folded(ranked: DataFrame, sizes: DataFrame, params: ChunkParams) -> DataFrame:
    """(file_id, n, breaks, pairs, threshold): breaks in order, and by position the ranked pairs that may be breaks, of which a file has few."""
    pair = F.struct("strength_pct", F.bround("similarity", 4).alias("cosine"), F.bround("strength", 4).alias("strength"))
    chosen = F.col("band") != "none"
    picked = ranked.groupBy("file_id").agg(
        F.collect_list(F.when(F.col("band") == "absolute", F.col("pos"))).alias("absolute"),
        F.array_sort(F.collect_list(F.when(F.col("band") == "candidate", F.struct((-F.col("rank")).alias("r"), F.col("pos").alias("p"))))).alias("pending"),
        F.map_from_entries(F.collect_list(F.when(chosen, F.struct("pos", pair)))).alias("pairs"), F.max("threshold").alias("threshold"),
    )

    def admit(breaks: Column, c: Column) -> Column:
        left = F.array_max(F.filter(breaks, lambda x: x <= c["p"]))
        right = F.array_min(F.filter(breaks, lambda x: x > c["p"]))
        far = (c["p"] - left >= params.min_sentences) & (right - c["p"] >= params.min_sentences)
        return F.when(far, F.array_append(breaks, c["p"])).otherwise(breaks)

    joined = picked.join(sizes, "file_id").withColumn("n", F.col("n").cast("int"))
    first = F.array_union(F.array(F.lit(0), F.col("n")), F.col("absolute").cast("array<int>"))
    breaks = F.array_sort(F.aggregate("pending", first, lambda b, c: admit(b, c.withField("p", c["p"].cast("int")))))
    return joined.select("file_id", "n", breaks.alias("breaks"), "pairs", "threshold")


def choose_breaks(ranked: DataFrame, sizes: DataFrame, params: ChunkParams) -> DataFrame:
    """(file_id, n, breaks): 0, n, all absolute breaks, and candidates from the weakest up that keep their distance."""
    return _folded(ranked, sizes, params).select("file_id", "n", "breaks")


def _boundary(pos: Column, n: Column, pair: Column) -> Column:
    """Boundary struct of a break from its ranked pair."""
    label = F.when(pos == 0, FILE_START).when(pos == n, FILE_END).otherwise(F.coalesce(F.concat(pair["strength_pct"].cast("string"), F.lit("%")), F.lit("-")))
    which = F.when(pos == 0, "left").when(pos == n, "right").otherwise("auto")
    return F.struct(which.alias("boundary_side"), pair["strength_pct"].alias("strength_pct"), pair["cosine"].alias("cosine"), pair["strength"].alias("strength"), label.alias("label"))


def cut_segments(ranked: DataFrame, sizes: DataFrame, params: ChunkParams) -> DataFrame:
    """(file_id, n, start_idx, end_idx exclusive) between consecutive breaks, with both ends' boundary structs and the file's strong threshold.

    All of a file is in its one folded row, so the ranked pairs are computed once and joined with nothing.
    """
    files = _folded(ranked, sizes, params)
    ends = F.transform(F.slice("breaks", 1, F.size("breaks") - 1), lambda x, i: F.struct(x.alias("a"), F.get("breaks", i + 1).alias("b")))
    rows = files.select("file_id", "n", "threshold", "pairs", F.explode(ends).alias("s")).select("file_id", "n", "threshold", F.col("s.a").alias("start_idx"), F.col("s.b").alias("end_idx"), F.try_element_at("pairs", F.col("s.a")).alias("l"), F.try_element_at("pairs", F.col("s.b")).alias("r"))
    return rows.select(
        "file_id", "n", "start_idx", "end_idx", (F.col("end_idx") - F.col("start_idx")).alias("entry_count"), "threshold",
        _boundary(F.col("start_idx"), F.col("n"), F.col("l")).alias("left_boundary"), _boundary(F.col("end_idx"), F.col("n"), F.col("r")).alias("right_boundary"),
    )


def noise_filter(segments: DataFrame, params: ChunkParams) -> DataFrame:
    """Adds ``dropped`` and ``drop_reason`` (P02-P04). A file's ends count as strength 0."""
    weak = lambda side: F.coalesce(F.col(f"{side}_boundary.strength"), F.lit(0.0)) >= F.col("threshold")
    reason = F.when(F.col("entry_count") <= params.noise_drop_len, TOO_SHORT.format(params.noise_drop_len)).when(
        (F.col("entry_count") == params.noise_weak_len) & weak("left") & weak("right"), WEAK_LINKS
    )
    return segments.withColumn("drop_reason", reason).withColumn("dropped", reason.isNotNull())


def smart_merge(entries: DataFrame, vectors: DataFrame, params: ChunkParams = ChunkParams()) -> DataFrame:
    """Chunks of all files from entries (file_id, idx, start_time, end_time, text) and window vectors (file_id, i, vector; null: failed).

    Files with fewer entries than a window, or with too few for one pair of windows, are a single
    chunk. Files with at least a window but fewer than five vectors give no chunk; see
    :func:`chunking_failures`. Empty files give none.
    """
    w = params.window_size
    sizes = entries.groupBy("file_id").agg(F.count("*").cast("int").alias("n"))
    valid = vectors.groupBy("file_id").agg(F.count("vector").alias("valid"))
    ranked = rank_breaks(window_similarity(vectors, w), params)
    kinds = sizes.join(valid, "file_id", "left").withColumn("valid", F.coalesce("valid", F.lit(0)))
    pairs = F.greatest(F.lit(0), F.col("n") - 2 * w + 1)
    kinds = kinds.withColumn("kind", F.when(F.col("n") < w, "single").when(F.col("valid") < 5, "failed").when(pairs == 0, "single").otherwise("semantic"))
    semantic = kinds.where("kind = 'semantic'").select("file_id", "n")
    cut = noise_filter(cut_segments(ranked, semantic, params), params)
    single = kinds.where("kind = 'single'").select("file_id", F.lit(0).alias("start_idx"), F.col("n").alias("end_idx"))
    spans = cut.withColumn("boundary_type", F.lit("semantic")).unionByName(single.withColumn("boundary_type", F.lit("single_chunk")), allowMissingColumns=True)
    # entries find their segment by a running count of starts: equal keys, no range join
    starts = spans.select("file_id", F.col("start_idx").alias("idx"), F.lit(1).alias("is_start"))
    marked = entries.join(starts, ["file_id", "idx"], "left").join(kinds.where("kind <> 'failed'").select("file_id"), "file_id", "left_semi")
    number = F.sum(F.coalesce("is_start", F.lit(0))).over(Window.partitionBy("file_id").orderBy("idx"))
    texts = marked.withColumn("seg", number).groupBy("file_id", "seg").agg(
        F.min("idx").alias("start_idx"), F.min_by("start_time", "idx").alias("start_time"), F.max_by("end_time", "idx").alias("end_time"), joined_text(F.col("idx"), F.col("text")).alias("text_content")
    )
    out = spans.join(texts.drop("seg"), ["file_id", "start_idx"])
    return out.select(
        chunk_id(F.col("file_id"), F.col("start_idx")).alias("chunk_id"), "file_id", "start_idx", "end_idx", "start_time", "end_time",
        (F.col("end_idx") - F.col("start_idx")).alias("entry_count"), "text_content", "boundary_type", "left_boundary", "right_boundary",
        F.coalesce("dropped", F.lit(False)).alias("dropped"), "drop_reason",
    )


def chunking_failures(entries: DataFrame, vectors: DataFrame, params: ChunkParams = ChunkParams()) -> DataFrame:
    """Files that give no chunk though they have a window, with the reason."""
    sizes = entries.groupBy("file_id").agg(F.count("*").alias("n"))
    valid = vectors.groupBy("file_id").agg(F.count("vector").alias("valid"), F.count_if(F.col("vector").isNull()).alias("failed_windows"))
    rows = sizes.join(valid, "file_id", "left").where((F.col("n") >= params.window_size) & (F.coalesce("valid", F.lit(0)) < 5))
    return rows.withColumn("reason", F.when(F.col("failed_windows") > 0, "failed windows").otherwise("fewer than five windows"))


def zero_chunk_reasons(entries: DataFrame, vectors: DataFrame, segments: DataFrame) -> DataFrame:
    """(file_id, reasons) of files without a kept segment: failed windows, all segments dropped, or neither."""
    files = entries.select("file_id").distinct()
    failed = vectors.groupBy("file_id").agg(F.count_if(F.col("vector").isNull()).alias("failed"))
    cut = segments.groupBy("file_id").agg(F.count_if(~F.col("dropped")).alias("kept"), F.count_if("dropped").alias("discarded"))
    rows = files.join(failed, "file_id", "left").join(cut, "file_id", "left").fillna(0, ["failed", "kept", "discarded"]).where("kept = 0")
    some = F.array_compact(F.array(
        F.when(F.col("failed") > 0, F.concat(F.col("failed").cast("string"), F.lit(" windows without a vector"))),
        F.when(F.col("discarded") > 0, F.concat(F.lit("all "), F.col("discarded").cast("string"), F.lit(" segments dropped as noise"))),
    ))
    return rows.select("file_id", F.when(F.size(some) > 0, some).otherwise(F.array(F.lit("no segment: see the subtitles and the parameters"))).alias("reasons"))


def failed_windows(vectors: DataFrame) -> DataFrame:
    """Every window without a vector."""
    return vectors.where("vector IS NULL").select("file_id", "i")


def chunk_size_stats(chunks: DataFrame) -> DataFrame:
    """Per file: count, minimum, maximum, mean and median of kept chunks' entry counts."""
    kept = chunks.where("NOT dropped").groupBy("file_id")
    return kept.agg(
        F.count("*").alias("n_chunks"), F.min("entry_count").alias("min_size"), F.max("entry_count").alias("max_size"),
        F.bround(F.avg("entry_count"), 2).alias("mean_size"), F.bround(F.median("entry_count"), 2).alias("median_size"),
    )


def embed_windows(windows: DataFrame, embed) -> DataFrame:
    """(file_id, i, vector) by a caller's pandas UDF over the text (X01); its nulls are failed windows."""
    return windows.select("file_id", "i", embed("text").alias("vector"))
