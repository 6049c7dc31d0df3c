"""Judge scores, samples, parameter sweeps and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from captionlake.config import ConfigError
from captionlake.functions.text import chunk_suffix


def judge_scores(results: DataFrame, metrics: list[str]) -> DataFrame:
    """Mean of each metric and of their total per label; a missing score is zero, failed judgements are left out."""
    zero = F.lit(0.0)
    score = lambda m: F.coalesce(F.col(m).cast("double"), zero)
    total = sum((score(m) for m in metrics[1:]), score(metrics[0]))
    rows = results.where("error IS NULL").groupBy("label")
    return rows.agg(F.count("*").alias("n"), *[F.avg(score(m)).alias(f"avg_{m}") for m in metrics], F.avg(total).alias("avg_total"))


def listed_findings(results: DataFrame, column: str, top: int = 10) -> DataFrame:
    """Per label how many findings there are and the first ones, by position (A19). Labels without any are left out; rows are cut before they are shuffled."""
    rows = results.select("label", "position", F.posexplode(column).alias("k", "finding"))
    nth = F.row_number().over(Window.partitionBy("label").orderBy("position", "k"))
    few = rows.withColumn("n", nth).where(F.col("n") <= top).groupBy("label").agg(F.array_sort(F.collect_list(F.struct("n", "finding"))).alias("f"))
    counted = rows.groupBy("label").agg(F.count("*").alias("n"))
    return counted.join(few, "label").select("label", "n", F.transform("f", lambda x: x["finding"]).alias("first"))


def best_and_worst(results: DataFrame, by: Column, key: str) -> DataFrame:
    """Per label the keys of the highest and the lowest value; ties go to the smallest key."""
    rows = results.withColumn("_v", by)
    best = F.min_by(key, F.struct((-F.col("_v")).alias("v"), F.col(key).alias("k")))
    return rows.groupBy("label").agg(best.alias("best"), F.max("_v").alias("best_value"), F.min_by(key, F.struct("_v", key)).alias("worst"), F.min("_v").alias("worst_value"))


def sample_rows(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, the same ones for a seed: those with the smallest keyed MD5."""
    return rows.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)


def sweep_grid(files: DataFrame, configs: DataFrame) -> DataFrame:
    """Every file with every configuration (J11); configurations are a handful, which is checked."""
    return files.crossJoin(F.broadcast(a_handful(configs)))


def a_handful(rows: DataFrame, most: int = 10_000) -> DataFrame:
    """Rows that a person configured, checked to be no more than ``most``."""
    if rows.limit(most + 1).count() > most:
        raise ConfigError(f"more than {most} configured rows")
    return rows


def resolve_configs(configs: list[dict], defaults: dict) -> list[dict]:
    """Each configuration's parameters over its base's over the defaults; models replace as a whole, and one with neither has the first's."""
    out: list[dict] = []
    for c in configs:
        base = c.get("base") or {}
        models = c.get("models") or base.get("models") or (out[0]["models"] if out else [])
        out.append({"label": c["label"], "models": list(models), "chunking": {**defaults, **base.get("chunking", {}), **c.get("chunking", {})}})
    return out


def sweep_diff(segments: DataFrame, baseline: str) -> DataFrame:
    """(label, file_id, chunk_id, change) against the baseline's kept and dropped segments (J12, U03); a failed baseline makes all new."""
    base = segments.where(F.col("label") == baseline).select("file_id", "chunk_id", F.col("dropped").alias("was_dropped"))
    labels = segments.where(F.col("label") != baseline).select("label", "file_id").distinct()
    old = labels.join(base, "file_id")
    new = segments.where(F.col("label") != baseline).select("label", "file_id", "chunk_id", "dropped")
    both = new.join(old, ["label", "file_id", "chunk_id"], "full_outer")
    change = (
        F.when(F.col("was_dropped").isNull() & ~F.col("dropped"), "new_kept")
        .when(F.col("was_dropped").isNull(), "new_dropped")
        .when(F.col("dropped").isNull(), "gone")
        .when(~F.col("was_dropped") & F.col("dropped"), "kept_to_dropped")
        .when(F.col("was_dropped") & ~F.col("dropped"), "dropped_to_kept")
        .otherwise("same")
    )
    return both.select("label", "file_id", "chunk_id", change.alias("change"))


def by_suffix(segments: DataFrame) -> DataFrame:
    """Segments in order of the number in their id."""
    return segments.orderBy("file_id", chunk_suffix(F.col("chunk_id")))


def by_start(segments: DataFrame) -> DataFrame:
    """Segments in order of start time as text, kept ones first."""
    return segments.orderBy("file_id", "start_time", "dropped", "chunk_id")


def pivot_table(rows: DataFrame, row: str, column: str, value: str, columns: list[str]) -> DataFrame:
    """``row`` by ``column`` with ``-`` where there is no value."""
    table = rows.groupBy(row).pivot(column, columns).agg(F.first(F.col(value).cast("string"), ignorenulls=True))
    return table.select(row, *[F.coalesce(F.col(f"`{c}`"), F.lit("-")).alias(c) for c in columns])


def metric_table(scores: DataFrame, metrics: list[str], labels: list[str]) -> DataFrame:
    """Mean scores (:func:`judge_scores`) as ``metric`` by label to two places, and the label that is best at each; ties go to the first by name."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"avg_{m}").alias("v")) for m in metrics]))
    rows = scores.select("label", pairs.alias("p")).select("label", "p.*")
    best = rows.groupBy("metric").agg(F.min_by("label", F.struct((-F.col("v")).alias("v"), "label")).alias("best"))
    return pivot_table(rows.withColumn("v", F.round("v", 2)), "metric", "label", "v", labels).join(best, "metric")


def distinct_values(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Per key the number of distinct values and the values in order (A21). Values are configured names: models, labels, sources."""
    return rows.where(F.col(value).isNotNull()).select(key, value).distinct().groupBy(key).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(value)).alias("values"))


def render(table: DataFrame) -> str:
    """A small result as an aligned text table."""
    rows = [table.columns, *[["-" if v is None else str(v) for v in r] for r in table.collect()]]
    widths = [max(len(r[i]) for r in rows) for i in range(len(rows[0]))]
    return "\n".join(" | ".join(v.ljust(w) for v, w in zip(r, widths)) for r in rows)
