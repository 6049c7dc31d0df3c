"""Quality rules with host verdicts, in DataFrame expressions only.

Each document is measured by itself. Failures are summed by host, the host's failure rate is shrunk
towards an empirical beta prior, and the verdict of each host is joined back to its documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captionlake.llm.common import ascii_words, let, materialize, spread


@dataclass(frozen=True)
class HostRules:
    """Thresholds. ``min_words`` and ``max_repeat_pct`` are the base rules; the others count for hosts only."""

    min_words: int = 50
    max_repeat_pct: int = 50
    max_symbols_per_word: float = 0.1
    max_dup_line_share: float = 0.3
    max_host_rate: float = 0.8
    #: bounds of the prior's strength in documents
    min_strength: float = 2.0
    max_strength: float = 1000.0


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the text."""

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - p, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def repeated(at: Column) -> Column:
        twice = F.filter(at, lambda e, k: (F.get(at, k + 1)["h"] == e["h"]) | (F.when(k > 0, F.get(at, k - 1)["h"]) == e["h"]))
        return let(F.sort_array(F.transform(twice, lambda e: e["p"])), covered)

    def by_hash(hashes: Column) -> Column:
        at = F.transform(hashes, lambda h, k: F.struct(h.alias("h"), k.alias("p")))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(F.sort_array(at), repeated)).otherwise(F.lit(0).cast("bigint"))

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) >= 3, let(hashes, by_hash)).otherwise(F.lit(0).cast("bigint"))


def document_measures(text: Column) -> Column:
    """A struct with n_words, word_chars, n_symbols, n_dup_lines, n_lines and n_repeat_words of a text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\f\r"))) > 0)
    long = lambda c: c.cast("bigint")
    return let(
        ascii_words(text),
        lambda words: F.struct(
            long(F.size(words)).alias("n_words"),
            long(F.length(F.array_join(words, ""))).alias("word_chars"),
            long(F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]+", ""))).alias("n_symbols"),
            long(let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))).alias("n_dup_lines"),
            long(F.size(lines)).alias("n_lines"),
            _repeat_words(words).alias("n_repeat_words"),
        ),
    )


def host_quality(docs: DataFrame, rules: HostRules = HostRules(), id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per document: id, the five measures, ``base_failed`` and ``kept``.

    A document fails for its host by a base rule, by too many symbols per word or by repeated lines.
    The host's rate is ``(failures + a) / (documents + a + b)``, with a and b from the mean and the
    variance of all hosts' rates; hosts above ``max_host_rate`` lose all their documents.

    Null text counts as empty (no words, so the base rules fail). A null host has no verdict: its
    documents are judged by the base rules alone. Repeated rows and ids, null ones too, give one row
    each. Very long texts are measured whole. An empty table gives an empty result. Other columns,
    whatever their names, are not read.
    """
    rows = spread(docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(text_col).alias("text")))
    measured = rows.select("doc_id", "host", document_measures(F.col("text")).alias("m")).select("doc_id", "host", "m.*")
    base_failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words"))
    failed = base_failed | (F.col("n_symbols") > rules.max_symbols_per_word * F.col("n_words")) | (F.col("n_dup_lines") > rules.max_dup_line_share * F.col("n_lines"))
    measured = measured.withColumn("base_failed", base_failed).withColumn("failed", failed).drop("n_lines")
    measured = materialize(measured, "host-measures")

    hosts = materialize(measured.where(F.col("host").isNotNull()).groupBy("host").agg(F.count("*").alias("n"), F.count_if("failed").alias("f")), "host-rates")
    rate = F.col("f") / F.col("n")
    mean, variance = hosts.agg(F.sum("f") / F.sum("n"), F.var_pop(rate)).first()
    mean = mean or 0.0
    strength = min(max(mean * (1 - mean) / variance - 1, rules.min_strength), rules.max_strength) if variance else rules.max_strength
    shrunk = (F.col("f") + mean * strength) / (F.col("n") + strength)
    verdicts = hosts.select("host", (shrunk > rules.max_host_rate).alias("host_failed"))

    joined = measured.join(verdicts, "host", "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce(F.col("host_failed"), F.lit(False))).alias("kept"),
    )
