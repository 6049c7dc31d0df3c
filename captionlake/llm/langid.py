"""Language identification with a string kernel.

The kernel of two texts is the number of character n-grams (n = 1 to 3, the blended spectrum) that
both contain, each counted once, over the geometric mean of their numbers of distinct n-grams. A
bounded sample of labelled texts gives Nystroem landmarks and, by kernel ridge regression, one
regressor per language against the rest. Texts are scored in batches: presence matrix times
landmark matrix gives kernel values, these times the coefficients give scores. The scores of a
text always sum up to the same, so they cannot tell that it is in no known language; its greatest
kernel value can.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from captionlake.llm.common import spread

#: Hashed n-grams: so many columns. A text has a few thousand distinct n-grams, all scripts together.
SPACE = 1 << 19
#: Code points handled at a time; n-grams across the cut are kept by an overlap of two.
BLOCK = 1 << 20
UNDETERMINED = "und"
#: Odd multipliers of a symbol by its place in an n-gram, and of the whole.
_FIRST, _SECOND, _THIRD, _WHOLE = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F))
_SHIFT = np.uint32(32 - 19)


@lru_cache(maxsize=1)
def symbol_table() -> tuple[np.ndarray, np.ndarray]:
    """The symbol of every code point (case folded; letters and marks, 0 for all else), and whether it is a letter."""
    table, letters = np.zeros(0x110000, np.uint32), np.zeros(0x110000, bool)
    for cp in range(0x110000):
        c = chr(cp)
        letters[cp] = c.isalpha()
        if letters[cp] or unicodedata.category(c)[0] == "M":
            table[cp] = ord(c.lower()[0])
    return table, letters


class GramReader:
    """Distinct n-gram codes of whole texts. Codes are hashes of the n-grams' symbols."""

    def __init__(self):
        (self.table, self.letters), self.flags = symbol_table(), np.zeros(SPACE, bool)

    def __call__(self, text: str | None) -> np.ndarray | None:
        """Sorted codes; None for a null text or one with no letter."""
        if not text:
            return None
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        flags, letters = self.flags, False
        for at in range(0, len(points), BLOCK):
            own = points[max(at - 2, 0) : at + BLOCK]
            s = self.table[own]
            letters = letters or bool(self.letters[own].any())
            keep = s != 0
            keep[1:] |= keep[:-1]  # of a run of other characters, the first after a letter stays
            s = s[keep]
            if not len(s):
                continue
            first = s * _FIRST
            flags[(first * _WHOLE) >> _SHIFT] = True
            two = first[:-1] ^ (s[1:] * _SECOND + _THIRD)
            flags[(two * _WHOLE) >> _SHIFT] = True
            flags[((two[:-1] ^ (s[2:] * _THIRD + _SECOND)) * _WHOLE) >> _SHIFT] = True
        codes = np.flatnonzero(flags).astype(np.int32)
        flags[codes] = False
        return codes if letters else None


@dataclass
class LanguageModel:
    languages: list[str]
    #: column of each n-gram in the presence matrix, -1 if no landmark has it
    columns: np.ndarray
    landmarks: np.ndarray
    sizes: np.ndarray
    coefficients: np.ndarray
    intercept: np.ndarray
    #: by the logarithm of a text's number of distinct n-grams, the least similarity to a landmark at which it is accepted
    floors: np.ndarray | None = None

    def accepts(self, grams: list[np.ndarray], similarity: np.ndarray) -> np.ndarray:
        """Whether texts are as like their nearest landmark as texts of known languages of their size are."""
        if self.floors is None:
            return np.ones(len(grams), bool)
        return similarity >= self.floors[_size_class(grams)]

    def kernel(self, grams: list[np.ndarray]) -> np.ndarray:
        present = np.zeros((len(grams), self.landmarks.shape[1]), np.float32)
        for row, codes in zip(present, grams):
            at = self.columns[codes]
            row[at[at >= 0]] = 1
        sizes = np.array([max(len(c), 1) for c in grams], np.float32)
        return (present @ self.landmarks.T) / np.sqrt(sizes[:, None] * self.sizes[None, :])

    def scores(self, grams: list[np.ndarray]) -> np.ndarray:
        return self.kernel(grams) @ self.coefficients + self.intercept


def _size_class(grams: list[np.ndarray]) -> np.ndarray:
    return np.array([len(g).bit_length() for g in grams], np.int64)


@dataclass(frozen=True)
class LanguageFit:
    """Bounds of the fit: labelled texts for each language and in all (as many again set the floors), n-grams of one, landmarks, the ridge penalty.

    A text is accepted from ``margin`` of the least similarity that labelled texts of its size class have
    which were not fitted on. Classes with fewer than ``least_texts`` of them have ``step`` times the floor
    of the class above.
    """

    per_language: int = 250
    max_texts: int = 2000
    max_grams: int = 20_000
    landmarks: int = 64
    ridge: float = 1e-2
    margin: float = 0.7
    least_texts: int = 5
    step: float = 0.75


def fit_model(texts: list[tuple[str, np.ndarray]], fit: LanguageFit) -> LanguageModel | None:
    """A model from (language, n-gram codes) pairs; None if there are none."""
    if not texts:
        return None
    languages = sorted({lang for lang, _ in texts})
    each = max(1, fit.landmarks // len(languages))
    chosen = [codes for lang in languages for codes in [c for k, c in texts if k == lang][:each]]
    vocabulary = np.unique(np.concatenate(chosen))
    columns = np.full(SPACE, -1, np.int32)
    columns[vocabulary] = np.arange(len(vocabulary))
    marks = np.zeros((len(chosen), len(vocabulary)), np.float32)
    for row, codes in zip(marks, chosen):
        row[columns[codes]] = 1
    model = LanguageModel(languages, columns, marks, np.array([len(c) for c in chosen], np.float32), np.zeros(0), np.zeros(0))
    grams = [codes for _, codes in texts]
    k = np.concatenate([model.kernel(grams[i : i + 256]) for i in range(0, len(grams), 256)]).astype(np.float64)
    w = model.kernel(chosen).astype(np.float64)
    values, vectors = np.linalg.eigh((w + w.T) / 2)
    root = vectors / np.sqrt(np.maximum(values, 1e-6))  # Nystroem features are k @ root
    phi = k @ root
    y = np.where(np.array([lang for lang, _ in texts])[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    mean_phi, mean_y = phi.mean(0), y.mean(0)
    a = (phi - mean_phi).T @ (phi - mean_phi) + fit.ridge * np.eye(phi.shape[1])
    beta = np.linalg.solve(a, (phi - mean_phi).T @ (y - mean_y))
    model.coefficients, model.intercept = (root @ beta).astype(np.float32), (mean_y - mean_phi @ beta).astype(np.float32)
    return model


def set_floors(model: LanguageModel, grams: list[np.ndarray], fit: LanguageFit) -> None:
    """Floors of similarity from texts of known languages that the model was not fitted on; without any, none."""
    if not grams:
        return
    similar = np.concatenate([model.kernel(grams[i : i + 256]).max(1) for i in range(0, len(grams), 256)])
    classes, floors = _size_class(grams), np.full(SPACE.bit_length() + 1, np.nan)
    for c in np.unique(classes):
        if np.count_nonzero(classes == c) >= fit.least_texts:
            floors[c] = fit.margin * similar[classes == c].min()
    if np.isnan(floors).all():
        floors[classes.max()] = fit.margin * similar.min()
    top = int(np.flatnonzero(~np.isnan(floors))[-1])
    floors[top:] = floors[top]
    for c in range(top - 1, -1, -1):
        if np.isnan(floors[c]):
            floors[c] = floors[c + 1] * fit.step
    model.floors = floors


def learn(labelled: DataFrame, fit: LanguageFit = LanguageFit(), text_col: str = "text", lang_col: str = "lang") -> LanguageModel | None:
    """Fit on a bounded sample of the distinct texts with a language: those with the smallest hashes of each language.

    Rows with a null or no letter, and texts beyond the bound of n-grams, are not learned from. None if nothing is left.
    """
    rows = spread(labelled.select(text_col, lang_col)).where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not counts:
        return None
    each = max(1, min(fit.per_language, fit.max_texts // len(counts)))
    # hashes are even, so a threshold keeps somewhat more than is wanted; copies are one; then the smallest are taken
    wanted = 2 * each
    limits = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, int((min(1.0, (2 * wanted + 30) / n) - 0.5) * 2**64) if n > 2 * wanted + 30 else 2**63 - 1)])
    few = rows.where(F.col("h") <= F.element_at(limits, F.col("lang"))).groupBy("lang", "h").agg(F.min("text").alias("text"))
    few = few.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("k") <= wanted)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = GramReader()
        for batch in batches:
            codes = [reader(t.as_py()) for t in batch.column("text")]
            codes = [None if c is None or len(c) > fit.max_grams else c.tobytes() for c in codes]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("k").cast(pa.int64()), pa.array(codes, pa.binary())], names=["lang", "k", "codes"])

    found = few.select("lang", "text", "k").mapInArrow(read, "lang string, k bigint, codes binary").where("codes IS NOT NULL").collect()
    found = sorted(((r["lang"], r["k"], np.frombuffer(r["codes"], np.int32)) for r in found), key=lambda r: r[:2])
    # every second text is fitted on, where there are enough for both
    fitted = [(lang, codes) for lang, k, codes in found if counts[lang] <= wanted or k % 2]
    model = fit_model(fitted, fit)
    if model:
        set_floors(model, [codes for lang, k, codes in found if k % 2 == 0], fit)
    return model


def identify(docs: DataFrame, model: LanguageModel | None, text_col: str = "text", batch: int = 256) -> DataFrame:
    """Columns ``row`` (a struct of all input columns), ``lang_pred``, ``score`` and ``accepted``.

    The score is the winning regressor's value moved from [-1, 1] to [0, 1]; ties go to the first
    language by name. A text is accepted if its greatest kernel value with a landmark is not below
    the floor of its size. Null texts, texts with no letter, and all texts if there was nothing to
    learn from get ``und`` and 0, and are not accepted. Texts are read whole, in blocks of bounded
    size. Rows are scored one by one, so repeated rows and ids get equal results and an empty table
    gives an empty one. Other columns, whatever their names, are passed on in ``row``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField("row", docs.schema), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, known = GramReader(), shared.value
        for rows in batches:
            column = rows.column(0).field(text_col)
            langs, scores, accepted = [UNDETERMINED] * len(column), np.zeros(len(column)), np.zeros(len(column), bool)
            for at in range(0, len(column) if known else 0, batch):
                grams = [reader(t.as_py()) for t in column[at : at + batch]]
                some = [i for i, g in enumerate(grams) if g is not None]
                if not some:
                    continue
                own = [grams[i] for i in some]
                values = known.kernel(own)
                found = values @ known.coefficients + known.intercept
                best = found.argmax(1)
                accepted[at + np.array(some)] = known.accepts(own, values.max(1))
                for i, b, s in zip(some, best, found[np.arange(len(some)), best]):
                    langs[at + i], scores[at + i] = known.languages[b], min(1.0, max(0.0, (1 + float(s)) / 2))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted)], names=["row", "lang_pred", "score", "accepted"])

    return spread(docs).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).mapInArrow(run, T.StructType(fields))
