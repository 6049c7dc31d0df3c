"""Vector expressions."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; zero vectors have similarity 0 to any; null if either is null."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms).when(norms.isNotNull(), F.lit(0.0))


def strength(similarity: Column) -> Column:
    """Break strength; a missing vector counts as no break."""
    return 1 - F.coalesce(similarity, F.lit(1.0))


def is_valid_vector(vector: Column, dim: int) -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dim) & good, F.lit(False))


def zero_vector(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), dim)


def hash_embedding(dim: int = 64):
    """A deterministic stand-in for an embedding model, as a pandas UDF: unit vectors seeded by the text's MD5."""

    @F.pandas_udf("array<float>")
    def embed(texts: pd.Series) -> pd.Series:
        def one(text: str | None):
            if text is None:
                return None
            seed = int.from_bytes(hashlib.md5(text.encode()).digest()[:8], "little")
            v = np.random.default_rng(seed).standard_normal(dim)
            return (v / np.linalg.norm(v)).astype(np.float32)

        return texts.map(one)

    return embed
