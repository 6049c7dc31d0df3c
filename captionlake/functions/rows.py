"""Rows from arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def each(rows: DataFrame, array: Column | str, name: str, *kept: str) -> DataFrame:
    """Columns ``kept`` and a row for each element of ``array``, null elements included, as ``name``.

    For a plain ``explode`` Spark infers a filter on the array's size and pushes it below the projections that
    make the array, where all of it is computed again, once for each time that an expression is named.
    """
    return rows.select(*kept, F.posexplode_outer(array).alias("_at", name)).where("_at IS NOT NULL").drop("_at")
