"""Places, running sums and short look-backs in a total order, for groups of any size.

Rows are dealt out by range of (group, order), so one group may span many partitions. Each partition
counts by itself; what goes over its end is one row for each partition, summed up in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from captionlake.workspace import materialize

#: Rows of (partition, group) totals that are broadcast; beyond that they meet by a shuffle.
FEW = 100_000


def running(rows: DataFrame, group: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """``rows`` and, for each of ``sums``, its running sum within the group in ``order``, the row itself included.

    ``group`` may be empty. ``order`` has to be total within a group for the result to be one; equal
    rows get places in any order. Null groups are one group.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = list(sums)
    dealt = rows.select("*", *[c.alias(f"_own_{n}") for n, c in sums.items()]).repartitionByRange(parts, *group, *order)
    dealt = materialize(dealt.withColumn("_part", F.spark_partition_id()), "ordered")
    key = ["_part", *group]
    local = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    counted = dealt.select("*", *[F.sum(f"_own_{n}").over(local).alias(n) for n in names])
    totals = dealt.groupBy(*key).agg(*[F.sum(f"_own_{n}").alias(f"_t_{n}") for n in names])
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each partition that a group goes on in: at most two groups begin or end in the middle of each
    carried = totals.select(*key, *[F.sum(f"_t_{n}").over(earlier).alias(f"_t_{n}") for n in names]).where(F.col(f"_t_{names[0]}").isNotNull())
    carried = materialize(carried, "ordered-carried")
    carried = carried.select(*[F.col(k).alias(f"_k_{k}") for k in key], *[f"_t_{n}" for n in names])
    if carried.count() <= FEW:
        carried = F.broadcast(carried)
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = counted.join(carried, same, "left")
    return joined.select(*rows.columns, *[(F.col(n) + F.coalesce(f"_t_{n}", F.lit(0))).alias(n) for n in names])


def place(rows: DataFrame, group: list[str], order: list[str], name: str = "place") -> DataFrame:
    """``rows`` with their place in ``order`` within the group, from 1 (a row number without a task for each group)."""
    return running(rows, group, order, {name: F.lit(1).cast("bigint")})


def mean_of_last(rows: DataFrame, group: list[str], position: str, value: str, name: str, last: int = 100, block: int = 65_536) -> DataFrame:
    """``rows`` with the mean of ``value`` over the ``last`` rows up to each, by ``position`` (1, 2, ... within the group).

    Groups are cut into blocks of ``block`` places; the end of each is repeated at the head of the next.
    """
    b = F.floor((F.col(position) - 1) / block)
    own = rows.withColumn("_block", b).withColumn("_own", F.lit(True))
    ends = own.where((F.col(position) - 1) % block >= block - (last - 1)).withColumn("_block", F.col("_block") + 1).withColumn("_own", F.lit(False))
    frame = Window.partitionBy(*group, "_block").orderBy(position).rowsBetween(-(last - 1), 0)
    return own.unionByName(ends).withColumn(name, F.avg(value).over(frame)).where("_own").drop("_own", "_block")
