"""Ranking, array windows and ordered sets (inventory R1-R10, T1-T6, Y1-Y10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import written

#: Ranges up to which their offsets are broadcast.
BROADCAST_RANGES = 100_000


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of every key; Spark limits within partitions before the shuffle."""
    return df.withColumn("place", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= k)


def last_k(array: Column, k: int) -> Column:
    """The last k elements, all of a shorter array."""
    return F.slice(array, F.greatest(F.size(array) - k + 1, F.lit(1)), k)


def last_k_all(array: Column, k: int, test) -> Column:
    """at least k elements, and the last k all pass."""
    return (F.size(array) >= k) & F.forall(last_k(array, k), test)


def first_live(queue: Column, live) -> Column:
    """The first element that is live."""
    return F.try_element_at(F.filter(queue, live), F.lit(1))


def photo_target(n: Column) -> Column:
    """0, 1, 2, 2 and then 1, as defined."""
    return F.when(n <= 0, 0).when(n == 1, 1).when(n <= 3, 2).otherwise(1)


def batch_number(df: DataFrame, order: list[str], size: int, out: str = "batch") -> DataFrame:
    """T5: numbers of fixed-size batches in order, without a single-task window.

    Rows are dealt out by ranges and kept, so that the numbers of a range and the rows in it are one and
    the same; a range's offset is added to the place within it.
    """
    ranged = written(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    counts = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = ranged.withColumn("__row", F.row_number().over(W.partitionBy("__part").orderBy(*order)))
    offsets = counts.select("__part", before.alias("__before"))  # one row a range
    few = ranged.rdd.getNumPartitions() <= BROADCAST_RANGES
    joined = placed.join(F.broadcast(offsets) if few else offsets, "__part")
    return joined.withColumn(out, F.expr(f"(__before + __row - 1) div {size}")).drop("__part", "__row", "__before")
