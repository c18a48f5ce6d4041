"""Aggregations (inventory A1-A18): DataFrame to DataFrame, all of them partial-then-final in Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import nudged_round
from .market import rollup_medians


def price_summary(df: DataFrame, keys: Sequence[str], price: str, digits: int = 2) -> DataFrame:
    """Counts, mean, median, least and largest of the known prices."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("listing_count"),
        F.count(price).alias("priced_count"),
        nudged_round(F.avg(price), digits).alias("avg_price"),
        nudged_round(F.median(price), digits).alias("median_price"),
        nudged_round(F.min(price), digits).alias("min_price"),
        nudged_round(F.max(price), digits).alias("max_price"),
    )


def rollup_summary(df: DataFrame, keys: Sequence[str], price: str) -> DataFrame:
    """Grand total and every level of a hierarchy; medians are per level, never combined, and found by ranges."""
    found = rollup_medians(df.select(*keys, price), list(keys), price)
    return found.select(*keys, "level", "n", nudged_round("mean", 2).alias("avg_price"), nudged_round("median", 2).alias("median_price"))


def histogram(df: DataFrame, keys: Sequence[str], bucket: Column) -> DataFrame:
    """A2: rows by bucket."""
    return df.groupBy(*keys, bucket.alias("bucket")).agg(F.count("*").alias("n"))


def mode_first_seen(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[Column]) -> DataFrame:
    """A3: the commonest value; of equals, the one seen first in ``order`` (each value's best place is kept, no global sort)."""
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("first"))
    place = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("n"), "first", value))
    return counted.withColumn("place", place).where("place = 1").drop("place", "first")


def top_values(df: DataFrame, value: str, k: int) -> DataFrame:
    """Values by count, then value; k <= 0 keeps all."""
    counted = df.groupBy(value).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), value).limit(k) if k > 0 else counted


def coverage(df: DataFrame, present: dict[str, Column]) -> DataFrame:
    """For each field, rows that have it and their share, in one pass."""
    total = F.count("*")
    sums = df.agg(total.alias("rows"), *[F.count_if(c).alias(k) for k, c in present.items()])
    stacked = ", ".join(f"'{k}', `{k}`" for k in present)
    return sums.selectExpr("rows", f"stack({len(present)}, {stacked}) as (field, n)").select("field", "n", nudged_round(F.col("n") / F.greatest(F.lit(1), F.col("rows")), 4).alias("share"))


def five_numbers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Count, extremes, mean and interpolated quartiles."""
    p = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    found = df.groupBy(*keys).agg(F.count(value).alias("n"), F.min(value).alias("least"), F.max(value).alias("largest"), F.avg(value).alias("mean"), p.alias("p"))
    return found.select(*keys, "n", *[nudged_round(c, 4).alias(a) for c, a in ((F.col("least"), "least"), (F.col("largest"), "largest"), (F.col("mean"), "mean"), (F.col("p")[0], "p25"), (F.col("p")[1], "median"), (F.col("p")[2], "p75"))])


def boolean_tally(df: DataFrame, *fields: str) -> DataFrame:
    """True, false, answered and the share of true of tri-state fields."""
    sums = df.agg(*[F.count_if(F.col(f) == v).alias(f"{f}_{n}") for f in fields for v, n in ((True, "t"), (False, "f"))])
    stacked = ", ".join(f"'{f}', `{f}_t`, `{f}_f`" for f in fields)
    rows = sums.selectExpr(f"stack({len(fields)}, {stacked}) as (field, n_true, n_false)")
    answered = F.col("n_true") + F.col("n_false")
    return rows.select("field", "n_true", "n_false", answered.alias("answered"), nudged_round(F.when(answered > 0, F.col("n_true") / answered), 4).alias("true_ratio"))
