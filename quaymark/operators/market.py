"""Market statistics of listings (inventory S1, F1, A1-A6, P6, P9, P10, R5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..session import written


def priced(direct: Column, other: Column, rent: Column, size: Column) -> Column:
    """a direct price a foot in either spelling, or a rent and a size above zero."""
    return direct.isNotNull() | other.isNotNull() | (rent.isNotNull() & F.coalesce(size > 0, F.lit(False)))


def market_scan(listings: DataFrame, types: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Listings that are not archived and have a price, newest first, of some types, up to a limit if there is one."""
    found = listings.where(~F.col("status").eqNullSafe(F.lit("archived")) & priced(F.col("price_sqft"), F.col("price_per_sqft"), F.col("rent_price"), F.col("net_size")))
    found = found.where(F.col("kind").isin(*types)) if types else found
    ordered = found.orderBy(F.col("created_at").desc_nulls_last(), "source_id")
    return ordered.limit(limit) if limit else ordered


def price_of(kind: Column, rent: Column, sell: Column) -> Column:
    """The price of a sale, else the rent; the other one where it is missing."""
    return F.when(kind == "sale", F.coalesce(sell, rent)).otherwise(F.coalesce(rent, sell))


def size_of(net: Column, gross: Column) -> Column:
    """Net size, or gross."""
    return F.coalesce(net, gross)


def building_age(built: Column, year: int) -> Column:
    """P10: years since a plausible year of completion."""
    return F.when((built > 1800) & (built <= year), year - built)


def price_per_foot(x: dict[str, Column]) -> Column:
    """N8 over text fields: a direct figure, or rent over size."""
    return N.price_per_unit(N.parse_number(x["price_sqft"]), N.parse_number(x["price_per_sqft"]), N.parse_number(x["rent_price"]), N.parse_number(x["net_size"]))


#: Rows of range offsets up to which they are broadcast; beyond, the join is shuffled.
BROADCAST_OFFSETS = 100_000


def medians(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys and median, the mean of the two middle values of each group (of all rows without keys).

    No state holds the values of a group: equal values become one row with a count, rows are dealt out by
    ranges of (keys, value) and counted there, and the middle places are looked up in the ranges that hold
    them.  Null values do not count; groups without any value are not returned; null keys are keys.
    """
    known = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    counts = known.groupBy(*keys, "__v").agg(F.count("*").alias("__n"))
    ranged = counts.repartitionByRange(*keys, "__v").withColumn("__part", F.spark_partition_id())
    # What is summed up below is found again by the rows themselves, so both sides read one written table.
    ranged = written(ranged)
    within = ranged.withColumn("__low", F.sum("__n").over(W.partitionBy("__part", *keys).orderBy("__v")))
    sums = ranged.groupBy("__part", *keys).agg(F.sum("__n").alias("__total"))
    every = W.partitionBy(*keys)
    before = F.coalesce(F.sum("__total").over(every.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select(F.col("__part").alias("__p"), *[F.col(k).alias(f"__k_{k}") for k in keys], before.alias("__before"), F.sum("__total").over(every).alias("__all"))
    few = offsets.limit(BROADCAST_OFFSETS + 1).count() <= BROADCAST_OFFSETS
    same = F.col("__part") == F.col("__p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    placed = within.join(F.broadcast(offsets) if few else offsets, same)
    high = F.col("__before") + F.col("__low")
    holds = [(high >= m) & (high - F.col("__n") < m) for m in (F.floor((F.col("__all") + 1) / 2), F.floor((F.col("__all") + 2) / 2))]
    found = placed.where(holds[0] | holds[1]).groupBy(*keys).agg(F.min(F.when(holds[0], F.col("__v"))).alias("__a"), F.min(F.when(holds[1], F.col("__v"))).alias("__b"))
    return found.select(*keys, ((F.col("__a") + F.col("__b")) / 2).alias("median"))


def rollup_medians(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Every level of a hierarchy: keys (null where summed up), level, n, mean and median."""
    figures = df.rollup(*keys).agg(F.grouping_id().cast("long").alias("level"), F.count("*").alias("n"), F.avg(value).alias("mean"))
    found = None
    for depth in range(len(keys) + 1):
        level = medians(df, keys[:depth], value).select(*[F.col(k).alias(f"__{k}") if i < depth else F.lit(None).cast(df.schema[k].dataType).alias(f"__{k}") for i, k in enumerate(keys)], F.lit((1 << len(keys) - depth) - 1).cast("long").alias("__level"), "median")
        found = level if found is None else found.unionByName(level)
    same = F.col("level") == F.col("__level")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return figures.join(found, same, "left").select(*keys, "level", "n", "mean", "median")


def district_stats(rows: DataFrame) -> DataFrame:
    """A1-A3, N11 over (district, price, bucket, seq): figures, level, commonest bucket (of equals the first met) and all buckets."""
    buckets = rows.groupBy("district", "bucket").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    spread = buckets.groupBy("district").agg(F.max_by("bucket", F.struct("n", -F.col("first"))).alias("dominant"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("bucket", "n")))).alias("buckets"))
    figures = rows.groupBy("district").agg(F.count("*").alias("listing_count"), F.count("price").alias("priced_count"), F.avg("price").alias("avg_price"), F.median("price").alias("median_price"))
    return figures.join(spread, "district").withColumn("level", N.price_level("median_price"))


def district_documents(rows: DataFrame) -> DataFrame:
    """One document a district with its buildings and their rents by bedrooms, in the defined order.

    ``rows``: district, building, group, price, size, rent, bucket, seq.  A district's buildings are a
    dimension of the market, so its arrays hold figures, never listings.
    """
    stats = district_stats(rows)
    named = rows.where(F.coalesce("building", F.lit("")) != "")
    rents = named.where("group is not null").groupBy("district", "building", "group").agg(F.count("*").alias("n"), F.avg("rent").alias("rent"))
    order = N.bedroom_order("group")
    by_group = rents.groupBy("district", "building").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "group", "n", N.nudged_round("rent", 2).alias("rent")))).alias("rents"))
    buildings = named.groupBy("district", "building").agg(F.count("*").alias("n"), F.avg("price").alias("price"), F.avg("size").alias("size")).join(by_group, ["district", "building"], "left")
    place = F.struct((-F.col("n")).alias("o1"), F.coalesce(-F.col("price"), F.lit(1.0)).alias("o2"), "building", "n", N.nudged_round("price", 2).alias("price"), N.nudged_round("size", 2).alias("size"), F.transform(F.coalesce("rents", F.array().cast("array<struct<o:int,group:string,n:bigint,rent:double>>")), lambda r: F.struct(r["group"].alias("group"), r["n"].alias("n"), r["rent"].alias("rent"))).alias("rents"))
    estates = buildings.groupBy("district").agg(F.transform(F.array_sort(F.collect_list(place)), lambda b: F.struct(b["building"].alias("building"), b["n"].alias("n"), b["price"].alias("price"), b["size"].alias("size"), b["rents"].alias("rents"))).alias("estates"))
    return stats.join(estates, "district", "left")
