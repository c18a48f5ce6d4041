"""Places, addresses and usage tiers (inventory S13, S14, C9, P5, P15, P16, C10, W4, J13, J18, Z13, Z16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import holding


def tier(usage: dict[str, Column], caps: dict[str, int], order: tuple[str, ...], default: str | None = None) -> Column:
    """The first tier whose usage of the month is below its cap."""
    out = F.lit(default)
    for t in reversed(order):
        out = F.when(F.coalesce(usage[t], F.lit(0)) < caps[t], t).otherwise(out)
    return out


def cached(requests: DataFrame, answers: DataFrame, now: int, ttl: int) -> DataFrame:
    """Requests (key) with the newest answer (key, created_at, result) that is not older than ``ttl`` seconds, and hit."""
    fresh = answers.where(F.col("created_at") > now - ttl).groupBy("key").agg(F.max_by("result", F.struct("created_at", "result")).alias("result"))
    return requests.join(fresh, "key", "left").withColumn("hit", F.col("result").isNotNull())


def brief_regions(parts: Column, levels: tuple[str, ...]) -> Column:
    """P5: names of those address parts (name, types) that are of one of the levels."""
    return F.transform(F.filter(parts, lambda p: F.arrays_overlap(p["types"], F.array(*map(F.lit, levels)))), lambda p: p["name"])


def joined_name(*parts: Column) -> Column:
    """The parts that say something, with a space between them."""
    return F.concat_ws(" ", *[F.nullif(F.trim(p), F.lit("")) for p in parts])


def query_text(district: Column, building: Column) -> Column:
    """What is looked up: district and building, or the one there is; null if there is none."""
    return F.nullif(joined_name(district, building), F.lit(""))


#: Fixed value: the least score of an address that is taken with its building.
GATE = 55


def map_addresses(listings: DataFrame, lookups: DataFrame) -> DataFrame:
    """Listings (source_id, district, building) with what the lookup (query, rank, score, building_en,
    district_en, lat, lng) suggests first: level is building or district, and error is not_found where nothing is."""
    asked = listings.withColumn("query", query_text(F.col("district"), F.col("building")))
    best = lookups.groupBy("query").agg(F.min_by(F.struct("score", "building_en", "district_en", "lat", "lng"), F.struct("rank", "building_en")).alias("best"))
    found = asked.join(best, "query", "left")
    low = (F.coalesce(F.trim("building"), F.lit("")) == "") | (F.coalesce("best.score", F.lit(0.0)) < GATE)
    level = F.when(F.col("best").isNotNull(), F.when(low, "district").otherwise("building"))
    return found.select(
        "source_id", "query", level.alias("level"), F.col("best.district_en").alias("district_en"),
        F.when(level == "building", F.col("best.building_en")).alias("building_en"), F.nullif(F.col("best.score"), F.lit(0.0)).alias("score"),
        F.col("best.lat").alias("lat"), F.col("best.lng").alias("lng"), F.when(F.col("best").isNull(), "not_found").alias("error"),
    )


def upsert_by_names(old: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
    """Each new row replaces the columns of the first old row (by id) with its English or Chinese name, or
    is inserted with a null id.  Empty names match nothing; new rows without any name are left out; of new
    rows for one old row the last (by name_en, name_zh) counts."""
    named = new.withColumn("__en", F.nullif("name_en", F.lit(""))).withColumn("__zh", F.nullif("name_zh", F.lit(""))).where("__en is not null or __zh is not null")
    keys = old.select("id", F.col("name_en").alias("__k"), F.lit("en").alias("__by")).union(old.select("id", "name_zh", F.lit("zh"))).where("__k is not null and __k <> ''")
    # Many rows may share a name: only the first old id of each name is met, once for each pair of new names.
    firsts = keys.groupBy("__by", "__k").agg(F.min("id").alias("id"))
    pairs = named.select("name_en", "name_zh", "__en", "__zh").distinct()
    tries = pairs.select("name_en", "name_zh", F.explode(F.array(F.struct(F.lit("en").alias("__by"), F.col("__en").alias("__k")), F.struct(F.lit("zh").alias("__by"), F.col("__zh").alias("__k")))).alias("t"))
    hits = tries.select("name_en", "name_zh", "t.*").join(firsts, ["__by", "__k"]).groupBy("name_en", "name_zh").agg(F.min("id").alias("id"))
    placed = named.drop("__en", "__zh").join(hits.toDF("__e", "__z", "__id"), F.col("name_en").eqNullSafe(F.col("__e")) & F.col("name_zh").eqNullSafe(F.col("__z")), "left")
    best = F.max_by(F.struct(*columns), F.struct("name_en", "name_zh"))
    hit = placed.where("__id is not null").groupBy(F.col("__id").alias("id")).agg(best.alias("__b")).select("id", "__b.*")
    inserted = placed.where("__id is null").select(F.lit(None).cast(old.schema["id"].dataType).alias("id"), *columns).distinct()
    return old.join(hit.select("id"), "id", "left_anti").select("id", *columns).unionByName(hit).unionByName(inserted)


def district_like(rows: DataFrame, references: DataFrame) -> DataFrame:
    """Rows (source_id, channel_id, district) with the first reference (by ref_id) of their channel whose
    Chinese or English name holds the last word of the district; error where there is none.

    A keyword meets only the names that share its rarest gram (see ``holding``).  An empty one is held by every name.
    """
    word = F.element_at(F.split(F.replace(F.coalesce("district", F.lit("")), F.lit(","), F.lit(" ")), " "), -1)
    asked = rows.withColumn("keyword", F.trim(word)).select("channel_id", "keyword").distinct()
    names = references.select("channel_id", "ref_id", F.explode(F.array("district_chi", "district")).alias("text")).where("text is not null")
    pairs = holding(asked.select("keyword").distinct(), names.select("text").distinct())
    met = asked.join(pairs, "keyword").join(names, ["channel_id", "text"]).unionByName(asked.where("keyword = ''").join(names, "channel_id"))
    hits = met.groupBy("channel_id", "keyword").agg(F.min("ref_id").alias("ref_id"))
    out = rows.withColumn("keyword", F.trim(word)).join(hits, ["channel_id", "keyword"], "left")
    return out.select("source_id", "keyword", "ref_id", F.when(F.col("ref_id").isNull(), "district_not_found").alias("error"))


def pick_place(places: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    """Of each query's places (query, name, pos, kind) the one with the very name, else one that holds it, else
    the first, all among the allowed kinds."""
    name, wanted = F.lower(F.coalesce("name", F.lit(""))), F.lower(F.coalesce("query", F.lit("")))
    rank = F.when((wanted != "") & (name == wanted), 0).when((wanted != "") & (name != "") & name.contains(wanted), 1).otherwise(2)
    return places.where(F.col("kind").isin(*allowed)).groupBy("query").agg(F.min_by(F.struct("name", "pos"), F.struct(rank, "pos")).alias("p")).select("query", "p.name", "p.pos")


def estate_query(kind: Column, building: Column, district: Column) -> Column:
    """The text of a place query; null without a building."""
    b, d = F.nullif(F.trim(building), F.lit("")), F.nullif(F.trim(district), F.lit(""))
    return F.concat(kind, F.lit(" "), b, F.coalesce(F.concat(F.lit(", "), d), F.lit("")), F.lit(", Hong Kong"))
