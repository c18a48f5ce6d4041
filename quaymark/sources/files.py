"""File sources (inventory S7-S10, J2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blocked_page, strip


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row of ``schema`` for each line that is a JSON object; blank and broken lines go."""
    raw = spark.read.text(path)
    parsed = raw.select(F.from_json("value", f"{schema}, __bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}).alias("r"), strip("value").alias("v"))
    return parsed.where("v like '{%' and r.__bad is null").select("r.*").drop("__bad")


def read_folder(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Lines of all files below ``path`` whose names match, with their file."""
    lines = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"))


def read_geojson(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """A row for each feature: its place, its ``properties`` and, for points, lng and lat."""
    schema = f"features array<struct<properties: struct<{properties}>, geometry: struct<type: string, coordinates: string>>>"
    features = spark.read.schema(schema).option("multiLine", "true").json(path).select(F.posexplode("features").alias("pos", "f"))
    at = F.when(F.col("f.geometry.type") == "Point", F.from_json("f.geometry.coordinates", "array<double>"))
    return features.select("pos", "f.properties.*", F.try_element_at(at, F.lit(1)).alias("lng"), F.try_element_at(at, F.lit(2)).alias("lat"))


def read_seeds(spark: SparkSession, path: str, urls: bool = True) -> DataFrame:
    """Lines without comments; with ``urls`` only those with an http scheme and a host."""
    seeds = spark.read.text(path).select(strip(F.regexp_replace("value", "#.*$", "")).alias("seed")).where("seed <> ''")
    return seeds.where(F.col("seed").rlike(r"(?i)^https?://[^/?#\s]+")) if urls else seeds


def settlements(names: DataFrame, places: DataFrame, key: str = "GEO_NAME_ID") -> DataFrame:
    """Names with the position of their settlement; of repeated ids, the last place counts."""
    known = places.where("PLACE_CLASS = 'Settlement' and lng is not null and lat is not null")
    last = known.groupBy(key).agg(F.max_by(F.struct("DISTRICT", "lng", "lat"), "pos").alias("at"))
    return names.drop("lng", "lat", "pos").join(last, key).select(*[c for c in names.columns if c not in ("lng", "lat", "pos")], "at.*")


#: Tables that stand for what lies outside (S11, S12, S15, S16): what the engine reads of pages, lookups, answers and rows.
SEAMS = {
    "fetched_pages": "url string, final_url string, http_status int, html string",
    "geocodes": "keyword string, rank int, lat double, lng double, score double",
    "model_answers": "line string",
    "relational_rows": "source_id string, channel_id int, payload string",
}


def seam(df: DataFrame, name: str) -> DataFrame:
    """The columns of a seam table, cast to its types; a missing column is an error, others are ignored."""
    fields = [f.split() for f in SEAMS[name].split(", ")]
    missing = [c for c, _ in fields if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks {', '.join(missing)}")
    return df.select(*[F.col(c).try_cast(kind).alias(c) for c, kind in fields])


def fetch_outcome(status: str = "http_status", html: str = "html") -> Column:
    """Ok, blocked, empty, or failed."""
    body = F.coalesce(F.col(html), F.lit(""))
    return F.when(F.coalesce(F.col(status), F.lit(599)) >= 400, "failed").when(blocked_page(body), "blocked").when(strip(body) == "", "empty").otherwise("ok")


def lookup_row(rows: DataFrame, source_id: str) -> DataFrame:
    """The rows of one id; the filter reaches the scan."""
    return rows.where(F.col("source_id") == source_id)


def read_tiers(spark: SparkSession, path: str) -> DataFrame:
    """Tier, cap and field of a file of field masks ({tier: {free_cap, fields}}); a null cap has no bound."""
    raw = spark.read.option("wholetext", "true").text(path)
    tiers = F.from_json("value", "map<string, struct<free_cap: bigint, fields: array<string>>>")
    rows = raw.select(F.explode(tiers).alias("tier", "t"))
    return rows.select("tier", F.col("t.free_cap").alias("cap"), F.explode_outer("t.fields").alias("field"))
