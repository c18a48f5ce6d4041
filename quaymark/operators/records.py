"""Records for requests, messages and exports (inventory P1-P3, P7, P11, P12, P17, C11, F16, R3, T6, X22)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import numbers as N
from .ranking import photo_target

#: Fields of a listing, its summary and a photo that requests carry.
LISTING_FIELDS = ("rent_price", "net_size_sqft", "number_of_bedrooms")
SUMMARY_FIELDS = ("headline_en", "executive_summary_en", "key_highlights", "possible_concerns", "price_analysis", "layout_and_space", "location_and_transport", "photo_insights", "recommended_for", "confidence_score")
SUMMARY_PROMPT_FIELDS = ("title", "description", "estate_or_building_name", "district", "floor", "features", "rent_price", "sell_price", "net_size_sqft", "gross_size_sqft", "number_of_bedrooms", "number_of_bathrooms", "building_age", "nearby_places", "transportation_options", "additional_notes")
POST_FIELDS = ("title", "description", "floor", "flat", "floor_group", "features", "rent_price", "sell_price", "net_size_sqft", "gross_size_sqft", "number_of_bedrooms", "number_of_bathrooms")
PHOTO_FIELDS = {"room_type": "room", "image_description": "desc", "quality_score": "q", "is_indoor": "indoor"}


def _fields(df: DataFrame, source: str, names: tuple[str, ...]) -> list[Column]:
    """Fields of a struct column, null for those that its schema lacks."""
    known = df.schema[source].dataType.names
    return [F.col(f"{source}.{n}").alias(n) if n in known else F.lit(None).cast("string").alias(n) for n in names]


def prop_payload(df: DataFrame) -> DataFrame:
    """source_id, extracted and summary fields of a listing (source_id, extracted, summary)."""
    return df.select("source_id", *_fields(df, "extracted", LISTING_FIELDS), *_fields(df, "summary", SUMMARY_FIELDS))


def summary_payload(df: DataFrame) -> DataFrame:
    """What a summary is made of (source_id, source_channel, source_url, extracted)."""
    return df.select("source_id", "source_channel", "source_url", *_fields(df, "extracted", SUMMARY_PROMPT_FIELDS))


def compact_photos(photos: Column) -> Column:
    """Photos with short names."""
    return F.transform(photos, lambda p: F.struct(*[p[old].alias(new) for old, new in PHOTO_FIELDS.items()]))


def post_payload(df: DataFrame) -> DataFrame:
    """A post (id, post_type, post, building) with its district and building nested."""
    b = F.col("building")
    district = F.struct(b["district_en"].alias("en"), b["district_zh"].alias("zh_hk"))
    estate = F.struct(F.struct(b["name_en"].alias("en"), b["name_zh"].alias("zh_hk")).alias("name"), b["type"].alias("type"), b["tower"].alias("tower"), b["built_in"].alias("builtIn"))
    return df.select(F.col("id").cast("string").alias("post_id"), "post_type", *_fields(df, "post", POST_FIELDS), district.alias("district"), estate.alias("estate_building"))


def company(zh: dict[str, Column], en: dict[str, Column], mail: Column, tel: Column) -> dict[str, Column]:
    """Fields of an agency: the Chinese schema first, then the English one, then what the page's links say."""

    def some(*given: Column) -> Column:
        return F.coalesce(*[F.nullif(F.trim(g), F.lit("")) for g in given])

    def bare(x: Column) -> Column:
        return F.replace(x, F.lit("tel:"), F.lit(""))

    return {
        "name_en": some(en["name"]), "name_zh": some(zh["name"]), "license": some(zh["leiCode"], en["leiCode"]),
        "email": some(zh["email"], en["email"], mail), "phone": some(bare(zh["telephone"]), bare(en["telephone"]), tel), "logo": F.coalesce(some(zh["logo"], en["logo"]), F.lit("")),
    }


def license_parts(x: Column) -> Column:
    """The parts of a licence number around its dash: kind and number."""
    kind, number = F.regexp_extract(x, r"^\s*([A-Za-z])\s*-\s*(\d+)\s*$", 1), F.regexp_extract(x, r"^\s*([A-Za-z])\s*-\s*(\d+)\s*$", 2)
    return F.struct(F.nullif(F.upper(kind), F.lit("")).alias("kind"), F.nullif(number, F.lit("")).alias("number"))


#: Fixed value: what a link to a WhatsApp chat looks like.
WHATSAPP = r"(?i)(wa\.me/|api\.whatsapp\.com/|whatsapp)"


def channel_id(channel: Column) -> Column:
    """Numbers of the portals."""
    return F.when(channel == "squarefoot", 2).when(channel == "spacious", 3).when(channel == "house730", 4).otherwise(1)


def export_row(post_type: Column, rent: Column, sell: Column, size: Column) -> dict[str, Column]:
    """Type (1 for sales, 2 for rents), price of that type and price over size, 0 where missing."""
    kind = F.when(post_type == "sell", 1).otherwise(2)
    price = F.coalesce(F.when(kind == 2, rent).otherwise(sell), F.lit(0)).cast("bigint")
    area = F.coalesce(size, F.lit(0)).cast("bigint")
    return {"listing_type": kind, "price_from": price, "net_size": area, "price_sqft": F.when((price != 0) & (area != 0), price / area)}


#: Words of a post's caption by language: rent, sale, joins of details, and the signs after bedrooms, bathrooms and feet.
CAPTIONS = {
    "zh-hk": ("租盤", "售盤", "，", "房", "廁", "平方呎"),
    "zh-cn": ("租盘", "售盘", "，", "房", "卫", "平方英尺"),
    "en": ("Rent", "Sale", ", ", " bed", " bath", " sqft"),
}
MESSAGES = {
    "zh-hk": ("跟據你要求, 新盤搵到有單位可能啱：", "如果想暫停通知隨時話我知"),
    "zh-cn": ("根据您的要求, 新盘中找到了可能适合您的单位：", "如果想暂停通知，请随时告诉我。"),
    "en": ("Based on your requirements, a new listing has been found that might suit you:", "Just let me know anytime if you want to pause these notifications."),
}


def _by_language(lang: Column, of) -> Column:
    out = of("en")
    for code in ("zh-hk", "zh-cn"):
        out = F.when(lang == code, of(code)).otherwise(out)
    return out


def post_title(*names: Column) -> Column:
    """The first of title and names that says something, or Post."""
    return F.coalesce(*[F.nullif(F.trim(n), F.lit("")) for n in names], F.lit("Post"))


def post_caption(title: Column, kind: Column, price: Column, bedrooms: Column, bathrooms: Column, size: Column, lang: Column) -> Column:
    """A post in one of three languages; details that are not known are left out."""

    def of(code: str) -> Column:
        rent, sale, comma, beds, baths, feet = CAPTIONS[code]
        first = F.concat(F.when(kind == "rent", rent).otherwise(sale), F.lit(": "), N.format_price(price))
        more = [F.concat(x.cast("string"), F.lit(sign)) for x, sign in ((bedrooms, beds), (bathrooms, baths), (size, feet))]
        return F.concat(title, F.lit(" - "), F.concat_ws(comma, first, *more))

    return _by_language(lang, of)


def rendered(text: Column, lang: Column) -> Column:
    """The message around a caption and its link."""
    return _by_language(lang, lambda code: F.concat(F.lit(MESSAGES[code][0] + "\n\n"), text, F.lit("\n\n" + MESSAGES[code][1])))


def choose_templates(wanted: DataFrame, templates: DataFrame, most: int = 4) -> DataFrame:
    """Rows (id, count, lang) with the template of the largest number of listings that is not above theirs; null if
    there is none.  Templates (n, lang, template) are a small dimension."""
    joined = wanted.join(templates.withColumnRenamed("lang", "__lang"), (F.col("lang") == F.col("__lang")) & (F.col("n") <= F.least("count", F.lit(most))) & (F.col("n") >= 1), "left")
    return joined.groupBy("id", "count", "lang").agg(F.max_by(F.struct("n", "template"), "n").alias("t")).select("id", "count", "lang", F.col("t.n").alias("n"), F.col("t.template").alias("template"))


def photo_candidates(listings: DataFrame, photos: DataFrame, reachable: DataFrame) -> DataFrame:
    """C11: new photos (source_id, pos, photo_url): links and photo addresses in order, each once, as many as the
    listing's number calls for, not there yet, and answered (the seam)."""
    links = F.array_distinct(F.concat(F.coalesce("links", F.array().cast("array<string>")), F.coalesce("photo_urls", F.array().cast("array<string>"))))
    some = listings.withColumn("__l", links).select("source_id", F.posexplode(F.slice("__l", 1, photo_target(F.size("__l")))).alias("pos", "photo_url"))
    new = some.join(photos.select("source_id", "photo_url").distinct(), ["source_id", "photo_url"], "left_anti")
    return new.join(reachable.select("photo_url").distinct(), "photo_url", "left_semi").select("source_id", "pos", "photo_url")


def eligible(p: dict[str, Column]) -> Column:
    """F16: an analysed photo of the property, without people and within the policy."""
    return F.coalesce((p["status"] == "photo_analysed") & p["is_property"] & ~p["is_violating"] & ~p["is_human"], F.lit(False))


def best_photos(photos: DataFrame, k: int = 2) -> DataFrame:
    """The k eligible photos of the best quality of each listing; a missing quality comes last, ties by id."""
    good = photos.where(eligible({n: F.col(n) for n in ("status", "is_property", "is_violating", "is_human")}))
    place = F.row_number().over(W.partitionBy("source_id").orderBy(F.col("quality").desc_nulls_last(), "photo_id"))
    return good.withColumn("place", place).where(F.col("place") <= k)


def index_text(*parts: Column) -> Column:
    """The parts that say something, in order, with one space between them; arrays give their first five."""
    return F.trim(F.concat_ws(" ", *[F.nullif(F.trim(p), F.lit("")) for p in parts]))


def first_five(items: Column) -> Column:
    return F.array_join(F.slice(F.coalesce(items, F.array().cast("array<string>")), 1, 5), " ")
