"""Queries over the domain tables: market, matching, queues, threads, users, batches, photos and addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import chunking, district
from ..functions import numbers as N
from ..functions import pages as G
from ..functions import text as X
from ..operators import batches as B
from ..operators import ids as I
from ..operators import market as K
from ..operators import matching as C
from ..operators import merge as M
from ..operators import places as P
from ..operators import queue as Q
from ..operators import ranking as R
from ..operators import records as E
from ..operators import threads as T
from ..operators import users as U
from ..session import in_small_batches, ship, written
from . import monitor
from .domain import NOW, YEAR, rows, sql
from .queries import query, table

NUM = r"TRY_CAST(regexp_extract(replace({0}, ',', ''), '\d+(\.\d+)?', 0) AS DOUBLE)"
MONEY = "CAST(trunc(TRY_CAST(replace(replace(replace(lower(trim({0})), ',', ''), '$', ''), 'hkd', '') AS DOUBLE)) AS BIGINT)"
WHOLE = r"CASE WHEN regexp_full_match(trim({0}), '[+-]?\d+') THEN CAST(trim({0}) AS BIGINT) END"


def columns(*names: str, **renamed: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names} | {n: F.col(c) for n, c in renamed.items()}


# Market.

FOOT = f"coalesce({NUM.format('price_sqft')}, {NUM.format('price_per_sqft')}, CASE WHEN net_size > 0 THEN {NUM.format('rent_price')} / net_size END)"
SCAN = "status IS DISTINCT FROM 'archived' AND (price_sqft IS NOT NULL OR price_per_sqft IS NOT NULL OR (rent_price IS NOT NULL AND net_size > 0))"
BUCKET = "CASE WHEN price IS NULL THEN 'unknown' WHEN price < 30 THEN 'under_30' WHEN price < 40 THEN '30_to_39_99' WHEN price < 50 THEN '40_to_49_99' WHEN price < 60 THEN '50_to_59_99' WHEN price < 80 THEN '60_to_79_99' ELSE '80_plus' END"
GROUP = f"CASE WHEN trunc(b) <= 0 THEN 'studio' WHEN trunc(b) >= 6 THEN '6+ bedrooms' WHEN b IS NOT NULL THEN CAST(CAST(trunc(b) AS BIGINT) AS VARCHAR) || ' bedrooms' END"
PRICED = f"{sql('listings')}, scanned AS (SELECT *, {FOOT} AS price, CASE WHEN net_size > 0 THEN CAST(net_size AS DOUBLE) END AS size, CASE WHEN {NUM.format('rent_price')} > 0 THEN {NUM.format('rent_price')} END AS rent, {NUM.format('bedrooms')} AS b, -created_at * 1000000 + k AS seq FROM listings WHERE {SCAN}), priced AS (SELECT *, {BUCKET} AS bucket, {GROUP} AS grp FROM scanned)"


def priced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = K.market_scan(rows(spark, sf_dir, "listings"))
    price = K.price_per_foot(columns("price_sqft", "price_per_sqft", "rent_price", "net_size"))
    out = scanned.select("k", "district", "building", price.alias("price"), N.positive("net_size").cast("double").alias("size"), N.positive(N.parse_number("rent_price")).alias("rent"), N.bedroom_group("bedrooms").alias("group"), (-F.col("created_at") * 1000000 + F.col("k")).alias("seq"))
    return out.withColumn("bucket", N.sqft_price_bucket("price"))


@query(f"{sql('listings')} SELECT source_id, kind, created_at FROM listings WHERE {SCAN} AND kind IN ('rent', 'sale')")
def market_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the market report reads."""
    return K.market_scan(rows(spark, sf_dir, "listings"), ["rent", "sale"]).select("source_id", "kind", "created_at")


@query(f"{PRICED}, spread AS (SELECT district, bucket, count(*) AS n, min(seq) AS first FROM priced GROUP BY 1, 2), figures AS (SELECT district, count(*) AS listing_count, count(price) AS priced_count, round(avg(price)+1e-9,2) AS avg_price, round(median(price)+1e-9,2) AS median_price, CASE WHEN median(price) IS NULL THEN 'unknown' WHEN median(price) < 30 THEN 'budget' WHEN median(price) < 40 THEN 'affordable' WHEN median(price) < 50 THEN 'mid_market' WHEN median(price) < 70 THEN 'premium' ELSE 'luxury' END AS level FROM priced GROUP BY 1) SELECT f.*, (SELECT bucket FROM spread s WHERE s.district = f.district ORDER BY n DESC, first LIMIT 1) AS dominant, (SELECT string_agg(bucket || ':' || n, ',' ORDER BY bucket) FROM spread s WHERE s.district = f.district) AS buckets FROM figures f")
def market_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of every district."""
    s = K.district_stats(priced_rows(spark, sf_dir))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("buckets")), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",")
    return s.select("district", "listing_count", "priced_count", N.nudged_round("avg_price", 2).alias("avg_price"), N.nudged_round("median_price", 2).alias("median_price"), "level", "dominant", text.alias("buckets"))


@query(f"{PRICED}, rents AS (SELECT district, building, grp, count(*) AS n, round(avg(rent)+1e-9,2) AS rent, CASE WHEN grp = 'studio' THEN 0 WHEN grp = '6+ bedrooms' THEN 99 ELSE CAST(split_part(grp, ' ', 1) AS INTEGER) END AS o FROM priced WHERE building <> '' AND grp IS NOT NULL GROUP BY 1, 2, 3), built AS (SELECT district, building, count(*) AS n, avg(price) AS price, avg(size) AS size FROM priced WHERE building <> '' GROUP BY 1, 2) SELECT district, CAST(row_number() OVER (PARTITION BY district ORDER BY n DESC, coalesce(-price, 1), building) - 1 AS INTEGER) AS pos, building, n, round(price+1e-9,2) AS price, round(size+1e-9,2) AS size, coalesce((SELECT string_agg(grp || ' ' || n || ' ' || coalesce(CAST(CAST(floor(rent) AS BIGINT) AS VARCHAR), '-'), ';' ORDER BY o) FROM rents r WHERE r.district = b.district AND r.building = b.building), '') AS rents FROM built b")
def market_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The buildings of the district documents, in their order."""
    d = K.district_documents(priced_rows(spark, sf_dir)).select("district", F.posexplode("estates").alias("pos", "b"))
    one = lambda r: F.concat(r["group"], F.lit(" "), r["n"].cast("string"), F.lit(" "), F.coalesce(F.floor(r["rent"]).cast("string"), F.lit("-")))
    return d.select("district", "pos", "b.building", "b.n", "b.price", "b.size", F.array_join(F.transform("b.rents", one), ";").alias("rents"))


@query(f"{PRICED} SELECT round(median(price)+1e-9,4) AS median FROM priced")
def market_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The median of all by ranges of values."""
    return K.medians(priced_rows(spark, sf_dir), [], "price").select(N.nudged_round("median", 4).alias("median"))


DAY = 86400


@query(f"{sql('listings')} SELECT source_id, 'prop' AS chain FROM listings WHERE indexing = 'indexed' AND status IS DISTINCT FROM 'archived' AND confidence >= 80 AND created_at >= {NOW - DAY} AND created_at < {NOW} UNION ALL SELECT source_id, 'post' FROM listings WHERE status = 'published' AND estate_id IS NOT NULL AND created_at >= {NOW - DAY} AND created_at < {NOW}")
def yesterday_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """yesterday's indexed listings of good confidence, and yesterday's published posts."""
    fresh = rows(spark, sf_dir, "listings").where(F.col("created_at").between(NOW - DAY, NOW - 1))
    props = fresh.where((F.col("indexing") == "indexed") & Q.active_property(F.col("status")) & (F.col("confidence") >= 80))
    posts = fresh.where(Q.active_post(F.col("status")) & F.col("estate_id").isNotNull())
    return props.select("source_id", F.lit("prop").alias("chain")).union(posts.select("source_id", F.lit("post")))


@query(f"{sql('prefs')} SELECT conv_id, state, created_at FROM prefs WHERE state IN ('ACTIVE_TRACKING') ORDER BY created_at DESC, conv_id LIMIT 300")
def conversation_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest conversations of some states, up to the report's limit."""
    return rows(spark, sf_dir, "prefs").where(F.col("state").isin("ACTIVE_TRACKING")).orderBy(F.desc("created_at"), "conv_id").limit(300).select("conv_id", "state", "created_at")


WORK = {
    "extract": "status = 'pending_extraction'",
    "photo": "status = 'data_extracted'",
    "summary": "status IN ('photo_analysed', 'summary_failed') AND summary_code IS NULL",
    "index": "confidence IS NOT NULL AND indexing IS NULL AND (status IS NULL OR status <> 'archived')",
    "address": "(status IS NULL OR status <> 'archived') AND lat IS NULL",
}


@query(f"{sql('listings')} " + " UNION ALL ".join(f"(SELECT '{name}' AS chain, source_id FROM listings WHERE {test} ORDER BY created_at DESC, source_id LIMIT 200)" for name, test in WORK.items()))
def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each chain's next batch, the newest listings that wait for it (a batch size is the feature)."""
    x = rows(spark, sf_dir, "listings")
    out = None
    for name, test in WORK.items():
        batch = x.where(test).orderBy(F.desc("created_at"), "source_id").limit(200).select(F.lit(name).alias("chain"), "source_id")
        out = batch if out is None else out.union(batch)
    return out


# Matching.

BOUNDS = ("min_price", "max_price", "min_size", "max_size", "min_bedrooms", "max_bedrooms", "min_age", "max_age")
YES = "coalesce(lower(trim({0})) IN ('1', 'true', 'yes'), FALSE)"
NEAR = "abs(x.lat - g.lat) <= 1/69.0 AND abs(x.lng - g.lng) <= (1/69.0) / CASE WHEN cos(radians(x.lat)) = 0 THEN 0.0001 ELSE abs(cos(radians(x.lat))) END"


def preferences(spark: SparkSession, sf_dir: str, number) -> DataFrame:
    """Preferences with their numbers parsed, their wishes as booleans, and the places of their districts."""
    p = C.with_places(rows(spark, sf_dir, "prefs"), "conv_id", "districts", rows(spark, sf_dir, "geocodes"))
    asked = [N.bool_pref(c).alias(f"wish_{c}") for c in ("car", "village", "pets")]
    words = F.transform(F.coalesce("districts", F.array().cast("array<string>")), lambda d: F.lower(F.trim(d)))
    return p.select("conv_id", *[number(c).alias(c) for c in BOUNDS], *asked, "places", words.alias("keywords"))


def wishes() -> dict[str, Column]:
    return columns(*BOUNDS, car="wish_car", village="wish_village", pets="wish_pets")


def prefs_sql(number: str) -> str:
    typed = ", ".join(f"{number.format(f'CAST({c} AS VARCHAR)')} AS {c}" for c in BOUNDS)
    return f"p AS (SELECT conv_id, {typed}, {YES.format('car')} AS wish_car, {YES.format('village')} AS wish_village, {YES.format('pets')} AS wish_pets, districts FROM prefs), g AS (SELECT DISTINCT conv_id, lat, lng FROM (SELECT conv_id, unnest(districts) AS d FROM prefs) JOIN geocodes ON keyword = d)"


MONEY_SQL = f"({MONEY})"
PROP_TEST = f"""(NOT EXISTS (SELECT 1 FROM g WHERE g.conv_id = p.conv_id) OR EXISTS (SELECT 1 FROM g WHERE g.conv_id = p.conv_id AND {NEAR}))
AND (x.beds IS NULL OR ((p.min_bedrooms IS NULL OR x.beds > p.min_bedrooms) AND (p.max_bedrooms IS NULL OR x.beds < p.max_bedrooms + 1)))
AND x.price IS NOT NULL AND (p.min_price IS NULL OR x.price >= p.min_price * 0.8e0) AND (p.max_price IS NULL OR x.price <= p.max_price * 1.1e0)
AND (x.area IS NULL OR ((p.min_size IS NULL OR x.area >= p.min_size * 0.8e0) AND (p.max_size IS NULL OR x.area <= p.max_size * 1.2e0)))
AND (x.age IS NULL OR ((p.min_age IS NULL OR x.age >= p.min_age) AND (p.max_age IS NULL OR x.age <= p.max_age)))
AND (NOT wish_car OR coalesce(x.car, FALSE)) AND (NOT wish_village OR coalesce(x.village, FALSE)) AND (NOT wish_pets OR coalesce(x.pets, FALSE))"""
PROP_PAIRS = f"{sql('listings', 'prefs', 'geocodes')}, {prefs_sql(MONEY_SQL)}, x AS (SELECT *, {MONEY_SQL.format('rent_price')} AS price, {MONEY_SQL.format('bedrooms')} AS beds, net_size AS area FROM listings)"


PROP_TEST_COLUMNS = ("zones", "bedrooms", "price", "size", "age", "car", "village", "pets")


def prop_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    x = rows(spark, sf_dir, "listings").select("k", "lat", "lng", "age", "car", "village", "pets", "confidence", N.whole_money_or_null("rent_price").alias("price"), N.whole_money_or_null("bedrooms").alias("bedrooms"), F.col("net_size").alias("size"))
    p = written(preferences(spark, sf_dir, N.whole_money_or_null))
    return C.zoned(p, C.with_near(x, "k", p).drop("lat", "lng"))


@query(f"{PROP_PAIRS} SELECT p.conv_id, x.k FROM p, x WHERE {PROP_TEST}")
def prop_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listing that meets every preference."""
    p, x = prop_sides(spark, sf_dir)
    return C.match_cells(C.in_zones(p), C.in_zones(x), "k", block_rows=C.PAIR_BLOCK).where(C.prop_matches(wishes(), columns(*PROP_TEST_COLUMNS))).select("conv_id", "k")


@query(f"{PROP_PAIRS} SELECT conv_id, k, place FROM (SELECT p.conv_id, x.k, row_number() OVER (PARTITION BY p.conv_id ORDER BY coalesce(confidence, 0) DESC, k) AS place FROM p, x WHERE {PROP_TEST}) WHERE place <= 6")
def prop_match_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2, C4: the six of the best confidence, a missing one counting 0."""
    p, x = prop_sides(spark, sf_dir)
    confidence = F.coalesce("confidence", F.lit(0))
    found = C.top_matches(p, x, "conv_id", "k", C.prop_matches(wishes(), columns(*PROP_TEST_COLUMNS)), confidence, confidence, 6, exact=True)
    return found.select("conv_id", "k", "place")


WHOLE_SQL = f"({WHOLE})"
FEATURES = "coalesce(list_filter(list_transform(x.features, lambda f: lower(trim(f))), lambda f: f <> ''), [])"


def _has(words: tuple[str, ...]) -> str:
    return "len(list_filter(" + FEATURES + ", lambda f: " + " OR ".join(f"contains(f, '{w}')" for w in words) + ")) > 0"


POST_TEST = f"""(NOT EXISTS (SELECT 1 FROM g WHERE g.conv_id = p.conv_id) OR EXISTS (SELECT 1 FROM g WHERE g.conv_id = p.conv_id AND {NEAR})
 OR len(list_filter(coalesce(p.districts, []), lambda d: trim(d) <> '' AND (contains(x.district_en, lower(trim(d))) OR contains(x.district_zh, lower(trim(d)))))) > 0)
AND (x.beds IS NULL OR ((p.min_bedrooms IS NULL OR x.beds >= p.min_bedrooms) AND (p.max_bedrooms IS NULL OR x.beds <= p.max_bedrooms)))
AND x.price IS NOT NULL AND (p.min_price IS NULL OR x.price >= p.min_price * 0.8e0) AND (p.max_price IS NULL OR x.price <= p.max_price * 1.1e0)
AND (x.area IS NULL OR ((p.min_size IS NULL OR x.area >= p.min_size * 0.8e0) AND (p.max_size IS NULL OR x.area <= p.max_size * 1.2e0)))
AND (x.years IS NULL OR ((p.min_age IS NULL OR x.years >= p.min_age) AND (p.max_age IS NULL OR x.years <= p.max_age)))
AND (NOT wish_car OR len({FEATURES}) = 0 OR {_has(C.CAR_WORDS)}) AND (NOT wish_pets OR len({FEATURES}) = 0 OR {_has(C.PET_WORDS)})
AND (NOT wish_village OR (len({FEATURES}) = 0 AND x.name_zh = '' AND x.name_en = '') OR contains(x.name_zh, '村屋') OR contains(x.name_en, 'village') OR {_has(C.VILLAGE_WORDS)})"""
MID = "coalesce((p.{0} + p.{1}) / 2, p.{0}, p.{1})"


def _near(value: str, low: str, high: str, weight: float, tolerance: float) -> str:
    mid = MID.format(low, high)
    return f"coalesce(CASE WHEN {mid} <> 0 THEN greatest(0, 1 - abs({value} - {mid}) / {mid} / {tolerance}) * {weight} END, 0)"


AGE = "coalesce(nullif(x.updated_at, 0), nullif(x.created_at, 0))"
SCORE = f"{_near('x.price', 'min_price', 'max_price', 45, 0.25)} + {_near('x.area', 'min_size', 'max_size', 25, 0.25)} + {_near('x.beds', 'min_bedrooms', 'max_bedrooms', 20, 1)} + coalesce(greatest(0, least(1, 1 - ({NOW} - {AGE}) / 604800)) * 10, 0)"
POST_PAIRS = f"{sql('listings', 'prefs', 'geocodes', 'estates')}, {prefs_sql(WHOLE_SQL)}, x AS (SELECT l.* EXCLUDE (lat, lng), e.* EXCLUDE (estate_id), CASE WHEN kind = 'sale' THEN coalesce({WHOLE_SQL.format('sell_price')}, {WHOLE_SQL.format('rent_price')}) ELSE coalesce({WHOLE_SQL.format('rent_price')}, {WHOLE_SQL.format('sell_price')}) END AS price, {WHOLE_SQL.format('bedrooms')} AS beds, coalesce(net_size, gross_size) AS area, CASE WHEN built_in > 1800 AND built_in <= {YEAR} THEN {YEAR} - built_in END AS years FROM listings l JOIN estates e ON l.estate_id = e.estate_id)"


def post_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    l = rows(spark, sf_dir, "listings").drop("lat", "lng", "age")
    e = rows(spark, sf_dir, "estates")
    x = l.join(e, "estate_id").select(
        "k", "features", "district_en", "district_zh", "name_en", "name_zh", "lat", "lng", "created_at", "updated_at",
        K.price_of(F.col("kind"), N.int_or_null("rent_price"), N.int_or_null("sell_price")).alias("price"), K.size_of(F.col("net_size"), F.col("gross_size")).alias("size"),
        N.int_or_null("bedrooms").alias("bedrooms"), K.building_age(F.col("built_in"), YEAR).alias("age"),
    )
    p = written(preferences(spark, sf_dir, N.int_or_null))
    facts = C.post_facts(columns("features", "name_en", "name_zh"))
    return C.zoned(p, C.with_named(C.with_near(x.withColumns(facts), "k", p), p).drop("lat", "lng", "features", "name_en", "name_zh", "district_en", "district_zh"))


@query(f"{POST_PAIRS} SELECT conv_id, k, score, place FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, k) AS place FROM (SELECT p.conv_id, x.k, round({SCORE} + 1e-9, 2) AS score FROM p, x WHERE {POST_TEST})) WHERE place <= 6")
def post_match_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts that meet the preferences, the six of the best score."""
    p, x = post_sides(spark, sf_dir)
    # What depends on one side alone is found once for each row of it, so the expression over pairs stays small.
    for name in ("price", "size", "bedrooms"):
        p = p.withColumn(f"mid_{name}", N.midpoint(f"min_{name}", f"max_{name}"))
    x = x.withColumn("fresh", F.least(F.lit(10.0), N.recency("updated_at", "created_at", F.lit(NOW)))).drop("updated_at", "created_at")
    test = C.post_matches(wishes(), columns("zones", "bedrooms", "price", "size", "age", "has_features", "has_words", "says_car", "says_pets", "says_village"))
    weights = {"price": (45.0, 0.25), "size": (25.0, 0.25), "bedrooms": (20.0, 1.0)}
    base = N.around("price", "mid_price", *weights["price"]) + N.around("size", "mid_size", *weights["size"]) + N.around("bedrooms", "mid_bedrooms", *weights["bedrooms"])
    return C.best_matches(p, x, "conv_id", "k", test, base, weights, 6).select("conv_id", "k", "score", "place")


# Queues.

ITEM = "event_id AS id, CASE event_id % 5 WHEN 0 THEN 'sent' ELSE 'pending' END AS status, CAST(floor(epoch(ts)) AS BIGINT) AS created, CASE event_id % 3 WHEN 0 THEN CAST(floor(epoch(ts)) AS BIGINT) + 7200000 WHEN 1 THEN CAST(floor(epoch(ts)) AS BIGINT) + 60 END AS deadline"
QUEUE = f"WITH i AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos, {ITEM} FROM events WHERE event_type = 'view' AND user_id IS NOT NULL), f AS (SELECT *, status = 'pending' AS waits, coalesce(deadline, created + 172800) <= {NOW} AS old FROM i), l AS (SELECT user_id, coalesce(min(pos) FILTER (waits AND NOT old), 1000000000) AS live FROM f GROUP BY 1)"


def queues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A queue for each user: the items of a stored array are few (they live two days), events stand in for them."""
    e = table(spark, sf_dir, "events").where("event_type = 'view' and user_id is not null")
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    item = F.struct(F.col("event_id").alias("id"), F.when(F.col("event_id") % 5 == 0, "sent").otherwise("pending").alias("status"), at.alias("createdAt"), F.when(F.col("event_id") % 3 == 0, at + 7_200_000).when(F.col("event_id") % 3 == 1, at + 60).alias("expired_at"))
    return e.groupBy("user_id").agg(F.array_sort(F.collect_list(item)).alias("q"))


@query(f"{QUEUE} SELECT f.user_id, min(id) FILTER (pos = live) AS first_live, count(*) FILTER (waits AND old AND pos < live) AS expired, string_agg(CASE WHEN waits AND old AND pos < live THEN 'expired' ELSE status END, ',' ORDER BY pos) AS statuses FROM f JOIN l USING (user_id) GROUP BY 1")
def queue_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items before the first live one that have expired are marked, those behind it are not."""
    q = queues(spark, sf_dir)
    return q.select("user_id", Q.first_live(F.col("q"), NOW)["id"].alias("first_live"), Q.n_expired(F.col("q"), NOW).cast("long").alias("expired"), F.array_join(F.transform(Q.expire(F.col("q"), NOW), lambda x: x["status"]), ",").alias("statuses"))


@query(f"{QUEUE} SELECT f.user_id, string_agg(CASE WHEN pos = live THEN 'skipped' ELSE status END, ',' ORDER BY pos) AS statuses FROM f JOIN l USING (user_id) GROUP BY 1")
def queue_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Y2: the item that was picked is written back as skipped, and nothing else."""
    q = queues(spark, sf_dir)
    picked = Q.first_live(F.col("q"), NOW)["id"]
    return q.select("user_id", F.array_join(F.transform(Q.mark_first(F.col("q"), picked, "skipped"), lambda x: x["status"]), ",").alias("statuses"))


DRAIN = f"""{sql('listings', 'prefs', 'users')[5:]}, c AS (SELECT p.*, l.user_id IS NOT NULL AS queued, l.live, f.id AS item FROM prefs p LEFT JOIN l ON l.user_id = p.conv_id LEFT JOIN f ON f.user_id = l.user_id AND f.pos = l.live),
d AS (SELECT c.conv_id, CASE WHEN u.user_id IS NULL THEN 'no_user' WHEN u.phone IS NULL OR u.phone = '' OR u.phone <> c.thread_id THEN 'no_phone' WHEN item IS NULL THEN 'nothing_live' WHEN u.disabled THEN 'no_contact' WHEN x.k IS NULL THEN 'not_found' WHEN x.status IS DISTINCT FROM 'published' THEN 'inactive' WHEN x.building = '' THEN 'no_id' WHEN c.updated_at % 7 = 0 THEN 'not_saved' WHEN c.conv_id % 5 = 0 THEN 'not_sent' ELSE 'sent' END AS outcome
FROM c LEFT JOIN users u ON u.user_id = c.conv_id AND u.status IS DISTINCT FROM 'deleted' LEFT JOIN listings x ON x.k = c.item WHERE c.state = 'ACTIVE_TRACKING' AND c.updated_at <= {NOW - 10800} AND queued)"""


@query(f"{QUEUE}, {DRAIN} SELECT conv_id, outcome, CASE WHEN outcome = 'sent' THEN 'sent' WHEN outcome IN ('no_user', 'no_phone', 'nothing_live', 'inactive') THEN 'skipped' ELSE 'failed' END AS counted FROM d")
def queue_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each conversation's turn ends, checks in their order; the messenger's answers
    are seams (flags of the tables)."""
    conv = rows(spark, sf_dir, "prefs").join(queues(spark, sf_dir).withColumnRenamed("user_id", "conv_id"), "conv_id")
    conv = conv.where(Q.may_send(F.col("state"), F.col("updated_at"), [F.expr("array(named_struct('status', 'pending'))")], NOW)).withColumn("item", Q.first_live(F.col("q"), NOW)["id"])
    u = rows(spark, sf_dir, "users").where(~F.col("status").eqNullSafe(F.lit("deleted"))).select(F.col("user_id").alias("conv_id"), F.lit(True).alias("known"), "disabled", F.array(F.struct(F.lit("phone").alias("type"), F.col("phone").alias("key"))).alias("identifiers"))
    x = rows(spark, sf_dir, "listings").select(F.col("k").alias("item"), F.lit(True).alias("found"), F.col("status").alias("x_status"), "building")
    j = conv.join(u, "conv_id", "left").join(x, "item", "left")
    own = U.phone_matches(F.col("identifiers"), F.col("thread_id")) & (F.coalesce(F.col("identifiers")[0]["key"], F.lit("")) != "")
    checks = [
        (F.col("known"), "no_user"), (own, "no_phone"), (F.col("item").isNotNull(), "nothing_live"), (~F.col("disabled"), "no_contact"), (F.col("found"), "not_found"),
        (Q.active_post(F.col("x_status")), "inactive"), (F.col("building") != "", "no_id"), (F.col("updated_at") % 7 != 0, "not_saved"), (F.col("conv_id") % 5 != 0, "not_sent"),
    ]
    out = j.select("conv_id", M.first_outcome(checks, "sent").alias("outcome"))
    counted = F.when(F.col("outcome") == "sent", "sent").when(F.col("outcome").isin("no_user", "no_phone", "nothing_live", "inactive"), "skipped").otherwise("failed")
    return out.withColumn("counted", counted)


# Threads.

PREFIX = "A"
THREAD = "WITH m AS (SELECT conv_id % 8 AS thread, row_number() OVER (PARTITION BY conv_id % 8 ORDER BY conv_id, turn, role, text) - 1 AS i, CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'ai' ELSE role END AS type, text FROM conversations), c AS (SELECT *, type = 'system' AND starts_with(coalesce(text, ''), 'A') AS cur FROM m), l AS (SELECT thread, max(i) FILTER (cur) AS last FROM c GROUP BY 1), k AS (SELECT c.*, row_number() OVER (PARTITION BY c.thread ORDER BY i) - 1 AS j FROM c JOIN l USING (thread) WHERE NOT cur OR i = last)"


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories of several conversations each: a stored array of messages, which summaries keep short."""
    c = table(spark, sf_dir, "conversations")
    kind = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "ai").otherwise(F.col("role"))
    m = F.struct("conv_id", "turn", "role", "text", kind.alias("type"))
    grouped = c.groupBy((F.col("conv_id") % 8).alias("thread")).agg(F.array_sort(F.collect_list(m)).alias("m"))
    return grouped.select("thread", F.transform("m", lambda x: F.struct(x["type"].alias("type"), x["text"].alias("content"))).alias("messages"))


@query(f"{THREAD}, s AS (SELECT thread, count(*) AS n, sum(length(coalesce(text, ''))) AS chars, coalesce(max(j) FILTER (cur), -1) AS place FROM k GROUP BY 1), o AS (SELECT k.thread, count(*) FILTER (j < n - 6 AND type IN ('human', 'ai') AND trim(coalesce(text, '')) <> '') AS said FROM k JOIN s USING (thread) GROUP BY 1), d AS (SELECT *, (n > 12 OR chars > 2800) AND n > 8 AND said > 0 AS due FROM s JOIN o USING (thread)) SELECT thread, CAST((SELECT coalesce(last, -1) FROM l WHERE l.thread = d.thread) AS INTEGER) AS curated, due, said AS dialogue, CASE WHEN due THEN 7 + CASE WHEN place >= 0 AND place < n - 6 THEN 1 ELSE 0 END ELSE (SELECT count(*) FROM m WHERE m.thread = d.thread) END AS next_size, CASE WHEN due THEN 'system' ELSE (SELECT type FROM m WHERE m.thread = d.thread AND i = 0) END AS next_first FROM d")
def thread_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which histories are due for a summary, and what is left of them."""
    t = T.with_rewrite(threads(spark, sf_dir).withColumn("summary", F.lit("what was said")), PREFIX, "summary")
    return t.select("thread", T.latest_curated(F.col("messages"), PREFIX).alias("curated"), "due", F.size("dialogue").cast("long").alias("dialogue"), F.size("next").cast("long").alias("next_size"), F.col("next")[0]["type"].alias("next_first"))


@query("WITH m AS (SELECT conv_id % 8 AS code, row_number() OVER (PARTITION BY conv_id % 8 ORDER BY conv_id, turn, role, text) - 1 AS index FROM conversations), b AS (SELECT code, index // 10 AS batch, min(index) AS low, max(index) AS high FROM m GROUP BY 1, 2) SELECT m.code, CAST(m.index AS INTEGER) AS index FROM m JOIN b ON m.code = b.code AND m.index // 10 = b.batch WHERE b.low >= 5 AND b.high <= 25")
def archived_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of a range from archived batches of ten; batches that reach beyond the range are left out."""
    t = threads(spark, sf_dir).select(F.col("thread").alias("code"), F.posexplode("messages").alias("index", "m"))
    b = t.groupBy("code", F.floor(F.col("index") / 10).alias("batch")).agg(F.min("index").alias("fromIndex"), F.max("index").alias("toIndex"), F.collect_list(F.struct("index")).alias("messages"))
    return T.message_range(b, 5, 25).select("code", "index")


@query("SELECT conv_id % 8 AS thread, count(*) FILTER (role IN ('user', 'system') OR (role = 'assistant' AND coalesce(text, '') <> '')) AS meaningful FROM conversations GROUP BY 1")
def thread_meaningful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that a request carries."""
    return threads(spark, sf_dir).select("thread", F.size(T.meaningful(F.col("messages"))).cast("long").alias("meaningful"))


# Users.

@query(f"{sql('users', 'prefs')}, a AS (SELECT * FROM users WHERE status IS DISTINCT FROM 'deleted'), known AS (SELECT conv_id, thread_id FROM prefs WHERE conv_id % 3 = 0), b AS (SELECT *, CASE WHEN phone IS NULL OR phone = '' THEN 'no_phone' WHEN user_id IN (SELECT conv_id FROM known) THEN 'exists' WHEN phone IN (SELECT thread_id FROM known) THEN 'thread_conflict' ELSE 'created' END AS o FROM a) SELECT user_id, CASE WHEN o = 'created' AND row_number() OVER (PARTITION BY phone, o ORDER BY user_id) > 1 THEN 'thread_conflict' ELSE o END AS outcome, CASE WHEN v2_state IN ('ACTIVE_TRACKING', 'MUTED') THEN v2_state WHEN v2_state IS NOT NULL OR muted OR disabled THEN 'MUTED' ELSE 'ACTIVE_TRACKING' END AS state, lower(trim(coalesce(nullif(v2_language, ''), nullif(old_language, ''), 'zh-hk'))) AS language FROM b")
def conversation_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who gets a conversation, and with which state and language."""
    known = rows(spark, sf_dir, "prefs").where("conv_id % 3 = 0").select(F.col("conv_id").alias("user_id"), "thread_id")
    out = U.bootstrap(rows(spark, sf_dir, "users"), known)
    return out.select("user_id", "outcome", U.state_of(F.col("v2_state"), F.col("muted"), F.col("disabled")).alias("state"), U.language_of(F.col("v2_language"), F.col("old_language")).alias("language"))


@query("WITH o AS (SELECT s_suppkey AS licence, CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE 0 END AS admins FROM supplier WHERE s_suppkey % 3 <> 0), n AS (SELECT s_suppkey AS licence, max(s_name || CAST(d AS VARCHAR)) AS name FROM supplier, (VALUES (1), (2)) v(d) GROUP BY 1) SELECT n.licence, name, CASE WHEN o.licence IS NULL THEN 'insert' WHEN admins = 0 THEN 'update' ELSE 'none' END AS action FROM n LEFT JOIN o ON o.licence = n.licence")
def agent_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agents that are inserted, updated, or left alone because somebody manages them."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("licence"), "s_name")
    old = s.where("licence % 3 <> 0").select("licence", F.when(F.col("licence") % 4 == 0, F.array(F.lit("a"))).alias("admins"))
    new = s.select("licence", F.explode(F.transform(F.array(F.lit(1), F.lit(2)), lambda d: F.concat("s_name", d.cast("string")))).alias("name"))
    return U.guarded_upsert(old, new, "licence")


@query()
def short_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique short ids; tested for uniqueness, repetition and ids that are there."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("id"), "c_custkey")).alias("short_id"))
    return I.assign_short_ids(c, "c_custkey")


# Batches.

QUOTE = "chr(92) || chr(34)"
LINE = f"CASE doc_id % 9 WHEN 0 THEN 'broken' || CAST(doc_id AS STRING) WHEN 1 THEN '{{\"custom_id\":\"other-1\"}}' WHEN 2 THEN '{{\"custom_id\":\"summary-' || CAST(doc_id AS STRING) || '\",\"error\":{{\"code\":1}}}}' WHEN 3 THEN '{{\"custom_id\":\"match-post-' || CAST(doc_id AS STRING) || '\",\"response\":{{\"body\":{{\"choices\":[]}}}}}}' WHEN 4 THEN '{{\"custom_id\":\"match-' || CAST(doc_id AS STRING) || '\",\"response\":{{\"body\":{{\"choices\":[{{\"message\":{{\"content\":\"no json\"}}}}]}}}}}}' ELSE '{{\"custom_id\":\"task-' || CAST(doc_id AS STRING) || '\",\"response\":{{\"body\":{{\"choices\":[{{\"message\":{{\"content\":\"{{' || {QUOTE} || 'headline_en' || {QUOTE} || ':' || {QUOTE} || lang || {QUOTE} || '}}\"}}}}]}}}}}}' END"
PREFIXES = ("summary-", "match-post-", "match-", "task-")


@query(f"WITH l AS (SELECT doc_id, {LINE} AS line FROM documents), p AS (SELECT doc_id, json_valid(line) AS ok, CASE WHEN json_valid(line) THEN line ELSE '{{}}' END AS j FROM l), q AS (SELECT *, json_extract_string(j, '$.custom_id') AS cid, json_extract_string(j, '$.response.body.choices[0].message.content') AS content FROM p), r AS (SELECT *, CASE WHEN cid LIKE 'summary-%' THEN substr(cid, 9) WHEN cid LIKE 'match-post-%' THEN substr(cid, 12) WHEN cid LIKE 'match-%' THEN substr(cid, 7) WHEN cid LIKE 'task-%' THEN substr(cid, 6) END AS id FROM q), s AS (SELECT *, CASE WHEN NOT ok THEN 'bad_line' WHEN id IS NULL THEN 'no_id' WHEN json_extract(j, '$.error') IS NOT NULL THEN 'row_error' WHEN content IS NULL THEN 'no_choices' WHEN NOT json_valid(content) THEN 'bad_json' END AS error FROM r) SELECT doc_id, id, error, CASE WHEN error IS NULL THEN json_extract_string(content, '$.headline_en') END AS headline FROM s")
def batch_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result lines with their errors, and the headline under its default name."""
    lines = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{LINE} AS line")
    found = B.ingest(lines, PREFIXES)
    return found.select("doc_id", "id", "error", B.with_default_names(F.col("content"), {"headline": "headline_en"})["headline"].alias("headline"))


TRACKED = ("o_orderkey AS batch_id", "CASE o_orderkey % 3 WHEN 0 THEN 'extract' WHEN 1 THEN 'match' ELSE 'summary' END AS chain", "'validating' AS status")
REPORTED = ("o_orderkey AS batch_id", "CASE o_orderkey % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'in_progress' WHEN 2 THEN 'expired' ELSE 'completed' END AS status")


@query(f"WITH b AS (SELECT {', '.join(TRACKED)} FROM orders), f AS (SELECT {', '.join(REPORTED)} FROM orders WHERE o_orderkey % 7 <> 0), j AS (SELECT b.batch_id, chain, coalesce(f.status, b.status) AS status FROM b LEFT JOIN f ON f.batch_id = b.batch_id) SELECT chain, CASE WHEN status IN ('completed', 'failed') THEN status ELSE 'pending' END AS outcome, CASE WHEN status = 'completed' THEN 'moved' WHEN status IN ('failed', 'expired') AND chain = 'match' THEN 'deleted' WHEN status IN ('failed', 'expired') AND chain = 'summary' THEN 'kept_failed' ELSE 'kept' END AS tracking, count(*) AS n FROM j GROUP BY 1, 2, 3")
def batch_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The control table after a report, counted by what becomes of the batches."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    found = o.where("o_orderkey % 7 <> 0").selectExpr(*REPORTED)
    return B.track(o.selectExpr(*TRACKED), found).groupBy("chain", "outcome", "tracking").agg(F.count("*").alias("n"))


COUNTS = "s AS (SELECT source_id, count(*) FILTER (status = 'photo_analysed') AS done, count(*) FILTER (status = 'photo_analysis_failed') AS bad, count(*) FILTER (status = 'batch_created') AS waiting FROM photos GROUP BY 1)"


@query(f"{sql('listings', 'photos')}, {COUNTS} SELECT l.source_id, CASE WHEN status = 'archived' THEN status WHEN status = 'pending_extraction' THEN CASE WHEN confidence IS NOT NULL THEN 'data_extracted' ELSE status END WHEN status = 'data_extracted' THEN CASE WHEN coalesce(waiting, 0) > 0 THEN 'photo_analysing' ELSE 'photo_analysed' END WHEN status = 'photo_analysing' THEN CASE WHEN coalesce(done, 0) > 0 THEN 'photo_analysed' WHEN coalesce(bad, 0) > 0 THEN 'photo_analysis_failed' ELSE status END ELSE status END AS status FROM listings l LEFT JOIN s ON s.source_id = l.source_id")
def listing_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each listing's next status from its photos."""
    s = rows(spark, sf_dir, "photos").groupBy("source_id").agg(*[F.count_if(F.col("status") == v).alias(a) for v, a in (("photo_analysed", "done"), ("photo_analysis_failed", "bad"), ("batch_created", "waiting"))])
    j = rows(spark, sf_dir, "listings").join(s, "source_id", "left").fillna(0, ["done", "bad", "waiting"])
    return j.select("source_id", B.next_listing_status(F.col("status"), F.col("confidence").isNotNull(), F.col("waiting"), F.col("done"), F.col("bad")).alias("status"))


@query(f"{sql('photos')}, {COUNTS} SELECT source_id, CASE WHEN done > 0 THEN 'photo_analysed' ELSE 'photo_analysis_failed' END AS status FROM s WHERE waiting = 0")
def stuck_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings none of whose photos waits."""
    return B.resolve_stuck(rows(spark, sf_dir, "photos"))


@query("WITH s AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'batch_created' WHEN 1 THEN 'batch_uploaded' WHEN 2 THEN 'batch_completed' ELSE 'summary_ready' END AS status, doc_id % 3 = 0 AS up, CASE doc_id % 5 WHEN 0 THEN 'completed' WHEN 1 THEN 'failed' END AS batch, CASE WHEN doc_id % 6 = 0 THEN 'e' END AS error, n_chars FROM documents) SELECT doc_id, CASE status WHEN 'batch_created' THEN CASE WHEN up THEN 'batch_uploaded' ELSE status END WHEN 'batch_uploaded' THEN CASE batch WHEN 'completed' THEN 'batch_completed' WHEN 'failed' THEN 'summary_failed' ELSE status END WHEN 'batch_completed' THEN CASE WHEN error IS NULL THEN 'summary_ready' ELSE 'summary_failed' END ELSE status END AS status, CASE WHEN length(coalesce(text, '')) >= 20 THEN CASE WHEN doc_id % 8 = 0 THEN 'indexing_failed' ELSE 'indexed' END END AS indexed FROM s JOIN documents USING (doc_id)")
def summary_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The machines of summaries and of the index."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    state = F.element_at(F.array(*map(F.lit, ("batch_created", "batch_uploaded", "batch_completed", "summary_ready"))), (F.col("doc_id") % 4 + 1).cast("int"))
    batch = F.when(F.col("doc_id") % 5 == 0, "completed").when(F.col("doc_id") % 5 == 1, "failed")
    return d.select("doc_id", B.next_summary_status(state, F.col("doc_id") % 3 == 0, batch, F.when(F.col("doc_id") % 6 == 0, "e")).alias("status"), B.index_status(F.col("text"), F.col("doc_id") % 8 == 0).alias("indexed"))


# Photos and records.

@query(f"{sql('photos')} SELECT source_id, photo_id, place FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY quality DESC NULLS LAST, photo_id) AS place FROM photos WHERE status = 'photo_analysed' AND is_property AND NOT is_violating AND NOT is_human) WHERE place <= 2")
def best_photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two best photos of each listing that may be shown."""
    return E.best_photos(rows(spark, sf_dir, "photos")).select("source_id", "photo_id", "place")


@query(f"{sql('photos')} SELECT photo_id, CASE WHEN photo_id % 4 = 0 THEN blob_url END AS blob_url, CASE WHEN photo_id % 4 = 0 THEN photo_id + 5 END AS redownloaded_at, CASE WHEN photo_id % 4 = 0 THEN 'redownloaded' ELSE 'failed' END AS outcome FROM photos WHERE blob_url IS NOT NULL AND redownloaded_at IS NULL")
def photo_redownload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second download leaves of a photo's address."""
    p = rows(spark, sf_dir, "photos")
    return B.redownload(p, p.select("photo_id", (F.col("photo_id") % 4 == 0).alias("ok"), (F.col("photo_id") + 5).alias("at")))


LINKS = "CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN {0}('u1', 'u2', 'u1', 'u3') WHEN 2 THEN {0}('u' || CAST(k AS STRING)) ELSE {0}('u1', 'u2', 'u3', 'u4') END"
MORE = "CASE k % 3 WHEN 0 THEN {0}('u2', 'x' || CAST(k AS STRING)) END"


@query(f"{sql('listings')}, a AS (SELECT source_id, k, coalesce({LINKS.format('list_value')}, []) || coalesce({MORE.format('list_value')}, []) AS l FROM listings), f AS (SELECT source_id, k, unnest(l) AS u, generate_subscripts(l, 1) AS i FROM a), o AS (SELECT source_id, k, u, row_number() OVER (PARTITION BY source_id ORDER BY min(i)) - 1 AS pos, count(*) OVER (PARTITION BY source_id) AS n FROM f GROUP BY source_id, k, u) SELECT source_id, CAST(pos AS INTEGER) AS pos, u AS photo_url FROM o WHERE pos < CASE WHEN n <= 1 THEN n WHEN n <= 3 THEN 2 ELSE 1 END AND NOT (u = 'u1' AND k % 4 = 0) AND u <> 'x9'")
def photo_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New photos of each listing, as many as its number of links calls for."""
    x = rows(spark, sf_dir, "listings").selectExpr("source_id", "k", f"{LINKS.format('array')} AS links", f"{MORE.format('array')} AS photo_urls")
    there = x.where("k % 4 = 0").select("source_id", F.lit("u1").alias("photo_url"))
    answered = x.select(F.explode(F.concat(F.coalesce("links", F.array().cast("array<string>")), F.coalesce("photo_urls", F.array().cast("array<string>")))).alias("photo_url")).where("photo_url <> 'x9'")
    return E.photo_candidates(x, there, answered)


CAPTION = "CASE WHEN lang = 'zh-hk' THEN source_id || ' - ' || concat_ws('，', CASE WHEN kind = 'rent' THEN '租盤' ELSE '售盤' END || ': ' || m, beds || '房', CAST(area AS VARCHAR) || '平方呎') WHEN lang = 'zh-cn' THEN source_id || ' - ' || concat_ws('，', CASE WHEN kind = 'rent' THEN '租盘' ELSE '售盘' END || ': ' || m, beds || '房', CAST(area AS VARCHAR) || '平方英尺') ELSE source_id || ' - ' || concat_ws(', ', CASE WHEN kind = 'rent' THEN 'Rent' ELSE 'Sale' END || ': ' || m, beds || ' bed', CAST(area AS VARCHAR) || ' sqft') END"


@query(f"{sql('listings')}, c AS (SELECT *, CASE k % 3 WHEN 0 THEN 'zh-hk' WHEN 1 THEN 'zh-cn' ELSE 'en' END AS lang, {WHOLE.format('bedrooms')} AS beds, coalesce(net_size, gross_size) AS area, CASE WHEN kind = 'sale' THEN coalesce({WHOLE.format('sell_price')}, {WHOLE.format('rent_price')}) ELSE coalesce({WHOLE.format('rent_price')}, {WHOLE.format('sell_price')}) END AS price FROM listings), d AS (SELECT *, coalesce('$' || format('{{:,}}', price), 'N/A') AS m FROM c) SELECT source_id, {CAPTION} AS caption FROM d")
def post_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions in three languages; details that are not known are left out."""
    lang = F.when(F.col("k") % 3 == 0, "zh-hk").when(F.col("k") % 3 == 1, "zh-cn").otherwise("en")
    price = K.price_of(F.col("kind"), N.int_or_null("rent_price"), N.int_or_null("sell_price"))
    caption = E.post_caption(E.post_title(F.lit(" "), F.col("source_id")), F.col("kind"), price, N.int_or_null("bedrooms"), F.lit(None).cast("bigint"), K.size_of(F.col("net_size"), F.col("gross_size")), lang)
    return rows(spark, sf_dir, "listings").select("source_id", caption.alias("caption"))


@query(f"{sql('templates')}, w AS (SELECT c_custkey AS id, CAST(c_custkey % 7 AS INTEGER) AS count, CASE c_custkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'zh-hk' ELSE 'fr' END AS lang FROM customer) SELECT id, count, w.lang, max(n) AS n, arg_max(template, n) AS template FROM w LEFT JOIN templates t ON t.lang = w.lang AND t.n <= least(count, 4) GROUP BY 1, 2, 3")
def template_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The template of the largest number of listings that is not above what there is."""
    w = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 7).cast("int").alias("count"), F.when(F.col("c_custkey") % 3 == 0, "en").when(F.col("c_custkey") % 3 == 1, "zh-hk").otherwise("fr").alias("lang"))
    return E.choose_templates(w, rows(spark, sf_dir, "templates"))


@query(f"{sql('listings')} SELECT source_id, CASE WHEN channel = 'house730' THEN 4 ELSE 1 END AS channel_id, CASE WHEN kind = 'sale' THEN 1 ELSE 2 END AS listing_type, coalesce(CASE WHEN kind = 'sale' THEN {WHOLE.format('sell_price')} ELSE {WHOLE.format('rent_price')} END, 0) AS price_from, CAST(coalesce(net_size, 0) AS BIGINT) AS net_size, round(CASE WHEN net_size > 0 THEN nullif(coalesce(CASE WHEN kind = 'sale' THEN {WHOLE.format('sell_price')} ELSE {WHOLE.format('rent_price')} END, 0), 0) / net_size END + 1e-9, 4) AS price_sqft FROM listings")
def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the relational export."""
    kind = F.when(F.col("kind") == "sale", "sell").otherwise("rent")
    made = E.export_row(kind, N.int_or_null("rent_price"), N.int_or_null("sell_price"), F.col("net_size"))
    made["price_sqft"] = N.nudged_round(made["price_sqft"], 4)
    return rows(spark, sf_dir, "listings").select("source_id", E.channel_id(F.col("channel")).alias("channel_id"), *[c.alias(n) for n, c in made.items()])


@query(f"{sql('listings')} SELECT source_id, trim(concat_ws(' ', nullif(building, ''), nullif(district, ''), array_to_string(coalesce(features, [])[1:5], ' '))) AS text FROM listings")
def index_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text that is indexed."""
    return rows(spark, sf_dir, "listings").select("source_id", E.index_text(F.col("building"), F.col("district"), E.first_five(F.col("features"))).alias("text"))


@query(f"{sql('listings')} SELECT source_id, (reviewed_at IS NULL OR reviewed_at <= {NOW - 6 * 3600}) AND status IS DISTINCT FROM 'archived' AS review, {NOW} - updated_at >= {3 * DAY} AS rescrape, coalesce(k % 50 * 10 >= 400, TRUE) OR (k % 4 = 1) AS removed FROM listings")
def due_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """listings that are due for a review or a new scrape, and those whose page is gone."""
    url = F.concat(F.lit("https://p.example/"), "source_id")
    final = F.when(F.col("k") % 4 == 1, F.lit("https://p.example/")).when(F.col("k") % 4 == 2, F.concat(url, F.lit("/"))).otherwise(url)
    gone = G.removed(F.col("k") % 50 * 10, url, final, F.lit("<html></html>"))
    return rows(spark, sf_dir, "listings").select("source_id", G.due_review("reviewed_at", "status", NOW).alias("review"), G.stale("updated_at", NOW).alias("rescrape"), gone.alias("removed"))


# Places.

LOOKUP = "SELECT 'Sha Tin ' || building AS query, rank, score, 'B' || CAST(rank AS VARCHAR) AS building_en, 'D' AS district_en, lat, lng FROM (SELECT DISTINCT building FROM listings WHERE building <> 'Estate 3'), (VALUES (1, 80e0, 22.1e0, 114e0), (2, 90e0, 22.2e0, 114.1e0)) v(rank, score, lat, lng) UNION ALL SELECT 'Tai Po', 1, 40e0, 'T', 'TP', 22.4e0, 114.2e0 UNION ALL SELECT 'Tai Po Estate 7', 1, 54e0, 'T7', 'TP', 22.4e0, 114.2e0"


@query(f"{sql('listings')}, lk AS ({LOOKUP}), q AS (SELECT source_id, building, nullif(concat_ws(' ', nullif(trim(district), ''), nullif(trim(building), '')), '') AS query FROM listings), b AS (SELECT query, arg_min(score, (rank, building_en)) AS score, arg_min(building_en, (rank, building_en)) AS building_en, arg_min(district_en, (rank, building_en)) AS district_en, arg_min(lat, (rank, building_en)) AS lat FROM lk GROUP BY 1) SELECT source_id, q.query, CASE WHEN b.query IS NULL THEN NULL WHEN building = '' OR score < 55 THEN 'district' ELSE 'building' END AS level, district_en, CASE WHEN building <> '' AND score >= 55 THEN building_en END AS building_en, score, lat, CASE WHEN b.query IS NULL THEN 'not_found' END AS error FROM q LEFT JOIN b ON b.query = q.query")
def address_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first suggestion for each listing, with its building only above the score's gate."""
    x = rows(spark, sf_dir, "listings").select("source_id", "district", "building")
    made = x.where("building <> 'Estate 3'").select(F.concat(F.lit("Sha Tin "), "building").alias("query")).distinct()
    two = F.array(*[F.struct(F.lit(r).alias("rank"), F.lit(s).alias("score"), F.lit(f"B{r}").alias("building_en"), F.lit("D").alias("district_en"), F.lit(a).alias("lat"), F.lit(b).alias("lng")) for r, s, a, b in ((1, 80.0, 22.1, 114.0), (2, 90.0, 22.2, 114.1))])
    more = spark.createDataFrame([("Tai Po", 1, 40.0, "T", "TP", 22.4, 114.2), ("Tai Po Estate 7", 1, 54.0, "T7", "TP", 22.4, 114.2)], "query string, rank int, score double, building_en string, district_en string, lat double, lng double")
    lookups = made.select("query", F.explode(two).alias("v")).select("query", "v.*").unionByName(more)
    return P.map_addresses(x, lookups).drop("lng")


@query(f"{sql('estates')}, old AS (SELECT estate_id AS id, name_en, name_zh, 0 AS v FROM estates WHERE estate_id % 2 = 0), n AS (SELECT DISTINCT name_en, name_zh, 1 AS v FROM estates WHERE estate_id % 3 = 0 AND (name_en <> '' OR name_zh <> '')), h AS (SELECT n.name_en, n.name_zh, min(old.id) AS id FROM n JOIN old ON (n.name_en <> '' AND n.name_en = old.name_en) OR (n.name_zh <> '' AND n.name_zh = old.name_zh) GROUP BY 1, 2), w AS (SELECT id, name_en, name_zh FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY name_en DESC, name_zh DESC) AS r FROM h) WHERE r = 1) SELECT old.id, coalesce(w.name_en, old.name_en) AS name_en, coalesce(w.name_zh, old.name_zh) AS name_zh, CASE WHEN w.id IS NULL THEN 0 ELSE 1 END AS v FROM old LEFT JOIN w ON w.id = old.id UNION ALL SELECT NULL, name_en, name_zh, 1 FROM n WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.name_en = n.name_en AND h.name_zh = n.name_zh)")
def estate_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An estate replaces the one of either name; nameless ones match nothing."""
    e = rows(spark, sf_dir, "estates")
    old = e.where("estate_id % 2 = 0").select(F.col("estate_id").alias("id"), "name_en", "name_zh", F.lit(0).alias("v"))
    new = e.where("estate_id % 3 = 0").select("name_en", "name_zh", F.lit(1).alias("v"))
    return P.upsert_by_names(old, new, ["name_en", "name_zh", "v"])


@query(f"{sql('listings')}, r AS (SELECT source_id, k % 3 AS channel_id, CASE k % 6 WHEN 0 THEN 'HK, ' || district WHEN 1 THEN '' ELSE district END AS district FROM listings), w AS (SELECT *, trim(list_extract(string_split(replace(district, ',', ' '), ' '), -1)) AS keyword FROM r), ref AS (SELECT n_nationkey AS ref_id, n_nationkey % 2 AS channel_id, n_name AS district, CASE n_nationkey % 4 WHEN 0 THEN 'Chai Wan' WHEN 1 THEN 'Tin Tong' ELSE 'Po' END AS district_chi FROM nation) SELECT source_id, keyword, min(ref_id) AS ref_id, CASE WHEN min(ref_id) IS NULL THEN 'district_not_found' END AS error FROM w LEFT JOIN ref ON ref.channel_id = w.channel_id AND (contains(ref.district_chi, keyword) OR contains(ref.district, keyword)) GROUP BY source_id, keyword")
def district_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first reference of the channel that holds the last word of a district."""
    d = F.when(F.col("k") % 6 == 0, F.concat(F.lit("HK, "), "district")).when(F.col("k") % 6 == 1, "").otherwise(F.col("district"))
    r = rows(spark, sf_dir, "listings").select("source_id", (F.col("k") % 3).alias("channel_id"), d.alias("district"))
    chi = F.when(F.col("n_nationkey") % 4 == 0, "Chai Wan").when(F.col("n_nationkey") % 4 == 1, "Tin Tong").otherwise("Po")
    ref = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ref_id"), (F.col("n_nationkey") % 2).cast("bigint").alias("channel_id"), F.col("n_name").alias("district"), chi.alias("district_chi"))
    return P.district_like(r, ref)


@query("WITH p AS (SELECT p_brand AS query, CASE p_partkey % 4 WHEN 0 THEN upper(p_brand) WHEN 1 THEN p_name || ' ' || p_brand ELSE p_name END AS name, p_partkey AS pos, CASE p_partkey % 3 WHEN 0 THEN 'region' ELSE 'estate' END AS kind FROM part), r AS (SELECT *, CASE WHEN query <> '' AND lower(name) = lower(query) THEN 0 WHEN query <> '' AND contains(lower(name), lower(query)) THEN 1 ELSE 2 END AS rank FROM p WHERE kind = 'estate') SELECT query, name, pos FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY rank, pos) AS n FROM r) WHERE n = 1")
def place_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The very name, else one that holds it, else the first, among the allowed kinds."""
    name = F.when(F.col("p_partkey") % 4 == 0, F.upper("p_brand")).when(F.col("p_partkey") % 4 == 1, F.concat("p_name", F.lit(" "), "p_brand")).otherwise(F.col("p_name"))
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("query"), name.alias("name"), F.col("p_partkey").alias("pos"), F.when(F.col("p_partkey") % 3 == 0, "region").otherwise("estate").alias("kind"))
    return P.pick_place(p, ("estate",))


@query("WITH u AS (SELECT user_id, count(*) FILTER (event_type = 'view') AS a, count(*) FILTER (event_type = 'click') AS b, count(*) FILTER (event_type = 'error') AS c FROM events WHERE user_id IS NOT NULL AND ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2024-01-31 23:59:59' GROUP BY 1) SELECT user_id, CASE WHEN a < 2 THEN 'enterprise_atmosphere' WHEN b < 2 THEN 'enterprise' WHEN c < 2 THEN 'pro' END AS tier FROM u")
def tier_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The highest tier whose month is not used up; null means the free search."""
    e = table(spark, sf_dir, "events").where("user_id is not null and ts >= timestamp '2024-01-01 00:00:00' and ts < timestamp '2024-01-31 23:59:59'")
    kinds = {"enterprise_atmosphere": "view", "enterprise": "click", "pro": "error"}
    u = e.groupBy("user_id").agg(*[F.count_if(F.col("event_type") == k).alias(t) for t, k in kinds.items()])
    return u.select("user_id", P.tier({t: F.col(t) for t in kinds}, dict.fromkeys(kinds, 2), tuple(kinds)).alias("tier"))


@query(f"WITH a AS (SELECT user_id AS key, CAST(floor(epoch(ts)) AS BIGINT) AS created_at, event_id AS result FROM events WHERE event_type = 'click'), b AS (SELECT key, arg_max(result, (created_at, result)) AS result FROM a WHERE created_at > {NOW - 5 * DAY} AND key IS NOT NULL GROUP BY 1) SELECT c_custkey AS key, result, result IS NOT NULL AS hit FROM customer LEFT JOIN b ON b.key = c_custkey")
def cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest answer that is not too old."""
    a = table(spark, sf_dir, "events").where("event_type = 'click'").select(F.col("user_id").alias("key"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("created_at"), F.col("event_id").alias("result"))
    return P.cached(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")), a, NOW, 5 * DAY)


@query(r"SELECT page_id, CASE WHEN len(p) >= 3 THEN 'web-' || list_extract(string_split(list_extract(p, -1), '-'), -1) END AS source_id, CASE WHEN len(p) >= 3 THEN list_extract(p, -2) END AS prop_type FROM (SELECT page_id, list_filter(string_split(regexp_extract(url || '/x-' || page_id, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS p FROM pages)")
def listing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and types of listings from their addresses."""
    s = G.source_fields(F.concat("url", F.lit("/x-"), F.col("page_id").cast("string")), "web")
    return table(spark, sf_dir, "pages").select("page_id", s["source_id"].alias("source_id"), s["prop_type"].alias("prop_type"))


STEP = "SELECT user_id, event_id, event_type AS channel, value, event_type || '|' || CAST(floor(value / 40) AS BIGINT) AS fp, CASE WHEN event_id % 6 = 0 THEN 'high' ELSE 'medium' END AS confidence, CASE user_id % 3 WHEN 0 THEN '28hse' WHEN 1 THEN 'midland' ELSE 'house730' END AS portal FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL"


@query(f"WITH e AS ({STEP}), p AS (SELECT *, lag(fp) OVER w AS old, lag(floor(value / 40)) OVER w AS old_price, lag(channel) OVER w AS old_title FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id)), r AS (SELECT *, old IS NOT NULL AND old <> fp AS differs, old IS NOT NULL AND old <> fp AND (confidence = 'high' OR portal = '28hse') AS changed, concat_ws(',', CASE WHEN old_price <> floor(value / 40) THEN 'price_changed' END, CASE WHEN old_title <> channel THEN 'title_changed' END) AS why FROM p) SELECT user_id, event_id, CASE WHEN old IS NULL THEN 'initial_monitor' WHEN NOT differs THEN '' WHEN changed THEN why ELSE 'pending:' || replace(why, ',', ',pending:') END AS reasons, changed, differs AND NOT changed AS candidate, CAST(count(*) FILTER (changed) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS change_count FROM r")
def monitor_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change monitor over every listing's snapshots, as defined: a two-hit portal only ever raises candidates."""
    ship(spark)
    e = table(spark, sf_dir, "events").where("user_id is not null and value is not null")
    price = F.floor(F.col("value") / 40).cast("string")
    portal = F.when(F.col("user_id") % 3 == 0, "28hse").when(F.col("user_id") % 3 == 1, "midland").otherwise("house730")
    none = F.lit("")
    s = e.select(F.col("user_id").cast("string").alias("source_id"), portal.alias("channel"), F.col("event_id").alias("seq"), F.when(F.col("event_id") % 6 == 0, "high").otherwise("medium").alias("confidence"), F.concat("event_type", F.lit("|"), price).alias("fingerprint"), price.alias("price"), none.alias("posted"), none.alias("updated"), none.alias("status"), F.col("event_type").alias("title"))
    out = monitor.fold(s)
    return out.select(F.col("source_id").cast("long").alias("user_id"), F.col("seq").alias("event_id"), F.array_join("reasons", ",").alias("reasons"), "changed", F.col("reextract_candidate").alias("candidate"), "change_count")


LINES_OF = r"list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '')"


@query(f"WITH p AS (SELECT page_id, url, CASE WHEN page_id % 7 <> 0 THEN regexp_replace(replace(html, '</p>', chr(10)), '<[^\n]*?>', '', 'g') END AS t, regexp_matches(url, '(?i)/tag/|/tags/|/category/|/author/|/feed/?$|/wp-json|/privacy|/terms|/cookie|/login|/signup|/register|/cart|/checkout') AS skip FROM pages), l AS (SELECT *, {LINES_OF} AS l FROM p) SELECT page_id, CASE WHEN skip THEN 'skipped' WHEN t IS NULL THEN 'failed' WHEN len(l) = 0 THEN 'no_text' WHEN len(l) < 3 OR length(t) < 1500 OR len(list_distinct(l)) / len(l) < 0.6 THEN 'low_quality' ELSE 'persisted' END AS outcome FROM l")
def knowledge_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each address gets: skipped, failed (the fetch is a seam), no text, low quality or persisted."""
    p = table(spark, sf_dir, "pages").withColumn("t", F.when(F.col("page_id") % 7 != 0, X.strip_tags(F.replace("html", F.lit("</p>"), F.lit("\n")))))
    reason = X.quality_reason("t", 3, 1500, 0.6)
    checks = [(~X.skip_url("url"), "skipped"), (F.col("t").isNotNull(), "failed"), (reason != "empty text", "no_text"), (reason == "ok", "low_quality")]
    return p.select("page_id", M.first_outcome(checks, "persisted").alias("outcome"))


@query(r"SELECT page_id, 'see ' || base || '?x=1 and (' || base || ') end' AS text FROM (SELECT page_id, regexp_extract(url, '^([^?#]*)', 1) AS base FROM pages)")
def text_strip_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses within a text lose their tracking parameters."""
    base = F.regexp_extract("url", "^([^?#]*)", 1)
    text = F.concat(F.lit("see "), base, F.lit("?utm_source=a&x=1 and ("), base, F.lit("?gclid=7) end"))
    return table(spark, sf_dir, "pages").select("page_id", X.strip_tracking_in_text(text).alias("text"))


@query("SELECT c_custkey, sha256('find-{\"a\":\"' || c_mktsegment || '\",\"b\":\"' || c_nationkey || '\"}') AS memo_key FROM customer")
def memo_keys_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key of an action and its options, whatever their order."""
    options = F.create_map(F.lit("b"), F.col("c_nationkey").cast("string"), F.lit("a"), "c_mktsegment")
    return table(spark, sf_dir, "customer").select("c_custkey", X.memo_key(F.lit("find"), options).alias("memo_key"))


@query(f"{sql('listings')}, c AS (SELECT source_id, 'Agent ' || CAST(k % 30 AS VARCHAR) AS name, CASE k % 4 WHEN 0 THEN [] WHEN 1 THEN ['', CAST(90000000 + k % 50 AS VARCHAR)] ELSE [CAST(90000000 + k % 50 AS VARCHAR)] END AS phones FROM listings) SELECT DISTINCT name, phone FROM (SELECT name, unnest(phones) AS phone FROM c) WHERE phone <> ''")
def contact_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts and their phones through the bridge of the normalised export."""
    number = (F.col("k") % 50 + 90000000).cast("string")
    phones = F.when(F.col("k") % 4 == 0, F.array().cast("array<string>")).when(F.col("k") % 4 == 1, F.array(F.lit(""), number)).otherwise(F.array(number))
    contact = F.struct(F.concat(F.lit("Agent "), (F.col("k") % 30).cast("string")).alias("name"), F.lit(None).cast("string").alias("license_no"), phones.alias("phones"), F.array().cast("array<string>").alias("wtsapps"))
    t = M.contact_tables(rows(spark, sf_dir, "listings").select("source_id", F.array(contact).alias("contacts")))
    return t["contacts"].join(t["contact_phones"], "contact_id").join(t["phones"], "phone_id").select("name", "phone")


@query(f"{sql('listings', 'photos')}, gone AS (SELECT source_id FROM listings WHERE k % 10 = 0) SELECT photo_id, CASE WHEN source_id IN (SELECT source_id FROM gone) THEN 'archived' ELSE status END AS status FROM photos")
def archive_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Photos after their listings were archived."""
    x, p = rows(spark, sf_dir, "listings"), rows(spark, sf_dir, "photos")
    archived = M.update_where(x, x.where("k % 10 = 0"), "source_id", {"status": F.lit("archived")})
    gone = archived.where("status = 'archived' and k % 10 = 0")
    return M.update_where(p, gone, "source_id", {"status": F.lit("archived")}).select("photo_id", "status")


@query(f"{sql('listings')} SELECT count(*) AS listings, count(*) FILTER (status = 'archived') AS archived FROM listings")
def listing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many listings there are."""
    return rows(spark, sf_dir, "listings").agg(F.count("*").alias("listings"), F.count_if(F.col("status") == "archived").alias("archived"))


@query(f"{PRICED} SELECT to_json({{'district': district, 'listing_count': count(*), 'priced_count': count(price)}}) AS document FROM priced GROUP BY district")
def market_report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document a district."""
    s = K.district_stats(priced_rows(spark, sf_dir))
    return s.select(F.to_json(F.struct("district", "listing_count", "priced_count")).alias("document"))


@query("SELECT n_name, CASE WHEN n_nationkey % 3 = 0 THEN 'Sha Tin' WHEN n_nationkey % 3 = 1 THEN 'LOHAS Park' ELSE 'x' END AS en, CASE WHEN n_nationkey % 3 = 0 THEN '沙田' WHEN n_nationkey % 3 = 1 THEN '康城' ELSE 'x' END AS cn FROM nation")
def district_translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English and simplified names; more of them are golden rows."""
    d = F.when(F.col("n_nationkey") % 3 == 0, "沙田").when(F.col("n_nationkey") % 3 == 1, "康城").otherwise("x")
    return table(spark, sf_dir, "nation").select("n_name", district.english_name(d).alias("en"), district.simplified_name(d).alias("cn"))


@query("WITH c AS (SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN 'p' || CAST(c_custkey % 9 AS VARCHAR) END AS held FROM customer WHERE c_custkey % 7 <> 0), m AS (SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN NULL ELSE 'p' || CAST((c_custkey + c_custkey % 2) % 9 AS VARCHAR) END AS first FROM customer WHERE c_custkey % 3 <> 0) SELECT coalesce(c.id, m.id) AS id, CASE WHEN m.id IS NULL THEN NULL WHEN c.id IS NULL THEN 'conversation_not_found' WHEN first IS NULL THEN 'nothing_matched' WHEN first = held THEN 'already_queued' ELSE 'queued' END AS outcome, CASE WHEN held IS NULL THEN 0 ELSE 1 END + CASE WHEN m.id IS NOT NULL AND c.id IS NOT NULL AND first IS NOT NULL AND first IS DISTINCT FROM held THEN 1 ELSE 0 END AS size FROM c FULL JOIN m ON c.id = m.id")
def queue_append_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of the first match of each conversation."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    name = lambda k: F.concat(F.lit("p"), (k % 9).cast("string"))
    item = F.struct(name(F.col("id")).alias("post_id"), F.lit("sent").alias("status"), F.lit(1).alias("createdAt"), F.lit(2).alias("expired_at"))
    convs = c.where("id % 7 <> 0").select("id", F.when(F.col("id") % 4 == 0, F.array(item)).alias("queue"))
    matches = c.where("id % 3 <> 0").select("id", F.when(F.col("id") % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(name(F.col("id") + F.col("id") % 2), F.lit("other"))).alias("post_ids"))
    return M.queue_append(convs, matches, NOW).select("id", "outcome", F.coalesce(F.size("queue"), F.lit(0)).alias("size"))


@query("WITH u AS (SELECT n_name AS value, 0 AS list, n_nationkey AS pos FROM nation WHERE n_nationkey % 3 = 0 UNION ALL SELECT n_name, 1, 25 - n_nationkey FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT r_name, 2, r_regionkey FROM region), f AS (SELECT *, row_number() OVER (PARTITION BY value ORDER BY list, pos) AS n FROM u) SELECT value, list, CAST(pos AS BIGINT) AS pos FROM f WHERE n = 1")
def union_of_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three lists as one, each value at its first place."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    first = n.where("n_nationkey % 3 = 0").select(F.col("n_name").alias("value"), F.col("n_nationkey").alias("pos"))
    second = n.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("value"), (25 - F.col("n_nationkey")).alias("pos"))
    return M.ordered_union(first, second, r.select(F.col("r_name").alias("value"), F.col("r_regionkey").alias("pos")))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE 'old' END AS a, 'kept' AS b, CASE WHEN c_custkey % 2 = 0 THEN 'added' END AS c FROM customer")
def map_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document after a partial one was laid over it, read by its fields."""
    new = F.when(F.col("c_custkey") % 2 == 0, F.create_map(F.lit("a"), F.lit("new"), F.lit("c"), F.lit("added"))).otherwise(F.create_map().cast("map<string,string>"))
    m = M.merge_maps(F.create_map(F.lit("a"), F.lit("old"), F.lit("b"), F.lit("kept")), new)
    return table(spark, sf_dir, "customer").select("c_custkey", *[m[k].alias(k) for k in "abc"])


CLEANED = "replace(replace(replace(lower(trim(rent_price)), ',', ''), '$', ''), 'hkd', '')"


@query(f"{sql('listings')} SELECT k, {NUM.format('rent_price')} AS n1, TRY_CAST(regexp_extract(rent_price, '\\d+(\\.\\d+)?', 0) AS DOUBLE) AS n2, {MONEY.format('rent_price')} AS n3, {WHOLE.format('rent_price')} AS n4, TRY_CAST({CLEANED} AS DOUBLE) AS n5, CAST(net_size AS DOUBLE) AS n1_number, CAST(-net_size AS DOUBLE) AS n2_number, CASE WHEN k % 4 = 0 THEN TRUE ELSE FALSE END AS n6, CASE k % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS n7, coalesce(CAST(gross_size AS VARCHAR) || ' sqft', 'N/A') AS n19, round(gross_size / 7e0, 2) AS n20 FROM listings")
def number_parsers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every parser over the rents, and over numbers."""
    ship(spark)
    wish = F.when(F.col("k") % 4 == 0, " YES ").when(F.col("k") % 4 == 1, "n").when(F.col("k") % 4 == 2, "?")
    return rows(spark, sf_dir, "listings").select(
        "k", N.parse_number("rent_price").alias("n1"), N.parse_first_number("rent_price").alias("n2"), N.whole_money_or_null("rent_price").alias("n3"), N.int_or_null("rent_price").alias("n4"), N.money_or_null("rent_price").alias("n5"),
        N.parse_number("net_size").alias("n1_number"), N.parse_first_number(-F.col("net_size")).alias("n2_number"), N.bool_pref(wish).alias("n6"), N.bool_or_null(wish).alias("n7"), N.format_size("gross_size").alias("n19"), N.py_round(F.col("gross_size") / 7, 2).alias("n20"),
    )


STRINGS = {
    "price": "'HK$ ' || CAST(c_custkey AS STRING) || ',000 港元/月'",
    "link": "CASE c_custkey % 3 WHEN 0 THEN '//h.example/' || CAST(c_custkey AS STRING) || '#x' WHEN 1 THEN '/p/' || CAST(c_custkey AS STRING) ELSE 'https://z.example/' || CAST(c_custkey AS STRING) || '#y#z' END",
    "said": "CASE c_custkey % 4 WHEN 0 THEN 'only $ ' || CAST(c_custkey AS STRING) || ',500 today' WHEN 1 THEN CAST(c_custkey AS STRING) || ',250 港元' WHEN 2 THEN '$12' ELSE 'none' END",
    "tel": "CASE WHEN c_custkey % 2 = 0 THEN 'tel:+852 9' ELSE '2' END || lpad(CAST(c_custkey AS STRING), 7, '0')",
    "lang": "CASE c_custkey % 4 WHEN 0 THEN ' ZH-HK ' WHEN 1 THEN 'xx' WHEN 2 THEN 'zh-cn' END",
    "url": "CASE WHEN c_custkey % 3 = 1 THEN 'https://q.example/buy/' ELSE 'HTTPS://www.P.example/buy/' END || CAST(c_custkey AS STRING) || CASE WHEN c_custkey % 5 = 0 THEN '/x' ELSE '?a' END",
    "html": "CASE WHEN c_custkey % 5 = 0 THEN 'Sorry, you have been BLOCKED' ELSE 'x' END",
    "mixed": "' A  b' || chr(9) || 'C ' || c_mktsegment || ' '",
}
URL_PATH = "regexp_extract(url, '(?i)^https?://[^/?#]*([^?#]*)', 1)"


@query(rf"WITH s AS (SELECT c_custkey, {', '.join(f'{e} AS {n}' for n, e in STRINGS.items())} FROM customer) SELECT c_custkey, trim(replace(replace(replace(replace(replace(replace(price, 'HK$', ''), '$', ''), ',', ''), '港元', ''), '/月', ''), '每月', '')) AS x3, CASE WHEN starts_with(split_part(link, '#', 1), '//') THEN 'https:' || split_part(link, '#', 1) WHEN starts_with(split_part(link, '#', 1), '/') THEN 'https://p.example' || split_part(link, '#', 1) ELSE split_part(link, '#', 1) END AS x16, CASE WHEN regexp_extract(said, '(?i)(?:HK\$|\$)\s*([0-9][0-9,]{{2,}})', 1) <> '' THEN regexp_extract(said, '(?i)(?:HK\$|\$)\s*([0-9][0-9,]{{2,}})', 1) ELSE regexp_extract(said, '([0-9][0-9,]{{3,}})\s*港元', 1) END AS x18, replace(replace(replace(replace(tel, 'tel:', ''), '+852', ''), '-', ''), ' ', '') AS x22, c_custkey % 2 = 0 AS f10, CASE WHEN lower(trim(lang)) IN ('zh-hk', 'zh-cn') THEN lower(trim(lang)) ELSE 'en' END AS x29, regexp_replace(lower(regexp_extract(url, '(?i)^https?://([^/?#]*)', 1)), '^www\.', '') = 'p.example' AND regexp_matches({URL_PATH}, '^/buy/[0-9]+$') AS f8, c_custkey % 5 = 0 AS f9, lower(trim(mixed)) AS x1, trim(regexp_replace(mixed, '\s+', ' ', 'g')) AS x2 FROM s")
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small text functions over made-up strings."""
    s = table(spark, sf_dir, "customer").selectExpr("c_custkey", *[f"{e} AS {n}" for n, e in STRINGS.items()])
    phone = X.bare_phone("tel")
    return s.select(
        "c_custkey", X.normalise_price("price").alias("x3"), X.normalise_link("link", "https://p.example").alias("x16"), X.price_in_text("said").alias("x18"), phone.alias("x22"), X.hk_mobile(phone).alias("f10"),
        X.language_or("lang", ("zh-hk", "zh-cn"), "en").alias("x29"), X.valid_listing_url("url", "p.example", "^/buy/[0-9]+$").alias("f8"), X.blocked_page("html").alias("f9"), X.stripped_lower("mixed").alias("x1"), X.collapse("mixed").alias("x2"),
    )


@query()
def knowledge_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of the pages that persist, with their ids and category; the chunker has no SQL."""
    ship(spark)
    kept = knowledge_outcomes(spark, sf_dir).where("outcome = 'persisted'").select("page_id")
    p = table(spark, sf_dir, "pages").join(kept, "page_id", "left_semi").select("page_id", "url", X.page_title("html").alias("title"), X.denoise(X.sanitise(X.strip_tags(F.replace("html", F.lit("</p>"), F.lit("\n"))))).alias("text"))
    c = p.select("page_id", "url", "title", X.category("url", "title", "text").alias("category"), F.posexplode(chunking.chunk_text("text")).alias("place", "chunk"))
    return c.select("page_id", X.chunk_id("url", "title", "place").alias("chunk_id"), "category", F.length("chunk").alias("size"))


@query()
def page_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11: title and main text of pages; tested on small pages."""
    in_small_batches(spark)
    return table(spark, sf_dir, "pages").select("page_id", G.cleaned("html").alias("c")).select("page_id", "c.*")


@query()
def page_model_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of pages for a request, up to the length of a request; tested on small pages."""
    in_small_batches(spark)
    return table(spark, sf_dir, "pages").select("page_id", G.model_text("html").alias("text"))
