"""Registered queries over the driver's tables, with their SQL counterparts.

The domain tables have stand-ins of the same shape: orders for listings, customers and nations for
buildings and districts, events for queues and conversations for message histories.  Times are
compared with a fixed ``NOW``, the end of the events.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import chunking, district
from ..functions import numbers as N
from ..functions import text as X
from ..operators import aggregate as A
from ..operators import joins as J
from ..operators import market as K
from ..operators import matching as C
from ..operators import merge as M
from ..operators import ranking as R
from ..operators import vector as V
from ..session import ship
from . import monitor

NOW = "2024-01-31 00:00:00"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the customer's segment and nation: the small sides are left to the optimiser to broadcast."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)


LISTINGS = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
SUMMARY = "count(*) AS listing_count, count(o_totalprice) AS priced_count, round(avg(o_totalprice)+1e-9,2) AS avg_price, round(median(o_totalprice)+1e-9,2) AS median_price, round(min(o_totalprice)+1e-9,2) AS min_price, round(max(o_totalprice)+1e-9,2) AS max_price"
LEVEL = "CASE WHEN median_price IS NULL THEN 'unknown' WHEN median_price < 100000 THEN 'affordable' WHEN median_price < 140000 THEN 'mid_market' WHEN median_price < 180000 THEN 'upper_mid' ELSE 'luxury' END"


@query(f"SELECT n_name, listing_count, priced_count, avg_price, median_price, min_price, max_price, {LEVEL} AS level FROM (SELECT n_name, {SUMMARY} FROM {LISTINGS} GROUP BY n_name HAVING count(*) > 1)")
def market_group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price statistics and level of every group with more than one listing."""
    stats = A.price_summary(listings(spark, sf_dir), ["n_name"], "o_totalprice").where("listing_count > 1")
    level = N.bucketize("median_price", (100_000, 140_000, 180_000), ("affordable", "mid_market", "upper_mid", "luxury"), "unknown")
    return stats.withColumn("level", level).orderBy(F.desc("listing_count"), "n_name")


@query(f"SELECT n_name, c_mktsegment, {SUMMARY} FROM {LISTINGS} GROUP BY n_name, c_mktsegment")
def market_building_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4, R5."""
    stats = A.price_summary(listings(spark, sf_dir), ["n_name", "c_mktsegment"], "o_totalprice")
    return stats.orderBy(F.desc("listing_count"), F.coalesce("avg_price", F.lit(-1)).desc(), "n_name", "c_mktsegment")


@query(f"SELECT n_name, c_mktsegment, o_orderpriority, CAST(grouping_id(n_name, c_mktsegment, o_orderpriority) AS BIGINT) AS level, count(*) AS n, round(avg(o_totalprice)+1e-9,2) AS avg_price, round(median(o_totalprice)+1e-9,2) AS median_price FROM {LISTINGS} GROUP BY ROLLUP(n_name, c_mktsegment, o_orderpriority)")
def market_three_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every level of the hierarchy at once."""
    return A.rollup_summary(listings(spark, sf_dir), ["n_name", "c_mktsegment", "o_orderpriority"], "o_totalprice")


@query(f"SELECT n_name, CASE WHEN o_totalprice IS NULL THEN 'unknown' WHEN o_totalprice < 50000 THEN 'under_50k' WHEN o_totalprice < 150000 THEN '50k_to_150k' WHEN o_totalprice < 300000 THEN '150k_to_300k' ELSE '300k_plus' END AS bucket, count(*) AS n FROM {LISTINGS} GROUP BY 1, 2")
def market_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2, N10."""
    bucket = N.bucketize("o_totalprice", (50_000, 150_000, 300_000), ("under_50k", "50k_to_150k", "150k_to_300k", "300k_plus"), "unknown")
    return A.histogram(listings(spark, sf_dir), ["n_name"], bucket)


@query(f"SELECT n_name, o_orderpriority, n FROM (SELECT *, row_number() OVER (PARTITION BY n_name ORDER BY n DESC, first_seen DESC, key, o_orderpriority) AS place FROM (SELECT n_name, o_orderpriority, count(*) AS n, max(o_orderdate) AS first_seen, arg_min(o_orderkey, (-epoch_us(o_orderdate), o_orderkey)) AS key FROM {LISTINGS} GROUP BY 1, 2)) WHERE place = 1")
def market_mode_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: the commonest value, ties to the one met first from the newest on."""
    return A.mode_first_seen(listings(spark, sf_dir), ["n_name"], "o_orderpriority", [-F.unix_micros(F.col("o_orderdate").cast("timestamp")), F.col("o_orderkey")])


@query("SELECT count(*) AS n, round(avg(l_extendedprice)+1e-9,2) AS avg_price, round(median(l_extendedprice)+1e-9,2) AS median_price, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_quantity FROM lineitem")
def market_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8."""
    li = table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_quantity")
    none = F.lit(None).cast("double")
    sums = li.agg(F.count("*").alias("n"), N.nudged_round(F.avg("l_extendedprice"), 2).alias("avg_price"), none.alias("median_price"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("total_quantity"))
    middle = K.medians(li, [], "l_extendedprice").select(F.lit(None).cast("long").alias("n"), none.alias("avg_price"), N.nudged_round("median", 2).alias("median_price"), none.alias("total_quantity"))
    return sums.union(middle).agg(*[F.max(c).alias(c) for c in sums.columns])  # two rows become one


@query("SELECT l_orderkey, l_linenumber, round(coalesce(CASE WHEN l_tax > 0.07 THEN p_retailprice END, CASE WHEN l_quantity > 0 THEN l_extendedprice / l_quantity END)+1e-9,2) AS unit_price FROM lineitem LEFT JOIN part ON l_partkey = p_partkey")
def price_per_unit_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A direct figure where there is one, else price over size."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_tax", "l_extendedprice", "l_quantity")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    joined = li.join(p, li.l_partkey == p.p_partkey, "left")
    unit = N.price_per_unit(F.when(F.col("l_tax") > 0.07, F.col("p_retailprice")), F.lit(None).cast("double"), "l_extendedprice", N.positive("l_quantity"))
    return joined.select("l_orderkey", "l_linenumber", N.nudged_round(unit, 2).alias("unit_price"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3")
def demand_topk_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report."""
    return A.top_values(table(spark, sf_dir, "events").select("event_type"), "event_type", 3)


@query(r"SELECT token, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '[\s,.;:!?/|、，。；：！？／｜]+')) AS token FROM conversations) WHERE length(token) >= 2 GROUP BY 1 ORDER BY n DESC, token LIMIT 20")
def demand_keyword_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report over tokens."""
    tokens = table(spark, sf_dir, "conversations").select(F.explode(X.query_tokens("text")).alias("token"))
    return A.top_values(tokens, "token", 20)


@query("""SELECT field, n, round(n / greatest(1, total)+1e-9,4) AS share FROM (SELECT count(*) AS total, count(CASE WHEN event_type <> '' THEN 1 END) AS event_type, count(value) AS value, count(CASE WHEN json_extract_string(props, '$.k') <> '' THEN 1 END) AS k, count(CASE WHEN json_extract_string(props, '$.missing') <> '' THEN 1 END) AS missing FROM events) UNPIVOT (n FOR field IN (event_type, value, k, missing))""")
def demand_field_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10, A13."""
    e = table(spark, sf_dir, "events").select("event_type", "value", "props")
    present = {"event_type": F.col("event_type") != "", "value": F.col("value").isNotNull(), "k": F.get_json_object("props", "$.k") != "", "missing": F.get_json_object("props", "$.missing") != ""}
    return A.coverage(e, present)


@query("SELECT event_type, count(value) AS n, round(min(value)+1e-9,4) AS least, round(max(value)+1e-9,4) AS largest, round(avg(value)+1e-9,4) AS mean, round(quantile_cont(value,0.25)+1e-9,4) AS p25, round(quantile_cont(value,0.5)+1e-9,4) AS median, round(quantile_cont(value,0.75)+1e-9,4) AS p75 FROM events GROUP BY 1")
def demand_five_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11, N18."""
    return A.five_numbers(table(spark, sf_dir, "events").select("event_type", "value"), ["event_type"], "value")


@query("SELECT field, n_true, n_false, n_true + n_false AS answered, round(CASE WHEN n_true + n_false > 0 THEN n_true / (n_true + n_false) END + 1e-9, 4) AS true_ratio FROM (SELECT 'quality' AS field, count(*) FILTER (quality = 1) AS n_true, count(*) FILTER (quality = 0) AS n_false FROM labels UNION ALL SELECT 'toxic', count(*) FILTER (toxic = 1), count(*) FILTER (toxic = 0) FROM labels)")
def demand_boolean_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12, N7."""
    labels = table(spark, sf_dir, "labels")
    marks = labels.select(*[N.bool_or_null(F.col(c).cast("string")).alias(c) for c in ("quality", "toxic")])
    return A.boolean_tally(marks, "quality", "toxic")


@query("SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN a IS NULL THEN 'unknown' WHEN a < 10000 THEN '<10k' WHEN a < 20000 THEN '10k-20k' WHEN a < 30000 THEN '20k-30k' WHEN a < 50000 THEN '30k-50k' WHEN a < 80000 THEN '50k-80k' ELSE '>=80k' END AS bucket FROM (SELECT coalesce(CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal * 10 END, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal * 5 END) AS a FROM customer)) GROUP BY 1")
def demand_budget_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing bounds included."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    low, high = F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal") * 5), F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal") * 10)
    return A.histogram(c, [], N.budget_bucket(low, high))


MATCH = """WITH pref AS (SELECT s_suppkey, s_acctbal / 10 + 900 AS low, s_acctbal / 10 + 1100 AS high, CAST(s_suppkey % 50 + 1 AS INTEGER) AS size FROM supplier WHERE s_acctbal > 0),
pairs AS (SELECT s_suppkey, p_partkey, greatest(0, 1 - abs(p_retailprice - (low+high)/2) / ((low+high)/2) / 0.25) * 45 + CASE WHEN size = 0 THEN 0 ELSE greatest(0, 1 - abs(p_size - size) / size / 1.0) * 20 END AS s FROM pref JOIN part ON p_size = size AND p_retailprice BETWEEN 0.8 * low AND 1.1 * high)
SELECT s_suppkey, p_partkey, round(s+1e-9,2) AS score, place FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY round(s+1e-9,2) DESC, p_partkey) AS place FROM pairs) WHERE place <= 2"""


@query(MATCH)
def match_theta_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preferences against listings; an equality carries the join, ranges filter it, the best two stay."""
    s = table(spark, sf_dir, "supplier").where("s_acctbal > 0")
    pref = s.select("s_suppkey", (F.col("s_acctbal") / 10 + 900).alias("low"), (F.col("s_acctbal") / 10 + 1100).alias("high"), (F.col("s_suppkey") % 50 + 1).cast("int").alias("size"))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    pref, p = pref.withColumn("mid", N.midpoint("low", "high")), p.withColumn("size", F.col("p_size").cast("int"))
    test = F.col("p_retailprice").between(0.8 * F.col("low"), 1.1 * F.col("high"))
    equal = N.closeness("p_size", "size", "size", 20, 1.0)
    score = N.nudged_round(N.closeness("p_retailprice", "low", "high", 45) + equal, 2)
    beyond = lambda d: N.nudged_round(N.closeness(F.col("mid") - d, "low", "high", 45) + equal, 2)
    return C.closest_matches(pref, p, "s_suppkey", "p_partkey", ["size"], "p_retailprice", "mid", test, score, beyond, 2)


@query("SELECT p.vec_id AS pid, q.vec_id AS qid FROM (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS lat, CAST(embedding[2] AS DOUBLE) AS lng FROM embeddings) p JOIN (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS lat, CAST(embedding[2] AS DOUBLE) AS lng FROM embeddings WHERE vec_id % 25 = 0) q ON abs(p.lat - q.lat) <= 1/69.0 AND abs(p.lng - q.lng) <= (1/69.0) / cos(radians(p.lat))")
def match_bbox_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-dimensional range join on grid cells."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("lat"), F.col("embedding")[1].cast("double").alias("lng"))
    points, probes = e.toDF("pid", "plat", "plng"), e.where("vec_id % 25 = 0").toDF("qid", "qlat", "qlng")
    return J.bbox_join(points, probes).select("pid", "qid")


@query("SELECT p.vec_id AS pid, q.vec_id AS qid FROM (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS lat, CAST(embedding[2] AS DOUBLE) AS lng FROM embeddings) p JOIN (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS lat, CAST(embedding[2] AS DOUBLE) AS lng FROM embeddings) q ON abs(p.lat - q.lat) <= 1/69.0 AND abs(p.lng - q.lng) <= (1/69.0) / cos(radians(p.lat))")
def match_bbox_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row is a point and a probe."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("lat"), F.col("embedding")[1].cast("double").alias("lng"))
    return J.bbox_join(e.toDF("pid", "plat", "plng"), e.toDF("qid", "qlat", "qlng")).select("pid", "qid")


@query("SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey")
def lookup_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1, J2, J11, J12."""
    o, c = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name", "o_totalprice")


@query("SELECT s_suppkey, coalesce(a.n_name, b.n_name) AS n_name FROM (SELECT *, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey ELSE s_nationkey % 5 + 100 END AS k FROM supplier) LEFT JOIN nation a ON k = a.n_nationkey LEFT JOIN (SELECT n_regionkey, min(n_name) AS n_name FROM nation GROUP BY 1) b ON k - 100 = b.n_regionkey")
def lookup_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first key that matches wins."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey")).otherwise(F.col("s_nationkey") % 5 + 100).alias("k"))
    n = table(spark, sf_dir, "nation")
    least = n.groupBy("n_regionkey").agg(F.min("n_name").alias("n_name")).select(F.lit(None).cast("int").alias("n_nationkey"), (F.col("n_regionkey") + 100).alias("region_key"), "n_name")
    both = n.select("n_nationkey", F.lit(None).cast("int").alias("region_key"), "n_name").unionByName(least)
    return J.lookup_first(s, both, "k", ["n_nationkey", "region_key"], "n_name").select("s_suppkey", "n_name")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def anti_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9, J10, J15."""
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return J.new_rows(table(spark, sf_dir, "customer").select("c_custkey"), done, "c_custkey")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def semi_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J14, J17."""
    found = table(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name").join(found, "c_custkey", "left_semi")


@query("SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, word FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) - 1 AS pos FROM conversations)")
def generate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each element, with its place."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("pos", "word"))


@query("SELECT user_id, count(*) AS queued, count(*) FILTER (NOT live) AS expired, min(CASE WHEN live THEN event_id END) AS first_live FROM (SELECT user_id, event_id, ts > TIMESTAMP '2024-01-29 00:00:00' AS live FROM events WHERE event_type = 'view') GROUP BY 1")
def queue_first_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's queue in order, how much of it has expired and its first live item."""
    e = table(spark, sf_dir, "events").where("event_type = 'view'").select("user_id", "event_id", (F.col("ts") + F.expr("interval 2 days") > F.lit(NOW).cast("timestamp")).alias("live"))
    return e.groupBy("user_id").agg(F.count("*").alias("queued"), F.count_if(~F.col("live")).alias("expired"), F.min(F.when(F.col("live"), F.col("event_id"))).alias("first_live"))


@query("SELECT conv_id, count(*) >= 3 AND bool_and(role IN ('user', 'assistant')) FILTER (back <= 3) AS last_all FROM (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC) AS back FROM conversations) GROUP BY 1")
def last_k_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4, R7, with k = 3."""
    last = R.top_per_key(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), ["conv_id"], [F.desc("turn"), F.desc("role")], 3)
    return last.groupBy("conv_id").agg(((F.count("*") >= 3) & F.bool_and(F.col("role").isin("user", "assistant"))).alias("last_all"))


@query("SELECT conv_id, max(CASE WHEN role = 'system' THEN turn END) AS last_system, count(*) FILTER (role <> 'system') AS others FROM conversations GROUP BY 1")
def latest_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R8, Y4."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return c.groupBy("conv_id").agg(F.max(F.when(F.col("role") == "system", F.col("turn"))).alias("last_system"), F.count_if(F.col("role") != "system").alias("others"))


@query("SELECT conv_id, count(*) AS messages, sum(length(text)) AS chars, string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) FILTER (back <= 6) AS recent, (count(*) > 12 OR sum(length(text)) > 2800) AND count(*) > 8 AS compact FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations) GROUP BY 1")
def rolling_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six latest messages, and whether a conversation is due for a summary."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").alias("size"))
    last = R.top_per_key(c, ["conv_id"], [F.desc("turn")], 6).groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_list("turn")).cast("array<string>"), ",").alias("recent"))
    due = ((F.col("messages") > 12) | (F.col("chars") > 2800)) & (F.col("messages") > 8)
    return c.groupBy("conv_id").agg(F.count("*").alias("messages"), F.sum("size").alias("chars")).join(last, "conv_id").select("conv_id", "messages", "chars", "recent", due.alias("compact"))


@query("SELECT conv_id, turn, role FROM conversations WHERE turn BETWEEN 2 AND 5")
def message_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slice of turns."""
    return table(spark, sf_dir, "conversations").where("turn between 2 and 5").select("conv_id", "turn", "role")


@query("SELECT source, count(*) AS docs, CASE WHEN max(quality) = 1 THEN 'analysed' WHEN max(quality) = 0 THEN 'failed' ELSE 'pending' END AS status, count(*) FILTER (quality IS NULL) AS waiting FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def status_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any success counts; failures alone fail; nothing yet is pending."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    best = F.max("quality")
    return d.groupBy("source").agg(F.count("*").alias("docs"), F.when(best == 1, "analysed").when(best == 0, "failed").otherwise("pending").alias("status"), F.count_if(F.col("quality").isNull()).alias("waiting"))


@query("SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2024-01-31 23:59:59' GROUP BY 1")
def usage_by_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar month to date; its last second is left out, as defined."""
    now = F.lit(NOW).cast("timestamp")
    start = F.date_trunc("month", now)
    end = F.last_day(now).cast("timestamp") + F.expr("interval '23:59:59' hour to second")
    return table(spark, sf_dir, "events").where((F.col("ts") >= start) & (F.col("ts") < end)).groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 50")
def cache_evict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache keeps its newest fifty entries."""
    return table(spark, sf_dir, "events").select("event_id", "ts").orderBy(F.desc("ts"), F.desc("event_id")).limit(50)


@query("""WITH s AS (SELECT user_id, event_type, max(event_id) AS last, max(value) AS top, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2), t AS (SELECT user_id, event_type, max(event_id) AS last, max(value) AS top, count(*) AS n FROM events WHERE event_id % 2 = 1 GROUP BY 1, 2)
SELECT t.user_id, t.event_type, CASE WHEN s.user_id IS NULL THEN 'initial_monitor' ELSE concat_ws(',', CASE WHEN s.top <> t.top THEN 'price_changed' END, CASE WHEN s.n <> t.n THEN 'status_changed' END) END AS reasons, sha1(concat(CAST(t.n AS VARCHAR), '|', t.event_type)) AS fingerprint FROM t LEFT JOIN s ON s.user_id = t.user_id AND s.event_type = t.event_type""")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of each key and the reasons between them."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    both = e.groupBy("user_id", "event_type").agg(*[x for h, w in (("old", 0), ("new", 1)) for x in (F.max(F.when(F.col("event_id") % 2 == w, F.col("value"))).alias(f"{h}_top"), F.count_if(F.col("event_id") % 2 == w).alias(f"{h}_n"))]).where("new_n > 0")
    old, new = ({"price": F.col(f"{h}_top"), "status": F.col(f"{h}_n")} for h in ("old", "new"))
    same = (F.col("old_top") == F.col("new_top")) & (F.col("old_n") == F.col("new_n"))
    reasons = F.when(F.col("old_n") == 0, "initial_monitor").otherwise(F.array_join(monitor.change_reasons(old, new, same), ","))
    return both.select("user_id", "event_type", reasons.alias("reasons"), X.fingerprint(F.col("new_n"), "event_type").alias("fingerprint"))


@query("SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 4 = 0 THEN 0.0 ELSE s_acctbal END AS s_acctbal FROM supplier")
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1, W5."""
    old = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return M.upsert(old, old.where("s_suppkey % 4 = 0").withColumn("s_acctbal", F.lit(0.0)), "s_suppkey")


@query("SELECT s_suppkey, concat('new ', s_name) AS s_name, CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 2 END AS created FROM supplier")
def upsert_set_on_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A known row keeps its creation."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    old = s.where("s_suppkey % 2 = 0").withColumn("created", F.lit(1))
    new = s.select("s_suppkey", F.concat(F.lit("new "), "s_name").alias("s_name"), F.lit(2).alias("created"))
    return M.set_on_insert(old, new, "s_suppkey", ["created"])


@query("SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 3 = 0 THEN 1.5 ELSE s_acctbal END AS s_acctbal FROM supplier")
def partial_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2, W8, W13."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return M.partial_update(s, s.where("s_suppkey % 3 = 0").select("s_suppkey", F.lit(1.5).alias("s_acctbal")), "s_suppkey")


@query("SELECT o_custkey, string_agg(o_orderpriority, ',' ORDER BY pos) AS priorities FROM (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS pos FROM orders GROUP BY 1, 2) GROUP BY 1")
def ordered_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values in the order of their first place."""
    first = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.min("o_orderkey").alias("pos"))
    o = first.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("pos", "o_orderpriority"))).alias("a"))
    return o.select("o_custkey", F.array_join(F.transform("a", lambda x: x["o_orderpriority"]), ",").alias("priorities"))


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'O' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2."""
    o = table(spark, sf_dir, "orders")
    return o.where("o_orderstatus = 'O'").select("o_custkey").subtract(o.where("o_orderstatus = 'F'").select("o_custkey"))


@query("SELECT p_partkey, CAST((row_number() OVER (ORDER BY p_partkey) - 1) // 64 AS BIGINT) AS batch FROM part")
def batching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers without a window over everything."""
    return R.batch_number(table(spark, sf_dir, "part").select("p_partkey"), ["p_partkey"], 64)


@query(r"SELECT doc_id, trim(regexp_replace(replace(replace(replace(regexp_replace(regexp_replace(text, '!\[[^\n]*?\]\([^\n]*?\)', '', 'g'), '\[([^\n]*?)\]\([^\n]*?\)', '\1', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&middot;', '·'), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9) || chr(13)) AS clean FROM documents")
def doc_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X7."""
    return table(spark, sf_dir, "documents").select("doc_id", X.sanitise("text").alias("clean"))


LINES = r"list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '')"


NOISE = "|".join(f"(?:{p})" for p in X.NOISE_LINES)


@query(f"SELECT doc_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i AND length(x) > 2 AND NOT regexp_matches(lower(x), '{NOISE}')), chr(10)) AS clean FROM (SELECT doc_id, {LINES} AS l FROM documents WHERE text IS NOT NULL)")
def doc_denoise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated and noise lines go."""
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", X.denoise("text").alias("clean"))


@query(f"SELECT doc_id, CASE WHEN trim(text, ' ' || chr(10) || chr(9)) = '' THEN 'empty text' WHEN len(l) < 3 THEN 'too few lines' WHEN length(text) < 400 THEN 'too short' WHEN len(list_distinct(l)) / greatest(1, len(l)) < 0.6 THEN 'low unique-line ratio' WHEN len(list_filter(l, lambda x: regexp_matches(lower(x), '{'|'.join(X.NAV_WORDS)}'))) / greatest(1, len(l)) > 0.5 THEN 'too many navigation lines' ELSE 'ok' END AS reason FROM (SELECT doc_id, text, {LINES} AS l FROM documents)")
def doc_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7."""
    return table(spark, sf_dir, "documents").select("doc_id", X.quality_reason("text", 3, 400, 0.6, 0.5).alias("reason"))


@query("SELECT page_id, url, regexp_matches(url, '(?i)/tag/|/tags/|/category/|/author/|/feed/?$|/wp-json|/privacy|/terms|/cookie|/login|/signup|/register|/cart|/checkout') AS skipped FROM pages")
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5."""
    return table(spark, sf_dir, "pages").select("page_id", "url", X.skip_url("url").alias("skipped"))


@query(r"SELECT page_id, CASE WHEN regexp_extract(p, '-(\d+)$', 1) <> '' THEN regexp_extract(p, '-(\d+)$', 1) ELSE p END AS source_id FROM (SELECT page_id, regexp_replace(coalesce(list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '')[-1], ''), '\.[a-z]+$', '') AS p FROM pages)")
def url_source_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X15."""
    return table(spark, sf_dir, "pages").select("page_id", X.source_id("url").alias("source_id"))


@query(r"SELECT page_id, concat(path, CASE WHEN kept <> '' THEN concat('?', kept) ELSE '' END, frag) AS url FROM (SELECT page_id, regexp_extract(url, '^([^?#]*)', 1) AS path, regexp_extract(url, '(#.*)$', 1) AS frag, array_to_string(list_filter(string_split(regexp_extract(url, '^[^#?]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[^=]*|fbclid|gclid|msclkid|igshid|mc_cid|mc_eid)(=|$)')), '&') AS kept FROM pages)")
def url_strip_tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X8."""
    return table(spark, sf_dir, "pages").select("page_id", X.strip_tracking("url").alias("url"))


@query(r"SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')) AS title FROM pages")
def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11, title."""
    return table(spark, sf_dir, "pages").select("page_id", X.page_title("html").alias("title"))


@query("SELECT page_id, length(regexp_replace(html, '<[^\\n]*?>', '', 'g')) AS n FROM pages")
def page_without_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X30."""
    return table(spark, sf_dir, "pages").select("page_id", F.length(X.strip_tags("html")).cast("long").alias("n"))


@query("SELECT doc_id, CASE WHEN regexp_matches(h, 'stamp duty|ssd|bsd|mortgage|legal|tenancy agreement|rental|conveyancing|buying process') THEN 'PROCESS_LAW' WHEN regexp_matches(h, 'district|estate|neighborhood|mtr|school net|pet-friendly|tseung kwan o|sai kung') THEN 'DISTRICT_ESTATE' ELSE 'GENERAL' END AS category FROM (SELECT doc_id, lower(concat(source, chr(10), lang, chr(10), substr(text, 1, 2000))) AS h FROM documents)")
def doc_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X10."""
    return table(spark, sf_dir, "documents").select("doc_id", X.category("source", "lang", "text").alias("category"))


@query("SELECT p_partkey, concat_ws(' ', p_name, nullif(p_brand, ''), CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'medium' ELSE 'large' END, CASE WHEN p_retailprice > 1500 THEN p_type END) AS text FROM part")
def text_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Optional parts in order."""
    p = table(spark, sf_dir, "part")
    size = N.bucketize("p_size", (10, 30), ("small", "medium", "large"), right=True)
    return p.select("p_partkey", F.concat_ws(" ", "p_name", F.nullif("p_brand", F.lit("")), size, F.when(F.col("p_retailprice") > 1500, F.col("p_type"))).alias("text"))


@query("SELECT o_orderkey, concat(CASE o_orderpriority WHEN '1-URGENT' THEN 'Now' ELSE 'Later' END, ': ', coalesce('$' || format('{:,}', CAST(floor(o_totalprice) AS BIGINT)), 'N/A')) AS caption FROM orders")
def caption_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12, N19."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.floor("o_totalprice").alias("price"))
    return o.select("o_orderkey", F.concat(F.when(F.col("o_orderpriority") == "1-URGENT", "Now").otherwise("Later"), F.lit(": "), N.format_price("price")).alias("caption"))


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.none') AS none FROM events")
def json_extract_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X17, X23."""
    return table(spark, sf_dir, "events").select("event_id", N.int_or_null(F.get_json_object("props", "$.k")).alias("k"), F.get_json_object("props", "$.none").alias("none"))


@query("""SELECT doc_id, concat('{"custom_id":"extract-', doc_id, '","method":"POST","url":"/v1/responses","body":{"lang":"', lang, '","chars":', n_chars, '}}') AS line FROM documents""")
def llm_request_emit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request of a batch file for each row."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    body = F.struct("lang", F.col("n_chars").alias("chars"))
    line = F.to_json(F.struct(F.concat(F.lit("extract-"), "doc_id").alias("custom_id"), F.lit("POST").alias("method"), F.lit("/v1/responses").alias("url"), body.alias("body")))
    return d.select("doc_id", line.alias("line"))


@query("SELECT e.vec_id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))+1e-9,6) AS cosine FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q WHERE e.label <> 3 ORDER BY 2 DESC, 1 LIMIT 10")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: cosine top-k with a filter for one query vector."""
    ship(spark)
    e = table(spark, sf_dir, "embeddings")
    return V.nearest_vectors(e.where("vec_id = 0"), e.where("label <> 3"), 10).select("vec_id", "cosine").orderBy(F.desc("cosine"), "vec_id").limit(10)


@query("SELECT query_id, vec_id, cosine, place FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, vec_id) AS place FROM (SELECT q.vec_id AS query_id, e.vec_id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))+1e-9,6) AS cosine FROM embeddings e, embeddings q WHERE e.label <> 3 AND q.vec_id % 100 = 0)) WHERE place <= 10")
def vector_topk_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: every id divisible by 100 is a query, with the filter and the ten places of ``vector_topk``."""
    ship(spark)
    e = table(spark, sf_dir, "embeddings")
    found = V.nearest_vectors(e.where("vec_id % 100 = 0"), e.where("label <> 3"), 10)
    return R.top_per_key(found, ["query_id"], [F.desc("cosine"), F.col("vec_id")], 10)


@query("SELECT doc_id, concat(substr(sha256(concat(source, '|', lang)), 1, 16), '_', lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0')) AS chunk_id FROM documents")
def doc_chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X20."""
    return table(spark, sf_dir, "documents").select("doc_id", X.chunk_id("source", "lang", F.col("doc_id") % 10000).alias("chunk_id"))


@query("SELECT DISTINCT n_name FROM nation WHERE n_name IS NOT NULL AND n_name <> ''")
def distinct_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S17, A18."""
    return table(spark, sf_dir, "nation").select("n_name").where("n_name is not null and n_name <> ''").distinct().orderBy("n_name")


@query("SELECT c_custkey, n_nationkey, round(miles+1e-9,3) AS miles FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY miles, n_nationkey) AS place FROM (SELECT c_custkey, n_nationkey, 2*3958.8*asin(sqrt(least(1.0, power(sin(radians(slat-plat)/2),2) + cos(radians(plat))*cos(radians(slat))*power(sin(radians(slng-plng)/2),2)))) AS miles FROM (SELECT c_custkey, (c_custkey*37%1601)/20.0 - 40 AS plat, (c_custkey*91%3203)/10.0 - 160 AS plng FROM customer) p, (SELECT n_nationkey, (n_nationkey*7%25)*3.1 - 38 AS slat, (n_nationkey*11%25)*12.7 - 155 AS slng FROM nation) s)) WHERE place = 1")
def nearest_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and nations with positions made from their keys."""
    points = table(spark, sf_dir, "customer").selectExpr("c_custkey AS pid", "(c_custkey*37%1601)/20.0D - 40 AS plat", "(c_custkey*91%3203)/10.0D - 160 AS plng")
    sites = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS sid", "(n_nationkey*7%25)*3.1D - 38 AS slat", "(n_nationkey*11%25)*12.7D - 155 AS slng")
    return J.nearest(points, sites).select(F.col("pid").alias("c_custkey"), F.col("sid").alias("n_nationkey"), N.nudged_round("miles", 3).alias("miles"))


@query()
def doc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tested against the definition on small texts."""
    ship(spark)
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.chunk_text("text")).alias("place", "chunk"))


@query()
def district_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4, X5 over nations' names: tested with golden rows."""
    n = table(spark, sf_dir, "nation").select("n_name").distinct()
    return n.select("n_name", district.district_name("n_name").alias("district")).withColumn("region", district.region_of("district"))


@query("SELECT doc_id, CASE WHEN len(l) = 0 THEN 0.0 ELSE round(len(list_filter(l, lambda x: regexp_matches(lower(x), 'menu|navigation|cookie|privacy|terms|subscribe|follow|share|login|signup|register|home|contact|關於|聯絡|登入|註冊|主頁|首頁|私隱|條款|版權|返回|廣告|贊助')))/len(l)+1e-9,6) END AS ratio FROM (SELECT doc_id, " + LINES + " AS l FROM documents WHERE text IS NOT NULL)")
def doc_navigation_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the share of navigation lines."""
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.round(X.navigation_ratio("text") + 1e-9, 6).alias("ratio"))


@query(r"""SELECT page_id, len(list_distinct(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']([^"''>]+)["'']', 1))) AS links FROM pages""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many different targets a page links to."""
    return table(spark, sf_dir, "pages").select("page_id", F.size(X.links("html")).cast("long").alias("links"))


@query(f"SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN c_custkey IS NULL THEN 'no_user' WHEN c_acctbal < 0 THEN 'phone_mismatch' WHEN live = 0 THEN 'nothing_live' WHEN bought = 0 THEN 'inactive' ELSE 'sent' END AS outcome FROM (SELECT user_id, count(*) FILTER (WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 2 DAY) AS live, count(*) FILTER (WHERE event_type = 'purchase') AS bought FROM events WHERE user_id IS NOT NULL GROUP BY user_id) LEFT JOIN customer ON user_id = c_custkey) GROUP BY outcome")
def queue_drain_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every queue's turn ends, checks in their order."""
    live, bought = F.col("ts") >= F.expr(f"TIMESTAMP '{NOW}' - INTERVAL 2 DAY"), F.col("event_type") == "purchase"
    users = table(spark, sf_dir, "events").where("user_id is not null").groupBy("user_id").agg(F.count_if(live).alias("live"), F.count_if(bought).alias("bought"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_acctbal")
    checks = [(F.col("c_acctbal").isNotNull(), "no_user"), (F.col("c_acctbal") >= 0, "phone_mismatch"), (F.col("live") > 0, "nothing_live"), (F.col("bought") > 0, "inactive")]
    return users.join(customers, "user_id", "left").groupBy(M.first_outcome(checks, "sent").alias("outcome")).agg(F.count("*").alias("n"))


@query("SELECT event_id, list_max(list_transform(regexp_extract_all(props, '[0-9]+'), lambda x: CAST(x AS BIGINT))) AS largest FROM events")
def largest_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest number in a text."""
    numbers = F.transform(F.regexp_extract_all("props", F.lit("([0-9]+)"), F.lit(1)), lambda x: x.cast("long"))
    return table(spark, sf_dir, "events").select("event_id", F.array_max(numbers).alias("largest"))


@query("SELECT event_id, sha256(concat(event_type, '-', props)) AS memo_key FROM events")
def memo_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key under which an answer is remembered."""
    return table(spark, sf_dir, "events").select("event_id", F.sha2(F.concat("event_type", F.lit("-"), "props"), 256).alias("memo_key"))


@query("SELECT event_id, date_trunc('month', ts) AS month_start, strftime(ts, '%Y-%m-%d') AS day, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s, ts >= TIMESTAMP '2024-01-30 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00' AS yesterday FROM events")
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month and day of a time, its epoch, and whether it lies in the day before NOW."""
    day = F.date_trunc("day", F.lit(NOW).cast("timestamp"))
    ts = F.col("ts").cast("timestamp")
    month = F.date_trunc("month", ts).cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select("event_id", month.alias("month_start"), F.date_format(ts, "yyyy-MM-dd").alias("day"), F.unix_timestamp(ts).alias("epoch_s"), ((ts >= day - F.expr("INTERVAL 1 DAY")) & (ts < day)).alias("yesterday"))


@query(f"SELECT string_agg('| ' || n_name || ' | ' || n || ' |', chr(10) ORDER BY n_name) AS report, sum(n) AS listings FROM (SELECT n_name, count(*) AS n FROM {LISTINGS} GROUP BY n_name)")
def markdown_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row, the table of a report; its lines are groups of a dimension, not rows of the corpus."""
    groups = listings(spark, sf_dir).groupBy("n_name").agg(F.count("*").alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct("n_name", "n")))
    lines = F.transform(ordered, lambda g: F.concat(F.lit("| "), g.n_name, F.lit(" | "), g.n.cast("string"), F.lit(" |")))
    return groups.agg(F.array_join(lines, "\n").alias("report"), F.sum("n").alias("listings"))


@query("SELECT DISTINCT conv_id, substr(sha256(role), 1, 16) AS role_id FROM conversations WHERE role IS NOT NULL")
def export_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridge of a normalised export."""
    return M.normalise(table(spark, sf_dir, "conversations"), "conv_id", "role")[1].select("conv_id", F.col("id").alias("role_id"))


from . import domain_queries  # noqa: E402, F401 - registers its queries
