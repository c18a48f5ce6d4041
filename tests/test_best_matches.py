"""Ranked posts by classes and rounds (F2): the rows of brute force, from few pairs."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from quaymark.functions import numbers as N
from quaymark.operators import matching
from quaymark.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
WEIGHTS = {"price": (45.0, 0.25), "size": (25.0, 0.25), "bedrooms": (20.0, 1.0)}


@pytest.mark.parametrize("slacks", [(), (0.5, 5.0)])
def test_best_matches_equal_brute_force(spark, monkeypatch, slacks):
    monkeypatch.setattr(matching, "BLOCK", 60)
    r = random.Random(11)
    some = lambda *values: r.choice([None, *values])
    prefs = [(i, r.sample(["a", "b", "c"], r.randint(1, 3)) if i % 2 else [""], some(300, 900), some(500, 1200), some(50, 90), some(120, 200), some(0.0, 600.0, 333.0), some(0.0, 80.0), some(2.0, 3.5)) for i in range(40)]
    prefs += [(90, [""], None, None, None, None, -40.0, None, -1.0), (91, [""], 10**6, None, None, None, 1e6, None, None), (92, [""], None, None, None, None, None, None, None)]
    # Few classes, fresh values that differ by less than rounding shows, and many ties.
    listings = [(k, ["", *r.sample(["a", "b"], r.randint(0, 2))], some(-70, 1, 400, 480, 600, 1100), some(0, 70, 80, 180), some(0, 2, 3), r.choice([0.0, 4.0, 4.004, 4.0049, 4.012, r.uniform(0, 10)])) for k in range(700)]
    p = spark.createDataFrame(prefs, "i long, zones array<string>, min_price long, max_price long, min_size long, max_size long, mid_price double, mid_size double, mid_bedrooms double")
    x = spark.createDataFrame(listings, "k long, zones array<string>, price long, size long, bedrooms long, fresh double")
    test = F.expr("(min_price is null or price >= min_price * 0.8) and (max_price is null or price <= max_price * 1.1) and (size is null or ((min_size is null or size >= min_size * 0.8) and (max_size is null or size <= max_size * 1.2)))")
    base = sum((N.around(n, f"mid_{n}", *w) for n, w in list(WEIGHTS.items())[1:]), N.around("price", "mid_price", *WEIGHTS["price"]))
    every = p.withColumnRenamed("zones", "pz").crossJoin(x).where(F.arrays_overlap("pz", "zones") & F.col("price").isNotNull() & test)
    scored = every.select("i", "k", N.nudged_round(base + F.col("fresh"), 2).alias("score")).collect()
    want = []
    for i in {s.i for s in scored}:
        want += [(i, k, -v, n) for n, (v, k) in enumerate(sorted((-s.score, s.k) for s in scored if s.i == i)[:4], 1)]
    got = matching.best_matches(p, x, "i", "k", test, base, WEIGHTS, 4, slacks)
    assert sorted((row.i, row.k, row.score, row.place) for row in got.collect()) == sorted(want) and len(want) > 100
    assert matching.best_matches(p, x.limit(0), "i", "k", test, base, WEIGHTS, 4, slacks).count() == 0
    assert matching.best_matches(p.limit(0), x, "i", "k", test, base, WEIGHTS, 4, slacks).count() == 0


def test_one_class_of_many_listings_keeps_few(spark):
    x = spark.range(20000).select(F.col("id").alias("k"), F.lit(5).alias("price"), ((F.col("id") * 7919 % 10007) / 1000.7).alias("fresh"))
    classes, heads = matching.like_heads(x.unionByName(x.select(F.col("k") + 20000, "price", F.lit(0.0).alias("fresh")).toDF(*x.columns)), "k", 6)
    assert classes.count() == 1 and 6 <= heads.count() < 60


def test_post_match_ranked_tests_few_pairs(spark, tmp_path, monkeypatch):
    """With 20 times the listings the query gives the rows of its SQL, and its predicate sees a small part of all pairs."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    step = con.execute(f"SELECT max(p_partkey) - min(p_partkey) + 1 FROM '{SF}/part.parquet'").fetchone()[0]
    con.execute(f"COPY (SELECT t.* REPLACE (t.p_partkey + i * {step} AS p_partkey) FROM '{SF}/part.parquet' t, range(20) r(i)) TO '{tmp_path}/part.parquet' (FORMAT parquet)")
    con.execute(f"COPY (FROM '{SF}/customer.parquet') TO '{tmp_path}/customer.parquet' (FORMAT parquet)")
    for t in ("part", "customer"):
        con.execute(f"CREATE VIEW {t} AS FROM '{tmp_path}/{t}.parquet'")
    seen = spark.sparkContext.accumulator(0)
    rule = matching.post_matches

    def counted(p, x):
        @F.udf("boolean")
        def see(price):
            seen.add(1)
            return True

        return F.when(see(x["price"]), rule(p, x))

    monkeypatch.setattr(matching, "post_matches", counted)
    got = sorted((r.conv_id, r.k, r.score, r.place) for r in QUERIES["post_match_ranked"](spark, str(tmp_path)).collect())
    found = con.execute(f"SELECT conv_id, k, score, place FROM ({ORACLE_SQL['post_match_ranked']})").fetchall()
    assert got == sorted(found)
    pairs = con.execute("SELECT (SELECT count(*) FROM part) * (SELECT count(*) FROM customer)").fetchone()[0]
    assert seen.value < pairs / 200
