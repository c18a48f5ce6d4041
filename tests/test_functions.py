"""Golden rows of the number, text and monitor functions."""

import pytest
from pyspark.sql import functions as F

from quaymark.functions import numbers as N
from quaymark.functions import text as X
from quaymark.operators import joins, ranking
from quaymark.plans import monitor

NUMBERS = [
    ("12,300", 12300.0, 12.0, 12300, None, 12300.0),
    ("HK$ 12,300", 12300.0, 12.0, None, None, None),
    ("12.9", 12.9, 12.9, 12, None, 12.9),
    ("-5", 5.0, 5.0, -5, -5, -5.0),
    ("", None, None, None, None, None),
    ("1200 HKD", 1200.0, 1200.0, 1200, None, 1200.0),
    (None, None, None, None, None, None),
]


def test_numbers(spark):
    df = spark.createDataFrame([(r[0],) for r in NUMBERS], "x string")
    got = df.select("x", N.parse_number("x"), N.parse_first_number("x"), N.whole_money_or_null("x"), N.int_or_null("x"), N.money_or_null("x")).collect()
    assert [tuple(r) for r in got] == NUMBERS


def test_numeric_numbers(spark):
    """Numbers keep their value and sign, however large; booleans are numbers."""
    df = spark.range(1)
    parsers = (N.parse_number, N.parse_first_number, N.whole_money_or_null, N.int_or_null, N.money_or_null)
    for value, expected in ((12.9, (12.9, 12.9, 12, 12, 12.9)), (12_000_000.0, (12e6, 12e6, 12_000_000, 12_000_000, 12e6)), (-5.0, (-5.0, -5.0, -5, -5, -5.0)), (7, (7.0, 7.0, 7, 7, 7.0)), (True, (1.0, 1.0, 1, 1, 1.0))):
        assert tuple(df.select(*[p(F.lit(value)) for p in parsers]).first()) == expected
    assert df.select(N.money_or_null(F.lit(" NaN "))).first()[0] != 0 and df.select(N.whole_money_or_null(F.lit("nan"))).first()[0] is None


def test_booleans(spark):
    cases = [(True, True, True), (False, False, False), ("1", True, True), (" YES ", True, True), ("y", False, True), ("0", False, False), ("x", False, None), (1, False, None), (0, False, None)]
    for value, pref, tri in cases:
        assert tuple(spark.range(1).select(N.bool_pref(F.lit(value)), N.bool_or_null(F.lit(value))).first()) == (pref, tri), value
    assert tuple(spark.range(1).select(N.bool_pref(F.lit(None).cast("boolean")), N.bool_or_null(F.lit(None).cast("string"))).first()) == (False, None)


@pytest.mark.parametrize(
    ("expr", "expected"),
    [
        (lambda: N.bedroom_group(F.lit(-5.0)), "studio"),
        (lambda: N.bedroom_group(F.lit(1)), "1 bedrooms"),
        (lambda: N.bedroom_order(F.lit("6+ bedrooms")), 99),
        (lambda: N.bedroom_order(F.lit("3 bedrooms")), 3),
        (lambda: N.bedroom_order(F.lit("other")), 100),
        (lambda: N.price_level(F.lit(39.9)), "affordable"),
        (lambda: N.price_level(F.lit(40.0)), "mid_market"),
        (lambda: N.price_level(F.lit(70.0)), "luxury"),
        (lambda: N.price_level(F.lit(None).cast("double")), "unknown"),
        (lambda: N.format_size(F.lit(1234.9)), "1234 sqft"),
        (lambda: N.py_round(F.lit(2.675), 2), 2.67),
        (lambda: N.closeness(F.lit(10000.0), F.lit(None).cast("double"), F.lit(10000.0), 45), 45.0),
        (lambda: N.closeness(F.lit(1.0), F.lit(None).cast("double"), F.lit(None).cast("double"), 45), 0.0),
        (lambda: N.budget_bucket(F.lit(None).cast("int"), F.lit(None).cast("int")), "unknown"),
        (lambda: N.budget_bucket(F.lit(None).cast("int"), F.lit(80000)), ">=80k"),
        (lambda: X.quality_reason(F.lit("home\nlogin here\nshare"), 1, 1, 0.1, 0.5), "too many navigation lines"),
        (lambda: X.quality_reason(F.lit(" \n "), 1, 1, 0.1), "empty text"),
        (lambda: X.strip_tracking_in_text(F.lit("a https://e.example/p?utm_source=a&x=1) b http://f.example/?gclid=2")), "a https://e.example/p?x=1) b http://f.example/"),
        (lambda: X.stripped_lower(F.lit("\u3000 A b\t")), "a b"),
        (lambda: X.stripped_lower(F.lit(None).cast("string")), ""),
        (lambda: X.normalise_price(F.lit(" HK$ 12,300 港元/月 ")), "12300"),
        (lambda: X.normalise_link(F.lit("//h.example/a#b"), "https://p.example"), "https://h.example/a"),
        (lambda: X.normalise_link(F.lit("/a#b"), "https://p.example"), "https://p.example/a"),
        (lambda: X.hk_mobile(F.lit("9123-4567")), True),
        (lambda: X.hk_mobile(F.lit("2123 4567")), False),
        (lambda: X.collapse(F.lit(" a \u3000\n b ")), "a b"),
        (lambda: ranking.photo_target(F.lit(0)), 0),
        (lambda: ranking.photo_target(F.lit(1)), 1),
        (lambda: ranking.photo_target(F.lit(3)), 2),
        (lambda: N.sqft_price_bucket(F.lit(None).cast("double")), "unknown"),
        (lambda: N.sqft_price_bucket(F.lit(29.99)), "under_30"),
        (lambda: N.sqft_price_bucket(F.lit(30.0)), "30_to_39_99"),
        (lambda: N.sqft_price_bucket(F.lit(80.0)), "80_plus"),
        (lambda: N.bedroom_group(F.lit("0")), "studio"),
        (lambda: N.bedroom_group(F.lit("2.9")), "2 bedrooms"),
        (lambda: N.bedroom_group(F.lit("6")), "6+ bedrooms"),
        (lambda: N.bedroom_group(F.lit(None).cast("string")), None),
        (lambda: N.budget_bucket(F.lit(5000), F.lit(None).cast("int")), "<10k"),
        (lambda: N.budget_bucket(F.lit(5000), F.lit(20000)), "20k-30k"),
        (lambda: N.closeness(F.lit(9000.0), F.lit(8000.0), F.lit(12000.0), 45), 27.0),
        (lambda: N.closeness(F.lit(7500.0), F.lit(8000.0), F.lit(12000.0), 45), 0.0),
        (lambda: N.closeness(F.lit(2.0), F.lit(2.0), F.lit(3.0), 20, 1.0), 16.0),
        (lambda: X.sanitise(F.lit("![a](u)[t](v) &amp;")), "t &"),
        (lambda: X.strip_tracking(F.lit("https://e.example/p?utm_source=a&x=1")), "https://e.example/p?x=1"),
        (lambda: X.skip_url(F.lit("https://a.example/tag/x")), True),
        (lambda: X.skip_url(F.lit("https://www.facebook.com/p")), False),
        (lambda: X.denoise(F.lit("Menu\nok\nMoneyHero offer\nMoneyHero offer")), "MoneyHero offer"),
        (lambda: X.category(F.lit(""), F.lit(""), F.lit("stamp duty near the MTR")), "PROCESS_LAW"),
        (lambda: X.category(F.lit(""), F.lit(""), F.lit("near the MTR")), "DISTRICT_ESTATE"),
        (lambda: X.chunk_id(F.lit("u"), F.lit("t"), F.lit(12345)).substr(17, 9), "_12345"),
        (lambda: ranking.photo_target(F.lit(9)), 1),
        (lambda: ranking.last_k_all(F.array(F.lit(1), F.lit(1)), 3, lambda x: x == 1), False),
    ],
)
def test_golden(spark, expr, expected):
    got = spark.range(1).select(expr().alias("v")).first()["v"]
    assert got == pytest.approx(expected, abs=1e-9) if isinstance(expected, float) else got == expected


def test_bbox_join_equals_cross(spark):
    points = spark.range(400).selectExpr("id as pid", "(id * 37 % 200) / 100.0D + 22 as plat", "(id * 91 % 300) / 100.0D + 113 as plng")
    probes = points.where("pid % 9 = 0").toDF("qid", "qlat", "qlng")
    got = {tuple(r) for r in joins.bbox_join(points, probes, 5).select("pid", "qid").collect()}
    import math

    p, q = points.collect(), probes.collect()
    r = 5 / 69.0
    assert got == {(a.pid, b.qid) for a in p for b in q if abs(a.plat - b.qlat) <= r and abs(a.plng - b.qlng) <= r / math.cos(math.radians(a.plat))}


@pytest.mark.parametrize("sites", [3, 40])
def test_nearest_by_brute_force(spark, monkeypatch, sites):
    """One row of sites, and grids of growing cells for more, with the date line and a pole in reach."""
    import math
    import random

    monkeypatch.setattr(joins, "SITES", 10)
    r = random.Random(3)
    spots = [(k, r.uniform(-60, 60), r.uniform(-180, 180)) for k in range(sites - 3)] + [(90, 10.0, 179.9), (91, 10.0, -179.8), (92, 89.0, 5.0)]
    points = [(k, r.uniform(-89, 89), r.uniform(-180, 180)) for k in range(80)] + [(100, 10.0, -179.95), (101, 10.05, 179.97), (102, None, 1.0), (103, 88.0, -170.0), (103, 88.0, -170.0)]

    def miles(a, b):
        h = math.sin(math.radians(b[1] - a[1]) / 2) ** 2 + math.cos(math.radians(a[1])) * math.cos(math.radians(b[1])) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return 2 * joins.EARTH_MILES * math.asin(math.sqrt(min(1.0, h)))

    got = joins.nearest(spark.createDataFrame(points, "pid long, plat double, plng double"), spark.createDataFrame([*spots, (99, None, None)], "sid long, slat double, slng double")).collect()
    expected = sorted((p[0], min((miles(p, s), s[0]) for s in spots)[1]) for p in points if p[1] is not None)
    assert sorted((x.pid, x.sid) for x in got) == expected


def snapshots(spark, channel, prints, confidence="medium"):
    rows = [("s", channel, i, confidence, f, f, "", "", "", "") for i, f in enumerate(prints)]
    return spark.createDataFrame(rows, "source_id string, channel string, seq long, confidence string, fingerprint string, price string, posted string, updated string, status string, title string")


@pytest.mark.parametrize(
    ("channel", "prints", "confidence", "mode", "changed"),
    [
        ("28hse", "AB", "high", "reference", [False, True]),
        ("28hse", "AB", "medium", "reference", [False, True]),
        ("midland", "ABB", "medium", "reference", [False, False, False]),
        ("midland", "ABB", "medium", "intended", [False, False, True]),
    ],
)
def test_monitor(spark, channel, prints, confidence, mode, changed):
    rows = monitor.fold(snapshots(spark, channel, prints, confidence), mode).orderBy("seq").collect()
    assert [r.changed for r in rows] == changed
    assert rows[0].reasons == ["initial_monitor"]
