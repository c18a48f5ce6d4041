"""Golden rows and edge cases of the domain operators."""

import pytest
from pyspark.sql import functions as F

from quaymark.functions import district
from quaymark.functions import pages as G
from quaymark.operators import batches, ids, market, matching, merge, places, queue, records, threads, users
from quaymark.sources import files

PREFS = "min_price long, max_price long, min_size long, max_size long, min_bedrooms long, max_bedrooms long, min_age long, max_age long, car boolean, village boolean, pets boolean, places array<struct<lat: double, lng: double>>, keywords array<string>"
PROP = "lat double, lng double, bedrooms long, price long, size long, age long, car boolean, village boolean, pets boolean"
POST = "lat double, lng double, bedrooms long, price long, size long, age long, features array<string>, district_en string, district_zh string, name_en string, name_zh string"
OPEN = dict.fromkeys(["min_price", "max_price", "min_size", "max_size", "min_bedrooms", "max_bedrooms", "min_age", "max_age", "car", "village", "pets"]) | {"places": [], "keywords": []}


def judged(spark, rule, schema, pref, listing):
    names = [f.split()[0] for f in schema.split(", ")]
    p = spark.createDataFrame([tuple((OPEN | pref).values())], PREFS).select(F.struct("*").alias("p"))
    x = spark.createDataFrame([tuple(listing.get(n) for n in names)], schema).select(F.struct("*").alias("x"))
    row = p.withColumn("j", F.lit(1)).join(x.withColumn("j", F.lit(1)), "j")
    return row.select(rule({n: F.col(f"p.{n}") for n in OPEN}, {n: F.col(f"x.{n}") for n in names})).first()[0]


@pytest.mark.parametrize(
    ("pref", "listing", "prop", "post"),
    [
        ({}, {}, False, False),  # without a price nothing matches
        ({}, {"price": 5}, True, True),
        ({"min_bedrooms": 2}, {"price": 5, "bedrooms": 2}, False, True),  # the lower bound is exclusive for properties
        ({"max_bedrooms": 2}, {"price": 5, "bedrooms": 2}, True, True),
        ({"max_price": 10_000}, {"price": 11_000}, True, True),
        ({"max_price": 10_000}, {"price": 11_001}, False, False),
        ({"min_price": 10_000}, {"price": 8_000}, True, True),
        ({"min_price": 10_000}, {"price": 7_999}, False, False),
        ({"max_size": 100}, {"price": 5, "size": 120}, True, True),
        ({"max_size": 100}, {"price": 5, "size": 121}, False, False),
        ({"max_size": 100}, {"price": 5}, True, True),  # unknown sizes pass
        ({"min_age": 5}, {"price": 5, "age": 4}, False, False),
        ({"car": True}, {"price": 5}, False, True),  # posts without features are not judged by them
        ({"places": [(22.3, 114.2)]}, {"price": 5}, False, False),
        ({"places": [(22.3, 114.2)], "keywords": ["wan chai"]}, {"price": 5, "district_en": "wan chai district", "district_zh": ""}, False, True),
        ({"places": [(22.3, 114.2)]}, {"price": 5, "lat": 22.31, "lng": 114.21}, True, True),
        ({"places": [(22.3, 114.2)]}, {"price": 5, "lat": 22.32, "lng": 114.2}, False, False),
    ],
)
def test_matching_rules(spark, pref, listing, prop, post):
    assert judged(spark, matching.prop_matches, PROP, pref, listing) is prop
    assert judged(spark, matching.post_matches, POST, pref, listing) is post


def test_match_join_reaches_every_price(spark):
    prefs = spark.createDataFrame([(i, lo, hi) for i, (lo, hi) in enumerate([(None, None), (0, 0), (5, 900), (1000, 10), (None, 10**7), (10**6, None), (100, 100)])], "i long, lo long, hi long")
    listings = spark.createDataFrame([(k, p) for k, p in enumerate([None, -3, 0, 1, 2, 80, 110, 111, 900, 990, 10**6, 800_000, 10**7, 10**13])], "k long, price long")
    test = "(lo is null or price >= lo * 0.8) and (hi is null or price <= hi * 1.1)"
    got = {(r.i, r.k) for r in matching.match_join(prefs, listings, "lo", "hi", "price").where(test).collect()}
    expected = {(p.i, x.k) for p in prefs.collect() for x in listings.collect() if x.price is not None and (p.lo is None or x.price >= p.lo * 0.8) and (p.hi is None or x.price <= p.hi * 1.1)}
    assert got == expected


ITEM = "array<struct<id: string, status: string, createdAt: string, expired_at: string>>"


def test_queue_items(spark):
    rows = [("100", None, 100, True), ("101", None, 100, False), (None, "0", 172800, True), (None, None, 5, False), ("soon", "0", 10**9, False), (None, "x", 10**9, False)]
    for expired_at, created, now, expected in rows:
        item = spark.createDataFrame([(("a", "pending", created, expired_at),)], "x struct<id: string, status: string, createdAt: string, expired_at: string>")
        assert item.select(queue.expired(F.col("x"), now)).first()[0] is expected
    q = spark.createDataFrame([([("a", "pending", None, "1"), ("b", "sent", None, "1"), ("c", "pending", None, "9"), ("a", "pending", None, "1"), (None, "pending", None, "9")],)], f"q {ITEM}")
    got = q.select(queue.first_live(F.col("q"), 5)["id"].alias("live"), queue.expire(F.col("q"), 5)["status"].alias("after"), queue.mark_first(F.col("q"), F.lit("a"), "skipped")["status"].alias("marked"), queue.n_expired(F.col("q"), 5).alias("n")).first()
    assert got.live == "c" and got.n == 1
    assert got.after == ["expired", "sent", "pending", "pending", "pending"] and got.marked == ["skipped", "sent", "pending", "pending", "pending"]
    empty = spark.createDataFrame([([],)], f"q {ITEM}")
    assert empty.select(queue.first_live(F.col("q"), 5), queue.n_expired(F.col("q"), 5)).first()[:] == (None, 0)


def test_messages(spark):
    contents = ["plain", '["a", {"text": "b"}, {"x": 1}]', "[not json", None, "[]"]
    got = spark.createDataFrame([(c,) for c in contents], "c string").select(threads.content_text(F.col("c"))).collect()
    assert [r[0] for r in got] == ["plain", "a\nb", "[not json", "", ""]
    said = lambda i: ("human" if i % 2 else "ai", f"message {i}")
    old = ("system", '{"type": "rolling_summary", "summary": " before "}')
    curated = ("system", "CURATED one")
    history = [old, ("system", "CURATED zero"), curated, *map(said, range(14))]
    t = spark.createDataFrame([(1, history, " now "), (2, history[:5], "now"), (3, history, " "), (4, [], "now")], "id long, messages array<struct<type: string, content: string>>, summary string")
    rows = {r.id: r for r in threads.with_rewrite(t, "CURATED", "summary").collect()}
    assert rows[1].due and rows[1].previous == "before" and len(rows[1].dialogue) == 8 and rows[1].dialogue[0].role == "assistant"
    assert [tuple(m) for m in rows[1].next] == [("system", '{"type":"rolling_summary","summary":"now"}'), curated, *map(said, range(8, 14))]
    assert not rows[2].due and len(rows[2].next) == 5 and rows[3].due and len(rows[3].next) == len(history) and rows[4].next == []


def test_archived_batches(spark):
    b = spark.createDataFrame([("c", i, i + 9, [(k,) for k in range(i, i + 10)]) for i in (0, 10, 20)], "code string, fromIndex long, toIndex long, messages array<struct<index: long>>")
    assert [r["index"] for r in threads.message_range(b, 5, 25).orderBy("index").collect()] == list(range(10, 20))
    assert threads.message_range(b, None, None).count() == 30


def test_short_ids(spark):
    df = spark.range(300).select("id", F.when(F.col("id") == 7, "keep").when(F.col("id") == 8, "").alias("short_id"))
    got = {r.id: r.short_id for r in ids.assign_short_ids(df, "id", length=2).collect()}
    assert len(set(got.values())) == 300 and got[7] == "keep" and all(set(v) <= set(ids.ALPHABET) for k, v in got.items() if k != 7)
    assert {r.id: r.short_id for r in ids.assign_short_ids(df.repartition(3), "id", length=2).collect()} == got
    with pytest.raises(RuntimeError):
        ids.assign_short_ids(df, "id", length=1, attempts=2)


def test_pages(spark):
    html = """<html><head><script type="application/ld+json">[{"offers": {"price": 12300}, "datePosted": " 1  May "}, {"@type": "RealEstateAgent", "name": "A"}]</script>
    <script type="application/ld+json">{broken</script><script type="application/ld+json">{"dateModified": "2 May", "itemListElement": [{"url": "/property-1"}, {"url": "https://p.example/property-2"}, {"url": "/property-1"}]}</script></head>
    <body><ol class="breadcrumb"><a><span itemprop="name">HK</span></a><a><span itemprop="name">Buy</span></a><a><span itemprop="name">East</span></a></ol><div class="slider-block"><img src="a.jpg"><img src="a.jpg"><img src="b.jpg"></div>
    <div class="content_body"><div class="x ten"><div class="message"><p class="header"> Flat &amp; view </p></div><div id="desc_normal">One<br>Two<script>no</script></div><div class="labels"><i class="label">new</i></div>
    <div class="contactsDiv"><b class="header">Ann</b><div class="content"><span class="less_span">代理個人牌照號碼: S-1</span></div></div><div class="propertyDate">刊登: 1/5 | 更新: 2/5</div>
    <table class="tablePair"><tr><td class="table_left">Size</td><td><span class="pairValue">300</span></td></tr></table></div></div><a class="detail_page" href="/property-9">z</a></body></html>"""
    agents = '<div class="agent"><b class="name">Bo</b><span class="license">E-2</span><a href="tel:+85291234567">call</a></div><div class="agent"><b class="name">No</b></div>'
    df = spark.createDataFrame([(1, html), (2, None), (3, agents), (4, '<a class="detail_page" href="/property-9">z</a><main>Main <b>text</b></main>')], "id long, html string")
    rows = {r.id: r for r in df.select("id", G.ld_json("html").alias("ld"), G.details("html").alias("d"), G.links_of("html", "https://p.example", "/property-").alias("links"), G.agents("html").alias("agents"), G.model_text("html", 9).alias("text")).collect()}
    assert tuple(rows[1].ld)[:3] == ("12300", "1 May", "2 May") and "RealEstateAgent" in rows[1].ld.agent and rows[2].ld.price == ""
    d = rows[1].d
    assert (d.location_parts, d.title, d.description, d.labels, d.posted, d.updated, d["info"], d.images) == (["East"], "Flat & view", "One\nTwo", ["new"], "1/5", "2/5", {"Size": "300"}, ["a.jpg", "b.jpg"])
    assert [tuple(c) for c in d.contacts] == [("Ann", "S-1")] and rows[2].d.title is None
    assert rows[1].links == ["/property-1", "https://p.example/property-2"] and rows[4].links == ["https://p.example/property-9"] and rows[2].links == []
    assert [tuple(a) for a in rows[3].agents] == [("Bo", "+85291234567", "E-2")] and rows[4].text == "Main\ntext"


def test_clean_page():
    page = "<title> A\nb </title><nav>menu</nav><main>One <b>two</b><div class='ads'>x</div><table><tr><th>Size<th>Price</tr><tr><td>3<td>$4</tr></table><table><tr><td>a</td><td>b</td></tr></table>"
    got = G.clean_page(page)
    assert got["title"] == "A b" and got["text"] == "One\ntwo\n\nStructured tables\nTable 1: Size | Price\nSize: 3; Price: $4\n\nTable 2\na | b"
    assert G.clean_page(None) == {"title": "", "text": ""} and G.clean_page("<p>x")["text"] == "x"


def test_seams(spark, tmp_path):
    pages = spark.createDataFrame([("u", "u", "200", "<p>"), ("v", "v", "404", "x"), ("w", "w", "200", " "), ("z", "z", "200", "Sorry, you have been blocked")], "url string, final_url string, http_status string, html string").withColumn("extra", F.lit(1))
    s = files.seam(pages, "fetched_pages")
    assert dict(s.dtypes)["http_status"] == "int" and "extra" not in s.columns
    assert [r[0] for r in s.orderBy("url").select(files.fetch_outcome()).collect()] == ["ok", "failed", "empty", "blocked"]
    with pytest.raises(ValueError):
        files.seam(pages, "geocodes")
    (tmp_path / "tiers.json").write_text('{"pro": {"free_cap": 5, "fields": ["a", "b"]}, "id": {"free_cap": null, "fields": []}}')
    assert sorted(map(str, map(tuple, files.read_tiers(spark, str(tmp_path / "tiers.json")).collect()))) == sorted(map(str, [("pro", 5, "a"), ("pro", 5, "b"), ("id", None, None)]))
    rows = spark.createDataFrame([("s", 1, "p"), ("t", 1, "q")], "source_id string, channel_id int, payload string")
    assert files.lookup_row(files.seam(rows, "relational_rows"), "t").first().payload == "q"


def test_source_fields_and_signals(spark):
    df = spark.range(1)
    f = lambda u: df.select(G.source_fields(F.lit(u), "28hse").alias("s")).first()["s"]
    assert tuple(f("https://p.example/buy/apartment/property-12-345?x#y")) == ("28hse-345", "property-12-345", "apartment", "buy")
    assert f("https://p.example/a/b") is None and tuple(f("https://p.example/a/b/c"))[0] == "28hse-c"
    gone = lambda *a: df.select(G.removed(*[F.lit(x) for x in a])).first()[0]
    assert gone(404, "u", "u", "") and gone(None, "u", "u", "") and gone(200, "u", "v", "") and gone(200, "u", "u/", "此樓盤已被隱藏") and not gone(200, "u", "u/", "")


def test_records(spark):
    listing = spark.createDataFrame([("s", ("5", "6"), ("h", 90))], "source_id string, extracted struct<rent_price: string, net_size_sqft: string>, summary struct<headline_en: string, confidence_score: int>")
    row = records.prop_payload(listing).first().asDict()
    assert len(row) == 14 and row["rent_price"] == "5" and row["confidence_score"] == 90 and row["number_of_bedrooms"] is None
    assert len(records.summary_payload(listing.withColumn("source_channel", F.lit("c")).withColumn("source_url", F.lit("u"))).columns) == 19
    post = spark.createDataFrame([(1, "rent", ("t",), ("d", "e", "n", "m", "building", None, 1990))], "id long, post_type string, post struct<title: string>, building struct<district_en: string, district_zh: string, name_en: string, name_zh: string, type: string, tower: string, built_in: int>")
    p = records.post_payload(post).first()
    assert p.post_id == "1" and p.district.zh_hk == "e" and p.estate_building.name.en == "n" and p.estate_building.builtIn == 1990 and p.floor is None
    photos = spark.createDataFrame([([("bath", "d", 5.0, True)],)], "p array<struct<room_type: string, image_description: string, quality_score: double, is_indoor: boolean>>")
    assert photos.select(records.compact_photos(F.col("p"))[0].alias("x")).first()["x"].asDict() == {"room": "bath", "desc": "d", "q": 5.0, "indoor": True}
    one = spark.range(1)
    schema = lambda **k: {n: F.lit(k.get(n)).cast("string") for n in ("name", "leiCode", "email", "telephone", "logo")}
    made = records.company(schema(name="中", telephone="tel:1"), schema(name="En", leiCode="C-1", email=" "), F.lit("m@x"), F.lit("2"))
    assert one.select(*[c.alias(n) for n, c in made.items()]).first().asDict() == {"name_en": "En", "name_zh": "中", "license": "C-1", "email": "m@x", "phone": "1", "logo": ""}
    assert tuple(one.select(records.license_parts(F.lit(" e-123 ")).alias("x")).first()["x"]) == ("E", "123")
    for lang, expected in (("en", "T - Sale: $1,200, 2 bed, 300 sqft"), ("zh-hk", "T - 售盤: $1,200，2房，300平方呎"), ("zh-cn", "T - 售盘: $1,200，2房，300平方英尺")):
        assert one.select(records.post_caption(F.lit("T"), F.lit("sale"), F.lit(1200), F.lit(2), F.lit(None).cast("int"), F.lit(300), F.lit(lang))).first()[0] == expected
    assert one.select(records.rendered(F.lit("X"), F.lit("en"))).first()[0].count("\n\n") == 2


def test_places(spark):
    parts = spark.createDataFrame([([("HK", ["country"]), ("East", ["locality", "political"])],)], "p array<struct<name: string, types: array<string>>>")
    assert parts.select(places.brief_regions(F.col("p"), ("locality", "sublocality"))).first()[0] == ["East"]
    one = spark.range(1)
    assert one.select(places.joined_name(F.lit(" a "), F.lit(""), F.lit(None).cast("string"), F.lit("b"))).first()[0] == "a b"
    assert one.select(places.estate_query(F.lit("flat"), F.lit("E"), F.lit(""))).first()[0] == "flat E, Hong Kong"
    assert one.select(places.estate_query(F.lit("flat"), F.lit(" "), F.lit("D"))).first()[0] is None


def test_users(spark):
    u = spark.createDataFrame([([("mail", "x"), ("phone", ""), ("phone", "1"), ("phone", "2")],), ([],), (None,)], "i array<struct<type: string, key: string>>")
    assert [r[0] for r in u.select(users.phone_of(F.col("i"))).collect()] == ["1", None, None]
    assert [r[0] for r in u.select(users.phone_matches(F.col("i"), F.lit("2"))).collect()] == [True, False, False]


def test_merges(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k long, x string, y int")
    new = spark.createDataFrame([(1, "p", 3), (1, "q", 0), (3, "r", 4), (3, "r", 4)], "k long, x string, y int")
    assert sorted(map(tuple, merge.upsert(old, new, "k").collect())) == [(1, "q", 0), (2, "b", 2), (3, "r", 4)]
    changes = spark.createDataFrame([(1, None, ["y"]), (2, "z", None), (2, "y", None)], "k long, x string, gone array<string>")
    assert sorted(map(tuple, merge.partial_update(old, changes, "k", "gone").collect())) == [(1, "a", None), (2, "z", 2)]
    assert merge.outbox(old, "mail", "k", ["x"]).orderBy("key").first().body == '{"x":"a"}'
    listing = spark.createDataFrame([("s", [("A", "L", ["1", ""], ["wa.me/8529123456789"]), ("A", "K", ["1"], None)])], "source_id string, contacts array<struct<name: string, license_no: string, phones: array<string>, wtsapps: array<string>>>")
    t = merge.contact_tables(listing)
    assert {n: d.count() for n, d in t.items()} == {"contacts": 1, "phones": 2, "contact_phones": 2, "property_contacts": 1} and t["contacts"].first().license_no == "K"


def test_overwrite(spark, tmp_path):
    for n in (3, 2):
        merge.overwrite(spark.range(n), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_batch_lines(spark):
    assert batches.valid_batch(spark.createDataFrame([(" ",), ("x",)], "value string")).count() == 1
    done = spark.createDataFrame([("completed", "f"), ("completed", None), ("failed", "f")], "status string, output_file_id string")
    assert batches.completed(done).count() == 1


def test_medians(spark):
    import random
    import statistics

    r = random.Random(2)
    rows = [(r.choice("abc") if r.random() < 0.9 else None, r.choice([None, *map(float, range(9)), r.random()])) for _ in range(300)] + [("z", None), ("one", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    values = lambda g: [v for k, v in rows if k == g and v is not None]
    assert {x.g: x.median for x in market.medians(df, ["g"], "v").collect()} == {g: statistics.median(values(g)) for g in {k for k, _ in rows} if values(g)}
    assert market.medians(df, [], "v").first().median == statistics.median(v for _, v in rows if v is not None)
    assert market.medians(df.limit(0), [], "v").first()[0] is None


@pytest.mark.parametrize(("name", "english", "simplified"), [("灣仔", "Wan Chai", "湾仔"), ("西半山", "Mid-Levels West", "西半山"), ("將軍澳", "Tseung Kwan O", "将军澳"), ("鰂魚涌", "Quarry Bay", "鲗鱼涌"), ("西營盤", "Sai Ying Pun", "西营盘"), ("九龍站", "Kowloon Station", "九龙站"), ("東區", "Eastern District", "东区"), ("Unknown", "Unknown", "未知"), ("別處", "別處", "別處")])
def test_district_translations(spark, name, english, simplified):
    assert tuple(spark.range(1).select(district.english_name(F.lit(name)), district.simplified_name(F.lit(name))).first()) == (english, simplified)
