"""Golden rows of districts, chunks, file sources and the later text functions."""

import pytest
from pyspark.sql import functions as F

from quaymark.functions import chunking, district
from quaymark.functions import text as X
from quaymark.operators import joins, merge
from quaymark.sources import files

DISTRICTS = [
    (None, "Unknown"), ("", "Unknown"), ("  ", "Unknown"), ("香港島", "Unknown"), ("新界東", "Unknown"), ("Kowloon", "Unknown"), ("湾仔区", "灣仔"), ("港島灣仔", "灣仔"),
    ("Wan Chai, Hong Kong", "灣仔"), ("Central and Western", "中環"), ("港島東", "東區"), ("【筍盤】沙田（第一城）", "沙田"), ("半山區, 堅道", "堅道"), ("九龍塘", "九龍塘"), ("山", "Unknown"), ("Foo Bar", "Foo Bar"),
]


def test_districts(spark):
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(DISTRICTS)], "i int, x string")
    got = [r[0] for r in df.orderBy("i").select(district.district_name("x")).collect()]
    assert got == [y for _, y in DISTRICTS]
    regions = spark.createDataFrame([("東涌",), ("灣仔",), ("觀塘",), ("葵青",), ("x",), (None,)], "d string").select(district.region_of("d")).collect()
    assert [r[0] for r in regions] == ["離島", "香港島", "九龍", "新界", "Unknown", "Unknown"]


def test_chunks(spark):
    text = "\n\n".join(" ".join(f"w{i}x{j}" for j in range(30)) for i in range(6)) + " " + "山" * 50
    out = chunking.chunks_of(text, 40, 5)
    assert all(len(chunking.TOKEN.findall(c)) <= 45 for c in out)
    assert all(f"w{i}x{j}" in " ".join(out) for i in range(6) for j in range(30))
    assert out[1].startswith("w0x25 w0x26 w0x27 w0x28 w0x29\n\nw1x0")
    assert chunking.chunks_of(None) == chunking.chunks_of(" \n ") == [] and chunking.chunks_of("a b") == ["a b"]
    got = spark.createDataFrame([(text,), (None,)], "t string").select(chunking.chunk_text("t", 40, 5)).collect()
    assert [r[0] for r in got] == [out, []]


def test_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\n{bad\n{"x": 2, "y": 3}\n')
    (tmp_path / "seeds.txt").write_text("# c\nhttps://a.example/x # note\n\nnot a url\n")
    assert sorted(r.x for r in files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "x int").collect()) == [1, 2]
    assert [r.seed for r in files.read_seeds(spark, str(tmp_path / "seeds.txt")).collect()] == ["https://a.example/x"]
    assert files.read_seeds(spark, str(tmp_path / "seeds.txt"), urls=False).count() == 2
    assert files.read_folder(spark, str(tmp_path), "*.jsonl").select("file").distinct().count() == 1
    place = '{"type": "Feature", "properties": {"GEO_NAME_ID": "%s", "PLACE_CLASS": "%s", "DISTRICT": "d", "NAME_TC": "n"}, "geometry": {"type": "Point", "coordinates": [%s, 22.5]}}'
    (tmp_path / "g.json").write_text('{"features": [%s]}' % ",".join([place % ("1", "Settlement", "114.1"), place % ("1", "Settlement", "114.2"), place % ("2", "Hill", "114.3")]))
    g = files.read_geojson(spark, str(tmp_path / "g.json"), "GEO_NAME_ID: string, PLACE_CLASS: string, DISTRICT: string, NAME_TC: string")
    rows = files.settlements(g.select("GEO_NAME_ID", "NAME_TC").distinct(), g).collect()
    assert [(r.GEO_NAME_ID, r.NAME_TC, r.lng, r.lat) for r in rows] == [("1", "n", 114.2, 22.5)]


@pytest.mark.parametrize(
    ("expr", "expected"),
    [
        (lambda: X.valid_listing_url(F.lit("https://www.b.example/rent/x-12"), "b.example", r"^/(rent|buy)/(.*/)?[^/]*-\d+/?$"), True),
        (lambda: X.valid_listing_url(F.lit(None).cast("string"), "b.example", "."), False),
        (lambda: X.blocked_page(F.lit("<h1>Sorry, you have been BLOCKED</h1>")), True),
        (lambda: X.price_in_text(F.lit("now HK$ 12,300 or 9,999港元")), "12,300"),
        (lambda: X.price_in_text(F.lit("9,999 港元")), "9,999"),
        (lambda: X.price_in_text(F.lit(None).cast("string")), ""),
        (lambda: X.bare_phone(F.lit("tel:+852 9123-4567")), "91234567"),
        (lambda: X.language_or(F.lit(" EN "), ("en", "zh-hk"), "zh-hk"), "en"),
        (lambda: X.language_or(F.lit(None).cast("string"), ("en",), "en"), "en"),
        (lambda: X.links(F.lit("<a class=x href='/a'>1</a><A HREF=\"/b\">2</A><a href='/a'>3</a>")), ["/a", "/b"]),
    ],
)
def test_text(spark, expr, expected):
    assert spark.range(1).select(expr()).collect()[0][0] == expected


def test_nearest_in_blocks(spark, monkeypatch):
    points = spark.range(50).selectExpr("id as pid", "id * 1.3D - 30 as plat", "id * 5.1D - 120 as plng")
    sites = spark.range(40).selectExpr("id as sid", "(id * 7 % 40) - 20.5D as slat", "(id * 11 % 40) * 6D - 119 as slng")
    whole = sorted(map(tuple, joins.nearest(points, sites).collect()))
    monkeypatch.setattr(joins, "SITES", 3)
    assert sorted(map(tuple, joins.nearest(points, sites).collect())) == whole and len(whole) == 50
    assert joins.nearest(points, sites.limit(0)).count() == 0


def test_queue_append(spark):
    conversations = spark.createDataFrame([("a", [("p", "pending", 1, 2)]), ("b", None), ("c", []), ("d", [])], "id string, queue array<struct<post_id: string, status: string, createdAt: long, expired_at: long>>")
    matches = spark.createDataFrame([("a", ["p", "q"]), ("b", ["q", "r"]), ("c", []), ("x", ["q"])], "id string, post_ids array<string>")
    got = {r.id: (r.outcome, [tuple(i) for i in r.queue or []]) for r in merge.queue_append(conversations, matches, 100).collect()}
    assert got == {"a": ("already_queued", [("p", "pending", 1, 2)]), "b": ("queued", [("q", "pending", 100, 172900)]), "c": ("nothing_matched", []), "d": (None, []), "x": ("conversation_not_found", [])}
    again = {r.id: len(r.queue or []) for r in merge.queue_append(conversations, matches, 100, guard=False).collect()}
    assert again == {"a": 2, "b": 1, "c": 0, "d": 0, "x": 0}
