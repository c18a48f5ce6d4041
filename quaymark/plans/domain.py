"""Domain tables made from the driver's tables, for queries and their SQL alike.

Every column is one expression that Spark and DuckDB read in the same way, so both sides see the same
rows; ``duck`` spells the few names that differ.  Small dimensions are literal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The end of the events as epoch seconds, and its year.
NOW, YEAR = 1_706_659_200, 2024

DISTRICTS = "CASE {0} % 5 WHEN 0 THEN 'Wan Chai' WHEN 1 THEN 'Sha Tin' WHEN 2 THEN 'Tai Po' WHEN 3 THEN 'Sai Kung' ELSE 'Kwun Tong' END"
TABLES: dict[str, tuple[str, dict[str, str]]] = {
    "listings": ("part", {
        "k": "p_partkey",
        "source_id": "'src-' || CAST(p_partkey AS STRING)",
        "channel": "CASE p_partkey % 3 WHEN 0 THEN '28hse' WHEN 1 THEN 'midland' ELSE 'house730' END",
        "kind": "CASE WHEN p_partkey % 4 = 0 THEN 'sale' WHEN p_partkey % 9 = 0 THEN NULL ELSE 'rent' END",
        "status": "CASE WHEN p_partkey % 11 = 0 THEN 'archived' WHEN p_partkey % 11 = 1 THEN NULL WHEN p_partkey % 5 = 0 THEN 'pending_extraction' WHEN p_partkey % 5 = 1 THEN 'photo_analysed' WHEN p_partkey % 5 = 2 THEN 'photo_analysing' WHEN p_partkey % 5 = 3 THEN 'published' ELSE 'data_extracted' END",
        "created_at": "1704067200 + (p_partkey * 7919) % 2592000",
        "updated_at": "CASE WHEN p_partkey % 6 = 2 THEN 0 ELSE 1706659200 - (p_partkey * 4001) % 1000000 END",
        "rent_price": "CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 7 = 1 THEN 'HK$ ' || CAST(p_size * 431 AS STRING) WHEN p_partkey % 7 = 2 THEN '12,3' || CAST(10 + p_size AS STRING) ELSE CAST(p_size * 431 + p_partkey % 100 AS STRING) END",
        "sell_price": "CASE WHEN p_partkey % 5 = 0 THEN CAST(p_size * 150000 AS STRING) END",
        "price_sqft": "CASE WHEN p_partkey % 6 = 0 THEN CAST(25 + p_partkey % 60 AS STRING) END",
        "price_per_sqft": "CASE WHEN p_partkey % 10 = 3 THEN CAST(20 + p_partkey % 70 AS STRING) || '.5' END",
        "net_size": "CASE WHEN p_partkey % 8 = 0 THEN NULL WHEN p_partkey % 8 = 1 THEN 0 ELSE p_size * 12 + 40 END",
        "gross_size": "p_size * 15 + 60",
        "bedrooms": "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(p_size % 8 AS STRING) END",
        "age": "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size END",
        "building": "CASE WHEN p_partkey % 17 = 0 THEN '' ELSE 'Estate ' || CAST(p_partkey % 40 AS STRING) END",
        "estate_id": "p_partkey % 50",
        "district": DISTRICTS.format("p_partkey"),
        "lat": "CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE 22.2e0 + ((p_partkey * 37) % 300) / 1000e0 END",
        "lng": "113.9e0 + ((p_partkey * 91) % 400) / 1000e0",
        "car": "p_partkey % 2 = 0",
        "pets": "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_partkey % 3 = 1 END",
        "village": "p_partkey % 5 = 0",
        "confidence": "CASE WHEN p_partkey % 12 = 0 THEN NULL ELSE (p_partkey * 31) % 101 END",
        "indexing": "CASE WHEN p_partkey % 4 = 1 THEN 'indexed' END",
        "summary_code": "CASE WHEN p_partkey % 3 = 1 THEN 'b' || CAST(p_partkey % 9 AS STRING) END",
        "features": "CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN ARRAY('Car Park', 'pets ok') WHEN 2 THEN ARRAY('village view', 'gym') ELSE ARRAY('sea view', ' ') END",
        "reviewed_at": "CASE WHEN p_partkey % 4 = 2 THEN NULL ELSE 1706659200 - (p_partkey * 613) % 50000 END",
    }),
    "estates": ("part", {
        "estate_id": "p_partkey - 1",
        "name_en": "CASE WHEN p_partkey % 7 = 0 THEN 'green village' WHEN p_partkey % 7 = 1 THEN '' ELSE 'estate ' || CAST(p_partkey AS STRING) END",
        "name_zh": "CASE WHEN p_partkey % 9 = 0 THEN '大村屋' WHEN p_partkey % 9 < 4 THEN '' ELSE '邨' || CAST(p_partkey AS STRING) END",
        "district_en": "lower(" + DISTRICTS.format("p_partkey") + ")",
        "district_zh": "CASE p_partkey % 3 WHEN 0 THEN '灣仔' WHEN 1 THEN '沙田' ELSE '' END",
        "built_in": "CASE WHEN p_partkey % 6 = 0 THEN NULL WHEN p_partkey % 6 = 1 THEN 1700 WHEN p_partkey % 6 = 2 THEN 2030 ELSE 1960 + p_partkey END",
        "lat": "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 22.2e0 + ((p_partkey * 53) % 300) / 1000e0 END",
        "lng": "113.9e0 + ((p_partkey * 71) % 400) / 1000e0",
    }),
    "prefs": ("customer", {
        "conv_id": "c_custkey",
        "thread_id": "'+852' || CAST(50000000 + c_custkey % 1200 AS STRING)",
        "state": "CASE WHEN c_custkey % 4 = 0 THEN 'MUTED' ELSE 'ACTIVE_TRACKING' END",
        "language": "CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN ' EN ' WHEN 2 THEN 'zh-cn' ELSE '' END",
        "created_at": "1704067200 + (c_custkey * 104729) % 2592000",
        "updated_at": "1706659200 - (c_custkey * 977) % 30000",
        "min_price": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(2000 + (c_custkey * 37) % 9000 AS STRING) END",
        "max_price": "CASE WHEN c_custkey % 4 = 1 THEN NULL WHEN c_custkey % 4 = 2 THEN '1' || CAST(c_custkey % 9 AS STRING) || ',500' ELSE CAST(6000 + (c_custkey * 53) % 16000 AS STRING) END",
        "min_size": "CASE WHEN c_custkey % 5 < 2 THEN NULL ELSE 60 + (c_custkey * 7) % 300 END",
        "max_size": "CASE WHEN c_custkey % 5 = 3 THEN NULL ELSE 200 + (c_custkey * 11) % 500 END",
        "min_bedrooms": "CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_custkey % 4 END",
        "max_bedrooms": "CASE WHEN c_custkey % 3 = 1 THEN NULL ELSE 1 + c_custkey % 6 END",
        "min_age": "CASE WHEN c_custkey % 7 = 0 THEN 5 END",
        "max_age": "CASE WHEN c_custkey % 6 = 0 THEN 40 END",
        "car": "CASE c_custkey % 10 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' END",
        "village": "CASE c_custkey % 15 WHEN 0 THEN '1' WHEN 1 THEN 'x' END",
        "pets": "CASE c_custkey % 12 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'false' END",
        "districts": "CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN ARRAY('Wan Chai', 'Tai Po') WHEN 2 THEN ARRAY('Nowhere') ELSE ARRAY('Sha Tin', '', 'Wan Chai') END",
    }),
    "users": ("customer", {
        "user_id": "c_custkey",
        "status": "CASE WHEN c_custkey % 13 = 0 THEN 'deleted' WHEN c_custkey % 13 = 1 THEN NULL ELSE 'active' END",
        "phone": "CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 6 = 1 THEN '' ELSE '+852' || CAST(50000000 + c_custkey % 400 AS STRING) END",
        "v2_state": "CASE c_custkey % 5 WHEN 0 THEN 'MUTED' WHEN 1 THEN 'SLEEPING' WHEN 2 THEN 'ACTIVE_TRACKING' END",
        "muted": "CASE WHEN c_custkey % 7 = 0 THEN TRUE END",
        "disabled": "c_custkey % 9 = 0",
        "v2_language": "CASE c_custkey % 3 WHEN 0 THEN ' EN' WHEN 1 THEN '' END",
        "old_language": "CASE c_custkey % 4 WHEN 0 THEN 'zh-CN' END",
    }),
    "photos": ("lineitem", {
        "photo_id": "l_orderkey * 10 + l_linenumber",
        "source_id": "'src-' || CAST(l_partkey AS STRING)",
        "status": "CASE WHEN l_partkey % 3 = 0 AND l_linenumber = 1 THEN 'batch_created' WHEN (l_orderkey + l_linenumber) % 6 = 1 OR l_partkey % 7 = 0 THEN 'photo_analysis_failed' ELSE 'photo_analysed' END",
        "quality": "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE (l_orderkey * 13 + l_linenumber) % 101 END",
        "is_property": "l_orderkey % 5 <> 0",
        "is_violating": "CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_orderkey % 17 = 0 END",
        "is_human": "l_linenumber = 6",
        "blob_url": "CASE WHEN l_linenumber % 2 = 0 THEN 'blob/' || CAST(l_orderkey AS STRING) END",
        "redownloaded_at": "CASE WHEN l_orderkey % 3 = 0 THEN 1 END",
    }),
}
LITERALS: dict[str, tuple[str, list[tuple]]] = {
    "geocodes": ("keyword string, lat double, lng double", [("Wan Chai", 22.278, 114.172), ("Sha Tin", 22.381, 114.188), ("Kwun Tong", 22.312, 114.225)]),
    "templates": ("n int, lang string, template string", [(1, "en", "one_en"), (2, "en", "two_en"), (4, "en", "four_en"), (2, "zh-hk", "two_hk"), (3, "zh-hk", "three_hk")]),
}


def duck(expression: str) -> str:
    return expression.replace("ARRAY(", "list_value(")


def rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The domain table as a DataFrame."""
    if name in LITERALS:
        schema, values = LITERALS[name]
        return spark.createDataFrame(values, schema)
    source, columns = TABLES[name]
    return spark.read.parquet(f"{sf_dir}/{source}.parquet").selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def sql(*names: str) -> str:
    """The domain tables as common table expressions of DuckDB, to be followed by more of them or a query."""
    out = []
    for name in names:
        if name in LITERALS:
            schema, values = LITERALS[name]
            fields = [f.split() for f in schema.split(", ")]
            text = ", ".join("(" + ", ".join(f"CAST({v!r} AS {kind})" for v, (_, kind) in zip(row, fields, strict=True)) + ")" for row in values)
            out.append(f"{name}({', '.join(f for f, _ in fields)}) AS (VALUES {text})")
        else:
            source, columns = TABLES[name]
            out.append(f"{name} AS (SELECT {', '.join(f'{duck(e)} AS {c}' for c, e in columns.items())} FROM {source})")
    return "WITH " + ", ".join(out)
