"""The range join and the vector search over whole query sets, by brute force."""

import math
import random

from quaymark.operators import joins, vector
from quaymark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_row_probes(spark):
    assert {r.qid for r in QUERIES["match_bbox_all"](spark, SF).collect()} == {r.vec_id for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}


def test_bbox_join_by_brute_force(spark):
    r = random.Random(7)
    rows = [(k, r.uniform(0, 0.1) + base, r.uniform(0, 0.2)) for k, base in enumerate([0, 60, -70, 88] * 60)] + [(900, None, 1.0), (901, 60.01, None), (902, 60.01, 0.1), (902, 60.01, 0.1)]
    e = spark.createDataFrame(rows, "id long, lat double, lng double")
    got = sorted(tuple(x) for x in joins.bbox_join(e.toDF("pid", "plat", "plng"), e.toDF("qid", "qlat", "qlng")).select("pid", "qid").collect())
    known = [x for x in rows if None not in x]
    assert got == sorted((p[0], q[0]) for p in known for q in known if abs(p[1] - q[1]) <= 1 / 69 and abs(p[2] - q[2]) <= 1 / 69 / abs(math.cos(math.radians(p[1]))))


def test_every_query_has_its_nearest_vectors(spark, monkeypatch):
    monkeypatch.setattr(vector, "BLOCK_QUERIES", 2)
    rows = [r for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = {}
    for r in QUERIES["vector_topk_queries"](spark, SF).orderBy("query_id", "place").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    norm = lambda v: math.sqrt(math.fsum(x * x for x in v))
    expected = {}
    for q in (r for r in rows if r.vec_id % 100 == 0):
        scored = [(-round(math.fsum(x * y for x, y in zip(q.embedding, r.embedding)) / norm(q.embedding) / norm(r.embedding) + 1e-9, 6), r.vec_id) for r in rows if r.label != 3]
        expected[q.vec_id] = [i for _, i in sorted(scored)[:10]]
    assert got == expected and len(got) > 1
