"""The pipeline's stages against brute force, with null and repeated ids."""

import random

import pytest

pytest.importorskip("quaymark.llm")
import corpus_pipeline  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from quaymark.llm import components, pii  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_with_odd_ids():
    r = random.Random(3)
    texts = [" ".join(f"w{r.randrange(10**6)}" for _ in range(60)) for _ in range(9)]
    near = lambda t: t.rsplit(" ", 2)[0] + " other ending"
    rows = [
        (None, texts[0]),  # alone, without an id
        (5, texts[1]), (5, texts[1]), (5, texts[1]),  # one row three times
        (6, texts[2]), (6, texts[3]), (7, near(texts[3])),  # one id, two texts
        (None, texts[4]), (None, near(texts[4])),  # a group without ids
        (None, texts[5]), (9, near(texts[5])),  # an id goes before null
        (11, texts[6]), (10, texts[6]),
        (12, texts[7]), (12, near(texts[7])),  # a tie within one id
        (20, ""), (20, ""), (None, None), (21, "  "),
    ]
    return [(i, t, "en", "s", len(t or "")) for i, t in rows]


def shingles(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def groups_of(rows):
    sets = [shingles(r[1]) for r in rows]
    edges = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = dict(components.spanning([a for a, _ in edges], [b for _, b in edges]))
    out = {}
    for k, row in enumerate(rows):
        out.setdefault(root.get(k, k), []).append(row)
    return out.values()


@pytest.mark.parametrize("keys", [None, 1, 3])
def test_near_duplicates_keeps_one_row_of_each_group(spark, monkeypatch, keys):
    if keys:  # different rows share a key
        plain = pii.key
        monkeypatch.setattr(pii, "key", lambda text="text": F.pmod(plain(text), F.lit(keys)))
    rows = rows_with_odd_ids()
    got = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "").collect()]
    groups = list(groups_of(rows))
    assert len(got) == len(groups)
    for group in groups:
        kept = [r for r in got if r in group] if shingles(group[0][1]) else group
        assert set(kept) <= set(got) and len(set(kept)) == 1
        if shingles(group[0][1]):
            assert len(kept) == 1 and kept[0][0] == min((r[0] for r in group if r[0] is not None), default=None)


def test_row_keys_tell_rows_apart(spark, monkeypatch):
    docs = spark.createDataFrame(rows_with_odd_ids(), SCHEMA)
    for keys in (None, 1):
        if keys:
            monkeypatch.setattr(pii, "key", lambda text="text": F.lit(7).cast("long"))
        keyed = corpus_pipeline.with_row_keys(docs)
        assert keyed.select("__row").distinct().count() == docs.select("doc_id", "text").distinct().count() == keyed.select("__row", "doc_id", "text").distinct().count()
    assert corpus_pipeline.with_row_keys(docs.limit(0)).count() == 0


def test_language_id_keeps_recognised_rows_and_extra_columns(spark):
    rows = [(i, f"the words of an english text number {i}" if i % 2 else f"die wörter eines deutschen textes nummer {i}", "en" if i % 2 else "de", "s", 1, "more") for i in range(60)]
    odd = [(None, rows[1][1], None, None, None, "more"), (61, None, "en", "s", 1, "x"), (62, "", "en", "s", 1, "x"), (63, " 123 ", "en", "s", 1, "x"), rows[3]]
    docs = spark.createDataFrame(rows + odd, SCHEMA + ", lang_pred string")
    got = corpus_pipeline.language_id(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, rows + [odd[0], odd[4]]))
    assert corpus_pipeline.language_id(spark, docs.limit(0), "").count() == 0


def test_run_on_the_driver_tables_and_on_an_empty_one(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    pieces = corpus_pipeline.run(spark, sf).collect()
    ids = {r.doc_id for r in pieces}
    assert ids <= {r.doc_id for r in docs.select("doc_id").collect()} and 0.5 < len(ids) / docs.count() <= 1
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_decontamination_judges_rows(spark, tmp_path):
    item = "the plain passage of a benchmark that goes on for rather more than eight words in a row"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = rows_with_odd_ids() + [(None, f"intro {item} end", "en", "s", 1), (6, f"more {item} end", "en", "s", 1), (30, item, "en", "s", 1), (30, item, "en", "s", 1)]
    got = corpus_pipeline.decontamination(spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path)).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(map(tuple, got), key=key) == sorted((r for r in rows if item not in (r[1] or "")), key=key)


def test_other_stages_lose_no_row(spark):
    rows = rows_with_odd_ids()
    docs = spark.createDataFrame(rows, SCHEMA)
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted((tuple(r)[:2] for r in corpus_pipeline.pii_removal(spark, docs, "").collect()), key=key) == sorted((r[:2] for r in rows), key=key)
    starts = [r for r in corpus_pipeline.pack(spark, docs, "").collect() if r.start == 0]
    assert sorted(str(r.doc_id) for r in starts) == sorted(str(r[0]) for r in rows)
