"""Operator 8 where a document holds several instances of an item's template."""

import pytest

pytest.importorskip("quaymark.llm")
from quaymark.llm import decontaminate  # noqa: E402

ITEM = "there were 12 apples in a box and then 12 pears in a bag so the farmer took 12 plums home and ate 12 figs at night"
VALUES = iter("31 32 33 34".split())
WRONG = " ".join(next(VALUES) if w == "12" else w for w in ITEM.split())
FILLER = "nothing of this kind stands between the passages of the page"


def kinds(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    return {r.doc_id: (r.kind, r.coverage) for r in decontaminate.contaminated(docs, bench).collect()}


def test_every_offset_is_judged(spark):
    words = ITEM.split()
    partial = " ".join(words[:19])
    split = f"{' '.join(words[:14])} and also, {' '.join(words[14:])}"
    got = kinds(spark, WRONG, f"{WRONG} {FILLER} {ITEM}", f"{ITEM} {FILLER} {WRONG}", f"{WRONG} {FILLER} {partial}", f"{WRONG} {FILLER} {WRONG}", f"{WRONG} {FILLER} {split}")
    assert 0 not in got and 4 not in got
    assert got[1] == got[2] == ("copy", 1.0)
    assert got[3][0] == got[5][0] == "copy" and 0.5 <= got[3][1] < 1
