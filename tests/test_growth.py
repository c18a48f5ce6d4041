"""Joins on very frequent values meet a number of rows that grows with the input, not with its square."""

from pyspark.sql import functions as F

from quaymark.operators import places
from quaymark.plans.queries import QUERIES


def met(df):
    """The rows of ``df`` and the most rows that a join of its plan made."""
    rows, most, todo = df.collect(), 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        kind = p.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(p.plan())
        else:
            children = p.children()
            todo += [children.apply(i) for i in range(children.size())]
        if "Join" in kind and p.metrics().contains("numOutputRows"):
            most = max(most, p.metrics().apply("numOutputRows").value())
    return rows, most


def test_upsert_by_a_name_that_many_share(spark):
    n = 300
    old = spark.range(n).select("id", F.lit("green village").alias("name_en"), F.concat(F.lit("z"), F.col("id").cast("string")).alias("name_zh"), F.lit(0).alias("v"))
    new = spark.range(n).select(F.lit("green village").alias("name_en"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("z"), (F.col("id") + n // 2).cast("string"))).alias("name_zh"), F.lit(1).alias("v"))
    rows, most = met(places.upsert_by_names(old, new, ["name_en", "name_zh", "v"]))
    found = {r.id: r for r in rows}
    assert len(rows) == n and found[0].v == 1 and found[0].name_zh == "z" + str(max((n // 2 + i for i in range(n) if i % 3), key=str)) and not any(r.v for r in rows if r.id)
    assert most <= 3 * n


def test_pages_are_parsed_in_small_batches(spark):
    for name in ("page_cleaned", "page_model_texts"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
        QUERIES[name](spark, "/root/testdata/sf0.001")
        assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 512
