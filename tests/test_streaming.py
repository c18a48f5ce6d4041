"""A stream read to its end gives the rows of the table."""

import os

from quaymark.streaming.usage import daily_usage

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_daily_usage(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    path = str(tmp_path / "events")
    events.repartition(2).write.parquet(path)
    stream = daily_usage(spark.readStream.schema(events.schema).parquet(path))
    run = stream.writeStream.format("memory").queryName("daily_usage").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "state")).start()
    run.awaitTermination(120)
    got, expected = (sorted(map(tuple, d.collect())) for d in (spark.table("daily_usage"), daily_usage(events)))
    assert got == expected and got
    assert sum(n for _, _, n in got) == events.where("ts is not null").count()


def test_monitor_over_a_stream(spark, tmp_path):
    """Snapshots that come in several batches give the states that the table gives."""
    from quaymark.plans import monitor

    schema = "source_id string, channel string, seq long, confidence string, fingerprint string, price string, posted string, updated string, status string, title string"
    prints = {("a", "28hse"): "ABBC", ("b", "midland"): "ABBA", ("c", "house730"): "AAB"}
    rows = [(i, ch, k, "high" if k == 3 else "medium", f, f, "", "", "", "") for (i, ch), text in prints.items() for k, f in enumerate(text)]
    expected = sorted(map(str, monitor.fold(spark.createDataFrame(rows, schema)).collect()))
    source = str(tmp_path / "in")
    for k in range(4):
        spark.createDataFrame([r for r in rows if r[2] == k], schema).coalesce(1).write.mode("append").parquet(source)
        stream = monitor.fold_stream(spark.readStream.schema(schema).parquet(source))
        run = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "state")).start()
        run.awaitTermination(120)
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "out")).select(*monitor.OUT).collect())) == expected and len(expected) == 11
