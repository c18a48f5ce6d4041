"""Message histories (inventory X25, P4, P14, R8, R9, Y4, Y5, Z6): over arrays of (type, content)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Type of a summary's payload, sizes that call for a summary, and messages that stay.
SUMMARY = "rolling_summary"
MANY, LONG, RECENT = 12, 2800, 6


def content_text(content: Column) -> Column:
    """Content as text: a plain string as it is; of a JSON list, its strings and the text of its objects, one a line."""
    parsed = F.from_json(content, "array<string>")
    part = lambda x: F.when(x.startswith("{"), F.coalesce(F.get_json_object(x, "$.text"), F.lit(""))).otherwise(x)
    listed = F.regexp_replace(F.array_join(F.transform(parsed, part), "\n"), r"(?U)^\s+|\s+$", "")
    return F.when(content.startswith("[") & parsed.isNotNull(), listed).otherwise(F.coalesce(content, F.lit("")))


def message_type(m: Column) -> Column:
    return F.lower(F.trim(F.coalesce(m["type"], F.lit(""))))


def meaningful(messages: Column) -> Column:
    """Messages of people and the system, and answers that say something."""
    return F.filter(messages, lambda m: m["type"].isin("human", "system") | ((m["type"] == "ai") & (F.coalesce(m["content"], F.lit("")) != "")))


def _curated(m: Column, prefix: str) -> Column:
    return (message_type(m) == "system") & content_text(m["content"]).startswith(prefix)


def latest_curated(messages: Column, prefix: str) -> Column:
    """Place from 0 of the last curated system message, or -1."""
    marks = F.transform(messages, lambda m: _curated(m, prefix))
    back = F.array_position(F.reverse(marks), True)
    return F.when(back > 0, F.size(messages) - back).otherwise(-1).cast("int")


def summary_of(m: Column) -> Column:
    """The summary that a system message holds, or null."""
    text = content_text(m["content"])
    found = F.trim(F.get_json_object(text, "$.summary"))
    return F.when((message_type(m) == "system") & text.startswith("{") & (F.get_json_object(text, "$.type") == SUMMARY) & (found != ""), found)


def compact(messages: Column, prefix: str) -> Column:
    """Of the curated messages only the last stays."""
    last = latest_curated(messages, prefix)
    return F.filter(messages, lambda m, i: ~_curated(m, prefix) | (i == last))


def without_summaries(messages: Column) -> Column:
    return F.filter(messages, lambda m: summary_of(m).isNull())


def latest_summary(messages: Column) -> Column:
    return F.try_element_at(F.filter(F.transform(messages, summary_of), lambda s: s.isNotNull()), F.lit(-1))


def with_rewrite(threads: DataFrame, prefix: str, summary: str) -> DataFrame:
    """``threads`` (messages, and the text of a new summary from the seam) with previous, dialogue, due and next.

    ``dialogue`` is what is to be summed up, ``due`` whether it is: more than twelve messages or 2800
    characters, more than eight messages, and something said before the last six.  ``next`` is the new
    history where it is due and the summary says something: summary, the curated message if it
    would be lost, and the last six; else the messages as they are.
    """
    kept = without_summaries(compact(F.col("messages"), prefix))
    t = threads.withColumn("previous", latest_summary(compact(F.col("messages"), prefix))).withColumn("__kept", kept)
    n = F.size("__kept")
    start = F.greatest(F.lit(0), n - RECENT)
    chars = F.aggregate("__kept", F.lit(0), lambda a, m: a + F.length(content_text(m["content"])))
    said = F.filter(F.slice("__kept", 1, start), lambda m: message_type(m).isin("human", "ai") & (F.trim(content_text(m["content"])) != ""))
    role = lambda m: F.struct(F.when(message_type(m) == "human", "user").otherwise("assistant").alias("role"), F.trim(content_text(m["content"])).alias("content"))
    t = t.withColumn("dialogue", F.transform(said, role))
    due = ((n > MANY) | (chars > LONG)) & (n > RECENT + 2) & (F.size("dialogue") > 0)
    t = t.withColumn("due", F.coalesce(due, F.lit(False))).withColumn("__at", latest_curated(F.col("__kept"), prefix))
    text = F.trim(F.coalesce(F.col(summary), F.lit("")))
    payload = F.to_json(F.struct(F.lit(SUMMARY).alias("type"), text.alias("summary")))
    head = F.array(F.struct(F.lit("system").alias("type"), payload.alias("content")))
    pinned = F.when((F.col("__at") >= 0) & (F.col("__at") < start), F.slice("__kept", F.col("__at") + 1, 1)).otherwise(F.slice("__kept", 1, 0))
    rewritten = F.concat(head, pinned, F.slice("__kept", start + 1, RECENT))
    return t.withColumn("next", F.when(F.col("due") & (text != ""), rewritten).otherwise(F.col("messages"))).drop("__kept", "__at")


def message_range(batches: DataFrame, low: int | None, high: int | None) -> DataFrame:
    """Messages of archived batches (code, fromIndex, toIndex, messages with index) in a range, as defined:
    only batches that lie within the range count, and the first and the last of them are trimmed."""
    inside = batches
    if low is not None:
        inside = inside.where(F.col("fromIndex") >= low)
    if high is not None:
        inside = inside.where(F.col("toIndex") <= high)
    return inside.select("code", F.explode("messages").alias("m")).select("code", "m.*")
