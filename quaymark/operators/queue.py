"""Queues of items to send (inventory F11, F12, F15, Y2, Y3, C6): pure functions over an array of (id, status, createdAt, expired_at)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Seconds that an item without a deadline lives, and that a conversation rests after a change.
TTL, COOL_DOWN = 2 * 24 * 60 * 60, 3 * 60 * 60


def expired(item: Column, now: int) -> Column:
    """at its deadline, or two days after its creation; an item whose times cannot be read does not expire."""
    created = item["createdAt"].cast("string").try_cast("bigint") + TTL
    deadline = F.when(item["expired_at"].isNotNull(), item["expired_at"].cast("string").try_cast("bigint")).otherwise(created)
    return F.coalesce(deadline <= now, F.lit(False))


def waits(item: Column) -> Column:
    """Whether an item is pending and has an id."""
    return F.coalesce((item["status"] == "pending") & (F.coalesce(item["id"].cast("string"), F.lit("")) != ""), F.lit(False))


def first_live(queue: Column, now: int) -> Column:
    """The first pending item that has not expired."""
    return F.try_element_at(F.filter(queue, lambda x: waits(x) & ~expired(x, now)), F.lit(1))


def _live_at(queue: Column, now: int) -> Column:
    """Its place from 0, or the size of the queue."""
    marks = F.transform(queue, lambda x: waits(x) & ~expired(x, now))
    at = F.array_position(marks, True)
    return F.when(at > 0, at - 1).otherwise(F.size(queue))


def expire(queue: Column, now: int) -> Column:
    """Pending items before the first live one are marked expired; those behind it keep their status."""
    upto = _live_at(queue, now)
    return F.transform(queue, lambda x, i: F.when((i < upto) & waits(x) & expired(x, now), x.withField("status", F.lit("expired"))).otherwise(x))


def n_expired(queue: Column, now: int) -> Column:
    """How many items ``expire`` marks."""
    return F.size(F.filter(queue, lambda x, i: (i < _live_at(queue, now)) & waits(x) & expired(x, now)))


def mark_first(queue: Column, item_id: Column, status: str) -> Column:
    """Y2: the first pending item with the id gets a new status; others with that id keep theirs."""
    at = F.array_position(F.transform(queue, lambda x: waits(x) & (x["id"] == item_id)), True)
    return F.transform(queue, lambda x, i: F.when((at > 0) & (i == at - 1), x.withField("status", F.lit(status))).otherwise(x))


def active_post(status: Column) -> Column:
    """only published posts are active."""
    return F.coalesce(status == "published", F.lit(False))


def active_property(status: Column) -> Column:
    """properties are active unless archived; a missing status is not."""
    return ~status.eqNullSafe(F.lit("archived"))


def may_send(state: Column, updated: Column, queues: list[Column], now: int) -> Column:
    """tracking, at rest for three hours, and something pending in any queue."""
    pending = F.lit(False)
    for q in queues:
        pending = pending | F.coalesce(F.exists(q, lambda x: x["status"] == "pending"), F.lit(False))
    return F.coalesce((state == "ACTIVE_TRACKING") & (updated <= now - COOL_DOWN), F.lit(False)) & pending
