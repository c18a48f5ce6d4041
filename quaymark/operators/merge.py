"""Upserts as whole new snapshots (inventory W1-W8, W14): Parquet has no MERGE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_of(new: DataFrame, *keys: str) -> DataFrame:
    """One row for each key: of repeated ones the last, by all other columns in their order."""
    others = [c for c in new.columns if c not in keys]
    return new.groupBy(*keys).agg(F.max(F.struct(*others)).alias("__row")).select(*keys, "__row.*").select(*new.columns) if others else new.select(*keys).distinct()


def upsert(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``new`` replace those with their key; others stay.  Of new rows with one key the last counts."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(last_of(new, *keys))


def set_on_insert(old: DataFrame, new: DataFrame, key: str, kept: list[str]) -> DataFrame:
    """An upsert in which the columns ``kept`` come from the old row where there is one."""
    before = old.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in kept])
    merged = new.join(before, new[key] == F.col("__key"), "left")
    fixed = [F.when(F.col("__key").isNotNull(), F.col(f"__{c}")).otherwise(new[c]).alias(c) if c in kept else new[c] for c in new.columns]
    return upsert(old, merged.select(*fixed), key)


def partial_update(old: DataFrame, changes: DataFrame, key: str, cleared: str | None = None) -> DataFrame:
    """Known changes replace single columns; of changes with one key the last counts.

    ``cleared`` names a column of ``changes`` with an array of the columns that become null.
    """
    marked = last_of(changes, key).select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in changes.columns if c != key])
    joined = old.join(marked, old[key] == F.col("__key"), "left")

    def value(c: str) -> Column:
        out = F.coalesce(F.col(f"__{c}"), old[c]) if c in changes.columns else old[c]
        return F.when(~F.coalesce(F.array_contains(F.col(f"__{cleared}"), c), F.lit(False)), out) if cleared else out

    return joined.select(*[old[c] if c == key else value(c).alias(c) for c in old.columns])


def update_where(old: DataFrame, ids: DataFrame, key: str, changes: dict[str, Column]) -> DataFrame:
    """Rows whose key is among ``ids`` get the changes, others stay; a cascade is a second call with the first's ids."""
    named = ids.select(F.col(key).alias("__key")).distinct()
    joined = old.join(named, old[key] == F.col("__key"), "left")
    return joined.select(*[F.when(F.col("__key").isNotNull(), changes[c]).otherwise(old[c]).alias(c) if c in changes else old[c] for c in old.columns])


def overwrite(df: DataFrame, path: str) -> None:
    """The whole table anew."""
    df.write.mode("overwrite").parquet(path)


def outbox(df: DataFrame, kind: str, key: str, payload: list[str]) -> DataFrame:
    """Messages for what lies outside (kind, key, body as JSON), to be written and sent by another process."""
    return df.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"), F.to_json(F.struct(*payload)).alias("body"))


def contact_tables(listings: DataFrame) -> dict[str, DataFrame]:
    """Listings (source_id, contacts of name, license_no, phones, wtsapps) as contacts, phones and two bridges.

    A contact is known by its name (licence: the least one), a phone by its number; blank phones go, and of a
    WhatsApp link its first ten digits count.
    """
    c = listings.select("source_id", F.explode("contacts").alias("c")).select("source_id", "c.*")
    contact = F.substring(F.sha2(F.coalesce("name", F.lit("")), 256), 1, 16)
    c = c.withColumn("contact_id", contact)
    plain = c.select("contact_id", F.explode("phones").alias("phone"), F.lit(False).alias("is_wtsapp")).where("phone is not null and phone <> ''")
    chats = c.select("contact_id", F.explode("wtsapps").alias("w")).select("contact_id", F.regexp_extract("w", r"(\d{10})", 1).alias("phone"), F.lit(True).alias("is_wtsapp")).where("phone <> ''")
    all_phones = plain.union(chats).withColumn("phone_id", F.substring(F.sha2(F.concat_ws("|", "phone", F.col("is_wtsapp").cast("string")), 256), 1, 16))
    return {
        "contacts": c.groupBy("contact_id", "name").agg(F.min("license_no").alias("license_no")),
        "phones": all_phones.select("phone_id", "phone", "is_wtsapp").distinct(),
        "contact_phones": all_phones.select("contact_id", "phone_id").distinct(),
        "property_contacts": c.select("source_id", "contact_id").distinct(),
    }


def push_unique(array: Column, item: Column, same) -> Column:
    """Append unless an equal element is there."""
    return F.when(F.exists(array, same), array).otherwise(F.concat(array, F.array(item)))


#: Seconds that a queued item lives.
QUEUE_TTL = 2 * 24 * 60 * 60


def queue_append(conversations: DataFrame, matches: DataFrame, now: int, ttl: int = QUEUE_TTL, guard: bool = True) -> DataFrame:
    """Conversations (id, queue of post_id, status, createdAt, expired_at) after matches (id, post_ids).

    Only a match's first id is queued, and with ``guard`` only once.  ``outcome`` is queued, already_queued,
    nothing_matched or conversation_not_found, and null for conversations without a match; a null queue is empty.
    """
    item = "array<struct<post_id: string, status: string, createdAt: bigint, expired_at: bigint>>"
    c = conversations.select("id", F.coalesce(F.col("queue").cast(item), F.array().cast(item)).alias("queue"), F.lit(True).alias("known"))
    m = matches.select("id", F.try_element_at("post_ids", F.lit(1)).cast("string").alias("first"), F.lit(True).alias("matched"))
    twice = F.coalesce(F.exists("queue", lambda x: x.post_id == F.col("first")), F.lit(False)) if guard else F.lit(False)
    outcome = (
        F.when(F.col("matched").isNull(), None)
        .when(F.col("known").isNull(), "conversation_not_found")
        .when(F.col("first").isNull(), "nothing_matched")
        .when(twice, "already_queued")
        .otherwise("queued")
    )
    new = F.array(F.struct(F.col("first").alias("post_id"), F.lit("pending").alias("status"), F.lit(now).cast("long").alias("createdAt"), F.lit(now + ttl).cast("long").alias("expired_at")))
    out = c.join(m, "id", "full_outer").withColumn("outcome", outcome)
    return out.select("id", F.when(F.col("outcome") == "queued", F.concat("queue", new.cast(item))).otherwise(F.col("queue")).alias("queue"), "outcome")


def first_outcome(checks: list[tuple[Column, str]], passed: str) -> Column:
    """The name of the first check that fails, in order; a check that is null fails."""
    out = F.when(F.lit(False), "")
    for holds, name in checks:
        out = out.when(~F.coalesce(holds, F.lit(False)), name)
    return out.otherwise(passed)


def normalise(df: DataFrame, key: str, value: str) -> tuple[DataFrame, DataFrame]:
    """A dimension (id, value) of distinct values and a bridge (key, id); ids derive from the values."""
    coded = df.where(F.col(value).isNotNull()).select(key, value, F.substring(F.sha2(F.col(value).cast("string"), 256), 1, 16).alias("id"))
    return coded.select("id", value).distinct(), coded.select(key, "id").distinct()


def merge_maps(a: Column, b: Column) -> Column:
    """Both maps; where they share a key, the second one's value."""
    return F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b)


def ordered_union(*lists: DataFrame, value: str = "value", pos: str = "pos") -> DataFrame:
    """Values of several ordered lists (value, pos), each once at its first place, with a new order (list, pos)."""
    all_rows = None
    for k, rows in enumerate(lists):
        part = rows.select(value, F.struct(F.lit(k).alias("list"), F.col(pos).cast("long").alias("pos")).alias("place"))
        all_rows = part if all_rows is None else all_rows.unionByName(part)
    return all_rows.groupBy(value).agg(F.min("place").alias("place")).select(value, "place.*")
