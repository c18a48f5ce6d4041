"""Users and their conversations (inventory P8, C12, J8, J9, W6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def phone_of(identifiers: Column) -> Column:
    """The key of the first phone identifier that has one."""
    return F.try_element_at(F.filter(identifiers, lambda x: (x["type"] == "phone") & (F.coalesce(x["key"], F.lit("")) != "")), F.lit(1))["key"]


def phone_matches(identifiers: Column, thread: Column) -> Column:
    """Whether any phone identifier is the thread's."""
    return F.coalesce(F.exists(identifiers, lambda x: (x["type"] == "phone") & (x["key"] == thread)), F.lit(False))


def language_of(*given: Column) -> Column:
    """The first language that is given, trimmed and in lower case, or zh-hk."""
    return F.lower(F.trim(F.coalesce(*[F.nullif(g, F.lit("")) for g in given], F.lit("zh-hk"))))


def state_of(v2_state: Column, muted: Column, disabled: Column) -> Column:
    """A known state stays, an unknown one mutes; without any, notifications and the assistant decide."""
    state = F.nullif(v2_state, F.lit(""))
    off = F.coalesce(muted, F.lit(False)) | F.coalesce(disabled, F.lit(False))
    return F.when(state.isin("ACTIVE_TRACKING", "MUTED"), state).when(state.isNotNull() | off, "MUTED").otherwise("ACTIVE_TRACKING")


def bootstrap(users: DataFrame, conversations: DataFrame) -> DataFrame:
    """Users (user_id, status, phone) with an outcome: no_phone, exists, thread_conflict or created.

    Deleted users are left out.  Of several users with one phone the first (by user_id) without a
    conversation is created, and the others conflict with it.
    """
    alive = users.where(~F.col("status").eqNullSafe(F.lit("deleted")))
    by_user = conversations.select(F.col("user_id"), F.lit(True).alias("__mine")).where("user_id is not null").distinct()
    by_thread = conversations.select(F.col("thread_id").alias("phone"), F.lit(True).alias("__thread")).where("phone is not null").distinct()
    known = alive.join(by_user, "user_id", "left").join(by_thread, "phone", "left")
    no_phone = F.coalesce("phone", F.lit("")) == ""
    base = F.when(no_phone, "no_phone").when(F.col("__mine"), "exists").when(F.col("__thread"), "thread_conflict").otherwise("created")
    known = known.withColumn("outcome", base)
    first = F.row_number().over(W.partitionBy("phone", "outcome").orderBy("user_id"))
    return known.withColumn("__n", first).withColumn("outcome", F.when((F.col("outcome") == "created") & (F.col("__n") > 1), "thread_conflict").otherwise(F.col("outcome"))).drop("__mine", "__thread", "__n")


def guarded_upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """What becomes of each new row (the last by value of a key): inserted, updated where the old row has no
    admins, or left alone where it has."""
    n_admins = old.groupBy(key).agg(F.max(F.size(F.coalesce("admins", F.array().cast("array<string>")))).alias("__admins"))
    last = new.groupBy(key).agg(F.max(F.struct(*[c for c in new.columns if c != key])).alias("__row")).select(key, "__row.*")
    return last.join(n_admins, key, "left").withColumn("action", F.when(F.col("__admins").isNull(), "insert").when(F.col("__admins") == 0, "update").otherwise("none")).drop("__admins")
