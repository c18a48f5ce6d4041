"""Short ids and tokens (inventory W15, X27, P18): derived from keys, so that a retried task gives the same ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import written

#: Letters and digits that are not mistaken for each other.
ALPHABET = "23456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz"
LENGTH, ATTEMPTS = 8, 20


def token(key: Column, salt: Column, length: int = LENGTH) -> Column:
    """``length`` characters of the alphabet, by the digits of a SHA-256 of the key and a salt."""
    digest = F.sha2(F.concat_ws("|", key.cast("string"), salt.cast("string")), 256)
    signs = [F.substring(F.lit(ALPHABET), F.pmod(F.conv(F.substring(digest, 1 + 4 * i, 4), 16, 10).cast("int"), F.lit(len(ALPHABET))) + 1, F.lit(1)) for i in range(length)]
    return F.concat(*signs)


def assign_short_ids(df: DataFrame, key: str, out: str = "short_id", length: int = LENGTH, attempts: int = ATTEMPTS) -> DataFrame:
    """``df`` with a unique short id in every row whose ``out`` is null or empty; ids that are there stay.

    In every attempt each row without an id draws one; of rows that draw the same, the least key keeps it
    unless it is taken.  Repeated keys draw the same id and are told apart by no one: keys must be unique.
    """
    given = df.withColumn(out, F.nullif(F.col(out), F.lit("")) if out in df.columns else F.lit(None).cast("string"))
    for attempt in range(attempts):
        drawn = given.withColumn("__new", F.col(out).isNull()).withColumn("__id", F.coalesce(F.col(out), token(F.col(key), F.lit(attempt), length)))
        place = F.row_number().over(W.partitionBy("__id").orderBy("__new", key))
        given = drawn.withColumn("__place", place).withColumn(out, F.when(~F.col("__new") | (F.col("__place") == 1), F.col("__id"))).drop("__new", "__id", "__place")
        given = written(given)  # a draw is made once, however many follow it
        if given.where(F.col(out).isNull()).isEmpty():
            return given
    raise RuntimeError("no unique short ids within the attempts")
