"""The corpus pipeline: language ID, near duplicates, decontamination, PII and packing, one after another.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and works on all rows
that its predecessor kept.  Results between stages are written as Parquet and read again.

Stages decide by row.  A row is known by ``with_row_keys`` (doc_id and text), so null and repeated doc_ids are
rows like others: rows of one doc_id with different texts are judged apart.  A group of near duplicates
keeps one row, that of the least doc_id (null after all others; ties to the smaller row key, and of rows
equal in both to the least by the other columns).  Texts without shingles are copies of nothing and stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymark.llm import decontaminate, jaccard, langid, packing, pii
from quaymark.llm._shared import count_rows, few_files, stage
from quaymark.llm.queries import vocabulary

#: Row keys (one number each) up to which they are broadcast to pick rows; beyond, rows and keys are shuffled.
BROADCAST_KEYS = 1_000_000
#: Documents whose best language has a smaller share than this are rejected, like those without a letter.
LEAST_SHARE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is recognised; texts that are null, empty or without a letter go.

    Each row is judged by its own text, so repeated rows and null ids are rows like others; a tie between
    languages goes to the first by name.  Extra columns stay; an empty table keeps no row.
    """
    model = langid.train(docs.where(~langid.held_out()))
    return few_files(langid.select_recognised(docs, model, LEAST_SHARE))


def with_row_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__row``: one number for rows of equal doc_id and text, another one for any other row.

    The number is a 64-bit hash.  A second hash tells whether different rows share it; those rows get a number made of
    both, until no number is shared, so rows are told apart by 128 bits.
    """
    spark = docs.sparkSession
    second = F.xxhash64(F.lit("second"), F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    keyed = docs.withColumn("__row", pii.key())
    while True:
        shared = keyed.select("__row", second.alias("__second")).groupBy("__row").agg(F.min("__second").alias("low"), F.max("__second").alias("high"))
        shared = stage(spark, shared.where("low < high").select("__row", F.lit(True).alias("__shared")), "shared_keys")
        if shared.isEmpty():
            return keyed
        keyed = keyed.join(shared, "__row", "left").withColumn("__row", F.when(F.col("__shared"), F.xxhash64("__row", second)).otherwise(F.col("__row"))).drop("__shared")


def pick(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows by their ``__row``; texts move only where the keys are too many to be broadcast."""
    few = count_rows(keys, BROADCAST_KEYS) <= BROADCAST_KEYS
    return rows.join(F.broadcast(keys) if few else keys, "__row", how)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every group of near duplicates, and every row without a shingle.

    Null and empty texts have no shingle; of repeated rows one stays; rows without doc_id are grouped like
    others and lose ties against rows with one (see the module for the order).  An empty table keeps no row.
    """
    keyed = with_row_keys(docs)
    found = jaccard.near_duplicates(keyed.select(F.col("__row").alias("doc_id"), "text"))
    groups = found.groupBy(F.col("doc_id").alias("__row")).agg(F.max("n_shingles").alias("n"), F.max("component_id").alias("component"), F.count("*").alias("copies"))
    ids = keyed.select("__row", "doc_id").distinct()
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row", "copies")).alias("least")
    kept = groups.where("n > 0").join(ids, "__row").groupBy("component").agg(least).select("least.__row", "least.copies")
    kept = stage(spark, kept.unionByName(groups.where("n = 0").select("__row", F.lit(1).cast("long").alias("copies"))), "kept")
    out = pick(keyed, kept.where("copies = 1").select("__row"), "left_semi").drop("__row")
    if kept.where("copies > 1").isEmpty():
        return few_files(out)
    repeated = pick(keyed, kept.where("copies > 1").select("__row"), "left_semi").groupBy("__row").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return few_files(out.unionByName(repeated.select("row.*")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows that hold benchmark passages, copied or re-parameterised.

    Null and empty texts hold none; repeated rows go or stay together; an empty benchmark drops nothing.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = with_row_keys(docs)
    hits = decontaminate.contaminated(keyed.select(F.col("__row").alias("doc_id"), "text"), benchmark)
    hits = stage(spark, hits.select(F.col("doc_id").alias("__row")).distinct(), "hits")
    return few_files(pick(keyed, hits, "left_anti").drop("__row"))


def pii_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Generalise personal data and the terms that disclose it; n_chars follows the text.

    No row goes: null texts stay null (and so does n_chars), repeated rows change alike.
    """
    return few_files(pii.sanitise(docs).withColumn("n_chars", F.length("text").cast("long")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 4096 ids, with small batches: executors also hold the memory of the stages before.

    Null and empty texts are their end id; repeated rows are packed each; null doc_id comes first.
    """
    return few_files(packing.pack(docs, vocabulary("word_bpe_49k.json"), end_id=2, capacity=4096, remembered=150_000, rows=256))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii_removal", pii_removal),
    ("pack", pack),
]

#: Several stages are learnt or need a tokenizer: SQL cannot express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(spark, step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
