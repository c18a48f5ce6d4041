"""The queries of the thirteen operators, applied with production parameters to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .sql import jaccard_sql, phrases_sql, pii_sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file, found in the installed package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tokencount import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), limit=4096)


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tokenstore import store_and_digest

    return store_and_digest(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)


def op3_media_sniffing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .media import media_digest

    return media_digest(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify

    return identify(table(spark, sf_dir, "documents"), per_language=20_000)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .htmlwrap import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages"))


def op6_pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import pii_digest

    return pii_digest(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), words=5, percent=80)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2, capacity=4096)


def op10_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import cotrain_and_score

    return cotrain_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import train_and_score

    return train_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), labelled=20_000)


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrases import mine

    return mine(table(spark, sf_dir, "documents"), threshold=100, most=2000)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .alignment import align_documents

    return align_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_token_store,
        op3_media_sniffing,
        op4_language_id,
        op5_html_extraction,
        op6_pii_sanitisation,
        op7_ngram_jaccard_join,
        op8_decontamination,
        op9_packing,
        op10_quality_cotraining,
        op11_toxicity,
        op12_phrase_mining,
        op13_tokenizer_alignment,
    )
}
#: The others need a tokenizer, a model, stored bytes or an HTML parser.
ORACLE_SQL: dict[str, str] = {"op6_pii_sanitisation": pii_sql(), "op7_ngram_jaccard_join": jaccard_sql(), "op12_phrase_mining": phrases_sql()}
