"""Batches of model requests and their results (inventory C7, C8, W11, Z1-Z5, F17, X23, X24, A17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_custom_id(x: Column, prefixes: tuple[str, ...]) -> Column:
    """what follows the first prefix that fits, in the given order; null for any other id or an empty rest."""
    out = F.lit(None).cast("string")
    for p in reversed(prefixes):
        out = F.when(x.startswith(p), F.substring(x, len(p) + 1, 1 << 30)).otherwise(out)
    return F.nullif(out, F.lit(""))


def is_object(text: Column) -> Column:
    """Whether a text is a JSON object."""
    return F.coalesce(F.trim(text).startswith("{") & F.try_parse_json(text).isNotNull(), F.lit(False))


def ingest(lines: DataFrame, prefixes: tuple[str, ...], line: str = "line") -> DataFrame:
    """Result lines with id, content and error, in this order of checks: the line, its id, the error in the
    row, an answer, and its content.  An error belongs to its own row's id; rows without one keep a null id."""
    at = lambda path: F.get_json_object(line, path)
    rows = lines.withColumn("__ok", is_object(F.col(line)))
    rows = rows.withColumn("id", F.when(F.col("__ok"), parse_custom_id(at("$.custom_id"), prefixes))).withColumn("content", at("$.response.body.choices[0].message.content"))
    error = (
        F.when(~F.col("__ok"), "bad_line")
        .when(F.col("id").isNull(), "no_id")
        .when(at("$.error").isNotNull() & (at("$.error") != "null"), "row_error")
        .when(F.col("content").isNull(), "no_choices")
        .when(~is_object(F.col("content")), "bad_json")
    )
    return rows.withColumn("error", error).withColumn("content", F.when(error.isNull(), F.col("content"))).drop("__ok")


def with_default_names(content: Column, names: dict[str, str]) -> Column:
    """Fields (JSON in) as a map; a name that is absent takes the value of its other spelling."""
    fields = F.from_json(content, "map<string,string>")
    extra = [F.when(~F.map_contains_key(fields, F.lit(new)) & F.coalesce(fields[old] != "", F.lit(False)), F.struct(F.lit(new).alias("key"), fields[old].alias("value"))) for new, old in names.items()]
    return F.map_concat(fields, F.map_from_entries(F.filter(F.array(*extra), lambda e: e.isNotNull())))


def track(batches: DataFrame, found: DataFrame) -> DataFrame:
    """The control table (batch_id, chain, status) after what the service reports (batch_id, status), and
    what becomes of each batch's tracking row."""
    new = found.select("batch_id", F.col("status").alias("__status"))
    out = batches.join(new, "batch_id", "left").withColumn("status", F.coalesce("__status", "status")).drop("__status")
    return out.withColumn("outcome", outcome(F.col("status"))).withColumn("tracking", tracking(F.col("chain"), F.col("status")))


def outcome(status: Column) -> Column:
    """Completed, failed, or still pending."""
    return F.when(status.isin("completed", "failed"), status).otherwise("pending")


def tracking(chain: Column, status: Column) -> Column:
    """What a chain does with the tracking row of a batch in that state."""
    ended = status.isin("failed", "expired", "cancelled")
    return F.when(status == "completed", "moved").when(ended & (chain == "match"), "deleted").when(ended & (chain == "summary"), "kept_failed").otherwise("kept")


def completed(batches: DataFrame) -> DataFrame:
    """Z3: only completed batches that have an output."""
    return batches.where("status = 'completed' and output_file_id is not null")


def next_listing_status(status: Column, extracted: Column, candidates: Column, analysed: Column, failed: Column) -> Column:
    """The listing's machine.  An archived listing stays; others go from extraction to photos to their result."""
    return (
        F.when(status.eqNullSafe(F.lit("archived")), status)
        .when(status == "pending_extraction", F.when(extracted, "data_extracted").otherwise(status))
        .when(status == "data_extracted", F.when(candidates > 0, "photo_analysing").otherwise("photo_analysed"))
        .when(status == "photo_analysing", F.when(analysed > 0, "photo_analysed").when(failed > 0, "photo_analysis_failed").otherwise(status))
        .otherwise(status)
    )


def next_photo_status(status: Column, known: Column, code: Column, choices: Column, parsed: Column) -> Column:
    """A photo that waits becomes missing, failed or analysed; others stay."""
    result = F.when(~known, "photo_analysis_missing").when((code == 200) & choices & parsed, "photo_analysed").otherwise("photo_analysis_failed")
    return F.when(status == "batch_created", result).otherwise(status)


def next_summary_status(status: Column, uploaded: Column, batch: Column, error: Column) -> Column:
    """Created, uploaded, completed, and ready or failed."""
    return (
        F.when(status == "batch_created", F.when(uploaded, "batch_uploaded").otherwise(status))
        .when(status == "batch_uploaded", F.when(batch == "completed", "batch_completed").when(batch == "failed", "summary_failed").otherwise(status))
        .when(status == "batch_completed", F.when(error.isNull(), "summary_ready").otherwise("summary_failed"))
        .otherwise(status)
    )


def index_status(text: Column, failed: Column, least: int = 20) -> Column:
    """A short text is skipped (null), others are indexed or failed."""
    return F.when(F.length(F.coalesce(text, F.lit(""))) >= least, F.when(failed, "indexing_failed").otherwise("indexed"))


def resolve_stuck(photos: DataFrame) -> DataFrame:
    """source_id and status of the listings none of whose photos waits any more."""
    sums = photos.groupBy("source_id").agg(F.count_if(F.col("status") == "batch_created").alias("waiting"), F.count_if(F.col("status") == "photo_analysed").alias("done"))
    return sums.where("waiting = 0").select("source_id", F.when(F.col("done") > 0, "photo_analysed").otherwise("photo_analysis_failed").alias("status"))


def redownload(photos: DataFrame, fetched: DataFrame) -> DataFrame:
    """Photos with a blob that were not fetched anew; success sets the time, failure takes the address away.

    Of repeated answers for a photo the last one counts.
    """
    last = fetched.groupBy("photo_id").agg(F.max_by(F.struct("ok", "at"), F.struct("at", "ok")).alias("f")).select("photo_id", "f.*")
    due = photos.where("blob_url is not null and redownloaded_at is null").join(last, "photo_id", "left")
    ok = F.coalesce("ok", F.lit(False))
    return due.select("photo_id", F.when(ok, F.col("blob_url")).alias("blob_url"), F.when(ok, F.col("at")).alias("redownloaded_at"), F.when(ok, "redownloaded").otherwise("failed").alias("outcome"))


def valid_batch(lines: DataFrame) -> DataFrame:
    """The lines of a batch file that say something; an empty result is not to be sent."""
    return lines.where(F.length(F.trim("value")) > 0)
