"""Operator 2 — token ids in Parquet files laid out for selective reads.

Documents are dealt out by ranges of doc_id and sorted, encoded, and written in ascending order
(the files' names follow the ranges).  Layout: ``ids`` is a list column with dictionary encoding,
the integer columns are delta-encoded (writer version 2, no dictionary), row groups and pages are
bounded and every file has page indexes.  Reading lengths or offsets touches only the small columns;
reading a range of doc_id touches only its pages.

``first`` is a document's offset within its file and ``part`` the file's number, so global offsets
need one row a file and no global sort or single-task window over documents.

Defined cases: null text counts as empty (end id only); rows of equal doc_id follow one another,
ordered by a hash of the text and the text; null doc_id comes first; extra columns are ignored; an empty table gives an empty store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._shared import batches, in_order, map_arrow, new_path, prepare, texts_of
from .packing import ROWS
from .wordids import chunk_encoder, with_ends

#: Files up to which their offsets are broadcast; beyond, the join is shuffled.
BROADCAST_FILES = 200_000
SCHEMA = "doc_id long, part int, first long, n_tokens long, ids array<int>"
#: Bytes of a row group and a page, and rows of a page: a page holds some hundred documents.
ROW_GROUP, PAGE, PAGE_ROWS = 16 << 20, 256 << 10, 512
LAYOUT = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "1",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(ROW_GROUP),
    "parquet.page.size": str(PAGE),
    "parquet.page.row.count.limit": str(PAGE_ROWS),
    "parquet.enable.dictionary": "true",
    **{f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "part", "first", "n_tokens")},
}


def encode_documents(documents: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Sorted, encoded documents, a partition for each future file."""
    prepare(documents.sparkSession, ROWS)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, first = chunk_encoder(tokenizer_path), 0
        for b in batches(rows):
            flat, stops = with_ends(*encoder.encode(texts_of(b.column("text"))), end_id)
            offsets = np.r_[0, stops]
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.view(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("part").cast(pa.int32()), pa.array(first + offsets[:-1]), pa.array(np.diff(offsets)), ids], names=["doc_id", "part", "first", "n_tokens", "ids"])
            first += int(offsets[-1])

    return map_arrow(in_order(documents), run, SCHEMA, "chunks")


def write_token_store(documents: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    encode_documents(documents, tokenizer_path, end_id).write.options(**LAYOUT).parquet(path)


def read_token_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def document_offsets(store: DataFrame) -> DataFrame:
    """part and base: ids in all files before a file.  One row a file, from the metadata columns only."""
    totals = store.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def token_digest(store: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone."""
    prepare(store.sparkSession)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows):
            ids = b.column("ids")
            flat, at = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"), np.r_[0, np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
            view = memoryview(flat).cast("B")
            crc = [zlib.crc32(view[4 * i : 4 * j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), b.column("first"), pa.array(np.diff(at)), pa.array(crc, pa.int64())], names=["doc_id", "part", "first", "n_tokens", "ids_crc32"])

    digest = map_arrow(store.select("doc_id", "part", "first", "ids"), run, "doc_id long, part int, first long, n_tokens long, ids_crc32 long")
    offsets = document_offsets(store)  # one row a file: a bound of files, not of documents
    few = len(store.inputFiles()) <= BROADCAST_FILES
    return digest.join(F.broadcast(offsets) if few else offsets, "part").select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def store_and_digest(documents: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    spark = documents.sparkSession
    path = new_path(spark, "tokens")
    write_token_store(documents, path, tokenizer_path, end_id)
    return token_digest(read_token_store(spark, path))
