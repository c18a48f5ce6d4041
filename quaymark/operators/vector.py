"""Vector search (inventory V1)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Query vectors compared at a time: a block is broadcast.
BLOCK_QUERIES = 2048


def _matrix(vectors: list) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, and which of the given ones have a direction."""
    m = np.array(vectors, np.float64).reshape(len(vectors), -1)
    length = np.sqrt((m * m).sum(1))
    return m[length > 0] / length[length > 0, None], length > 0


def nearest_vectors(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id and cosine (6 digits): at least the k best rows of every query, ties to the smaller vec_id.

    Queries go over all rows in blocks of bounded size; each batch of rows passes on its k best of each
    query, so the first k of every query are left to the caller.  Null and zero vectors have no cosine.
    """
    spark = rows.sparkSession
    schema = "query_id long, vec_id long, cosine double"
    vectors = rows.select("vec_id", "embedding").where("embedding is not null")
    out = spark.createDataFrame([], schema)

    def over(block: list) -> DataFrame:
        unit, has = _matrix([r["embedding"] for r in block])
        shared = spark.sparkContext.broadcast((np.array([r["vec_id"] for r in block])[has], unit))

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query_ids, unit = shared.value
            for b in parts:
                if not b.num_rows or not len(query_ids):
                    continue
                mine, has = _matrix(b.column("embedding").to_pylist())
                ids = b.column("vec_id").to_numpy()[has]
                order = np.argsort(ids, kind="stable")
                ids, mine = ids[order], mine[order]
                n = min(k, len(ids))
                if not n:
                    continue
                found = [np.argsort(-np.round(mine @ q + 1e-9, 6), kind="stable")[:n] for q in unit]
                at = np.concatenate(found)
                cosine = np.concatenate([np.round(mine[f] @ q + 1e-9, 6) for f, q in zip(found, unit, strict=True)])
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(query_ids, n)), pa.array(ids[at]), pa.array(cosine)], names=["query_id", "vec_id", "cosine"])

        return vectors.mapInArrow(run, schema)

    block: list = []
    for r in queries.select("vec_id", "embedding").where("embedding is not null").toLocalIterator():
        block.append(r)
        if len(block) >= BLOCK_QUERIES:
            out = out.unionByName(over(block))
            block = []
    return out.unionByName(over(block)) if block else out
