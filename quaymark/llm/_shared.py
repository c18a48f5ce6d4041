"""Staging of intermediate tables and helpers that several operators use."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

#: Rows and bytes in an Arrow batch sent to Python: texts can be long, so batches stay small.
ARROW_ROWS, ARROW_BYTES = 512, "4m"
#: Files of a staged table for each core of the cluster.
FILES_A_CORE = 10


def prepare(spark: SparkSession, rows: int = ARROW_ROWS) -> SparkSession:
    """Ship the package to the executors and bound the Arrow batches of the session's queries."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares.  A local one does only where everything runs in one process (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return "file://" + os.path.join(tempfile.gettempdir(), "quaymark-shared")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/quaymark/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}/{name}"


def clean(spark: SparkSession) -> None:
    """Delete all that this application has staged, once its results are written."""
    _delete(spark, f"{shared_dir(spark)}/quaymark/{spark.sparkContext.applicationId}")


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def few_files(df: DataFrame) -> DataFrame:
    """The rows in no more partitions than a few for each core: a table of many small files is slow to write and to read."""
    return df.coalesce(FILES_A_CORE * df.sparkSession.sparkContext.defaultParallelism)


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = new_path(spark, name)
    few_files(df).write.options(**{"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def release(spark: SparkSession, df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    path = getattr(df, "_staged_path", None)
    if path:
        _delete(spark, path)


def doc_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: extra columns, clashing names included, never reach an operator."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def in_order(documents: DataFrame) -> DataFrame:
    """doc_id, text and part, sorted: ranges of doc_id, of which one that many rows share may fill several.

    Rows of equal doc_id are told apart by a hash of the text, so no number of them meets in one task by its id alone
    (rows that are equal in both do).  Null doc_id comes first.
    """
    hashed = doc_columns(documents, "doc_id", "text").withColumn("__hash", F.xxhash64("text"))
    dealt = hashed.repartitionByRange("doc_id", "__hash").sortWithinPartitions("doc_id", "__hash", "text")
    return dealt.select("doc_id", "text", F.spark_partition_id().alias("part"))


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a batch; null counts as the empty text."""
    return [x or "" for x in column.to_pylist()]


def count_rows(df: DataFrame, at_most: int) -> int:
    """Rows of ``df``, counted no further than ``at_most`` + 1: the size check before a broadcast."""
    return df.limit(at_most + 1).count()


def batches(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b for b in rows if b.num_rows)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift, multiply, shift) over a uint64 array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Larger Arrow batches for a step over narrow rows that runs within the block."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Lexicon:
    """What is known of words, as arrays: ``columns`` hold what ``describe`` tells of each.

    A bounded number of words is remembered; those met longest ago are forgotten first.
    """

    def __init__(self, describe: Callable[[pa.Array], tuple[np.ndarray, ...]], entries: int):
        self.describe, self.entries, self.tick = describe, entries, 0
        self.words = pa.array([], pa.string())
        self.columns = describe(self.words)
        self.used = np.zeros(0, np.int32)

    def places(self, words: pa.Array) -> np.ndarray:
        """Where distinct words are remembered; unknown ones are described."""
        self.tick += 1
        if len(self.words) > self.entries:
            keep = self.used > np.median(self.used)
            self.words, self.used = self.words.filter(pa.array(keep)), self.used[keep]
            self.columns = tuple(c[keep] for c in self.columns)
        found = pc.index_in(self.words, value_set=words).fill_null(-1).to_numpy(zero_copy_only=False)
        known = np.flatnonzero(found >= 0)
        place = np.full(len(words), -1, np.int64)
        place[found[known]] = known
        unknown = np.flatnonzero(place < 0)
        if len(unknown):
            place[unknown] = len(self.words) + np.arange(len(unknown))
            new = words.take(pa.array(unknown))
            self.words = pa.concat_arrays([self.words, new])
            self.columns = tuple(np.concatenate(x) for x in zip(self.columns, self.describe(new), strict=True))
            self.used = np.concatenate([self.used, np.zeros(len(unknown), np.int32)])
        self.used[place] = self.tick
        return place


def split_words(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts between white space, and where each text's words stop."""
    cut = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))
    flat = cut.flatten()
    some = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    stops = np.r_[0, np.cumsum(some)][np.cumsum(cut.value_lengths().to_numpy())]
    return flat if some.all() else flat.filter(pa.array(some)), stops


_CACHES: dict[str, object] = {}


def worker_cache(name: str, make):
    """What a Python worker remembers between tasks: of one operator at a time, as workers serve many."""
    if name not in _CACHES:
        keep_caches("")
        _CACHES[name] = make()
    return _CACHES[name]


def keep_caches(kind: str) -> None:
    """Forget what other kinds of operators have left in this worker."""
    others = [n for n in _CACHES if not kind or not n.startswith(kind)]
    for n in others:
        del _CACHES[n]
    if others:
        trim()


def trim() -> None:
    """Give memory that is no longer used back to the system: workers stay alive between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, caches: str = "") -> DataFrame:
    """``mapInArrow`` whose workers keep no memory after a task but caches of the kind ``caches``."""

    def bounded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_caches(caches)
        yield from run(parts)
        trim()

    return df.mapInArrow(bounded, schema)
