"""Operator 4 — language identification by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; everything that is not a letter becomes one space.  The 1- to 3-grams of the
remaining characters are hashed into a fixed number of buckets.  Training counts buckets per
language on the executors and sums them; the log-probability matrix (buckets x languages, a size
fixed by a parameter and the label set) is broadcast.  Scoring gathers the matrix rows of a batch's
n-grams and adds them per document in numpy.

Training sees at most about ``per_language`` documents of each language, picked by a hash of doc_id
(the bound of the sample, a parameter); everything is scored.

Defined cases: a null text or one without a letter is ``und`` with score 0; with no training rows
everything is ``und``; ties go to the alphabetically first language; null doc_id is never held out
and never learnt from; lang, source and doc_id are no inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import batches, doc_columns, map_arrow, prepare, texts_of

BUCKET_BITS = 15
ORDERS = (1, 2, 3)
MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
UNKNOWN = "und"
#: Labels beyond this number are not languages: training refuses them.
MOST_LANGUAGES = 1000
#: Code points scored together; a longer text is scored in pieces cut at white space.
PIECE = 1 << 18
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters; made once in a worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(texts: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each order: buckets of all n-grams of the batch and the [start, stop) of each text; and the letters of each text."""
    lowered = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner_stop = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)))
    owner_start = np.r_[0, owner_stop[:-1]]
    letter = letters()[codes]
    before = np.r_[0, np.cumsum(letter)]
    n_letters = before[owner_stop] - before[owner_start]
    codes = np.where(letter, codes, np.uint32(32))
    first = np.zeros(len(codes), bool)
    first[owner_start] = True
    keep = letter | np.r_[True, letter[:-1]] | first
    kept = np.r_[0, np.cumsum(keep)]
    codes, start, stop = codes[keep], kept[owner_start], kept[owner_stop]
    out = []
    for n in ORDERS:
        size = max(0, len(codes) - n + 1)
        mixed = np.full(size, n, np.uint32)
        for k in range(n):
            mixed = (mixed ^ codes[k : k + size]) * MULTIPLIERS[k]
            mixed ^= mixed >> np.uint32(15)
        bucket = (mixed * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BUCKET_BITS)
        out.append((bucket, np.minimum(np.stack([start, np.maximum(start, stop - n + 1)], 1), size)))
    return out, n_letters


def pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of texts of bounded size, with their places; of a very long text, one piece after another."""
    owner: list[int] = []
    part: list[str] = []
    size = 0
    for i, t in enumerate(texts):
        while len(t) > PIECE:
            at = t.find(" ", PIECE)
            yield [i], [t[:at] if at >= 0 else t]
            t = t[at:] if at >= 0 else ""
        if part and size + len(t) > PIECE:
            yield owner, part
            owner, part, size = [], [], 0
        owner.append(i)
        part.append(t)
        size += len(t)
    if part:
        yield owner, part


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # buckets x languages, float32
    prior: np.ndarray

    def score(self, texts: list[str]) -> tuple[list[str], list[float]]:
        if not self.languages or not texts:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        total = np.tile(self.prior.astype(np.float64), (len(texts), 1))
        n_letters = np.zeros(len(texts), np.int64)
        for owner, part in pieces(texts):
            sums, letters_here = self.sums(part)
            np.add.at(total, owner, sums)
            np.add.at(n_letters, owner, letters_here)
        best = total.argmax(1)
        share = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        known = n_letters > 0
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)], np.where(known, share, 0.0).tolist()

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The summed weights of each text's n-grams, and its letters."""
        found, n_letters = grams(texts)
        total = np.zeros((len(texts), len(self.languages)))
        for bucket, span in found:
            if not len(bucket):
                continue
            for i in range(0, len(texts), 64):  # a few documents at a time: the gathered rows stay in the cache
                part = span[i : i + 64]
                low, high = int(part[0, 0]), int(part[-1, 1])
                if high <= low:
                    continue
                rows = np.vstack([self.weights[bucket[low:high]], np.zeros((1, len(self.languages)), np.float32)])
                sums = np.add.reduceat(rows, (part - low).ravel(), axis=0, dtype=np.float64)[::2]
                sums[part[:, 0] >= part[:, 1]] = 0
                total[i : i + 64] += sums
        return total, n_letters


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(labelled: DataFrame, per_language: int = 20_000, smoothing: float = 0.5) -> Model:
    """Fit on (doc_id, text, lang) rows; about ``per_language`` of each language at most."""
    prepare(labelled.sparkSession)
    rows = doc_columns(labelled, "doc_id", "text", "lang").where("lang is not null and doc_id is not null")
    # One row a language: bounded by the label set.
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"{len(sizes)} languages: the model is made for up to {MOST_LANGUAGES}")
    languages = sorted(sizes)
    place = {x: i for i, x in enumerate(languages)}
    if not languages:
        return Model([], np.zeros((1 << BUCKET_BITS, 0), np.float32), np.zeros(0))
    rates = F.create_map(*[F.lit(v) for x in languages for v in (x, min(1.0, per_language / sizes[x]))])
    rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 20)) < rates[F.col("lang")] * (1 << 20))

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(len(languages) << BUCKET_BITS, np.int64)
        for b in batches(parts):
            langs = np.array([place[x] for x in b.column("lang").to_pylist()], np.int64)
            for owner, part in pieces(texts_of(b.column("text"))):
                lang = langs[owner]
                for bucket, span in grams(part)[0]:
                    width = span[:, 1] - span[:, 0]
                    inside = np.zeros(len(bucket) + 1, np.int64)
                    np.add.at(inside, span[:, 0], 1)
                    np.add.at(inside, span[:, 1], -1)
                    inside = np.cumsum(inside[:-1]) > 0
                    table += np.bincount((np.repeat(lang, width) << BUCKET_BITS) + bucket[inside], minlength=len(table))
        at = np.flatnonzero(table)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at])], names=["cell", "n"])

    cells = map_arrow(rows.select("text", "lang"), count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(len(languages) << BUCKET_BITS)
    table[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    table = table.reshape(len(languages), -1) + smoothing
    weights = np.log(table / table.sum(1, keepdims=True)).T.astype(np.float32)
    counts = np.array([sizes[x] for x in languages], float)
    return Model(languages, np.ascontiguousarray(weights), np.log(counts / counts.sum()))


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    spark = prepare(documents.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    rows = doc_columns(documents, "doc_id", "text")
    rows = rows.withColumn("held_out", held_out())

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            lang, score = shared.value.score(texts_of(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return map_arrow(rows, run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(documents: DataFrame, per_language: int = 20_000) -> DataFrame:
    """Learn from the documents that are not held out, then predict all."""
    return predict(documents, train(documents.where(~held_out()), per_language))


def select_recognised(documents: DataFrame, model: Model, least_share: float) -> DataFrame:
    """The documents, all columns kept, whose text is in a learnt language with at least that score."""
    spark = prepare(documents.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            lang, score = shared.value.score(texts_of(b.column("text")))
            yield b.filter(pa.array([k != UNKNOWN and s >= least_share for k, s in zip(lang, score, strict=True)], pa.bool_()))

    return map_arrow(documents, run, documents.schema)
