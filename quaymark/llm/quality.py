"""Operator 10 — quality classifier by co-training.

Two classifiers see separate views of a document: its text (multinomial naive Bayes over hashed words,
the signs hung on them, and how much the text repeats itself) and its metadata (logistic regression over source, language and recorded
length; nothing of the text).  In each round each view labels all documents of the corpus; those of
which it is confident join the other view's training set.  Both are then calibrated (Platt scaling) on
labelled documents kept aside, and the calibrated log-odds are added, less the prior counted twice, to
score every document.

Labels are sampled: about ``labelled`` labelled documents at most, picked by a hash of doc_id (the
bound, a parameter).  All else covers the whole corpus: features are made once and written, and each
round reads them on the executors, which label every document and add up counts by word and by cell of
the metadata.  Those tables have a fixed number of cells, so the driver never holds documents.
Confident documents count in the labels' proportion and together as much as the labels do.

Defined cases: null text counts as empty, null metadata as a value of its own; rows without a label, or
with a null one, do not train; several labels of a document all count; with labels of fewer than two
classes every score is the share of good labels (0.5 with none); repeated rows get equal scores; ties
in confidence are all adopted; null ids are scored; extra columns are ignored; empty documents give no
rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import Lexicon, batches, count_rows, doc_columns, map_arrow, prepare, release, split_words, stage, texts_of, worker_cache

WORD_BITS = 16
WORDS = 1 << WORD_BITS
#: The last features tell a text's layout in tenths and quarters.
LAYOUT = WORDS - 64
#: Buckets of source, language and length; their product is the number of cells of the metadata.
SOURCES, LANGUAGES, LENGTHS = 64, 16, 24
CELLS = SOURCES * LANGUAGES * LENGTHS
#: Words whose features a worker remembers, and code points looked at together.
CACHE_ENTRIES, PIECE = 400_000, 1 << 20
#: Labelled documents up to which their marks are broadcast; beyond, they are joined by shuffle.
BROADCAST_MARKS = 200_000
_TAIL = re.compile(r"[\W_]+$")
#: Words with a small letter and at most one sign at the end: most words, made features as whole arrays.
_USUAL = r"^(?P<core>[a-zA-ZÀ-ÖØ-öø-ÿ]*[a-zß-öø-ÿ][a-zA-ZÀ-ÖØ-öø-ÿ]*)[!-/:-@\[-`{-~]?$"


def _feature(word: str) -> int:
    """Hash of a word in lower case, or, in the upper half, of the signs and the case that it shows."""
    tail = _TAIL.search(word)
    signs = tail[0] if tail else ""
    core = word[: len(word) - len(signs)]
    half = WORDS >> 1
    room = half - (WORDS - LAYOUT)
    if len(signs) > 1 or not core or (len(core) > 2 and core.isupper()):
        return half + xxhash.xxh32_intdigest(f"{signs} {core.isupper()}") % room
    return xxhash.xxh32_intdigest(core.lower()) % half


def _features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The feature of each word, and whether it is made of signs alone."""
    out = np.zeros(len(words), np.int32)
    parts = pc.extract_regex(words, _USUAL)
    usual = parts.is_valid().to_numpy(zero_copy_only=False)
    if usual.any():
        cores = pc.utf8_lower(parts.filter(pa.array(usual)).field("core")).to_pylist()
        out[usual] = np.fromiter(map(xxhash.xxh32_intdigest, cores), np.int64, len(cores)) % (WORDS >> 1)
    at = np.flatnonzero(~usual)
    rest = words.take(pa.array(at)).to_pylist()
    out[at] = [_feature(w) for w in rest]
    signs = np.zeros(len(words), bool)
    signs[at] = [not any(map(str.isalnum, w)) for w in rest]
    return out, signs


def _layout(words: np.ndarray, stops: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Pairs (text << WORD_BITS | feature) that tell the shares of different words, of words said twice in a row, and of lone signs."""
    n = np.diff(stops, prepend=0)
    owner = np.repeat(np.arange(len(n)), n)
    different = np.bincount(np.unique(owner << 32 | words) >> 32, minlength=len(n))
    again = np.flatnonzero((words[1:] == words[:-1]) & (owner[1:] == owner[:-1]))
    counts = (different, np.bincount(owner[again], minlength=len(n)), np.bincount(owner[signs], minlength=len(n)))
    some = np.flatnonzero(n)
    out = []
    for k, c in enumerate(counts):
        share = c[some] / n[some]
        out += (LAYOUT + 16 * k + (10 * share).astype(np.int64), LAYOUT + 48 + 5 * k + (4 * share).astype(np.int64))
    return np.concatenate([some << WORD_BITS | x for x in out])


def word_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text in one array, and how many each text has."""
    known = worker_cache("word features", lambda: Lexicon(_features, CACHE_ENTRIES))
    found, sizes, start, size = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0, 0
    for k, t in enumerate([*texts, None]):
        if (t is None or size + len(t) > PIECE) and k > start:
            flat, stops = split_words(texts[start:k])
            coded = flat.dictionary_encode()
            word = coded.indices.to_numpy()
            place = known.places(coded.dictionary.cast(pa.string()))[word]
            features, signs = (c[place] for c in known.columns)
            pairs = np.repeat(np.arange(k - start), np.diff(stops, prepend=0)) << WORD_BITS | features
            pairs = np.unique(np.concatenate([pairs, _layout(word.astype(np.int64), stops, signs)]))
            found.append((pairs & (WORDS - 1)).astype(np.int32))
            sizes.append(np.bincount(pairs >> WORD_BITS, minlength=k - start))
            start, size = k, 0
        size += len(t or "")
    return np.concatenate(found), np.concatenate(sizes)


def metadata_cell() -> Column:
    """The cell of a document's source, language and recorded length."""

    def bucket(name: str, n: int) -> Column:
        return F.pmod(F.xxhash64(F.col(name).isNull(), F.coalesce(F.col(name).cast("string"), F.lit(""))), F.lit(n))

    length = F.col("n_chars").cast("double")
    binned = F.when(length.isNull(), 0).otherwise(F.least(F.lit(LENGTHS - 1), 1 + F.floor(F.log2(F.greatest(length, F.lit(0.0)) + 1))))
    return ((bucket("source", SOURCES) * LANGUAGES + bucket("lang", LANGUAGES)) * LENGTHS + binned).cast("int")


def _design(cells: np.ndarray) -> np.ndarray:
    """One row of indicators for each cell, and a constant."""
    x = np.zeros((len(cells), SOURCES + LANGUAGES + LENGTHS + 1))
    rows = np.arange(len(cells))
    x[rows, cells // (LANGUAGES * LENGTHS)] = 1
    x[rows, SOURCES + cells // LENGTHS % LANGUAGES] = 1
    x[rows, SOURCES + LANGUAGES + cells % LENGTHS] = 1
    x[:, -1] = 1
    return x


def _bayes(counts: np.ndarray) -> np.ndarray:
    """Weights of naive Bayes as log-odds of each feature, from its counts in bad and good documents."""
    bad, good = counts + 0.5
    return (np.log(good / good.sum()) - np.log(bad / bad.sum())).astype(np.float32)


def _margin(weights: np.ndarray, features: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean log-odds of each text's features; 0 for a text without any."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.bincount(owner, weights[features], minlength=len(sizes)) / np.maximum(sizes, 1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, bad: np.ndarray, good: np.ndarray, penalty: float = 1.0, steps: int = 25) -> np.ndarray:
    """Newton's method for ridge-penalised logistic regression over rows that stand for several documents."""
    w, n = np.zeros(x.shape[1]), bad + good
    for _ in range(steps):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x.T * (n * p * (1 - p))) @ x + penalty * np.eye(len(w)), x.T @ (good - n * p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _calibrate(margin: np.ndarray, bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    return _logistic(np.stack([margin, np.ones(len(margin))], 1), bad, good, penalty=1e-3)


@dataclass
class Model:
    share: float
    words: np.ndarray | None = None  # weight of each word feature
    word_scale: np.ndarray | None = None
    cells: np.ndarray | None = None  # calibrated log-odds of each cell of the metadata
    prior: float = 0.0

    def logits(self, features: np.ndarray, sizes: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated log-odds of both views."""
        return _margin(self.words, features, sizes) * self.word_scale[0] + self.word_scale[1], self.cells[cells].astype(float)

    def score(self, features: np.ndarray, sizes: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Combined, content and metadata probabilities of being good."""
        if self.words is None:
            same = np.full(len(sizes), self.share)
            return same, same, same
        content, meta = self.logits(features, sizes, cells)
        return _sigmoid(content + meta - self.prior), _sigmoid(content), _sigmoid(meta)


def _arrays(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = b.column("words")
    return words.flatten().to_numpy(), words.value_lengths().to_numpy(zero_copy_only=False), b.column("cell").to_numpy()


def marks_of(labels: DataFrame, labelled: int) -> DataFrame:
    """doc_id, bad and good (how often it is labelled so) of about ``labelled`` documents at most."""
    marks = doc_columns(labels, "doc_id", "quality").where("doc_id is not null and quality in (0, 1)")
    rate = min(1.0, labelled / max(1, marks.count()))
    picked = marks.where(F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20)) < int(rate * (1 << 20)))
    return picked.groupBy("doc_id").agg(F.count_if(F.col("quality") == 0).cast("int").alias("bad"), F.count_if(F.col("quality") == 1).cast("int").alias("good"))


def features_of(documents: DataFrame, marks: DataFrame) -> DataFrame:
    """doc_id, words, cell, bad and good of every document."""
    few = count_rows(marks, BROADCAST_MARKS) <= BROADCAST_MARKS
    rows = doc_columns(documents, "doc_id", "text", "lang", "source", "n_chars").select("doc_id", "text", metadata_cell().alias("cell"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            found, sizes = word_features(texts_of(b.column("text")))
            words = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(found))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), words, b.column("cell")], names=["doc_id", "words", "cell"])

    made = map_arrow(rows, run, "doc_id long, words array<int>, cell int", "word features")
    return made.join(F.broadcast(marks) if few else marks, "doc_id", "left").fillna(0, ["bad", "good"])


def _tables(rows: DataFrame, model: Model | None, confident: float) -> tuple[np.ndarray, np.ndarray]:
    """Counts by class and word, and by class and cell of the metadata.

    Without a model, of the labels; with one, of the documents of which the other view is confident.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)
    edge = float(np.log(confident / (1 - confident)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, cells = np.zeros(2 * WORDS), np.zeros(2 * CELLS)
        for b in batches(parts):
            found, sizes, cell = _arrays(b)
            if shared.value is None:
                by_words = by_cells = [b.column("bad").to_numpy(), b.column("good").to_numpy()]
            else:
                content, meta = shared.value.logits(found, sizes, cell)
                by_words, by_cells = ([z <= -edge, z >= edge] for z in (meta, content))
            for k in (0, 1):
                words += np.bincount(found + k * WORDS, np.repeat(by_words[k].astype(float), sizes), minlength=2 * WORDS)
                cells += np.bincount(cell + k * CELLS, by_cells[k].astype(float), minlength=2 * CELLS)
        both = np.concatenate([words, cells])
        at = np.flatnonzero(both)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(both[at])], names=["at", "n"])

    table = np.zeros(2 * WORDS + 2 * CELLS)
    summed = map_arrow(rows.select("words", "cell", "bad", "good"), run, "at long, n double", "word features").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    table[summed.column("at").to_numpy()] = summed.column("n").to_numpy()
    return table[: 2 * WORDS].reshape(2, -1), table[2 * WORDS :].reshape(2, -1)


def _margins(rows: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Margin by the words, cell, bad and good of each of the rows: a bounded sample."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            found, sizes, _ = _arrays(b)
            yield pa.RecordBatch.from_arrays([pa.array(_margin(shared.value, found, sizes)), b.column("cell"), b.column("bad"), b.column("good")], names=["margin", "cell", "bad", "good"])

    found = map_arrow(rows.select("words", "cell", "bad", "good"), run, "margin double, cell int, bad int, good int", "word features").toArrow()
    return tuple(found.column(n).to_numpy() for n in ("margin", "cell", "bad", "good"))


def cotrain(features: DataFrame, rounds: int = 3, confident: float = 0.95) -> Model:
    """Fit both views on the labelled documents and, round by round, on what the other view is confident of."""
    spark = features.sparkSession
    labelled = stage(spark, features.where("bad + good > 0").withColumn("aside", F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(4)) == 3), "labelled")
    sums = {r["aside"]: (r["bad"], r["good"]) for r in labelled.groupBy("aside").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect()}
    bad, good = (sum(x) for x in zip(*sums.values(), strict=True)) if sums else (0, 0)
    share = good / (bad + good) if bad + good else 0.5
    if any(min(sums.get(part, (0, 0))) == 0 for part in (False, True)):
        return Model(float(share))
    train, aside = labelled.where("not aside"), labelled.where("aside")
    prior = float(np.log(share / (1 - share)))

    def model_of(words: np.ndarray, cells: np.ndarray) -> Model:
        weights = _bayes(words)
        margin, cell, bad, good = _margins(aside, weights)
        seen = np.flatnonzero(cells.sum(0))
        meta = _design(np.arange(CELLS)) @ _logistic(_design(seen), cells[0, seen], cells[1, seen])
        scale = _calibrate(meta[cell], bad, good)
        return Model(share, weights, _calibrate(margin, bad, good), (meta * scale[0] + scale[1]).astype(np.float32), prior)

    words, cells = _tables(train, None, confident)
    model, size = model_of(words, cells), cells.sum()
    for _ in range(rounds):
        more_words, more_cells = _tables(features.where("bad + good = 0"), model, confident)
        if not more_words.any() and not more_cells.any():
            break
        # Each class of confident documents weighs at most as much as the class has among the labels.
        weight = [np.minimum(1.0, np.array([1 - share, share]) * size / np.maximum(n, 1.0))[:, None] for n in (_documents(more_words, cells, words), more_cells.sum(1))]
        model = model_of(words + weight[0] * more_words, cells + weight[1] * more_cells)
    release(spark, labelled)
    return model


def _documents(more: np.ndarray, cells: np.ndarray, words: np.ndarray) -> np.ndarray:
    """About how many documents the word counts of each class stand for, by the labelled documents' features."""
    return more.sum(1) / max(1.0, words.sum() / max(1.0, cells.sum()))


def score(features: DataFrame, model: Model, keep_from: float = 0.5) -> DataFrame:
    """doc_id, score, content_score, metadata_score and keep of every document."""
    shared = features.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            both, content, meta = shared.value.score(*_arrays(b))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, (both, content, meta, both >= keep_from))], names=["doc_id", "score", "content_score", "metadata_score", "keep"])

    return map_arrow(features.select("doc_id", "words", "cell"), run, "doc_id long, score double, content_score double, metadata_score double, keep boolean", "word features")


def cotrain_and_score(documents: DataFrame, labels: DataFrame, labelled: int = 20_000, rounds: int = 3) -> DataFrame:
    spark = prepare(documents.sparkSession)
    features = stage(spark, features_of(documents, marks_of(labels, labelled)), "features")
    return score(features, cotrain(features, rounds))
