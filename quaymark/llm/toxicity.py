"""Operator 11 — toxicity by averaged subword embeddings and a linear softmax.

A word is the bag of its character n-grams and itself, hashed into a fixed number of buckets; each bucket has
a small vector.  A word's vector is the mean of its buckets', a text's the mean of its words', and a linear
softmax tells the two classes apart.  Vectors and softmax are trained jointly in numpy, so a misspelling that
was never seen shares most of its vectors with the word that was.

Labelled documents are made bags of words once and written.  Buckets of too few of their words keep a zero vector;
the others' vectors are trained in units of one over the root of their mean weight, so that rare n-grams move as
fast as common ones.  The documents are dealt into shards of a bounded size; in each round every shard takes steps of
its own from the common parameters (whole gradients with momentum), and the parameters are averaged.  The driver
sees only tables by bucket and parameters, both of a fixed size.  Documents kept aside calibrate the softmax's
log-odds (Platt scaling).

For scoring, each word's share of the log-odds is one number, so a text needs the mean of its words' numbers.

Training sees about ``labelled`` labelled documents at most, picked by a hash of doc_id (the bound, a
parameter); everything is scored, in whole.

Defined cases: null and empty texts, and texts without a word, get the share of toxic labels;
rows without a label, or with a null one, and rows without doc_id do not train; several labels of a document
count as their majority, ties as toxic; with labels of fewer than two classes every score is that share (0 with
no labels); repeated rows get equal scores; null doc_id is scored and never held out; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import Lexicon, batches, count_rows, doc_columns, map_arrow, prepare, release, split_words, stage, texts_of, worker_cache

BITS, WIDTH = 18, 16
BUCKETS = 1 << BITS
GRAMS = (3, 4, 5)
#: Words whose share a worker remembers, and code points looked at together.
CACHE_ENTRIES, PIECE = 300_000, 1 << 20
#: Labelled documents up to which their marks are broadcast; beyond, they are joined by shuffle.
BROADCAST_MARKS = 200_000
#: Parts of the labelled documents that train beside each other, and how many of 8 parts are kept aside.
SHARDS, ASIDE = 8, 1
STEPS, STEP, MOMENTUM = 30, 30.0, 0.9
#: A bucket is trained if so many words of labelled documents have it, or one in SHARE of the documents where those are few.
MOST_WORDS, SHARE = 50, 50
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
#: Signs around a word that do not belong to it.
_AROUND = " \t\r\n.,;:!?\"'()[]{}<>|-_*#=+/\\"


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def cores(words: pa.Array) -> pa.Array:
    """The words in lower case without the signs around them."""
    return pc.utf8_lower(pc.utf8_trim(words, _AROUND))


def subwords(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the words (with their ends marked) and of the words themselves; and how many each has."""
    listed = words.to_pylist()
    marked = [f"<{w}>" for w in listed]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    owner = np.repeat(np.arange(len(marked), dtype=np.int32), sizes)
    found = [np.fromiter((xxhash.xxh32_intdigest(w) for w in listed), np.uint32, len(listed)) & np.uint32(BUCKETS - 1)]
    owners = [np.arange(len(listed), dtype=np.int32)]
    for n in GRAMS:
        size = max(0, len(codes) - n + 1)
        mixed = np.full(size, n, np.uint32)
        for k in range(n):
            mixed = (mixed ^ codes[k : k + size]) * _MIX[k % 3]
            mixed ^= mixed >> np.uint32(15)
        inside = owner[:size] == owner[n - 1 : n - 1 + size]
        found.append(((mixed * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BITS))[inside])
        owners.append(owner[:size][inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order].astype(np.int64), np.bincount(owner, minlength=len(listed))


def word_runs(texts: list[str]) -> Iterator[tuple[int, int, pa.Array, np.ndarray, np.ndarray]]:
    """Groups of texts of bounded size: first and last, distinct words, each word's place, and each word's text."""
    start = size = 0
    for k, t in enumerate([*texts, None]):
        if (t is None or size + len(t) > PIECE) and k > start:
            flat, stops = split_words(texts[start:k])
            owner = np.repeat(np.arange(k - start), np.diff(stops, prepend=0))
            coded = flat.dictionary_encode()
            core = cores(coded.dictionary)
            some = pc.not_equal(core, "").to_numpy(zero_copy_only=False)
            at = coded.indices.to_numpy()
            if not some.all():
                keep = some[at]
                owner, at = owner[keep], (np.cumsum(some) - 1)[at[keep]]
                core = core.filter(pa.array(some))
            yield start, k, core.cast(pa.string()), at, owner
            start, size = k, 0
        size += len(t or "")


def bags(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of each text, their shares of it, and how many each text has."""
    found, shares, counts = [pa.array([], pa.string())], [np.zeros(0, np.float32)], np.zeros(len(texts), np.int64)
    for first, last, words, at, owner in word_runs(texts):
        coded = words.dictionary_encode()
        pair, times = np.unique(owner * len(words) + coded.indices.to_numpy()[at], return_counts=True) if len(at) else (at, at)
        text = pair // max(1, len(words))
        found.append(coded.dictionary.take(pa.array(pair % max(1, len(words)))))
        shares.append((times / np.bincount(owner, minlength=last - first)[text]).astype(np.float32))
        counts[first:last] = np.bincount(text, minlength=last - first)
    return pa.concat_arrays(found), np.concatenate(shares), counts


@dataclass
class Parameters:
    """Vectors of the trained buckets, and the difference of the softmax's two classes."""

    vectors: np.ndarray
    softmax: np.ndarray
    offset: float

    @staticmethod
    def first(n: int, share: float) -> Parameters:
        """The softmax starts in some direction, the vectors at zero: what they become depends on both."""
        softmax = np.random.default_rng(11).standard_normal(WIDTH).astype(np.float32)
        return Parameters(np.zeros((n, WIDTH), np.float32), softmax / np.linalg.norm(softmax), float(np.log(share / (1 - share))))


@dataclass
class Bags:
    """A shard: which text has which word to what share, and which word has which trained buckets."""

    text: np.ndarray
    word: np.ndarray
    share: np.ndarray
    of_word: np.ndarray
    bucket: np.ndarray
    per_word: np.ndarray  # one over the number of all buckets of a word
    units: np.ndarray
    texts: int

    @staticmethod
    def of(words: pa.Array, shares: np.ndarray, counts: np.ndarray, units: np.ndarray, renumber: np.ndarray) -> Bags:
        coded = words.dictionary_encode()
        flat, sizes = subwords(coded.dictionary)
        number, of_word = renumber[flat], np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        keep = number >= 0
        text = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        return Bags(text, coded.indices.to_numpy(), shares, of_word[keep], number[keep], 1 / np.maximum(sizes, 1), units, len(counts))

    def margins(self, buckets: np.ndarray) -> np.ndarray:
        """The texts' means of their words' means of what each bucket counts."""
        value = np.bincount(self.of_word, (self.units * buckets)[self.bucket], minlength=len(self.per_word)) * self.per_word
        return np.bincount(self.text, self.share * value[self.word], minlength=self.texts)

    def pull(self, errors: np.ndarray) -> np.ndarray:
        """The transposed product: what the texts' errors add up to by bucket."""
        word = np.bincount(self.word, self.share * errors[self.text], minlength=len(self.per_word)) * self.per_word
        return np.bincount(self.bucket, word[self.of_word], minlength=len(self.units)) * self.units

    def squared(self, probes: int = 8) -> float:
        """About the mean squared length of the texts' bags, from random signs."""
        signs = np.random.default_rng(5).choice([-1.0, 1.0], (probes, len(self.units)))
        return float(np.mean([(self.margins(x) ** 2).mean() for x in signs])) or 1.0


def train_shard(p: Parameters, bags: Bags, toxic: np.ndarray, steps: int = STEPS) -> Parameters:
    """Steps from ``p`` over one shard: vectors and softmax move together.

    The two classes' errors add up to zero, so one column of them is enough for the exact gradients.
    """
    vectors, softmax, offset = p.vectors.astype(np.float64), p.softmax.astype(np.float64), p.offset
    moving, turning, step = np.zeros_like(vectors), np.zeros_like(softmax), STEP / bags.squared()
    for _ in range(steps):
        error = _sigmoid(bags.margins(vectors @ softmax) + offset) - toxic
        pull = bags.pull(error) / len(toxic)
        turning = MOMENTUM * turning + vectors.T @ pull
        moving = MOMENTUM * moving + np.outer(pull, softmax)
        vectors -= step * moving
        softmax = softmax - 0.01 * turning
        offset -= float(error.mean())
    return Parameters(vectors.astype(np.float32), softmax.astype(np.float32), offset)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def calibrate(margin: np.ndarray, toxic: np.ndarray, steps: int = 50) -> np.ndarray:
    """Scale and offset of the margins as log-odds (Newton's method, lightly penalised)."""
    center, width = float(margin.mean()), float(margin.std()) or 1.0
    x, w = np.stack([(margin - center) / width, np.ones(len(margin))], 1), np.zeros(2)
    for _ in range(steps):
        q = _sigmoid(x @ w)
        step = np.linalg.solve((x.T * (q * (1 - q))) @ x + 0.1 * np.eye(2), x.T @ (toxic - q) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return np.array([w[0] / width, w[1] - w[0] * center / width])


@dataclass
class Model:
    share: float  # of toxic labels: the score where nothing could be learnt
    buckets: np.ndarray | None = None  # share of the log-odds of each bucket
    scale: np.ndarray | None = None
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def words(self, words: pa.Array) -> tuple[np.ndarray, ...]:
        """Each word's share of the log-odds: the mean of its buckets'."""
        flat, sizes = subwords(words)
        owner = np.repeat(np.arange(len(words)), sizes)
        return (np.bincount(owner, self.buckets[flat], minlength=len(words)) / np.maximum(sizes, 1),)

    def score(self, texts: list[str]) -> np.ndarray:
        if self.buckets is None:
            return np.full(len(texts), self.share)
        known = worker_cache(f"toxic words {self.name}", lambda: Lexicon(self.words, CACHE_ENTRIES))
        margin, some = np.zeros(len(texts)), np.zeros(len(texts), bool)
        for first, last, words, at, owner in word_runs(texts):
            # Different words may have one core: the lexicon looks up distinct ones.
            coded = words.dictionary_encode()
            place = known.places(coded.dictionary)[coded.indices.to_numpy()]
            n = np.bincount(owner, minlength=last - first)
            margin[first:last] = np.bincount(owner, known.columns[0][place[at]], minlength=last - first) / np.maximum(n, 1)
            some[first:last] = n > 0
        return np.where(some, _sigmoid(margin * self.scale[0] + self.scale[1]), self.share)


def marks_of(labels: DataFrame, labelled: int) -> DataFrame:
    """doc_id and toxic (0 or 1) of about ``labelled`` documents at most; none that is held out."""
    marks = doc_columns(labels, "doc_id", "toxic").where("doc_id is not null and toxic in (0, 1)").where(~held_out())
    rate = min(1.0, labelled / max(1, marks.count()))
    picked = marks.where(F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 20)) < int(rate * (1 << 20)))
    return picked.groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))


def labelled_bags(documents: DataFrame, marks: DataFrame) -> DataFrame:
    """part (of 0 to SHARDS * 8), toxic and the bag of every labelled document."""
    few = count_rows(marks, BROADCAST_MARKS) <= BROADCAST_MARKS
    rows = doc_columns(documents, "doc_id", "text").join(F.broadcast(marks) if few else marks, "doc_id")
    rows = rows.select("doc_id", "text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(8 * SHARDS)).cast("int").alias("part"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            found, shares, counts = bags(texts_of(b.column("text")))
            bounds = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
            lists = [pa.ListArray.from_arrays(bounds, x) for x in (found, pa.array(shares))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("part"), b.column("toxic"), *lists], names=["doc_id", "part", "toxic", "words", "shares"])

    return map_arrow(rows, run, "doc_id long, part int, toxic int, words array<string>, shares array<float>")


def bucket_table(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of each bucket: words of documents that have it, and the sum of its weights."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS))
        for b in batches(parts):
            coded = b.column("words").flatten().dictionary_encode()
            flat, sizes = subwords(coded.dictionary)
            of_word, at = np.repeat(np.arange(len(sizes)), sizes), coded.indices.to_numpy()
            share = np.bincount(at, b.column("shares").flatten().to_numpy(), minlength=len(sizes)) / np.maximum(sizes, 1)
            for k, x in enumerate((np.bincount(at, minlength=len(sizes)), share)):
                sums[k] += np.bincount(flat, x[of_word], minlength=BUCKETS)
        some = np.flatnonzero(sums[0])
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(x[some]) for x in sums)], names=["bucket", "n", "w"])

    summed = map_arrow(rows.select("words", "shares"), run, "bucket long, n double, w double").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("w").alias("w")).toArrow()
    out = np.zeros((2, BUCKETS))
    out[:, summed.column("bucket").to_numpy()] = [summed.column(c).to_numpy() for c in "nw"]
    return tuple(out)


def _stepper(shared) -> Callable[[pa.Table], pa.Table]:
    """What a shard does in a round: the parameters, units and numbers of the trained buckets are broadcast."""

    def run(table: pa.Table) -> pa.Table:
        before, units, renumber = shared.value
        table = table.sort_by([("doc_id", "ascending"), ("toxic", "ascending")])  # the rows' order does not matter
        words, shares = (table.column(c).combine_chunks() for c in ("words", "shares"))
        shard = Bags.of(words.flatten(), shares.flatten().to_numpy(), words.value_lengths().to_numpy(), units, renumber)
        after = train_shard(before, shard, table.column("toxic").to_numpy())
        head = np.r_[after.softmax, np.float32(after.offset)].astype(np.float32)
        return pa.table({"n": pa.array([table.num_rows], pa.int64()), "vectors": pa.array([after.vectors.tobytes()], pa.binary()), "head": pa.array([head.tobytes()], pa.binary())})

    return run


def fit(rows: DataFrame, rounds: int) -> Model:
    """Train round by round over the shards, then calibrate on the documents kept aside."""
    spark = rows.sparkSession
    rows = rows.withColumn("aside", F.col("part") % 8 < ASIDE).withColumn("shard", F.floor(F.col("part") / 8).cast("int"))
    sums = {r["aside"]: (r["n"], r["toxic"]) for r in rows.groupBy("aside").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).collect()}
    n, toxic = (sum(x) for x in zip(*sums.values(), strict=True)) if sums else (0, 0)
    share = toxic / n if n else 0.0
    if any(not 0 < sums.get(part, (0, 0))[1] < sums.get(part, (0, 0))[0] for part in (False, True)):
        return Model(float(share))
    train, n = rows.where("not aside"), sums[False][0]
    found, weight = bucket_table(train)
    trained = np.flatnonzero(found >= min(MOST_WORDS, max(2, n // SHARE)))
    units = np.sqrt(n / weight[trained])
    renumber = np.full(BUCKETS, -1, np.int32)
    renumber[trained] = np.arange(len(trained))
    p = Parameters.first(len(trained), share)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((p, units, renumber))
        # As many rows as shards, each of the parameters' fixed size.
        found = train.groupBy("shard").applyInArrow(_stepper(shared), "n long, vectors binary, head binary").toArrow().sort_by([("n", "ascending"), ("head", "ascending")]).to_pylist()
        vectors, head, total = np.zeros((len(trained), WIDTH)), np.zeros(WIDTH + 1), sum(r["n"] for r in found)
        for r in found:
            vectors += np.frombuffer(r["vectors"], np.float32).reshape(-1, WIDTH) * (r["n"] / total)
            head += np.frombuffer(r["head"], np.float32) * (r["n"] / total)
        p = Parameters(vectors.astype(np.float32), head[:WIDTH].astype(np.float32), float(head[WIDTH]))
        shared.unpersist()
    buckets = np.zeros(BUCKETS)
    buckets[trained] = (p.vectors @ p.softmax) * units
    weighed = spark.sparkContext.broadcast(buckets)

    def margins(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            lists = b.column("words")
            bag = Bags.of(lists.flatten(), b.column("shares").flatten().to_numpy(), lists.value_lengths().to_numpy(zero_copy_only=False), np.ones(BUCKETS), np.arange(BUCKETS))
            yield pa.RecordBatch.from_arrays([pa.array(bag.margins(weighed.value)), b.column("toxic")], names=["margin", "toxic"])

    aside = map_arrow(rows.where("aside").select("words", "shares", "toxic"), margins, "margin double, toxic int").toArrow()
    scale = calibrate(aside.column("margin").to_numpy(), aside.column("toxic").to_numpy())
    return Model(float(share), buckets, scale)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    spark = prepare(documents.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    rows = doc_columns(documents, "doc_id", "text").withColumn("held_out", held_out())

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            found = shared.value.score(texts_of(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("held_out"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return map_arrow(rows, run, "doc_id long, held_out boolean, score double, predicted int", "toxic words")


def train(documents: DataFrame, labels: DataFrame, labelled: int = 20_000, rounds: int = 4) -> Model:
    spark = prepare(documents.sparkSession)
    rows = stage(spark, labelled_bags(documents, marks_of(labels, labelled)), "bags")
    model = fit(rows, rounds)
    release(spark, rows)
    return model


def train_and_score(documents: DataFrame, labels: DataFrame, labelled: int = 20_000, rounds: int = 4) -> DataFrame:
    return score(documents, train(documents, labels, labelled, rounds))
