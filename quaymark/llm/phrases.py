"""Operator 12 — phrase collocations, counted by automata over candidates of a sketch.

Texts are put in lower case (A-Z), cut at punctuation and line ends into pieces and these into words.
Everything is counted by language.  First every task adds the hashes of its words and phrases (1 to 5 words)
to a count-min sketch whose cells stop at the least count that matters; the sketches are added up cell by
cell, and one bit a cell tells whether its upper bound reaches the threshold.  Those bits, of a fixed size,
are broadcast.

Then each shard of texts finds its candidates: phrases whose bits are all set, as are those of all parts.
They are compiled into an Aho-Corasick automaton, as strings guarded by a delimiter on both sides, and the
automaton counts their overlapping matches in the shard's text.  As a phrase's bits do not depend on the
shard, every shard that holds it counts it, and the summed counts are exact; what the sketch let through by
collision falls under the threshold.  No list of candidates is broadcast or collected: an automaton is
bounded by its shard.

Scores, cuts and the dropping of phrases that a longer one covers are joins and aggregations over the counts.

Defined cases: null text counts as empty, null lang as ``und``; repeated rows count each; ties in score go to
the larger count, then to the phrase first in UTF-8 order; a language with few words has fewer rows or none;
a very long text is scanned in parts cut at punctuation; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._shared import batches, doc_columns, map_arrow, prepare, release, stage, texts_of

LONGEST = 5
UNKNOWN = "und"
#: Code points that are scanned together; texts of an Arrow batch.
SHARD, ROWS = 12 << 20, 2048
#: Cells of a row of the sketch as a power of two: by the corpus, between these bounds; code points for each cell.
LEAST_BITS, MOST_BITS, CHARS_A_CELL = 12, 26, 64
#: Beyond so many bits a cell has more code points: some 40 words, so chance alone does not bring it to the threshold.
WIDE_BITS, CHARS_A_FULL_CELL = 22, 256
#: Rows of the sketch for each number of words.
DEPTHS = (1, 2, 2, 2, 2)
ROWS_BEFORE = (0, 1, 3, 5, 7, 9)
#: Code points for each group in which counts are added up, and the most groups.
CHARS_A_GROUP, MOST_GROUPS = 4 << 20, 1 << 18
#: Cells of a block that tasks add up, and how many of a block's rows are added together.
BLOCK, TOGETHER = 1 << 19, 64
_MULTIPLIER, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_END = "[.,;:!?\n\x0b\x0c\r]"
_CUT = re.compile(_END)


def shards(parts: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, list[str]]]:
    """Texts of one language, of about ``size`` code points; a longer text comes in parts that end at punctuation."""
    held: dict[str, list[str]] = defaultdict(list)
    chars: dict[str, int] = defaultdict(int)
    total = 0
    for b in batches(parts):
        for lang, text in zip(b.column("lang").to_pylist(), texts_of(b.column("text")), strict=True):
            at = 0
            while at < len(text):
                cut = _CUT.search(text, at + size) if len(text) - at > size else None
                stop = cut.end() if cut else len(text)
                held[lang].append(text[at:stop])
                chars[lang] += stop - at
                total += stop - at
                at = stop
                if total > size:
                    most = max(chars, key=chars.__getitem__)
                    total -= chars.pop(most)
                    yield most, held.pop(most)
    yield from held.items()


def words_of(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words, the place of each word of the texts among them, and the number of its piece."""
    joined = pa.array([t + "\n" for t in texts], pa.large_string())
    spaced = pc.replace_substring_regex(pc.replace_substring(pc.ascii_lower(joined), "\t", " "), _END, " \n ")
    flat = pc.split_pattern(spaced, " ").flatten()
    coded = flat.filter(pc.not_equal(flat, "")).dictionary_encode()
    codes = coded.indices.to_numpy()
    mark = pc.index(coded.dictionary, "\n").as_py()
    ends = codes == mark
    piece = np.cumsum(ends, dtype=np.int32)
    return coded.dictionary, codes[~ends], piece[~ends]


def hashes_of(words: pa.Array, lang: str) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang) & 0x7FFFFFFF
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words.to_pylist()), np.uint64, len(words))


def extend(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases that go on by a word."""
    mixed = (before * _MULTIPLIER) ^ word
    return (mixed ^ (mixed >> np.uint64(29))) * _MULTIPLIER


def cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    spread = hashes if row == 0 else (hashes ^ (hashes >> np.uint64(31))) * _SECOND
    return (spread >> np.uint64(64 - bits)).astype(np.uint32)


def sketch_bits(chars: int, most: int = MOST_BITS) -> int:
    """Cells of a row as a power of two: they grow with the corpus, else every cell would reach the threshold by chance."""
    bits = int(np.ceil(np.log2(max(1, chars / CHARS_A_CELL))))
    if bits > WIDE_BITS:
        bits = max(WIDE_BITS, int(np.ceil(np.log2(chars / CHARS_A_FULL_CELL))))
    return min(most, max(LEAST_BITS, bits))


def cell_type(cap: int) -> type:
    return np.uint8 if cap < 1 << 8 else np.uint32


def sketch(documents: DataFrame, bits: int, cap: int, size: int = SHARD) -> DataFrame:
    """Rows of two kinds: a block of cells as compressed bytes, or a language (block -1) and its words."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((ROWS_BEFORE[-1], 1 << bits), cell_type(cap))
        n: dict[str, int] = defaultdict(int)
        for lang, texts in shards(parts, size):
            words, codes, piece = words_of(texts)
            n[lang] += len(codes)
            word = hashes_of(words, lang)[codes]
            phrase = word
            for k in range(1, LONGEST + 1):
                if len(word) < k:
                    break
                if k > 1:
                    phrase = extend(phrase[:-1], word[k - 1 :])
                whole = phrase[piece[: len(piece) - k + 1] == piece[k - 1 :]]
                for row in range(DEPTHS[k - 1]):
                    at = np.sort(cells(whole, row, bits))
                    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]][: len(at)])
                    count = np.minimum(np.diff(np.r_[first, len(at)]), cap)
                    own, at = table[ROWS_BEFORE[k - 1] + row], at[first]
                    own[at] = np.minimum(own[at].astype(np.int64) + count, cap)
        if n:
            flat, step, codec = table.ravel(), min(BLOCK, 1 << bits), pa.Codec("zstd", compression_level=1)
            for i in range(0, len(flat), step):
                part = flat[i : i + step]
                if part.any():
                    yield pa.RecordBatch.from_pydict({"block": pa.array([i // step], pa.int32()), "lang": [""], "n": pa.array([0], pa.int64()), "data": [codec.compress(part.tobytes(), asbytes=True)]})
            yield pa.RecordBatch.from_pydict({"block": pa.array([-1] * len(n), pa.int32()), "lang": list(n), "n": pa.array(list(n.values()), pa.int64()), "data": pa.nulls(len(n), pa.binary())})

    return map_arrow(documents, run, "block int, lang string, n long, data binary")


def frequent_cells(blocks: DataFrame, bits: int, cap: int) -> np.ndarray:
    """One bit for each cell whose summed count reaches ``cap``; summed step by step, so no group holds all tasks' rows."""
    step, kind = min(BLOCK, 1 << bits), cell_type(cap)

    def summed(last: bool):
        def run(table: pa.Table) -> pa.Table:
            codec, total = pa.Codec("zstd", compression_level=1), np.zeros(step, kind)
            for chunk in table.column("data").chunks:
                for x in chunk:
                    part = np.frombuffer(codec.decompress(x.as_buffer(), decompressed_size=total.nbytes), kind)
                    total = np.minimum(total.astype(np.uint64 if kind is np.uint32 else np.uint16) + part, cap).astype(kind)
            data = np.packbits(total >= cap, bitorder="little").tobytes() if last else codec.compress(total.tobytes(), asbytes=True)
            return pa.table({"block": table.column("block").slice(0, 1), "data": pa.array([data], pa.binary())})

        return run

    blocks = blocks.select("block", "data")
    rows = blocks.groupBy("block").count().agg(F.max("count")).first()[0] or 0
    while rows > 2 * TOGETHER:
        groups = -(-rows // TOGETHER)
        salted = blocks.withColumn("salt", F.pmod(F.xxhash64("data"), F.lit(groups)))
        blocks, rows = salted.groupBy("block", "salt").applyInArrow(summed(False), "block int, data binary"), groups
    packed = blocks.groupBy("block").applyInArrow(summed(True), "block int, data binary").toArrow()
    out = np.zeros((ROWS_BEFORE[-1] << bits) >> 3, np.uint8)  # of a fixed size
    for block, data in zip(packed.column("block").to_pylist(), packed.column("data").to_pylist(), strict=True):
        out[block * step >> 3 : (block + 1) * step >> 3] = np.frombuffer(data, np.uint8)
    return out.reshape(ROWS_BEFORE[-1], -1)


def candidates(words: pa.Array, codes: np.ndarray, piece: np.ndarray, lang: str, bits: int, frequent: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """For 2 to 5 words the places of one occurrence of each candidate; and which words may start or go on in one."""

    def passing(k: int, phrase: np.ndarray) -> np.ndarray:
        ok = np.ones(len(phrase), bool)
        for row in range(DEPTHS[k - 1]):
            at = cells(phrase, row, bits)
            ok &= (frequent[ROWS_BEFORE[k - 1] + row][at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return ok

    hashes = hashes_of(words, lang)
    known = passing(1, hashes)
    found, n = [], len(codes)
    inside = np.zeros(n + 1, bool)  # whether the word at a place and the next are a candidate
    if n > 1:
        place = np.flatnonzero((piece[1:] == piece[:-1]) & known[codes[:-1]] & known[codes[1:]])
        phrase = extend(hashes[codes[place]], hashes[codes[place + 1]])
        number = codes[place].astype(np.int64)
        for k in range(2, LONGEST + 1):
            ok = passing(k, phrase)
            place, phrase, number = place[ok], phrase[ok], number[ok]
            # Equal numbers: equal words so far, told by place and not by hash.
            _, first, number = np.unique(number << 32 | codes[place + k - 1], return_index=True, return_inverse=True)
            found.append(place[first])
            if k == 2:
                inside[place] = True
            on = np.flatnonzero(place[1:] == place[:-1] + 1)
            place, phrase, number = place[on], extend(phrase[on], hashes[codes[place[on] + k]]), number[on]
    return found, inside


def scan(words: pa.Array, codes: np.ndarray, found: list[np.ndarray], inside: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Candidates, their words and all their occurrences, counted by an automaton."""
    phrases: list[str] = []
    for k, place in enumerate(found, 2):
        if len(place):
            phrases += pc.binary_join_element_wise(*(words.take(pa.array(codes[place + i])) for i in range(k)), pa.scalar(" ", words.type)).to_pylist()
    sizes = np.repeat(np.arange(2, 2 + len(found)), list(map(len, found)))
    if not phrases:
        return phrases, sizes, np.zeros(0, np.int64)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, p in enumerate(phrases):
        automaton.add_word(f" {p} ", i)
    automaton.make_automaton()
    # Words outside of every candidate are left out; a mark stands for each gap, and no phrase holds one.
    keep = inside[:-1] | np.r_[False, inside[:-2]]
    kept = np.flatnonzero(keep)
    gap = ~inside[kept]
    sequence = np.insert(codes[kept], np.flatnonzero(gap) + 1, len(words))
    told = pa.concat_arrays([words, pa.array(["\n"], words.type)]).cast(pa.large_string()).take(pa.array(sequence))
    text = " " + " ".join(told.to_pylist()) + " "
    hits = np.fromiter(map(itemgetter(1), automaton.iter(text)), np.int64)
    return phrases, sizes, np.bincount(hits, minlength=len(phrases))


def shard_counts(documents: DataFrame, bits: int, frequent: np.ndarray, groups: int, size: int = SHARD) -> DataFrame:
    """lang, part and lists of phrases, their words and occurrences: what each shard counts, dealt into ``groups`` parts by phrase."""
    shared = documents.sparkSession.sparkContext.broadcast(frequent)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in shards(parts, size):
            words, codes, piece = words_of(texts)
            found, inside = candidates(words, codes, piece, lang, bits, shared.value)
            phrases, sizes, n = scan(words, codes, found, inside)
            once = np.bincount(codes, minlength=len(words))
            # Only words of a candidate, here or elsewhere, can matter: those whose own bits are set.
            at = cells(hashes_of(words, lang), 0, bits)
            known = np.flatnonzero((shared.value[0][at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool) & (once > 0))
            phrases += words.take(pa.array(known)).to_pylist()
            part = np.fromiter(map(xxhash.xxh32_intdigest, phrases), np.int64, len(phrases)) % groups
            order = np.argsort(part, kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(part[order]) != 0][: len(order)])
            bounds = pa.array(np.r_[first, len(order)].astype(np.int32))
            values = pa.array(phrases, pa.string()), pa.array(np.r_[sizes, np.ones(len(known), np.int64)].astype(np.int32)), pa.array(np.r_[n, once[known]].astype(np.int64))
            lists = [pa.ListArray.from_arrays(bounds, x.take(pa.array(order))) for x in values]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(first), pa.string()), pa.array(part[order][first].astype(np.int32)), *lists], names=["lang", "part", "phrase", "words", "n"])

    return map_arrow(documents, run, "lang string, part int, phrase array<string>, words array<int>, n array<long>")


def summed_counts(parts: DataFrame, threshold: int) -> DataFrame:
    """lang, phrase, words and n of the phrases that reach the threshold; a group holds a bounded share of all phrases."""

    def run(table: pa.Table) -> pa.Table:
        flat = pa.table({c: table.column(c).combine_chunks().flatten() for c in ("phrase", "words", "n")})
        total = flat.group_by("phrase").aggregate([("words", "max"), ("n", "sum")])
        total = total.filter(pc.greater_equal(total.column("n_sum"), threshold))
        lang = pa.array([table.column("lang")[0].as_py()] * total.num_rows, pa.string())
        return pa.table({"lang": lang, "phrase": total.column("phrase"), "words": total.column("words_max"), "n": total.column("n_sum")})

    return parts.groupBy("lang", "part").applyInArrow(run, "lang string, phrase string, words int, n long")


def collocations(counts: DataFrame, totals: DataFrame, threshold: int = 100, most: int = 2000) -> DataFrame:
    """The first ``most`` phrases of each language, from exact counts of phrases and of all words."""
    found = counts.where((F.col("words") > 1) & (F.col("n") >= threshold)).select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    # A longer phrase that always stands around a shorter one also does so one word longer: single words decide.
    longer = found.where(F.size("w") > 2).select("lang", "a", F.explode(F.array(F.expr("slice(w, 1, size(w) - 1)"), F.expr("slice(w, 2, size(w) - 1)"))).alias("inner"))
    covered = longer.groupBy("lang", F.array_join("inner", " ").alias("phrase")).agg(F.max("a").alias("around"))
    kept = found.join(covered, ["lang", "phrase"], "left").where("around is null or around < a").drop("around")
    cuts = kept.select("lang", "phrase", "a", "w", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("left_part"), F.array_join(F.expr("slice(w, k + 1, size(w) - k)"), " ").alias("right_part"))
    parts = counts.select("lang", "phrase", "n")
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left_part"), F.col("n").alias("l")), ["lang", "left_part"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right_part"), F.col("n").alias("r")), ["lang", "right_part"])
    cuts = cuts.join(totals, "lang")
    # 1000 * a * n is up to 10^38 for counts up to 10^17; the division is of whole numbers.
    score = F.expr("cast(1000 * cast(a as decimal(17,0)) * cast(n as decimal(17,0)) as decimal(38,0)) div cast(cast(l as decimal(19,0)) * cast(r as decimal(19,0)) as decimal(38,0))")
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "a", "l", "r", "n")).alias("x")).select("lang", "phrase", "x.*")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def mine(documents: DataFrame, threshold: int = 100, most: int = 2000, size: int = SHARD, most_bits: int = MOST_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: the best collocations of every language."""
    spark = prepare(documents.sparkSession, ROWS)
    rows = doc_columns(documents, "text", "lang").select("text", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    chars = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = sketch_bits(chars, most_bits)
    sketched = stage(spark, sketch(rows, bits, threshold, size), "sketch")
    totals = stage(spark, sketched.where("block = -1").groupBy("lang").agg(F.sum("n").alias("n")), "words")
    frequent = frequent_cells(sketched.where("block >= 0"), bits, threshold)
    release(spark, sketched)
    groups = min(MOST_GROUPS, 1 + chars // CHARS_A_GROUP)
    counts = stage(spark, summed_counts(shard_counts(rows, bits, frequent, groups, size), threshold), "counts")
    return collocations(counts, totals, threshold, most)
