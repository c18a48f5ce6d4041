"""Operator 13 — alignment of two tokenizers over the bytes that both cover.

A byte-level BPE (A) and a sentencepiece BPE (B) cut the same bytes: a space and the text.  All tokens of
an Arrow batch are laid end to end, so a token's end is a byte offset in the whole batch.  The ends of A and
of B are counted by offset once; where both occur is a cut, and running sums over the offsets, taken at the
documents' bounds, give every document's tokens, groups and links.

No token of either vocabulary reaches from a visible character into white space, so a text falls into
chunks (white space and what follows it) that are encoded alone.  Distinct chunks of a batch are looked up
together, unknown ones are encoded once, and their ids and group strings are kept in Arrow and numpy arrays.

How often a pair of ids is linked is summed over the corpus; a second pass over the documents' staged pairs,
not over their texts, reads each pair's count and whether it is the best of its B id.  The table of pairs is
broadcast up to ``BROADCAST_PAIRS`` rows; beyond, pairs are joined by shuffle.

Defined cases: null and empty texts, and texts that one vocabulary changes (a U+2581 mark becomes a space),
have no tokens: zeros and an empty string.  Repeated rows get equal values and count each in the corpus; null
doc_id is kept; extra columns are ignored; an empty table gives no rows; nothing is cut short.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import arrow_rows, batches, count_rows, doc_columns, map_arrow, prepare, stage, texts_of, trim, worker_cache

#: Distinct chunks and bytes of chunks that a worker remembers; texts of an Arrow batch.
CACHE_ENTRIES, CACHE_BYTES, ROWS = 300_000, 48 << 20, 1024
#: Pairs of ids up to which their table is broadcast (some 24 bytes each).
BROADCAST_PAIRS = 4_000_000
#: Distinct pairs that a task holds before it hands their counts on.
HELD_PAIRS = 2_000_000
SPACE, MARK = "▁", "\x01"
#: Chunks that are joined for one call of a library.
GROUP = 2000
#: White space other than a space and a line feed, and the mark: such texts are cut one by one.
ODD = r"[\x01\t\x{0b}\x{0c}\r\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_CUT = re.compile(r"(?<=\S)(?=[ \n]+\S)")
_USUAL = re.compile(r"[ \n]+[^\s▁]+")
_BITS = 24
STAGED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones are themselves, the others follow from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Side:
    """One vocabulary: the bytes of each id, and how a joined text is encoded."""

    def __init__(self, encode, pieces: list[bytes]):
        self.encode, self.pieces = encode, pieces
        self.size = np.fromiter(map(len, pieces), np.int64, len(pieces))

    def split(self, text: str, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of the text and how many lie in each part; None if they do not give the text's bytes or cross a part."""
        ids = np.array(self.encode(text), np.int32)
        ends = np.cumsum(self.size[ids])
        if not len(ids) or b"".join(map(self.pieces.__getitem__, ids.tolist())) != text.encode():
            return None
        at = np.searchsorted(ends, stops)
        return (ids, np.diff(at + 1, prepend=0)) if (ends[at] == stops).all() else None


def byte_side(path: str) -> Side:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
        raise ValueError("only a byte-level vocabulary without normaliser or prefix can be cut at white space")
    del spec
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    byte = byte_of_char()
    vocabulary = tokenizer.get_vocab()
    pieces = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        pieces[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    return Side(lambda text: tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, pieces)


def piece_side(path: str) -> Side:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any(SPACE in p.lstrip(SPACE) or "\n" in p or " " in p for p in names):
        raise ValueError("pieces of this model reach across words or lines")
    pieces = [bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]

    def encode(text: str) -> list[int]:
        """The library adds a space: it stands for the text's first, or is taken away after a letter put before."""
        if text.startswith(" ") and len(text) > 1:
            return model.encode(text[1:], num_threads=1)
        ids, n = model.encode("x" + text, num_threads=1), 0
        while n < 2:
            n += len(pieces[ids[0]])
            ids = ids[1:]
        return ids

    return Side(encode, pieces)


def align(ends: tuple[np.ndarray, np.ndarray], bounds: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Cuts of a batch from the byte offsets where tokens of A and B end.

    ``bounds`` are the documents' byte offsets, 0 first.  Returns the tokens of A and of B that end at each
    cut (their places), the documents' tokens of A, of B and groups, and the cuts.
    """
    total = int(bounds[-1]) + 1
    marks = [np.bincount(e, minlength=total).astype(np.int32) for e in ends]
    both = (marks[0] > 0) & (marks[1] > 0)
    cuts = np.flatnonzero(both)
    sums = [np.cumsum(m) for m in marks]
    places = np.stack([s[cuts] - 1 for s in sums])
    counts = [np.diff(s[bounds]) for s in sums]
    # Offset 0 is no token's end: running sums at the bounds count what ends within each document.
    counts.append(np.diff(np.cumsum(both, dtype=np.int32)[bounds]))
    return places, counts, cuts


def group_strings(ids: tuple[np.ndarray, np.ndarray], places: np.ndarray, stops: np.ndarray) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` of each part; ``stops`` are the parts' last groups, ascending (a part may have none)."""
    n = places.shape[1]
    spans = np.diff(places, axis=1, prepend=-1)  # tokens of A and B in each group
    width = spans.sum(0)
    first = np.cumsum(width) - width
    order = np.zeros(int(width.sum()), np.int64)
    mark = np.zeros(len(order), np.int8)  # what stands after each token: 0 a comma, 1 a bar, 2 a semicolon, 3 nothing
    for side, (flat, before) in enumerate(zip(ids, (np.zeros(n, np.int64), spans[0]), strict=True)):
        group = np.repeat(np.arange(n), spans[side])
        inner = np.arange(len(group)) - np.repeat(np.cumsum(spans[side]) - spans[side], spans[side])
        order[first[group] + before[group] + inner] = flat[: len(group)]
        mark[first + before + spans[side] - 1] = side + 1
    ends = np.r_[0, np.cumsum(width)][stops]
    some = ends[ends > np.r_[0, ends[:-1]]]
    mark[some - 1] = 3
    text = pc.binary_join_element_wise(pa.array(order).cast(pa.string()), pa.array([",", "|", ";", ""]).take(pa.array(mark)), "")
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), text), "")


class PairEncoder:
    """Ids of both vocabularies for the chunks of texts, remembered as arrays."""

    def __init__(self, path_a: str, path_b: str, entries: int = CACHE_ENTRIES):
        self.sides = byte_side(path_a), piece_side(path_b)
        self.entries, self.tick = entries, 0
        # Chunk k has the ids at[k] to at[k + 1] of each side; the empty one is first.
        self.words, self.strings = pa.array([""], pa.string()), pa.array([""], pa.string())
        self.at = [np.zeros(2, np.int64) for _ in self.sides]
        self.ids = [np.zeros(0, np.int32) for _ in self.sides]
        self.used, self.bad = np.zeros(1, np.int32), np.zeros(1, bool)
        trim()

    def chunks(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The chunks of a space and each text, one after another, and how many each text has."""
        spaced = pa.array([" " + t if t else "" for t in texts], pa.large_string())
        odd = pc.match_substring_regex(spaced, ODD).to_numpy(zero_copy_only=False)
        marked = pc.replace_substring_regex(spaced, "[ \n]+", MARK + r"\0")
        cut = pc.split_pattern(marked.filter(pa.array(~odd)) if odd.any() else marked, MARK)
        flat = cut.flatten()
        some = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        stops = np.cumsum(cut.value_lengths().to_numpy())
        sizes = np.diff(np.r_[0, np.cumsum(some)][np.r_[0, stops]])
        flat = flat.filter(pa.array(some))
        if not odd.any():
            return flat, sizes
        apart = [_CUT.split(" " + texts[i]) for i in np.flatnonzero(odd).tolist()]
        every = np.zeros(len(texts), np.int64)
        every[~odd] = sizes
        every[odd] = list(map(len, apart))
        more = pa.array([c for part in apart for c in part], pa.large_string())
        # Both kinds in the texts' order.
        owner = np.repeat(odd, every)
        at = np.where(owner, len(flat) + np.cumsum(owner) - 1, np.cumsum(~owner) - 1)
        return pa.concat_arrays([flat, more]).take(pa.array(at)), every

    def places(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where the chunks of the texts are remembered, and how many each text has."""
        self.tick += 1
        if len(self.words) > self.entries or self.words.nbytes > CACHE_BYTES:
            self.forget()
        flat, sizes = self.chunks(texts)
        coded = flat.dictionary_encode()
        words = coded.dictionary.cast(pa.string())
        found = pc.index_in(self.words, value_set=words).fill_null(-1).to_numpy(zero_copy_only=False)
        known = np.flatnonzero(found >= 0)
        place = np.full(len(words), -1, np.int64)
        place[found[known]] = known
        unknown = np.flatnonzero(place < 0)
        if len(unknown):
            first = len(self.words)
            order = self.learn(words.take(pa.array(unknown)))
            place[unknown[order]] = first + np.arange(len(unknown))
        self.used[place] = self.tick
        return place[coded.indices.to_numpy()], sizes

    def forget(self) -> None:
        """Keep the chunks met most recently, about half of them; the empty one stays first."""
        keep = self.used > np.median(self.used)
        keep[0] = True
        kept = np.flatnonzero(keep)
        for s in (0, 1):
            self.ids[s], counts = self.gather(s, kept)
            self.at[s] = np.r_[0, np.cumsum(counts)]
        self.words, self.strings = (x.take(pa.array(kept)) for x in (self.words, self.strings))
        self.used, self.bad = self.used[kept], self.bad[kept]

    def gather(self, side: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = self.at[side][place]
        counts = self.at[side][place + 1] - start
        stops = np.cumsum(counts)
        shift = np.repeat(start - stops + counts, counts)
        return self.ids[side][shift + np.arange(len(shift))], counts

    def learn(self, words: pa.Array) -> np.ndarray:
        """Remember unknown chunks, usual ones first; returns which of them comes when."""
        listed = words.to_pylist()
        usual = np.fromiter((len(w) < 200 and _USUAL.fullmatch(w) is not None for w in listed), bool, len(listed))
        order = np.r_[np.flatnonzero(usual), np.flatnonzero(~usual)]
        n, listed = int(usual.sum()), [listed[i] for i in order.tolist()]
        sizes = np.fromiter((len(w.encode()) for w in listed), np.int64, len(listed))
        bad = np.zeros(len(listed), bool)
        runs = [(i, min(i + GROUP, n)) for i in range(0, n, GROUP)] + [(i, i + 1) for i in range(n, len(listed))]
        ids, counts = ([], []), ([], [])
        for first, last in runs:
            text, stops = "".join(listed[first:last]), np.cumsum(sizes[first:last])
            parts = [(text, stops)]
            split = [None] if SPACE in text else [s.split(text, stops) for s in self.sides]
            if not all(split) and last - first > 1:  # something among them is changed: each alone
                parts = [(w, sizes[first + k : first + k + 1]) for k, w in enumerate(listed[first:last])]
            for k, (part, stop) in enumerate(parts):
                split = split if len(parts) == 1 else [s.split(part, stop) for s in self.sides]
                if not all(split):
                    bad[first + k] = True
                    split = [(np.zeros(0, np.int32), np.zeros(1, np.int64))] * 2
                for s in (0, 1):
                    ids[s].append(split[s][0])
                    counts[s].append(split[s][1])
        flat, each = [np.concatenate(x) for x in ids], [np.concatenate(x) for x in counts]
        bounds = np.r_[0, np.cumsum(np.where(bad, 0, sizes))]
        places, per_chunk, _ = align(tuple(np.cumsum(self.sides[s].size[flat[s]]) for s in (0, 1)), bounds)
        self.strings = pa.concat_arrays([self.strings, group_strings(tuple(flat), places, np.cumsum(per_chunk[2]))])
        self.words = pa.concat_arrays([self.words, words.take(pa.array(order))])
        for s in (0, 1):
            self.at[s] = np.concatenate([self.at[s], self.at[s][-1] + np.cumsum(each[s])])
            self.ids[s] = np.concatenate([self.ids[s], flat[s]])
        self.used = np.concatenate([self.used, np.full(len(listed), self.tick, np.int32)])
        self.bad = np.concatenate([self.bad, bad])
        return order

    def digest(self, texts: list[str]) -> tuple[list[np.ndarray], list[str], np.ndarray, np.ndarray]:
        """Of each text: tokens of A, of B and groups, hash of its groups; and all links as pairs with their texts."""
        place, sizes = self.places(texts)
        owner = np.repeat(np.arange(len(texts)), sizes)
        good = np.ones(len(texts), bool)
        good[owner[self.bad[place]]] = False
        if not good.all():
            place, sizes = place[good[owner]], np.where(good, sizes, 0)
        n_bytes = np.fromiter((len(t.encode()) + 1 if t and g else 0 for t, g in zip(texts, good.tolist(), strict=True)), np.int64, len(texts))
        bounds = np.r_[0, np.cumsum(n_bytes)]
        ids = [self.gather(s, place)[0] for s in (0, 1)]
        places, counts, cuts = align(tuple(np.cumsum(self.sides[s].size[ids[s]]) for s in (0, 1)), bounds)
        parts = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), self.strings.take(pa.array(place)))
        joined = pc.binary_join(parts, ";")
        hashes = [hashlib.sha256(x.as_buffer()).hexdigest() if n else "" for x, n in zip(joined, n_bytes.tolist(), strict=True)]
        pairs = ids[0][places[0]].astype(np.int64) << _BITS | ids[1][places[1]]
        return counts, hashes, pairs, np.searchsorted(bounds, cuts) - 1


def pair_encoder(path_a: str, path_b: str) -> PairEncoder:
    return worker_cache(f"pair chunks {path_a} {path_b}", lambda: PairEncoder(path_a, path_b))


def counted(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and how often each occurs (or the sum of its weights)."""
    order = None if weights is None else np.argsort(values, kind="stable")
    ranked = np.sort(values) if order is None else values[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]][: len(ranked)])
    n = np.diff(np.r_[first, len(ranked)]) if order is None else np.add.reduceat(weights[order], first) if len(first) else np.zeros(0, np.int64)
    return ranked[first], n


def aligned(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Each document's own columns, and its distinct pairs with how often it links each."""
    prepare(documents.sparkSession, ROWS)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pair_encoder(path_a, path_b)
        for b in batches(parts):
            (n_a, n_b, n_groups), hashes, pairs, owner = encoder.digest(texts_of(b.column("text")))
            # A document's pairs together, by one sort of (document, pair).
            ids, of_pair = np.unique(pairs, return_inverse=True)
            key, times = counted(owner << 32 | of_pair)
            bounds = np.searchsorted(key >> 32, np.arange(b.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x)) for x in (ids[key & 0xFFFFFFFF], times.astype(np.int32))]
            columns = [b.column("doc_id").cast(pa.int64()), *(pa.array(x.astype(np.int64)) for x in (n_a, n_b, n_groups, n_groups)), pa.array(hashes, pa.string()), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in STAGED.split(", ")])

    return map_arrow(doc_columns(documents, "doc_id", "text"), run, STAGED, "pair chunks")


def pair_table(rows: DataFrame) -> DataFrame:
    """pair, n (links of it in the corpus) and best (whether no pair of its B id has more)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches(parts):
            keys, times = b.column("pairs").flatten().to_numpy(), b.column("times").flatten().to_numpy()
            held, n = counted(np.concatenate([held, keys]), np.concatenate([n, times]))
            if len(held) > HELD_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n)], names=["pair", "n"])
                held, n = held[:0], n[:0]
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n)], names=["pair", "n"])

    counts = map_arrow(rows.select("pairs", "times"), run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << _BITS) - 1)))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def with_pair_counts(rows: DataFrame, pairs: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """The documents with n_best and count_sum: sums over their links of what the table tells of each pair."""
    spark = rows.sparkSession
    if count_rows(pairs, broadcast_pairs) > broadcast_pairs:
        rows = rows.withColumn("__row", F.monotonically_increasing_id())
        links = rows.select("__row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("__row", "x.pairs", "x.times")
        told = links.join(pairs, links["pairs"] == pairs["pair"]).groupBy("__row")
        told = told.agg(F.sum(F.when(F.col("best"), F.col("times").cast("long")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
        return rows.join(told, "__row", "left").drop("__row", "pairs", "times").fillna(0, ["n_best", "count_sum"])
    table = pairs.orderBy("pair").toArrow()  # no more rows than the bound that was checked
    shared = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for b in batches(parts):
            lists = b.column("pairs")
            at = np.searchsorted(known, lists.flatten().to_numpy())
            times = b.column("times").flatten().to_numpy().astype(np.int64)
            bounds = np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]
            sums = [np.diff(np.r_[0, np.cumsum(x)][bounds]) for x in (best[at] * times, n[at] * times)]
            own = [b.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            yield pa.RecordBatch.from_arrays([*own, *map(pa.array, sums)], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"])

    return map_arrow(rows, run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")


def align_documents(documents: DataFrame, path_a: str, path_b: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    spark = prepare(documents.sparkSession, ROWS)
    rows = stage(spark, aligned(documents, path_a, path_b), "aligned")
    with arrow_rows(spark, ROWS):
        pairs = stage(spark, pair_table(rows), "pairs")
    told = with_pair_counts(rows, pairs, broadcast_pairs)
    return told.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
