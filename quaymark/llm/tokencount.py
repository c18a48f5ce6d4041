"""Operator 1 — token counts by rank-synchronous array merging.

A sentencepiece BPE model merges, again and again, the adjacent pair whose joined piece has the
best score, leftmost first.  Texts fall into pre-tokens across which no piece reaches; the distinct
pre-tokens of a batch are held together as one ragged numpy array, and in each round every
pre-token applies its own lowest-rank pair at once.  A pre-token of thousands of symbols would need a
round for every rank it applies, so it is merged alone: its pairs lie in buckets by rank, and a round
takes the lowest bucket and applies that rank at all its places at once.  What survives is counted;
symbols outside the vocabulary count their UTF-8 bytes (byte fallback).

Defined cases: null text counts as empty; the empty text has 0 tokens; null ids are kept; repeated
rows give repeated results; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._shared import batches, doc_columns, map_arrow, prepare, texts_of, worker_cache

SPACE = "▁"
#: Distinct pre-tokens in each of the two generations that a Python worker remembers.
CACHE_ENTRIES = 400_000
NONE = np.iinfo(np.int64).max
#: Pre-tokens of more symbols are merged alone.
LONG = 256


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and raw values of a protobuf message."""

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[i]
            i, value, shift = i + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value, i

    i = 0
    while i < len(data):
        tag, i = varint(i)
        kind = tag & 7
        if kind == 0:
            value, i = varint(i)
        elif kind == 2:
            n, i = varint(i)
            value, i = data[i : i + n], i + n
        else:
            n = {1: 8, 5: 4}[kind]
            value, i = data[i : i + n], i + n
        yield tag >> 3, value


class PieceModel:
    """The vocabulary of a sentencepiece BPE file as arrays, and the ragged merge over them."""

    def __init__(self, path: str):
        pieces: list[tuple[str, float, int]] = []
        with open(path, "rb") as f:
            for field, value in _fields(f.read()):
                if field == 1:
                    p = dict(_fields(value))
                    pieces.append((p[1].decode(), float(np.frombuffer(p.get(2, b"\0" * 4), "<f4")[0]), p.get(3, 1)))
                elif field == 3:
                    spec = dict(_fields(value))
                    if spec.get(1, b"identity") != b"identity" or spec.get(2) or spec.get(3, 1) != 1 or spec.get(4, 1) != 0:
                        raise ValueError("only models with identity normalisation, a dummy prefix and kept white space are supported")
        if any(kind in (4, 5) for _, _, kind in pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        normal = {p: s for p, s, kind in pieces if kind == 1}
        self.ids = {p: i for i, p in enumerate(normal)}
        known = len(self.ids)
        for p in normal:
            for c in p:
                self.ids.setdefault(c, len(self.ids))
        self.known, self.width = known, len(self.ids)
        order = {s: r for r, s in enumerate(sorted(set(normal.values()), reverse=True))}
        rank = {p: order[s] for p, s in normal.items()}
        joins, unsafe = {}, set()
        for p in normal:
            for k in range(1, len(p)):
                left, right = p[:k], p[k:]
                if left in self.ids and right in self.ids:
                    joins[self.ids[left] * self.width + self.ids[right]] = p
                # A part ranked no better than the whole: after its merge the whole may come first.
                unsafe.update(rank[x] for x in (left, right) if len(x) > 1 and rank.get(x, -1) >= rank[p])
        self.keys = np.array(sorted(joins), np.int64)
        self.merged = np.array([self.ids[joins[k]] for k in self.keys.tolist()], np.int64)
        self.ranks = np.array([rank[joins[k]] for k in self.keys.tolist()], np.int64)
        self.unsafe = np.zeros(len(order) + 1, bool)
        self.unsafe[list(unsafe)] = True
        inner = [p for p in normal if SPACE in p.lstrip(SPACE) or (p.startswith(SPACE * 2) and p.strip(SPACE))]
        runs = sorted(len(p) for p in normal if p and not p.strip(SPACE))
        last = max(rank.values(), default=0)
        if inner or any(rank[SPACE * n] != last for n in runs) or "\n" in self.ids:
            raise ValueError("pieces of this model reach across words or lines, or its white-space pieces are not ranked last")
        self.cache: dict[str, int] = {"": 0}
        self.lone: set[str] = set()
        self.older: dict[str, int] = {}
        # Pieces for a run of space marks: merged once for short runs, periodic in the longest piece beyond.
        self.period = max(runs, default=1)
        self.run_counts = [0, *self.merge([SPACE * n for n in range(1, 4 * self.period + 1)])[0].tolist()]
        if any(self.run_counts[n + self.period] != self.run_counts[n] + 1 for n in range(2 * self.period, 3 * self.period + 1)):
            raise ValueError("runs of white space of this model are not periodic")

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token count of each word, and whether its first symbol stayed a lone space mark."""
        counts, lone = np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        short = [i for i, w in enumerate(words) if len(w) <= LONG]
        if short:
            counts[short], lone[short] = self.merge_short([words[i] for i in short])
        if len(short) < len(words):
            for i in (i for i, w in enumerate(words) if len(w) > LONG):
                counts[i], lone[i] = self.merge_long(words[i])
        return counts, lone

    def symbols(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Id of each character, -1 for unknown ones, and the tokens that it is by itself."""
        chars = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        distinct, where = np.unique(chars, return_inverse=True)
        table = np.array([self.ids.get(chr(c), -1) for c in distinct.tolist()], np.int64)
        cost = np.array([1 if 0 <= i < self.known else len(chr(c).encode("utf-8", "replace")) for i, c in zip(table.tolist(), distinct.tolist(), strict=True)], np.int64)
        return table[where], cost[where]

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair of symbols (NONE if they do not join), and its place in the table of joins."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE), at

    def merge_long(self, word: str) -> tuple[int, bool]:
        """Count and lone mark of one word: the same merges, found by rank instead of by scanning."""
        symbols, cost = self.symbols(word)
        n, count = len(symbols), int(cost.sum())
        lone = bool(symbols[0] == self.ids.get(SPACE, -2))
        after, before, alive = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
        buckets: dict[int, list[np.ndarray]] = defaultdict(list)
        heap: list[int] = []

        def put(places: np.ndarray) -> None:
            places = places[after[places] < n]
            rank, _ = self.pairs(symbols[places], symbols[after[places]])
            order = np.argsort(rank, kind="stable")
            order = order[rank[order] != NONE]
            rank, places = rank[order], places[order]
            starts = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]])[: len(rank)]
            for r, group in zip(rank[starts].tolist(), np.split(places, starts[1:]), strict=len(rank) > 0):
                if r not in buckets:
                    heapq.heappush(heap, r)
                buckets[r].append(group)

        if len(self.keys):
            put(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            places = np.unique(np.concatenate(buckets.pop(r)))
            places = places[alive[places] & (after[places] < n)]
            rank, at = self.pairs(symbols[places], symbols[after[places]])
            places, at = places[rank == r], at[rank == r]
            if not len(places):
                continue
            if self.unsafe[r]:  # a better pair may come of the first merge
                put(places[1:])
                places, at = places[:1], at[:1]
            run = np.r_[True, after[places[:-1]] != places[1:]]  # of pairs that overlap, every other one
            keep = (np.arange(len(places)) - np.maximum.accumulate(np.where(run, np.arange(len(places)), 0))) % 2 == 0
            places, at = places[keep], at[keep]
            right = after[places]
            symbols[places] = self.merged[at]
            alive[right] = False
            after[places] = after[right]
            inner = after[places] < n
            before[after[places[inner]]] = places[inner]
            count -= len(places)
            lone = lone and places[0] != 0
            left = before[places]
            put(np.unique(np.r_[places, left[left >= 0]]))
        return count, lone

    def merge_short(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols, cost = self.symbols("".join(words))
        owner = np.repeat(np.arange(len(words)), lengths)
        counts = np.bincount(owner, cost, minlength=len(words)).astype(np.int64)
        lone_id = self.ids.get(SPACE, -2)
        lone = np.zeros(len(words), bool)
        if len(symbols):
            lone[owner[np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]] & (symbols == lone_id))]] = True
        while len(symbols) > 1 and len(self.keys):
            left, right = symbols[:-1], symbols[1:]
            rank, at = self.pairs(left, right)
            rank = np.append(np.where(owner[:-1] == owner[1:], rank, NONE), NONE)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(owner)))
            best_here = np.repeat(best, sizes)
            pick = np.flatnonzero((rank == best_here) & (rank != NONE))
            if not len(pick):
                break
            new_owner = np.r_[True, owner[pick[1:]] != owner[pick[:-1]]]
            new_run = np.r_[True, pick[1:] != pick[:-1] + 1] | new_owner
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(pick)), 0))
            keep = ((np.arange(len(pick)) - run_start) % 2 == 0) & (new_owner | ~self.unsafe[rank[pick]])
            pick = pick[keep]
            symbols = symbols.copy()
            symbols[pick] = self.merged[at[pick]]
            counts -= np.bincount(owner[pick], minlength=len(words))
            first = np.isin(pick, starts, assume_unique=True)
            lone[owner[pick[first]]] = False
            alive = best_here != NONE
            alive[pick + 1] = False
            symbols, owner = symbols[alive], owner[alive]
        return counts, lone

    def learn(self, words: set[str]) -> None:
        missing = words - self.cache.keys()
        if len(self.cache) + len(missing) > CACHE_ENTRIES:
            self.older, self.cache = self.cache, {"": 0}
            missing = words - self.cache.keys()
        kept = missing & self.older.keys()
        self.cache.update((w, self.older[w]) for w in kept)
        missing = list(missing - kept)
        if missing:
            if len(self.lone) > CACHE_ENTRIES:
                self.lone &= self.cache.keys() | self.older.keys()
            counts, lone = self.merge(missing)
            self.cache.update(zip(missing, counts.tolist(), strict=True))
            self.lone.update(w for w, x in zip(missing, lone.tolist(), strict=True) if x)

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each whole text."""
        cut = [(f" {SPACE}" + t.replace(" ", SPACE).replace(SPACE, f" {SPACE}").replace("\n", " ")).split(" ") if t else [] for t in texts]
        self.learn(set().union(*cut))
        out = []
        get = self.cache.__getitem__
        for text, words in zip(texts, cut, strict=True):
            n = sum(map(get, words)) + text.count("\n")
            if SPACE in words:
                n += self._runs(words)
            out.append(n)
        return out

    def _runs(self, words: list[str]) -> int:
        """What runs of space marks change against counting each mark alone."""
        change = marks = 0
        for w in [*words, ""]:
            if w == SPACE:
                marks += 1
                continue
            if marks:
                joins = marks + (w in self.lone and w.startswith(SPACE))
                far = max(0, joins // self.period - 3)
                change += self.run_counts[joins - far * self.period] + far - joins
            marks = 0
        return change


def piece_model(path: str) -> PieceModel:
    return worker_cache(f"pieces {path}", lambda: PieceModel(path))


def count_tokens(documents: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit of every document."""
    prepare(documents.sparkSession)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for b in batches(rows):
            texts = texts_of(b.column("text"))
            n = pa.array(model.count(texts), pa.int64())
            size = pa.array([len(t.encode()) for t in texts], pa.int64())
            over = pa.array([x > limit for x in n.to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), size, n, over], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_arrow(doc_columns(documents, "doc_id", "text"), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", "pieces")
