"""Operator 9 — order-preserving packing by dynamic programming.

The documents of a range of doc_id, in order, form one stream of ids.  Cuts may fall at the ends of
documents and sentences, and at word ends where a sentence is long; the cost of a packing is its
padding plus a penalty for each cut inside a document, smaller at a sentence's end.  With cut positions
x0 < x1 < ... the best cost to reach xj is the least of
cost(xi) + pad * (capacity - (xj - xi)) + penalty(xj) over the window xj - xi <= capacity.  Padding is
linear in xi, so a queue that is kept monotone in cost(xi) + pad * xi gives every minimum in constant
time.  Sequences whose length is a power of two are not padded; those few predecessors are found for
all positions at once and looked at one by one.

A range is planned in blocks of a bounded number of ids: every sequence of a block but the last is
final, and the last one's ids open the next block.  Sequences are numbered by range and within it.

Defined cases: null text counts as empty (its end id only); rows of equal doc_id are ordered by
a hash of the text and the text, null doc_id first; repeated rows are packed each; ranges end with one padded sequence each;
extra columns are ignored; an empty table gives no rows; texts and single words longer than a
sequence are cut wherever the capacity falls.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._shared import batches, in_order, map_arrow, prepare, texts_of
from .wordids import CACHE_ENTRIES, chunk_encoder, with_ends

#: Ids planned together, and costs in units of one padded id.
BLOCK_IDS = 1 << 18
SENTENCE_CUT, WORD_CUT = 2.0, 40.0
RANGE_BITS = 40
ENDS = (".", "!", "?")
#: All ends of documents and sentences are candidates; where there is none in STRETCH ids, so is one word end in SPACING ids.
SPACING, STRETCH = 16, 64
#: Texts of an Arrow batch.
ROWS = 2048
NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def plan(positions: np.ndarray, penalties: np.ndarray, capacity: int) -> tuple[list[int], float]:
    """Indexes of the cuts of the best packing; positions start at 0, rise, and rise by at most capacity.

    The last position is always a cut.  Returns the chosen indexes after 0 and the total cost.
    """
    n = len(positions)
    at, before = [], []  # position at[k] lies a power of two after position before[k]
    for p in (1 << k for k in range(capacity.bit_length()) if 1 << k <= capacity):
        found = np.minimum(np.searchsorted(positions, positions - p), n - 1)
        hit = np.flatnonzero(positions[found] == positions - p)
        at.append(hit)
        before.append(found[hit])
    order = np.argsort(np.concatenate(at), kind="stable")
    first = np.searchsorted(np.concatenate(at)[order], np.arange(n + 1)).tolist()
    whole = np.concatenate(before)[order].tolist()
    x, cost_of_cut = positions.tolist(), penalties.tolist()
    best, back = [0.0] * n, [0] * n
    queue, values, head = [0], [0.0], 0  # places still worth while, and their best + x, which rises
    for j in range(1, n):
        least = x[j] - capacity
        while x[queue[head]] < least:
            head += 1
        i, low = queue[head], values[head] - least
        if first[j] < first[j + 1]:
            for k in whole[first[j] : first[j + 1]]:
                if best[k] < low:
                    i, low = k, best[k]
        best[j], back[j] = low, i = low + cost_of_cut[j], i
        low += x[j]
        while len(values) > head and values[-1] >= low:
            values.pop()
            queue.pop()
        values.append(low)
        queue.append(j)
    cuts, j = [], n - 1
    while j > 0:
        cuts.append(j)
        j = back[j]
    return cuts[::-1], best[-1]


def cut_kinds(vocabulary: dict[str, int]) -> np.ndarray:
    """What ends after each id: 2 a sentence, 1 a word, 0 neither."""
    kind = np.zeros(max(vocabulary.values(), default=0) + 1, np.uint8)
    for token, i in vocabulary.items():
        if token.endswith("</w>"):
            kind[i] = 2 if token.removesuffix("</w>").endswith(ENDS) else 1
    return kind


def spaced(positions: np.ndarray) -> np.ndarray:
    """The first of the positions in every SPACING ids."""
    return positions[np.diff(positions // SPACING, prepend=-1) > 0]


def candidates(kinds: np.ndarray, stops: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions in a stream of ids, 0 first, and their penalties; the documents' ends are free.

    ``kinds`` says what ends after each id; no document is cut right before its end id.
    """
    end = np.zeros(len(kinds) + 2, bool)
    end[stops] = True
    inner = np.flatnonzero(kinds) + 1
    inner = inner[~(end[inner] | end[inner + 1])]
    sentence = kinds[inner - 1] == 2
    chosen = end[:-1].copy()
    chosen[inner[sentence]] = True
    at = np.flatnonzero(chosen)
    gaps = np.diff(at, prepend=0)
    if (gaps > STRETCH).any():
        words = inner[~sentence]
        chosen[spaced(words[gaps[np.searchsorted(at, words)] > STRETCH])] = True
        at = np.flatnonzero(chosen)
    at = np.r_[0, at]
    wide = np.flatnonzero(np.diff(at) > capacity)
    if len(wide):  # a stretch without a boundary: cuts where the capacity falls
        hard = np.concatenate([np.arange(at[i] + capacity, at[i + 1], capacity) for i in wide.tolist()])
        chosen[np.r_[0, hard]] = True
        at = np.flatnonzero(chosen)
    kind = np.r_[np.uint8(0), kinds][at]
    cost = np.where(kind == 2, SENTENCE_CUT, np.where(kind == 1, WORD_CUT, 2 * WORD_CUT))
    cost[end[at]] = 0.0
    return at, cost


class Stream:
    """The pending ids of a range: documents' pieces not yet assigned to a final sequence."""

    def __init__(self, capacity: int, kinds: np.ndarray):
        self.capacity, self.kinds = capacity, kinds
        self.ids: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []  # rows of doc_id, whether it is null, ids of the document, and its stop
        self.size = self.sequence = 0
        self.done = 0  # ids of the first pending document that are in final sequences

    def add(self, doc_ids: pa.Array, ids: np.ndarray, stops: np.ndarray) -> None:
        known = doc_ids.cast(pa.int64()).fill_null(0).to_numpy()
        self.docs.append(np.stack([known, doc_ids.is_null().to_numpy(zero_copy_only=False), np.diff(stops, prepend=0), self.size + stops]))
        self.ids.append(ids)
        self.size += len(ids)

    def flush(self, final: bool, base: int) -> pa.RecordBatch | None:
        if not self.size:
            return None
        ids, docs = np.concatenate(self.ids), np.concatenate(self.docs, 1)
        stops = docs[3]
        at, cost = candidates(self.kinds[ids], stops, self.capacity)
        cuts, _ = plan(at, cost, self.capacity)
        ends = at[cuts if final else cuts[:-1]]
        if not len(ends):
            self.ids, self.docs = [ids], [docs]
            return None
        last = ends[-1]
        edges = np.unique(np.r_[stops[stops < last], ends])
        begin = np.r_[0, edges[:-1]]
        doc, sequence = np.searchsorted(stops, begin, "right"), np.searchsorted(ends, begin, "right")
        start = begin - np.r_[0, stops][doc] + np.where(doc == 0, self.done, 0)
        view = memoryview(ids).cast("B")
        crc = [zlib.crc32(view[4 * i : 4 * j]) for i, j in zip(begin.tolist(), edges.tolist(), strict=True)]
        columns = [pa.array(docs[0][doc], mask=docs[1][doc] > 0), *map(pa.array, (start, edges - begin, np.array(crc, np.int64), docs[2][doc], base + self.sequence + sequence, begin - np.r_[0, ends][sequence]))]
        rest = int(np.searchsorted(stops, last, "right"))
        self.done = int(last - np.r_[0, stops][rest] + (self.done if rest == 0 else 0)) if rest < len(stops) else 0
        docs = docs[:, rest:].copy()
        docs[3] -= last
        self.ids, self.docs, self.size = [ids[last:].copy()], [docs], self.size - int(last)
        self.sequence += len(ends)
        return pa.RecordBatch.from_arrays(columns, names=NAMES)


def pack(documents: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 4096, remembered: int = CACHE_ENTRIES, rows: int = ROWS) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset.

    ``remembered`` bounds the words that a Python worker keeps and ``rows`` the texts that it takes at a time.
    They change memory and speed, and no document's ids.
    """
    prepare(documents.sparkSession, rows)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, base = chunk_encoder(tokenizer_path, remembered), 0
        stream = Stream(capacity, cut_kinds(encoder.vocabulary()))
        for b in batches(parts):
            base = b.column("part")[0].as_py() << RANGE_BITS
            stream.add(b.column("doc_id"), *with_ends(*encoder.encode(texts_of(b.column("text"))), end_id))
            if stream.size >= BLOCK_IDS and (pieces := stream.flush(False, base)):
                yield pieces
        if pieces := stream.flush(True, base):
            yield pieces

    return map_arrow(in_order(documents), run, ", ".join(f"{n} long" for n in NAMES), "chunks")
