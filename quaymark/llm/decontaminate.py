"""Operator 8 — benchmark decontamination by template canonicalisation.

Words lose the punctuation around them; then numbers, names (a capital letter within a sentence) and
units (after a number) become typed placeholders, and other words are put in lower case.  Items with
the same template form a class, and equal items of a class one entry.  Windows of template tokens are
hashed on both sides and joined.  Hits are laid over the template at each of their offsets, as a
document may hold several instances of it; every slot's value in the entry must go with one value in
the document and the other way round.  A document is contaminated by an entry if its aligned windows
cover enough of the template and its slots are consistent: copies keep their values,
re-parameterised questions change them.

A document and a class give a row for each entry that the document copies, and where it copies none,
one row for the consistent entry with the fewest changed slots: rows grow with the instances in the
documents, not with the entries that share a template.  ``entries`` tells how many those are.

The benchmark is a stated query set: it goes over all documents in blocks of bounded size.  A block is
a hash table of windows that is broadcast, so documents are joined where they lie and only hits go on.
All texts are read whole.

Defined cases: null texts and items match nothing; items shorter than a window are one window; items
of placeholders alone match nothing; null ids are kept; equal items count under their least id (null
after all others); repeated documents give repeated rows; of offsets with equally many hits the first
met is judged first; extra columns are ignored; an empty benchmark or table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import Lexicon, batches, doc_columns, map_arrow, mix64, prepare, split_words, texts_of, worker_cache

WIDTH = 8
#: Template windows of a block of benchmark items: what a broadcast may hold.
BLOCK_WINDOWS = 1 << 20
#: Words that a worker remembers; the ones met longest ago are forgotten first.
CACHE_ENTRIES = 400_000
#: Code points looked at together.
PIECE = 1 << 20
NUMBER, NAME, UNIT = 1, 2, 3
LOW_BITS = 20
LOW = np.uint64((1 << LOW_BITS) - 1)
SCHEMA = "doc_id long, item_id long, windows long, item_windows long, coverage double, slots long, changed_slots long, kind string, entries long"

#: Units, in lower case.
UNITS = frozenset("mm cm m km in ft yd mi mg g kg t lb lbs oz ml l s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years % percent usd eur gbp dollar dollars euro euros cent cents mph kmh kb mb gb tb hz khz mhz ghz w kw v a j kj cal kcal".split())
_NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/]*([a-zA-Z]+)?%?")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def describe(word: str) -> tuple[int, int, int, str]:
    """Code of a word (placeholder or hash), its code within a sentence, flags (1: unit, 2: ends a sentence), and its value."""
    core = word if word.isalnum() else word.strip(punctuation)
    if not core.isalnum():
        core = _EDGES.sub("", core)
    flags = 2 * (core is not word and word.rstrip("\"')]}»”’").endswith((".", "!", "?", ":")))
    if not core:
        return 0, 0, flags, ""
    lower = core.lower()
    if not core.isalpha() and (number := _NUMBER.fullmatch(core)) and (not number[1] or number[1].lower() in UNITS):
        return NUMBER, NUMBER, flags, lower
    code = xxhash.xxh64_intdigest(lower) | 8
    name = len(core) > 1 and core[0].isupper() and core[1:] == lower[1:]
    return code, NAME if name else code, flags | (lower in UNITS), lower


#: Words of Latin letters with ASCII signs around them: what most words are, described as whole arrays.
_PLAIN = r"^(?P<head>[!-/:-@\[-`{-~]*)(?P<core>[a-zA-ZÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-/:-@\[-`{-~]*)$"
_NAMED = "^[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+$"
_CLOSED = r"[.!?:][\"')\]}]*$"


def describe_all(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes at the start of a sentence and within it, and flags, of distinct words."""

    def flags_of(mask) -> np.ndarray:
        return mask.to_numpy(zero_copy_only=False)

    first, inner, flags = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint8)
    parts = pc.extract_regex(words, _PLAIN)
    plain = flags_of(parts.is_valid())
    if plain.any():
        parts = parts.filter(pa.array(plain))
        core, tail = parts.field("core"), parts.field("tail")
        lower = pc.utf8_lower(core)
        codes = np.fromiter(map(xxhash.xxh64_intdigest, lower.to_pylist()), np.uint64, len(core)) | np.uint64(8)
        first[plain] = codes
        inner[plain] = np.where(flags_of(pc.match_substring_regex(core, _NAMED)), np.uint64(NAME), codes)
        flags[plain] = flags_of(pc.is_in(lower, value_set=pa.array(sorted(UNITS)))) + 2 * flags_of(pc.match_substring_regex(tail, _CLOSED)).astype(np.uint8)
    for i in np.flatnonzero(~plain).tolist():
        first[i], inner[i], flags[i], _ = describe(words[i].as_py())
    return first, inner, flags


def _words() -> Lexicon:
    return worker_cache("template words", lambda: Lexicon(describe_all, CACHE_ENTRIES))


def templates(texts: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Template tokens of all texts in one array, the number of each text, all words, and where each text's words stop."""
    flat, stop = split_words(texts)
    coded = flat.dictionary_encode()
    known = _words()
    at = known.places(coded.dictionary.cast(pa.string()))[coded.indices.to_numpy()]
    first, inner, flags = (c[at] for c in known.columns)
    kept = first != 0
    before = np.r_[0, np.cumsum(kept)]
    lengths = np.diff(before[np.r_[0, stop]])
    stops = np.r_[0, np.cumsum(flags >> 1)]
    place = np.flatnonzero(kept)
    # A word opens a sentence if a sentence ended since the word before it, or if it is its text's first.
    opens = np.r_[True, stops[place[1:]] > stops[place[:-1]]] if len(place) else np.zeros(0, bool)
    heads = np.cumsum(lengths) - lengths
    opens[heads[lengths > 0]] = True
    codes = np.where(opens, first[place], inner[place])
    follows = np.r_[False, codes[:-1] == NUMBER] if len(codes) else np.zeros(0, bool)
    follows[heads[lengths > 0]] = False
    codes[follows & (flags[place] & 1 == 1)] = UNIT
    return codes, lengths, flat, stop


def values_of(words: list[str]) -> list[str]:
    """Values of a text's template tokens."""
    return [x for w in words if (x := describe(w)[3])]


def window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every window of ``width`` template tokens; windows of placeholders alone hash to 0."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    mixed = mix64(codes)
    out, literal = np.zeros(n, np.uint64), np.zeros(n, bool)
    for k in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + mixed[k : k + n]
        literal |= codes[k : k + n] > 7
    return np.where(literal, mix64(out + np.uint64(width)) | np.uint64(1), np.uint64(0))


class Template:
    """A class of items: their common template, and the values of the different ones."""

    def __init__(self, codes: list[int], entries: list[tuple[int | None, list[str]]]):
        self.codes = codes
        self.entries = entries
        self.width = min(WIDTH, len(codes))
        self.places = [i for i, c in enumerate(codes) if c <= 7]
        self.values = np.array([[xxhash.xxh64_intdigest(v[i]) for i in self.places] for _, v in entries], np.uint64).reshape(len(entries), -1)
        patterns: dict[tuple, int] = {}
        for k, (_, v) in enumerate(entries):
            slots = [(codes[i], v[i]) for i in self.places]
            patterns.setdefault(tuple(map(slots.index, slots)), k)
        #: One entry for each way in which slots repeat each other's values.
        self.patterns = list(patterns.values())

    def likely(self, offsets: dict[int, set[int]], values: list[str]) -> dict[int, set[int]]:
        """Entries worth comparing, each with the offsets at which it is: entries that agree in all slots there, one of
        the nearest entries of each other offset, and one of each pattern at all offsets."""
        everywhere = set(offsets)
        if len(self.entries) == 1:
            return {0: everywhere}
        found = dict.fromkeys(self.patterns, everywhere)
        copied: dict[int, set[int]] = defaultdict(set)
        for offset, aligned in offsets.items():
            covered = {k for a in aligned for k in range(a, a + self.width)}
            slots = [k for k, i in enumerate(self.places) if i in covered]
            mine = np.array([xxhash.xxh64_intdigest(values[offset + self.places[k]]) for k in slots], np.uint64)
            agree = (self.values[:, slots] == mine).sum(1)
            if agree.max() < len(slots):
                found[int(agree.argmax())] = everywhere
            else:
                for k in np.flatnonzero(agree == len(slots)).tolist():
                    copied[k].add(offset)
        return found | copied


class Block:
    """Templates of the benchmark and the sorted hashes of their windows."""

    def __init__(self, items: list[tuple[int | None, list[int], list[str]]]):
        classes: dict[tuple, dict[tuple, int | None]] = defaultdict(dict)
        for item_id, codes, values in items:  # by id, so that the least id of equal items is kept
            classes[tuple(codes)].setdefault(tuple(values), item_id)
        self.templates = [Template(list(codes), [(i, list(v)) for v, i in entries.items()]) for codes, entries in classes.items()]
        self.sizes: list[int] = []
        hashes, where = [], []
        self.widths: set[int] = set()
        for k, t in enumerate(self.templates):
            found = window_hashes(np.array(t.codes, np.uint64), t.width) if t.width else np.zeros(0, np.uint64)
            at = np.flatnonzero(found)
            self.sizes.append(len(at))
            if len(at):
                self.widths.add(t.width)
                hashes.append(found[at])
                where.append(np.stack([np.full(len(at), k), at], 1))
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.where = np.concatenate(where) if where else np.zeros((0, 2), np.int64)
        order = np.argsort(self.hashes, kind="stable")
        self.hashes, self.where = self.hashes[order], self.where[order]
        # A table of the hashes' low bits: most windows need no search.
        self.seen = np.zeros(1 << LOW_BITS, bool)
        self.seen[self.hashes & LOW] = True


class Slots:
    """Which values of an item go with which values of a document, at one offset or several."""

    def __init__(self) -> None:
        self.forward: dict[tuple, Counter] = defaultdict(Counter)
        self.backward: dict[tuple, Counter] = defaultdict(Counter)
        self.slots = self.changed = 0
        self.covered: set[int] = set()

    def add(self, item: tuple, offset: int, aligned: set[int], values: list[str]) -> None:
        _, item_codes, item_values = item
        width = min(WIDTH, len(item_codes))
        self.covered |= aligned
        for i in sorted({k for a in aligned for k in range(a, a + width)}):
            if item_codes[i] <= 7:
                self.slots += 1
                mine, other = item_values[i], values[offset + i]
                self.changed += mine != other
                self.forward[item_codes[i], mine][other] += 1
                self.backward[item_codes[i], other][mine] += 1

    def consistent(self) -> bool:
        agreed = min(sum(c.most_common(1)[0][1] for c in side.values()) for side in (self.forward, self.backward))
        return not self.slots or agreed >= 0.8 * self.slots


def compare(item: tuple, size: int, hits: list[tuple[int, int]], values: list[str], coverage: float) -> tuple | None:
    """The row of a document and an item, or None if the hits do not make a contamination.

    Offsets are taken by their hits, the commonest first.  If that one is consistent, all hits count; else
    the others are put together as long as their slots stay consistent, and one such group must cover enough.
    """
    by_offset: dict[int, set[int]] = defaultdict(set)
    for d, i in hits:
        by_offset[d - i].add(i)
    covered = len({i for _, i in hits})
    if covered < coverage * size:
        return None
    groups: list[list[int]] = []
    for place, (offset, _) in enumerate(Counter(d - i for d, i in hits).most_common()):
        alone = Slots()
        alone.add(item, offset, by_offset[offset], values)
        if not alone.consistent():
            continue
        if not place:
            return row_of(item, size, covered, alone)
        for group in groups:
            both = Slots()
            for o in (*group, offset):
                both.add(item, o, by_offset[o], values)
            if both.consistent():
                group.append(offset)
                break
        else:
            both = alone
            groups.append([offset])
        if len(both.covered) >= coverage * size:
            return row_of(item, size, len(both.covered), both)
    return None


def row_of(item: tuple, size: int, covered: int, found: Slots) -> tuple:
    return item[0], covered, size, covered / size, found.slots, found.changed, "reparameterised" if found.changed else "copy"


def compare_all(template: Template, size: int, hits: list[tuple[int, int]], values: list[str], coverage: float) -> list[tuple]:
    """The rows of a document and a class of items."""
    offsets: dict[int, set[int]] = defaultdict(set)
    for d, i in hits:
        offsets[d - i].add(i)
    rows = []
    for k, at in sorted(template.likely(offsets, values).items()):
        item_id, item_values = template.entries[k]
        mine = hits if len(at) == len(offsets) else [(d, i) for d, i in hits if d - i in at]
        if row := compare((item_id, template.codes, item_values), size, mine, values, coverage):
            rows.append((*row, len(template.entries)))
    copies = [r for r in rows if r[-2] == "copy"]
    return copies or sorted(rows, key=lambda r: r[5])[:1]


def find(block: Block, texts: list[str], coverage: float) -> list[tuple]:
    """(index of the text, row) for every contamination of a batch; texts are looked at in groups of bounded size."""
    out, start, size = [], 0, 0
    for k, t in enumerate([*texts, None]):
        if t is None or size and size + len(t) > PIECE:
            out += [(start + i, row) for i, row in _find(block, texts[start:k], coverage)]
            start, size = k, 0
        size += len(t or "")
    return out


def _find(block: Block, texts: list[str], coverage: float) -> list[tuple]:
    if not texts:
        return []
    flat, lengths, words, word_stops = templates(texts)
    stops = np.cumsum(lengths)
    starts = stops - lengths
    hits: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    for width in sorted(block.widths):
        hashes = window_hashes(flat, width)
        near = np.flatnonzero(block.seen[hashes & LOW] & (hashes != 0))
        at = np.searchsorted(block.hashes, hashes[near])
        at[at == len(block.hashes)] = 0
        exact = block.hashes[at] == hashes[near]
        for p, first in zip(near[exact].tolist(), at[exact].tolist(), strict=True):
            doc = int(np.searchsorted(stops, p, side="right"))
            if p + width > stops[doc]:
                continue
            k = first
            while k < len(block.hashes) and block.hashes[k] == hashes[p]:
                item, position = block.where[k].tolist()
                if block.templates[item].width == width:
                    hits[doc, item].append((p - int(starts[doc]), position))
                k += 1
    out, values, read = [], [], None
    for (doc, item), found in sorted(hits.items()):
        if len({i for _, i in found}) < coverage * block.sizes[item]:
            continue
        if doc != read:
            begin = int(word_stops[doc - 1]) if doc else 0
            values, read = values_of(words[begin : int(word_stops[doc])].to_pylist()), doc
        out += [(doc, row) for row in compare_all(block.templates[item], block.sizes[item], found, values, coverage)]
    return out


def blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The benchmark in blocks of bounded size, one at a time on the driver."""
    items, size = [], 0
    for r in doc_columns(benchmark, "item_id", "text").orderBy(F.col("item_id").asc_nulls_last(), "text").toLocalIterator():
        codes, _, words, _ = templates([r["text"] or ""])
        items.append((r["item_id"], codes.tolist(), values_of(words.to_pylist())))
        size += max(1, len(codes))
        if size >= BLOCK_WINDOWS:
            yield Block(items)
            items, size = [], 0
    if items:
        yield Block(items)


def contaminated(documents: DataFrame, benchmark: DataFrame, coverage: float = 0.5) -> DataFrame:
    """Rows for each document and benchmark item that it contains, copied or re-parameterised."""
    spark = prepare(documents.sparkSession)
    rows = doc_columns(documents, "doc_id", "text").where("text is not null")
    out = spark.createDataFrame([], SCHEMA)
    for block in blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def run(parts: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            kinds = [pa.int64()] * 4 + [pa.float64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
            names = ["doc_id", "item_id", "windows", "item_windows", "coverage", "slots", "changed_slots", "kind", "entries"]
            for b in batches(parts):
                found = find(shared.value, texts_of(b.column("text")), coverage)
                if found:
                    ids = b.column("doc_id").to_pylist()
                    columns = zip(*((ids[d], *row) for d, row in found), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

        out = out.unionByName(map_arrow(rows, run, SCHEMA, "template"))
    return out
