"""Word shingles of whole batches as 64-bit hashes, computed on UTF-8 bytes in numpy.

Defined cases: the empty text and white space have no shingles; a text of fewer words than a shingle has
one, its whole sequence; repeated shingles count once; a long text is hashed whole.
"""

from __future__ import annotations

import numpy as np

from ._shared import mix64

#: Characters hashed together; a longer text is alone.
GROUP_CHARS = 1 << 20
_PRIME = 0x100000001B3
_INVERSE = pow(_PRIME, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if n <= GROUP_CHARS:
            _POWERS[base] = known
    return known[:n]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (ASCII letters in lower case, cut at ASCII white space), and the number of words of each text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join([b"", *raw, b""]), np.uint8)
    space = _SPACE[data]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    stops = np.flatnonzero(~space[:-1] & space[1:]) + 1
    total = np.r_[np.uint64(0), np.cumsum(_BYTE[data] * _powers(_PRIME, len(data)), dtype=np.uint64)]
    hashes = mix64((total[stops] - total[starts]) * _powers(_INVERSE, len(data))[starts] + (stops - starts).astype(np.uint64))
    # Text k lies before the separator at the end of the first k + 1 texts.
    ends = np.cumsum([len(r) + 1 for r in raw])
    upto = np.searchsorted(starts, np.r_[0, ends], side="right")
    return hashes, np.diff(upto)


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle, an empty one none."""
    out: list[np.ndarray] = []
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > GROUP_CHARS:
            out += _sets(texts[start:i], words)
            start, total = i, 0
        total += len(t) + 1
    return out + _sets(texts[start:], words) if start < len(texts) else out


def _sets(texts: list[str], words: int) -> list[np.ndarray]:
    hashes, sizes = word_hashes(texts)
    n = max(0, len(hashes) - words + 1)
    joined = np.zeros(n, np.uint64)
    for k in range(words):
        joined = joined * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    joined = mix64(joined)
    out, at = [], 0
    for size in sizes.tolist():
        if size >= words:
            found = np.sort(joined[at : at + size - words + 1])
            if len(found) > 1:
                found = found[np.r_[True, found[1:] != found[:-1]]]
        elif size:
            whole = np.uint64(size)
            with np.errstate(over="ignore"):
                for h in hashes[at : at + size]:
                    whole = whole * np.uint64(0xD6E8FEB86659FD93) + h
            found = mix64(np.array([whole], np.uint64))
        else:
            found = np.zeros(0, np.uint64)
        out.append(found)
        at += size
    return out


def _mark(sums: np.uint64, folded: np.uint64, size: int) -> int:
    mixed = mix64(np.array([sums], np.uint64)) ^ folded
    return int(mix64(mixed * np.uint64(0x9E3779B97F4A7C15) + np.uint64(size)).view(np.int64)[0])


def first_fingerprint(found: np.ndarray) -> int:
    """A 64-bit fingerprint of a set, its size included, as a signed integer."""
    if not len(found):
        return 0
    return _mark(mix64(found + np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix64(found ^ np.uint64(0xE7037ED1A0B428DB))), len(found))


def second_fingerprint(found: np.ndarray) -> int:
    """Another one, of other sums."""
    if not len(found):
        return 0
    mixed = mix64(found * np.uint64(0x8EBC6AF09C88C6E3) + np.uint64(0x589965CC75374CC3))
    return _mark(mixed.sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed * np.uint64(0xD6E8FEB86659FD93)), len(found))


def fingerprints(found: np.ndarray) -> tuple[int, int]:
    """Both fingerprints of a set."""
    return first_fingerprint(found), second_fingerprint(found)


def class_of(found: np.ndarray, collided: frozenset[int]) -> int:
    """The class of a set: its first fingerprint, or the second where the first is known to stand for several sets."""
    one = first_fingerprint(found)
    return second_fingerprint(found) if one in collided else one
