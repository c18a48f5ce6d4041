"""Recursive chunks of text with an overlap (inventory C1).

Tokens are words and single CJK characters or signs with the white space before them: joining them
gives the text again.  Another tokenizer is any pair of functions (text to list, list to text).
Null and blank texts have no chunks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Separators, the coarsest first.
SEPARATORS = ("\n## ", "\n### ", "\n# ", "\n\n", "\n", ". ", "? ", "! ", "; ", ", ", " ")
TOKEN = re.compile(r"\s*(?:[一-鿿]|[^\W一-鿿]+|[^\w\s])")
Encode = Callable[[str], list[str]]
Decode = Callable[[list[str]], str]


def _pieces(text: str, separators: tuple[str, ...], target: int, overlap: int, encode: Encode, decode: Decode) -> Iterator[str]:
    """Pieces of at most ``target`` tokens, cut at the coarsest separator that occurs, and finer ones only where needed."""
    text = text.strip()
    tokens = encode(text)
    if len(tokens) <= target:
        if text:
            yield text
        return
    level = next((i for i, s in enumerate(separators) if s in text), None)
    if level is None:
        last = max(len(tokens) - overlap, 1)
        windows = (decode(tokens[i : i + target]).strip() for i in range(0, last, max(1, target - overlap)))
        yield from filter(None, windows)
        return
    sep, finer, held = separators[level], separators[level + 1 :], ""
    for part in text.split(sep):
        joined = (held + sep + part).strip() if held else part
        if len(encode(joined)) > target:
            yield from _pieces(held, finer, target, overlap, encode, decode)
            joined = part
        held = joined
    yield from _pieces(held, finer, target, overlap, encode, decode)


def chunks_of(text: str | None, target: int = 500, overlap: int = 80, encode: Encode = TOKEN.findall, decode: Decode = "".join) -> list[str]:
    """Each piece after the first opens with the last ``overlap`` tokens of the chunk before it."""
    out: list[str] = []
    for piece in _pieces(text or "", SEPARATORS, target, overlap, encode, decode):
        tail = decode(encode(out[-1])[-overlap:]).strip() if out and overlap > 0 else ""
        whole = f"{tail}\n\n{piece}" if tail else piece
        tokens = encode(whole)
        out.append(decode(tokens[: target + overlap]).strip() if len(tokens) > target + overlap else whole)
    return out


def chunk_text(text: Column | str, target: int = 500, overlap: int = 80) -> Column:
    """C1 as a column: an array of chunks, in Arrow batches."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: chunks_of(t, target, overlap))

    return run(text)
