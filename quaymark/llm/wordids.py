"""Token ids of whole texts through the tokenizers library, remembered by white-space chunk.

The vocabulary's normaliser turns white space into one space and its pre-tokenizer drops it, so no
token reaches across a space or a line feed.  A text is therefore cut at those two characters, the
library encodes each distinct chunk once, and a text's ids are its chunks' ids one after another —
the ids that the library gives for the whole text.

Chunks and ids are kept in Arrow and numpy arrays, never as one Python object a chunk: a remembered
chunk takes some 30 bytes, and a batch is looked up, learnt and gathered as a whole.

Defined cases: the empty text has no ids; equal texts have equal ids; nothing is cut or capped.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ._shared import trim, worker_cache

#: Distinct chunks that a Python worker remembers.
CACHE_ENTRIES = 1_000_000
MARK = "\x01"
#: Chunks that are joined for the library, and joined texts of one call.
GROUP, CALL = 2000, 16
PLAIN = "".join(c for c in map(chr, range(256)) if c.isalpha() and c.islower()).encode("latin-1") + b" \n.,"
#: Words that no normaliser changes and that are one pre-token each.
WORD = "^[a-zß-öø-ÿ]+$"
#: ASCII signs after a Latin letter are always tokens of their own.
SIGNED = r"^(?P<stem>.*[a-zA-ZÀ-ÖØ-öø-ÿ])(?P<tail>[!-/:-@\[-`{-~]+)$"


def settings_of(path: str) -> dict:
    """What a tokenizer's file says before its vocabulary; the whole file where the order is another."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    head = text[: text.find('"vocab"')].rstrip().rstrip(",") + "}}"
    try:
        spec = json.loads(head)
        return spec if "end_of_word_suffix" in spec.get("model", {}) else json.loads(text)
    except ValueError:
        return json.loads(text)


class ChunkEncoder:
    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        spec = settings_of(path)
        steps = [x.get("pattern", {}).get("Regex") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        if r"\s+" not in steps or not (pre.get("behavior") == "Removed" and pre.get("invert")):
            raise ValueError("this vocabulary keeps white space in its tokens; texts cannot be cut there")
        suffix = spec["model"].get("end_of_word_suffix")
        if not suffix:
            raise ValueError("this vocabulary does not tell the last token of a word")
        self.tokenizer = Tokenizer.from_file(path)
        # The same model without the steps that plain words do not need.
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        vocabulary = self.vocabulary()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.entries, self.tick = entries, 0
        # What is remembered: chunk k has the ids at[k] to at[k + 1] and was last met in batch used[k].
        self.words = pa.array([""], pa.string())
        self.at, self.ids, self.used = np.zeros(2, np.int64), np.zeros(0, "<u4"), np.zeros(1, np.int32)
        trim()

    def vocabulary(self) -> dict[str, int]:
        return self.tokenizer.get_vocab()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text's ids stop."""
        if not texts:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        self.tick += 1
        if len(self.words) > self.entries:
            self.forget()
        cut = pc.split_pattern(pa.array(list(map(self.spaced, texts)), pa.large_string()), " ")
        coded = cut.flatten().dictionary_encode()
        place = self.places(coded.dictionary.cast(pa.string()))
        self.used[place] = self.tick
        flat, counts = self.gather(place[coded.indices.to_numpy()])
        return flat, np.cumsum(counts)[np.cumsum(cut.value_lengths().to_numpy()) - 1]

    def gather(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of remembered chunks one after another, and how many each has."""
        start = self.at[place]
        counts = self.at[place + 1] - start
        stops = np.cumsum(counts)
        shift = (start - stops + counts).astype(np.int32)
        return self.ids[np.repeat(shift, counts) + np.arange(stops[-1] if len(stops) else 0, dtype=np.int32)], counts

    def places(self, chunks: pa.Array) -> np.ndarray:
        """Where distinct chunks are remembered; unknown ones are learnt."""
        found = pc.index_in(self.words, value_set=chunks).fill_null(-1).to_numpy(zero_copy_only=False)
        known = np.flatnonzero(found >= 0)
        place = np.full(len(chunks), -1, np.int64)
        place[found[known]] = known
        unknown = np.flatnonzero(place < 0)
        if len(unknown):
            place[unknown] = self.learn(chunks.take(pa.array(unknown)))
        return place

    def learn(self, chunks: pa.Array) -> np.ndarray:
        place = np.zeros(len(chunks), np.int64)
        plain = pc.match_substring_regex(chunks, WORD).to_numpy(zero_copy_only=False)
        if plain.any():
            some = chunks.filter(pa.array(plain))
            place[plain] = self.remember(some, *self.plain_ids(some))
        if plain.all():
            return place
        others, at = chunks.filter(pa.array(~plain)), np.flatnonzero(~plain)
        parts = pc.extract_regex(others, SIGNED)
        signed = parts.is_valid().to_numpy(zero_copy_only=False) & ~pc.match_substring(others, "<|").to_numpy(zero_copy_only=False)
        if not signed.all():
            some = others.filter(pa.array(~signed))
            place[at[~signed]] = self.remember(some, *self.other_ids(some))
        if signed.any():
            parts = parts.filter(pa.array(signed))
            both = pa.concat_arrays([parts.field("stem"), parts.field("tail")]).dictionary_encode()
            known = self.places(both.dictionary)[both.indices.to_numpy()]
            flat, counts = self.gather(known.reshape(2, -1).T.ravel())
            place[at[signed]] = self.remember(others.filter(pa.array(signed)), flat, counts.reshape(-1, 2).sum(1))
        return place

    def remember(self, chunks: pa.Array, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        base = len(self.words)
        self.words = pa.concat_arrays([self.words, chunks])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(counts)])
        self.ids = np.concatenate([self.ids, ids])
        self.used = np.concatenate([self.used, np.full(len(chunks), self.tick, np.int32)])
        return np.arange(base, len(self.words))

    def forget(self) -> None:
        """Keep the chunks met most recently, about half of them; the empty one stays first."""
        keep = self.used > np.median(self.used)
        keep[0] = True
        kept = np.flatnonzero(keep)
        self.ids, counts = self.gather(kept)
        self.words, self.at, self.used = self.words.take(pa.array(kept)), np.r_[0, np.cumsum(counts)], self.used[kept]

    def plain_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words of one pre-token each: only their last token closes a word."""
        ids = self.joined_ids(self.letters, chunks, " ", np.zeros(0, "<u4"))
        stops = np.flatnonzero(self.closing[ids]) + 1
        if len(stops) != len(chunks) or stops[-1] != len(ids):
            raise ValueError("the vocabulary joins a chunk with its neighbours")
        return ids, np.diff(stops, prepend=0)

    def other_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Between any other chunks stands a marked character, a token of its own."""
        if len(self.mark) != 1 or pc.any(pc.match_substring(chunks, MARK)).as_py():
            found = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(chunks.to_pylist(), add_special_tokens=False)]
            return np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))
        ids = self.joined_ids(self.tokenizer, chunks, f" {MARK} ", np.array(self.mark, "<u4"))
        stops = np.flatnonzero(ids == self.mark[0])
        if len(stops) != len(chunks):
            raise ValueError("the vocabulary joins a chunk with its neighbours")
        return ids[ids != self.mark[0]], np.diff(stops, prepend=-1) - 1

    @staticmethod
    def joined_ids(tokenizer, chunks: pa.Array, between: str, after: np.ndarray) -> np.ndarray:
        """Ids of the chunks, joined group by group for the library; ``after`` follows each group."""
        offsets = np.unique(np.r_[np.arange(0, len(chunks), GROUP), len(chunks)]).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), chunks), between)
        out: list[np.ndarray] = []
        for i in range(0, len(joined), CALL):  # what the library returns is large, and only its ids are kept
            found = tokenizer.encode_batch_fast(joined[i : i + CALL].to_pylist(), add_special_tokens=False)
            out += [x for e in found for x in (np.array(e.ids, "<u4"), after)]
        return np.concatenate(out)

    @staticmethod
    def spaced(text: str) -> str:
        """The text with a space between its chunks.

        Latin-1 text is put in lower case first: the normaliser does the same to it, letter by letter.
        If it then holds nothing but letters, spaces, line feeds and single full stops and commas,
        these stand alone: they are always tokens of their own.
        """
        if "<|" not in text:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text.replace("\n", " ")
            text = text.lower()
            raw = text.encode("latin-1")
            if not raw.translate(None, PLAIN) and not any(x in raw for x in (b"..", b".,", b",.", b",,")):
                text = text.replace(".", " . ").replace(",", " , ")
        return text.replace("\n", " ")


def with_ends(flat: np.ndarray, stops: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each text's, and where each text stops then."""
    last = stops + np.arange(len(stops))
    out = np.full(len(flat) + len(stops), end_id, "<u4")
    inner = np.ones(len(out), bool)
    inner[last] = False
    out[inner] = flat
    return out, last + 1


def chunk_encoder(path: str, entries: int = CACHE_ENTRIES) -> ChunkEncoder:
    return worker_cache(f"chunks {entries} {path}", lambda: ChunkEncoder(path, entries))
