"""Token ids of a byte-level BPE vocabulary for many texts at a time.

The texts of a batch are cut into words by one numpy pass over their characters. Each different word
of the batch is encoded once and its ids are put in all its places.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
import tiktoken

from tradeweir.llm.words import mix, powers

# The public pattern that cuts a text before byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A worker remembers the ids of words it has met, found again by the word's 64-bit hash, one word a
# slot, until so many ids are stored. It changes speed, not results.
SLOTS = 1 << 20
REMEMBERED = 4_000_000
PART = 1 << 20  # characters of a text that are encoded at a time
# Between a letter and what is not a letter a word always ends; the bar is left out because a special token holds it.
_CUT = regex.compile(r"(?<=\p{L})[^\p{L}|]")
_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3


def text_parts(text: str, size: int = PART) -> Iterator[str]:
    """A text in parts of about ``size`` characters; their ids in a row are the text's."""
    at = 0
    while len(text) - at > size:
        found = _CUT.search(text, at + size)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def bytes_of() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file, by the public rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Kind and hash of every character."""
    kinds = {"L": _LETTER, "N": _NUMBER}
    kind = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8)
    # White_Space of the Unicode standard.
    kind[[*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]] = _SPACE
    return kind, mix(np.arange(1, 0x110001, dtype=np.uint64))


def cut(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All characters, where each word begins, and where each text begins, as :data:`PATTERN` cuts them."""
    kind_of, _ = _characters()
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))))
    n = len(chars)
    if n == 0:
        return chars, np.zeros(0, np.int64), bounds
    kind = kind_of[chars]
    text_begins = np.zeros(n + 1, bool)
    text_begins[bounds] = True
    begins = text_begins.copy()
    begins[1:n] |= kind[1:] != kind[:-1]
    last = np.flatnonzero((kind == _SPACE) & begins[1:] & ~text_begins[1:])  # of white space before a word
    begins[last] = True
    begins[last[chars[last] == 32] + 1] = False
    quote = np.flatnonzero((chars == 39) & begins[:-1] & begins[1:] & ~text_begins[1:])
    quote = quote[kind[np.minimum(quote + 1, n - 1)] == _LETTER]
    for at in quote.tolist():
        after = chr(chars[at + 1])
        two = after + (chr(chars[at + 2]) if at + 2 < n and not text_begins[at + 2] else "")
        size = 1 if after in "stmd" else 2 if two in ("re", "ve", "ll") else 0
        if size:
            begins[at + 1] = False
            begins[at + 1 + size] = True
    return chars, np.flatnonzero(begins[:n]), bounds


class Vocabulary:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        byte = bytes_of()
        special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        ranks = {
            bytes(byte[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special
        }
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = special
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.first, self.count = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int32)
        self.flat = np.zeros(0, np.uint32)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and where each text's begin; special tokens' strings are those tokens."""
        parts, special = texts, {}
        if self.splitter and any(s in t for s in self.special for t in texts):
            split = [self.splitter.split(t) for t in texts]
            parts = [p for s in split for p in s]
            special = {i: self.special[p] for i, p in enumerate(parts) if p in self.special}
            ends = np.cumsum([0, *map(len, split)])
        ids, bounds = self._ordinary(["" if i in special else p for i, p in enumerate(parts)] if special else parts)
        if special:
            places = sorted(special)
            ids = np.insert(ids, bounds[places], [special[i] for i in places])
            more = np.zeros(len(parts) + 1, np.int64)
            more[np.array(places) + 1] = 1
            bounds = (bounds + np.cumsum(more))[ends]
        return ids, bounds

    def _ordinary(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        chars, begins, text_bounds = cut(texts)
        if len(begins) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        _, hash_of = _characters()
        lengths = np.diff(begins, append=len(chars))
        place = np.arange(len(chars)) - np.repeat(begins, lengths)
        hashes = np.add.reduceat(hash_of[chars] * powers(int(lengths.max()))[place], begins)
        if len(self.flat) > REMEMBERED:
            self._forget()
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        first, own = self.first[slot], self.count[slot].astype(np.int64)
        new = np.flatnonzero(self.keys[slot] != hashes)
        keys, sample, which = np.unique(hashes[new], return_index=True, return_inverse=True)
        whole = "".join(texts)
        at, size = begins[new[sample]].tolist(), lengths[new[sample]].tolist()
        each = [self.encoding.encode_ordinary(whole[a : a + n]) for a, n in zip(at, size, strict=True)]
        counts = np.fromiter(map(len, each), np.int64, len(each))
        starts = len(self.flat) + np.cumsum(counts) - counts
        self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(each), np.uint32)))
        first[new], own[new] = starts[which], counts[which]
        slot = slot[new[sample]]
        self.keys[slot], self.first[slot], self.count[slot] = keys, starts, counts
        ends = np.cumsum(own)
        ids = self.flat[np.arange(ends[-1]) + np.repeat(first - (ends - own), own)]
        before = np.concatenate(([0], ends))
        return ids, before[np.searchsorted(begins, text_bounds)]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(os.fspath(path))
