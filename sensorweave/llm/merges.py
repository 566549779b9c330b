"""Merge ranks of a byte-level vocabulary file, applied to many words at once."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np

NO_RANK = np.int32(2**31 - 1)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Merges:
    """Ranks of symbol pairs, and the rank-synchronous merge of ragged arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.byte_ids = np.array([vocabulary[c] for c in byte_characters()], dtype=np.int32)
        self.last_ids = np.array([vocabulary[c + suffix] for c in byte_characters()], dtype=np.int32)
        left = np.array([vocabulary[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], dtype=np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int32)
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.specials = [t["content"] for t in spec["added_tokens"]]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)

    def _finished(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per round, the words that no pair merges any more: their numbers, sizes and symbols."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbols = self.byte_ids[raw]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last_ids[raw[ends]]
        owner = np.repeat(np.arange(len(words)), lengths)
        ranks = np.full(len(symbols), NO_RANK, dtype=np.int32)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        ranks[inner] = self.rank(symbols[inner], symbols[inner + 1])
        while len(symbols):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(ranks, first)
            sizes = np.diff(np.r_[first, len(symbols)])
            done = lowest == NO_RANK
            if done.any():
                over = np.repeat(done, sizes)
                yield owner[first[done]], sizes[done], symbols[over]
                symbols, owner, ranks = symbols[~over], owner[~over], ranks[~over]
                lowest, sizes = lowest[~done], sizes[~done]
                if not len(symbols):
                    return
            hit = np.flatnonzero(ranks == np.repeat(lowest, sizes))
            # A run such as "aaa" offers overlapping pairs: every second one merges.
            fresh = np.r_[True, np.diff(hit) != 1]
            start = hit[fresh][np.cumsum(fresh) - 1]
            hit = hit[(hit - start) % 2 == 0]
            symbols[hit] = self.merged[ranks[hit]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[hit + 1] = False
            at = hit - np.arange(len(hit))  # places of the merged symbols after the cut
            symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
            changed = np.r_[at, at[at > 0] - 1]
            last = (changed + 1 >= len(symbols)) | (owner[changed] != owner[np.minimum(changed + 1, len(symbols) - 1)])
            ranks[changed[last]] = NO_RANK
            changed = changed[~last]
            ranks[changed] = self.rank(symbols[changed], symbols[changed + 1])

    def count(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each non-empty byte string, all merged together."""
        result = np.zeros(len(words), dtype=np.int64)
        for owner, sizes, _ in self._finished(words):
            result[owner] = sizes
        return result

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each non-empty byte string, as little-endian unsigned 32-bit numbers."""
        result: list[bytes] = [b""] * len(words)
        for owner, sizes, symbols in self._finished(words):
            raw = symbols.astype("<u4").tobytes()
            stops = (np.cumsum(sizes) * 4).tolist()
            for at, start, stop in zip(owner.tolist(), [0, *stops], stops):
                result[at] = raw[start:stop]
        return result
