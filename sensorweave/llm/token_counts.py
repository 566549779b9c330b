"""Token counts of byte-level BPE by rank-synchronous merging of ragged arrays.

Texts are cut into pre-tokens. The pre-tokens a batch has not met yet become one
ragged array of byte symbols, in which every sequence applies its lowest-rank pair
at the same time, round after round, until no pair of any sequence has a rank. The
symbols that survive are the tokens. Counts of pre-tokens are kept by the Python
worker for later batches, so each word is merged about once per worker.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from sensorweave.llm.common import kept_in_worker, slices, text_bytes
from sensorweave.llm.merges import Merges

# White space as Unicode defines it, and the pattern that cuts
# byte-level BPE texts into pre-tokens.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRE_TOKEN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)

ASCII_PAIRS = [c + " " for c in "\t\n\v\f\r "]
PAIRS = ASCII_PAIRS + [chr(c) + " " for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
UNASSIGNED = regex.compile(r"\p{Cn}")

#: Entries of the per-worker cache; it is emptied when full, which changes no result.
CACHE_ENTRIES = 600_000
#: Bytes of pre-tokens merged together.
MERGE_BYTES = 1 << 20


class Counter:
    """Token counts of texts, with a cache of space-led chunks met before."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.pattern = regex.compile(PRE_TOKEN)
        specials = self.merges.specials
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.known: dict[str, int] = {}

    def pre_tokens(self, text: str) -> list[str]:
        """Cut by the pattern; characters newer than its tables are left to the library."""
        if text.isascii() or not UNASSIGNED.search(text):
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def sizes(self, texts: list[str]) -> list[int]:
        """Tokens of each text, merged in groups of about MERGE_BYTES."""
        result = np.zeros(len(texts), dtype=np.int64)
        words: list[bytes] = []
        owners: list[int] = []
        size = 0
        for at, text in enumerate(texts):
            # Letters alone, after at most one space, are one pre-token.
            if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
                words.append(text.encode("utf-8"))
                owners.append(at)
                size += len(text)
            else:
                found = self.pre_tokens(text)
                words.extend(word.encode("utf-8") for word in found)
                owners.extend([at] * len(found))
                size += len(text)
            if size >= MERGE_BYTES:
                result += np.bincount(owners, self.merges.count(words), len(texts)).astype(np.int64)
                words, owners, size = [], [], 0
        if words:
            result += np.bincount(owners, self.merges.count(words), len(texts)).astype(np.int64)
        return result.tolist()

    def count(self, texts: list[str]) -> list[int]:
        totals = [0] * len(texts)
        chunked: list[tuple[int, list[str]]] = []
        plain: list[tuple[int, str]] = []
        for at, text in enumerate(texts):
            parts = self.special.split(text) if self.special else [text]
            totals[at] += len(parts) - 1
            for part in parts:
                if any(pair in part for pair in (ASCII_PAIRS if part.isascii() else PAIRS)):
                    plain.append((at, part))
                    continue
                # No white space stands before a space, so a text falls apart at its
                # spaces: each leads the chunk that follows it.
                first, *chunks = part.split(" ")
                plain.append((at, first))
                chunked.append((at, chunks))
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        known = self.known
        new = list(set().union(*(chunks for _, chunks in chunked)).difference(known))
        known.update(zip(new, self.sizes([f" {chunk}" for chunk in new]), strict=True))
        for at, chunks in chunked:
            totals[at] += sum(map(known.__getitem__, chunks))
        for (at, _), n in zip(plain, self.sizes([part for _, part in plain]), strict=True):
            totals[at] += n
        return totals


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


kept_in_worker("counter", counter.cache_clear)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """Bytes and tokens of every whole text.

    ``vocabulary`` is the path of a byte-level BPE file on every executor. A null text
    counts as empty: 0 bytes, 0 tokens. Repeated rows give repeated results, a null id
    stays null, other columns are ignored. Special strings in a text count as one
    token each. No shuffle: rows come back from the task that read them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(vocabulary)
        for batch in slices(batches, keep="counter"):
            raw = batch.column(1).to_pylist()
            tokens = counts.count([x.decode("utf-8", "replace") for x in raw])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in raw], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    source = docs.select("doc_id", text_bytes().alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
