"""Packing of tokenised documents into sequences of a fixed size.

Documents are tokenised once and cut into pieces: whole sequences and one remainder.
Pieces are dealt at random, by a hash, into groups of about ``GROUP_PIECES``; each
group is packed by first-fit decreasing. The first bin with enough room is found by
descending a tournament tree over the bins' free capacities, so a group of n pieces
takes n log n steps. Only piece descriptions are shuffled, never tokens.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sensorweave.llm.common import kept_in_worker, slices, text_bytes, written
from sensorweave.llm.merges import Merges

#: Pieces packed together by one call; a group is bounded by chance around this size.
GROUP_PIECES = 8192
#: Bytes, about, of the per-worker cache; it is emptied when full, which changes no result.
CACHE_BYTES = 64 << 20
#: What one entry takes beside its chunk and ids.
ENTRY_BYTES = 200
SIMPLE_WORD = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]?")
LOWER_WORD = re.compile(rb"[a-z]+")
#: A single stop after a letter is a word of its own; where others follow, they belong together.
LAST_STOP = re.compile(rb"(?<=[a-z])([.,])(?!\S)")
BITS = 31  # of a sequence number within its group


class Encoder:
    """Token ids as bytes. White space only separates words here, so each
    whitespace-delimited chunk is encoded alone and kept for later batches."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.merges = Merges(path)
        self.known: dict[bytes, bytes] = {}
        self.kept = 0
        self.marks = [mark.lower().encode() for mark in self.merges.specials]
        self.stops = {mark: self.by_library([mark])[0] for mark in ".,"}

    def by_library(self, chunks: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(chunks, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def learn(self, chunks: set[bytes]) -> None:
        """Plain words are merged together, everything else is left to the library."""
        plain = list(filter(LOWER_WORD.fullmatch, chunks))
        found = dict(zip(plain, self.merges.encode(plain), strict=True))
        simple: dict[bytes, list[tuple[bytes, bytes]]] = {}
        other: list[bytes] = []
        for chunk in chunks.difference(found):
            text = chunk.decode("utf-8", "replace")
            if SIMPLE_WORD.fullmatch(text):
                stop = text[-1] if text[-1] in ".," else ""
                stem = text.removesuffix(stop).lower().encode("utf-8") if stop else text.lower().encode("utf-8")
                simple.setdefault(stem, []).append((chunk, self.stops[stop] if stop else b""))
            else:
                other.append(chunk)
        for (_, uses), ids in zip(simple.items(), self.merges.encode(list(simple)), strict=True):
            for chunk, stop in uses:
                found[chunk] = ids + stop
        if other:
            found.update(zip(other, self.by_library([x.decode("utf-8", "replace") for x in other]), strict=True))
        self.known.update(found)
        self.kept += sum(map(len, found)) + sum(map(len, found.values())) + ENTRY_BYTES * len(found)

    def chunks(self, text: bytes) -> list[bytes]:
        """Chunks between white space, in lower case and without last stops, so that a word is met
        once. A text with something like a special mark, in any case, is only cut."""
        low = text.lower()
        if any(mark in low for mark in self.marks):
            return text.split()
        return LAST_STOP.sub(rb" \1", low).split()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if self.kept > CACHE_BYTES:
            self.known.clear()
            self.kept = 0
        chunked = [self.chunks(text) for text in texts]
        new = set().union(*chunked).difference(self.known)
        if new:
            self.learn(new)
        return [b"".join(map(self.known.__getitem__, chunks)) for chunks in chunked]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    # A task has one core; the library's threads would each keep memory of their own.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


kept_in_worker("encoder", encoder.cache_clear)


class BinTree:
    """Tournament tree of free capacities: each node holds the larger of its children."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)

    def first_fit(self, need: int) -> tuple[int, int]:
        """The first bin with that much room, and the room it had; takes the space."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < need:
                at += 1
        had = room[at]
        room[at] = had - need
        node = at >> 1
        while node:
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
            node >>= 1
        return at - self.leaves, had


def first_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece; lengths are at most the capacity. Bins are
    numbered from 0 without gaps, equal lengths keep their order."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    tree = BinTree(len(lengths), capacity)
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    for i in order:
        bins[i], had = tree.first_fit(lengths[i])
        offsets[i] = capacity - had
    return bins, offsets


PIECES = "start long, length long, ids_crc32 long, doc_tokens long"


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int) -> DataFrame:
    """The pieces of each document in order, with the checksum of their ids."""
    end = np.array([end_id], dtype="<u4").tobytes()
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in slices(batches, keep="encoder"):
            rows: list[tuple[int, int, int, int, int]] = []
            for i, raw in enumerate(coder.encode(batch.column(1).to_pylist())):
                ids = raw + end
                total = len(ids) // 4
                for at in range(0, len(ids), step):
                    piece = ids[at : at + step]
                    rows.append((i, at // 4, len(piece) // 4, zlib.crc32(piece), total))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(columns[0]), *columns[1:]],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    source = docs.select("doc_id", text_bytes().alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, {PIECES}")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    A null or empty text is the end token alone. Repeated rows are packed each for
    itself; a null id stays null and is packed like any other. Documents longer than
    a sequence are cut at its multiples; only the remainder shares a sequence.
    An empty table gives an empty result. Other columns are ignored.
    """
    pieces, _ = written(cut_pieces(docs, vocabulary, capacity, end_id), "pieces")
    groups = max(1, -(-pieces.count() // GROUP_PIECES))
    numbered = pieces.withColumn(
        "group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups))
    )
    id_type = pieces.schema["doc_id"].dataType.simpleString()

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        bins, offsets = first_fit_decreasing(group["length"].tolist(), capacity)
        group["sequence_id"] = group["group"] * (1 << BITS) + np.array(bins, dtype=np.int64)
        group["offset"] = np.array(offsets, dtype=np.int64)
        return group.drop(columns="group")

    return numbered.groupBy("group").applyInPandas(
        run, f"doc_id {id_type}, {PIECES}, sequence_id long, offset long"
    )
