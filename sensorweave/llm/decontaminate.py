"""Benchmark decontamination with an FM-index per shard of documents.

A shard is what one task reads up to ``SHARD_BYTES``. Its words become numbers of the
test phrases' vocabulary; words outside it cannot be part of any phrase, so only runs
of known words at least as long as the shortest phrase enter the index. All phrases are
searched backwards at once through wavelet-tree ranks, occurrences are located from
sampled suffix positions, and their spans are merged per document. No shuffle: the
documents stay where they are read, the phrases come in blocks of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.llm.common import dropped, slices, written
from sensorweave.llm.fm_index import FmIndex

#: Words of test items broadcast at once; a larger benchmark is searched block by block.
BLOCK_WORDS = 500_000
SHARD_BYTES = 4 << 20

# Every byte that is no letter, digit or part of a non-ASCII character separates
# words; A-Z become lower case.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
WORD = re.compile(rb"[^ ]+")


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(WORD_BYTES).split(b" ")


class Phrases:
    """Windows of a block of test items, as rows of word numbers by length."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            width = min(window, len(numbers))
            for at in range(len(numbers) - width + 1) if width else ():
                found.setdefault(tuple(numbers[at : at + width]), set()).update([] if item is None else [item])
        self.groups: list[tuple[np.ndarray, list[list[str]]]] = []
        for width in sorted({len(p) for p in found}):
            some = [p for p in found if len(p) == width]
            self.groups.append((np.array(some, dtype=np.int64), [sorted(found[p]) for p in some]))
        self.shortest = min((len(p) for p in found), default=0)

    def search(self, docs: list[bytes]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """Per document: its words, merged spans of hit words, and the items found."""
        get = self.vocabulary.get
        numbers, counts = [], []
        for raw in docs:
            words = [w for w in words_of(raw) if w]
            counts.append(len(words))
            numbers.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
            numbers.append(np.zeros(1, np.int64))
        result = [(n, [], []) for n in counts]
        if not self.groups or not docs:
            return result
        text = np.concatenate(numbers)
        edges = np.flatnonzero(np.diff(np.r_[0, text != 0, 0]))
        long = edges[1::2] - edges[::2] >= self.shortest
        starts, ends = edges[::2][long], edges[1::2][long]
        if not len(starts):
            return result
        # Each run with the separator behind it; every document ends in one.
        sizes = ends - starts + 1
        offsets = np.r_[0, np.cumsum(sizes)]
        origin = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
        index = FmIndex(text[origin], len(self.vocabulary))
        first_word = np.r_[0, np.cumsum(np.array(counts) + 1)]
        cover = np.zeros(len(text) + 1, np.int64)
        items: dict[int, set[str]] = {}
        for phrases, owners in self.groups:
            low, high = index.search(phrases)
            total = high - low
            hit = np.flatnonzero(total)
            if not len(hit):
                continue
            total = total[hit]
            rows = np.repeat(low[hit] - np.r_[0, np.cumsum(total)[:-1]], total) + np.arange(total.sum())
            at = origin[index.locate(rows)]
            np.add.at(cover, at, 1)
            np.add.at(cover, at + phrases.shape[1], -1)
            doc = np.searchsorted(first_word, at, side="right") - 1
            for d, p in np.unique(np.stack([doc, np.repeat(hit, total)]), axis=1).T.tolist():
                items.setdefault(d, set()).update(owners[p])
        edges = np.flatnonzero(np.diff(np.r_[0, np.cumsum(cover[:-1]) > 0, 0]))
        doc = np.searchsorted(first_word, edges[::2], side="right") - 1
        for d, a, b in zip(doc.tolist(), edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            base = int(first_word[d])
            result[d][1].append((a - base, b - base))
        for d, names in items.items():
            result[d][2].extend(sorted(names))
        return result


def phrase_blocks(benchmark: DataFrame, window: int) -> Iterator[Phrases]:
    """The test items in blocks of bounded size, as the driver streams them."""
    items: list[tuple[str | None, list[bytes]]] = []
    size = 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).filter("text is not null")
    for item, raw in rows.toLocalIterator():
        words = [w for w in words_of(bytes(raw)) if w]
        items.append((item, words))
        size += len(words)
        if size >= BLOCK_WORDS:
            yield Phrases(items, window)
            items, size = [], 0
    if items:
        yield Phrases(items, window)


HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("stop", T.LongType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
ARROW_HITS = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return [(a, b) for a, b in merged]


Batches = Iterator[pa.RecordBatch]


def _searched(
    frame: DataFrame, sent: Broadcast, then: Callable[[Batches], Batches] | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Adds a block's hits to those of the blocks before, in column ``hits``. What follows in the same
    tasks goes into ``then`` (its result: ``schema``): one Python worker a core, not two."""

    def shard(held: list[pa.RecordBatch]) -> Batches:
        texts = [x or b"" for batch in held for x in batch.column("text").to_pylist()]
        found = iter(sent.value.search(texts))
        for batch in held:
            rows = []
            for old, (n, spans, items) in zip(batch.column("hits").to_pylist(), found):
                if old:
                    spans = merge_spans(spans + [(s["first"], s["stop"]) for s in old["spans"]])
                    items = sorted({*items, *old["items"]})
                rows.append({"n_words": n, "spans": [{"first": a, "stop": b} for a, b in spans], "items": items})
            columns = [*batch.columns[:-1], pa.array(rows, ARROW_HITS)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    def run(batches: Batches) -> Batches:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in slices(batches, 128):
            held.append(batch)
            size += batch.nbytes
            if size >= SHARD_BYTES:
                yield from shard(held)
                held, size = [], 0
        yield from shard(held)

    if then is None:
        return frame.mapInArrow(run, frame.schema)
    return frame.mapInArrow(lambda batches: then(run(batches)), schema)


def _last_block(docs: DataFrame, benchmark: DataFrame, window: int) -> tuple[DataFrame, Broadcast]:
    """Rows with the hits of all blocks of test items but the last one, and the last one's broadcast."""
    spark = docs.sparkSession
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.col("row.text").cast("binary").alias("text")
    frame = docs.select(row, F.col("text").cast("binary").alias("text"), F.lit(None).cast(HITS).alias("hits"))
    sent = before = None
    for phrases in phrase_blocks(benchmark, window):
        if sent:
            # One block at a time: its hits are written before the next one is sent.
            done, path = written(_searched(frame, sent).select("row", "hits"), "hits")
            sent.destroy()
            if before:
                dropped(spark, before)
            frame, before = done.select("row", text, "hits"), path
        sent = spark.sparkContext.broadcast(phrases)
    return frame, sent or spark.sparkContext.broadcast(Phrases([], window))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Columns ``row`` (the document), ``text`` (bytes) and ``hits`` of every document.

    ``hits`` has the number of words, the merged spans of hit words and the ids (as
    text, sorted) of test items with a window in the document. A null or empty text
    has no words and no hits, and so have all documents if the benchmark is empty.
    A null item_id marks words but is not listed. Repeated rows and null ids are
    kept as they are; columns besides ``text`` are only carried along.
    """
    return _searched(*_last_block(docs, benchmark, window))


def cut_words(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the given runs of words and what stands between their words."""
    places = [m.span() for m in WORD.finditer(raw.translate(WORD_BYTES))]
    kept, at = [], 0
    for first, stop in spans:
        kept.append(raw[at : places[first][0]])
        at = places[stop - 1][1]
    return b"".join([*kept, raw[at:]])


def remove_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents without the words that test items share with them; every row stays."""
    frame, sent = _last_block(docs, benchmark, window)

    def cut(batches: Batches) -> Batches:
        for batch in batches:
            raws, hits = batch.column("text").to_pylist(), batch.column("hits").to_pylist()
            clean = [
                cut_words(raw, [(s["first"], s["stop"]) for s in hit["spans"]]) if raw and hit["spans"] else None
                for raw, hit in zip(raws, hits, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(clean, pa.binary())], ["row", "clean"])

    schema = T.StructType([frame.schema["row"], T.StructField("clean", T.BinaryType())])
    cleaned = _searched(frame, sent, cut, schema)
    text = F.coalesce(F.col("clean").cast("string"), F.col("row.text"))
    return cleaned.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    hits = F.col("hits")
    n_hit = F.aggregate(hits["spans"], F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["first"])
    return find_contamination(docs.select("doc_id", "text"), benchmark, window).select(
        F.col("row.doc_id").alias("doc_id"),
        hits["n_words"].alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(hits["items"], ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
