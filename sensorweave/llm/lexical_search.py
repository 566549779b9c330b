"""Ranked search by word impacts: max-sketches bound every score, exact scores settle the rest.

Documents are read in blocks. A block's documents fold the impacts of all their terms into
sketches, one number per hashed coordinate, the maximum of what falls there. Looking up an
item's terms in all sketches of a block at once gives a bound that no score of the item
exceeds. Documents are then scored exactly in descending order of their bounds, until the
bound is below the score that the last of the best ``k`` has. Each task keeps ``k`` documents
per item; a floor known from a sample of the documents keeps most of those at home, too.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, IntegerType, LongType, StructField, StructType

from sensorweave.llm.common import slices, written

#: Bytes of text and documents of a block; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
BLOCK_DOCS = 4096
#: Coordinates of a sketch: the smallest of these with room for twice the document's terms.
#: Beyond the last one bounds get looser, and more documents are scored.
WIDTHS = np.array([1 << 9, 1 << 12, 1 << 15, 1 << 18])
#: Numbers held by the sketches that are looked up together.
CELLS = 1 << 23
#: Impacts are below 1,000,000; sketches hold them in sixteenths, rounded up, as 16 bits.
GRAIN = 16
#: Documents scored between two looks at the bound.
STEP = 128
#: Items searched in one pass over the documents, and their terms.
ITEMS_AT_ONCE = 4096
TERMS_AT_ONCE = 200_000

# Bytes that separate terms become spaces, A-Z become lower case.
_KEPT = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
TERM_BYTES = bytes(b if b in _KEPT else 0x20 for b in range(256)).lower()


def terms_of(raw: bytes) -> list[bytes]:
    return raw.translate(TERM_BYTES).split()


def hashed(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term) & 0xFFFFFFFF


class Items:
    """Items searched together: their distinct terms, numbered."""

    def __init__(self, rows: list[tuple[object, list[bytes]]]):
        self.ids = [item_id for item_id, _ in rows]
        numbers: dict[bytes, int] = {}
        self.terms = [
            np.array([numbers.setdefault(term, len(numbers)) for term in dict.fromkeys(found)], dtype=np.int64) for _, found in rows
        ]
        self.numbers = numbers


@dataclass
class Weights:
    """Corpus counts, and what follows from them: the weight of each term of the items."""

    documents: int
    words: int
    weight: np.ndarray

    @classmethod
    def of(cls, documents: int, words: int, held: dict[int, int], terms: int) -> Weights:
        held_by = [held.get(term, 0) for term in range(terms)]
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in held_by]
        return cls(documents, words, np.array(weight, dtype=np.int64))

    def lengths(self, sizes: list[int]) -> np.ndarray:
        return np.array([100 - 50 + 50 * n * self.documents // self.words for n in sizes], dtype=np.int64)


def item_blocks(items: DataFrame) -> Iterator[Items]:
    rows: list[tuple[object, list[bytes]]] = []
    size = 0
    source = items.select("item_id", F.col("text").cast("binary")).filter("text is not null")
    for item_id, raw in source.toLocalIterator():
        rows.append((item_id, terms_of(bytes(raw))))
        size += len(rows[-1][1])
        if len(rows) >= ITEMS_AT_ONCE or size >= TERMS_AT_ONCE:
            yield Items(rows)
            rows, size = [], 0
    if rows:
        yield Items(rows)


def text_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts of documents with terms, in blocks of bounded size."""
    ids: list = []
    texts: list[bytes] = []
    size = 0
    for batch in slices(batches):
        for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids.append(doc_id)
            texts.append(raw or b"")
            size += len(texts[-1])
            if size >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def corpus_counts(docs: DataFrame, items: Items) -> tuple[int, int, dict[int, int]]:
    """Documents with terms, all their terms, and the documents that hold each term of the items."""
    numbers = items.numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, held = set(numbers), np.zeros(len(numbers) + 2, dtype=np.int64)
        for _, texts in text_blocks(batches):
            for text in texts:
                if found := terms_of(text):
                    held[-2] += 1
                    held[-1] += len(found)
                    held[[numbers[term] for term in vocabulary.intersection(found)]] += 1
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(held[some], pa.int64())], ["term", "n"])

    source = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    counted = source.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {row.term: row.n for row in counted.collect()}  # two rows and one per term of the block
    documents, words = (found.pop(len(numbers) + at, 0) for at in (0, 1))
    return documents, words, found


class Postings:
    """Impacts of the terms of a block's documents."""

    def __init__(self, texts: list[bytes], numbers: dict[bytes, int], weights: Weights):
        words = [terms_of(text) for text in texts]
        sizes = [len(found) for found in words]
        seen: dict[bytes, int] = defaultdict(itertools.count().__next__)
        flat = np.fromiter(map(seen.__getitem__, itertools.chain.from_iterable(words)), np.int64, sum(sizes))
        keys, often = np.unique(np.repeat(np.arange(len(texts)), sizes) * max(1, len(seen)) + flat, return_counts=True)
        self.doc, term = np.divmod(keys, max(1, len(seen)))
        self.impact = 1_000_000_000 * often // (1000 * often + 20 * weights.lengths(sizes)[self.doc])
        self.hash = np.fromiter(map(hashed, seen), np.int64, len(seen))[term]
        self.term = np.fromiter((numbers.get(word, -1) for word in seen), np.int64, len(seen))[term]
        self.distinct = np.bincount(self.doc, minlength=len(texts))

    def parts(self) -> Iterator[tuple[int, np.ndarray]]:
        """Documents whose sketches have the same width, in parts of bounded size."""
        choice = np.minimum(np.searchsorted(WIDTHS, 2 * self.distinct), len(WIDTHS) - 1)
        for at, width in enumerate(WIDTHS.tolist()):
            docs = np.flatnonzero((choice == at) & (self.distinct > 0))
            for start in range(0, len(docs), CELLS // width):
                yield width, docs[start : start + CELLS // width]


class Sketches:
    """Max-sketches of some documents of a block, with their exact impacts for rescoring."""

    def __init__(self, postings: Postings, width: int, docs: np.ndarray, terms: int):
        local = np.full(len(postings.distinct), -1)
        local[docs] = np.arange(len(docs))
        mine = np.flatnonzero(local[postings.doc] >= 0)
        doc, impact = local[postings.doc[mine]], postings.impact[mine]
        self.width, self.terms = width, max(1, terms)
        flat = np.zeros(width * len(docs), dtype=np.uint16)
        np.maximum.at(flat, (postings.hash[mine] & (width - 1)) * len(docs) + doc, (-(-impact // GRAIN)).astype(np.uint16))
        self.maxima = flat.reshape(width, len(docs))
        asked = np.flatnonzero(postings.term[mine] >= 0)
        keys = doc[asked] * self.terms + postings.term[mine][asked]
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.impact = np.append(impact[asked][order], 0)

    def bounds(self, coordinates: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """No document's score for these terms is above its bound."""
        found = weight.astype(np.float64) @ self.maxima[coordinates & (self.width - 1)]
        return found.astype(np.int64) * GRAIN

    def scores(self, docs: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        wanted = docs[:, None] * self.terms + terms
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.impact[at], 0) @ weight


class Best:
    """The best ``k`` documents of one item so far; scores below ``need`` are of no use."""

    def __init__(self, k: int, floor: int):
        self.k, self.need = k, max(1, floor)
        self.rows: list[tuple[int, bool, object]] = []

    def add(self, scores: np.ndarray, ids: list) -> None:
        self.rows += [(-score, doc_id is None, doc_id) for score, doc_id in zip(scores.tolist(), ids, strict=True)]
        if len(self.rows) >= self.k:
            # Missing ids come last and never meet another id in a comparison.
            self.rows.sort(key=lambda row: row[:2] if row[1] else row)
            del self.rows[self.k :]
            self.need = max(self.need, -self.rows[-1][0])


def _best_of_tasks(docs: DataFrame, items: Items, weights: Weights, k: int, floors: list[int], item_type: DataType) -> DataFrame:
    """The best ``k`` documents of every item among those of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k, floor) for floor in floors]
        coordinates = np.fromiter(map(hashed, items.numbers), np.int64, len(items.numbers))
        weight = [weights.weight[terms] for terms in items.terms]
        for ids, texts in text_blocks(batches):
            postings = Postings(texts, items.numbers, weights)
            for width, part in postings.parts():
                sketches = Sketches(postings, width, part, len(items.numbers))
                for found, terms, w in zip(best, items.terms, weight, strict=True):
                    if not len(terms):
                        continue
                    bound = sketches.bounds(coordinates[terms], w)
                    likely = np.flatnonzero(bound >= found.need)
                    likely = likely[np.argsort(-bound[likely], kind="stable")]
                    for start in range(0, len(likely), STEP):
                        some = likely[start : start + STEP]
                        if bound[some[0]] < found.need:
                            break
                        scores = sketches.scores(some, terms, w)
                        good = np.flatnonzero(scores >= found.need)
                        if len(good):
                            found.add(scores[good], [ids[i] for i in part[some[good]].tolist()])
        rows = [(i, items.ids[i], doc_id, -score) for i, found in enumerate(best) for score, _, doc_id in found.rows]
        for start in range(0, len(rows), 1 << 14):
            columns = zip(*rows[start : start + (1 << 14)], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)

    names = ["item", "item_id", "doc_id", "score"]
    types = [IntegerType(), item_type, docs.schema["doc_id"].dataType, LongType()]
    schema = StructType([StructField(name, kind) for name, kind in zip(names, types, strict=True)])
    kinds = [field.type for field in to_arrow_schema(schema)]
    source = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 50, sample: int = 16) -> DataFrame:
    """The ``k`` documents of the highest scores above 0 for every item, equal scores by
    ascending doc_id (missing ids last): item_id, rank, doc_id, score.

    A null or empty text, of a document or an item, has no terms: it is in no list and gets
    none, and does not count among the documents. Repeated documents rank each for itself;
    repeated items get one list each. An empty table gives an empty result; other columns are
    ignored. One document in ``sample`` is scored first: the k-th best of these is a floor that
    no listed score is below, which is used to leave out documents early and changes no result.
    """
    item_type = items.schema["item_id"].dataType
    results: list[DataFrame] = []
    blocks = item_blocks(items)
    block = next(blocks, None)
    while block:
        following = next(blocks, None)
        documents, words, held = corpus_counts(docs, block)
        if documents:
            weights = Weights.of(documents, words, held, len(block.numbers))
            few = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(sample)) == 0)
            first = _ranked(_best_of_tasks(few, block, weights, k, [0] * len(block.ids), item_type), k)
            last = first.filter(F.col("rank") == k).select("item", "score").collect()  # at most one row per item
            floors = [0] * len(block.ids)
            for row in last:
                floors[row.item] = row.score
            found = _ranked(_best_of_tasks(docs, block, weights, k, floors, item_type), k)
            found = found.select("item_id", "rank", "doc_id", "score")
            # With several blocks of items, each list is written before the next pass starts.
            results.append(written(found, "ranked")[0] if following or results else found)
        block = following
    if not results:
        kinds = f"item_id {item_type.simpleString()}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long"
        return docs.sparkSession.createDataFrame([], kinds)
    merged = results[0]
    for more in results[1:]:
        merged = merged.unionByName(more)
    return merged
