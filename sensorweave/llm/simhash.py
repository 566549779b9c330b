"""Near-duplicate detection with SimHash fingerprints and a popcount grid.

Fingerprints are cut into small segments, and each segment is replaced by its number
of one bits. The Manhattan distance of two such count vectors never exceeds the
Hamming distance of the fingerprints. If it is at most 3, the counts of one half of
the vector differ by at most 1. So each half is a cell of a grid, and fingerprints
meet in equal or neighbouring cells. Two cells at distance 1 have sums of different
parity, hence only cells with an even sum are copied to their neighbours. What meets
in a cell is compared exactly. Only distinct fingerprints take part, and a cell emits
links that span its groups, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.llm.common import slices, text_bytes, written
from sensorweave.llm.components import connected_components

SEED = 42
#: Fingerprints compared at once; larger cells are split into pairs of such blocks.
CELL_BLOCK = 4096


def shingle_hashes(raw: bytes, width: int) -> np.ndarray:
    """Hashes of the shingles of a text's words, repeats included."""
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    shingles = zip(*(words[i:] for i in range(width)), strict=False)
    n = len(words) - width + 1
    return np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, shingles), repeat(SEED)), np.uint64, n)


def fold_bits(hashes: list[np.ndarray]) -> np.ndarray:
    """A fingerprint of each array: the bits set in more than half of its hashes."""
    result = np.zeros(len(hashes), np.uint64)
    full = [i for i, h in enumerate(hashes) if len(h)]
    if not full:
        return result
    sizes = np.array([len(hashes[i]) for i in full])
    flat = np.concatenate([hashes[i] for i in full]).astype("<u8")
    bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.add.reduceat(bits, np.r_[0, np.cumsum(sizes)[:-1]], axis=0, dtype=np.int32)
    ones = (2 * sums > sizes[:, None]).astype(np.uint8)
    result[full] = np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel()
    return result


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id`` and ``fp`` (signed 64 bits) of every whole text; without words it is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            found = fold_bits([shingle_hashes(raw, width) for raw in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    source = docs.select("doc_id", text_bytes().alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, fp long")


def grid_cells(values: np.ndarray, segment: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Cells of each fingerprint and the row each cell belongs to; segment is 1 or 2 bits."""
    one = np.uint64(1)
    counts = values - ((values >> one) & np.uint64(0x5555555555555555)) if segment == 2 else values
    field = np.uint64((1 << segment) - 1)
    rows = np.arange(len(values))
    cells, owners = [], []
    for half in (0, 1):
        own = (counts >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        tag = np.uint64(half << 32)
        cells.append(own | tag)
        owners.append(rows)
        fields = [(own >> np.uint64(s)) & field for s in range(0, 32, segment)]
        even = sum(fields) % np.uint64(2) == 0
        for s, value in zip(range(0, 32, segment), fields, strict=True):
            for can, step in ((value < np.uint64(segment), 1 << s), (value > 0, -(1 << s))):
                at = np.flatnonzero(even & can)
                cells.append((own[at].astype(np.int64) + step).astype(np.uint64) | tag)
                owners.append(at)
    return np.concatenate(cells), np.concatenate(owners)


def spanning_links(keys: np.ndarray, values: np.ndarray, sides: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal (sorted) keys that connect all that is linked there.

    ``sides`` is 0, or 1 and 2 for the halves of a pair of blocks, which are compared
    with each other only.
    """
    n = len(keys)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:n])
    sizes = np.diff(np.r_[starts, n])
    ends = np.repeat(starts + sizes, sizes)
    parent = np.arange(n)
    left: list[int] = []
    right: list[int] = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    active = np.flatnonzero(ends - np.arange(n) > 1)
    gap = 1
    while len(active):
        other = active + gap
        close = np.bitwise_count(values[active] ^ values[other]) <= distance
        close &= (sides[active] == 0) | (sides[active] != sides[other])
        near, far = active[close], other[close]
        while len(near):
            differ = parent[parent[near]] != parent[parent[far]]
            near, far = near[differ], far[differ]
            for a, b in zip(near[:512].tolist(), far[:512].tolist(), strict=True):
                ra, rb = root(a), root(b)
                if ra != rb:
                    parent[max(ra, rb)] = min(ra, rb)
                    left.append(a)
                    right.append(b)
            near, far = near[512:], far[512:]
        gap += 1
        active = active[active + gap < ends[active]]
    return values[left], values[right]


def links(distinct: DataFrame, distance: int = 3, segment: int = 2) -> DataFrame:
    """Pairs ``a``, ``b`` of fingerprints in column ``fp`` that connect all within the distance."""
    if distance > 3:
        raise ValueError("the two halves of the grid find distances up to 3")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16384):
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            cells, owners = grid_cells(values, segment)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells.view(np.int64)), pa.array(values[owners].view(np.int64))], ["cell", "fp"]
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by cell and block; the last run waits for the next batch.
        held: list[np.ndarray] = []

        def emit(rows: np.ndarray) -> pa.RecordBatch:
            keys = np.unique(rows[:3], axis=1, return_inverse=True)[1].ravel()
            a, b = spanning_links(keys, rows[3].view(np.uint64), rows[4], distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if held:
                rows = np.concatenate([held.pop(), rows], axis=1)
            same = (rows[:3] == rows[:3, -1:]).all(axis=0)
            cut = rows.shape[1] - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield emit(rows[:, :cut])
            held.append(rows[:, cut:])
        if held:
            yield emit(held[0])

    placed = distinct.select("fp").mapInArrow(spread, "cell long, fp long")
    placed, _ = written(placed, "cells")
    large = placed.groupBy("cell").count().filter(F.col("count") > CELL_BLOCK)
    large = large.select("cell", F.ceil(F.col("count") / CELL_BLOCK).cast("long").alias("blocks"))
    # A large cell is compared block against block, in as many tasks as there are pairs.
    block = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    pair = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    tiles = (
        placed.join(large, "cell")
        .select("cell", "fp", block.alias("block"), pair)
        .select(
            "cell",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "fp",
            F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).cast("long").alias("side"),
        )
    )
    zero = F.lit(0).cast("long")
    small = placed.join(large, "cell", "left_anti").select("cell", zero.alias("low"), zero.alias("high"), "fp", zero.alias("side"))
    return (
        small.unionByName(tiles)
        .repartition("cell", "low", "high")
        .sortWithinPartitions("cell", "low", "high")
        .mapInArrow(compare, "a long, b long")
        .distinct()
    )


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 3, segment: int = 2) -> DataFrame:
    """Every row with its fingerprint and the smallest doc_id its links reach.

    Texts without words have fingerprint 0 and are linked like any other. Repeated rows
    give repeated results. A null id takes part in links but is never a component's
    id, unless all ids of the component are null. Other columns are ignored.
    """
    rows, _ = written(fingerprints(docs, width), "fingerprints")
    classes, _ = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    joined, _ = written(links(classes, distance, segment), "links")
    stars = connected_components(joined.select(F.col("a").alias("u"), F.col("b").alias("v")))
    linked = stars.join(classes, stars.node == classes.fp).select("fp", "root", "first")
    lowest = linked.groupBy("root").agg(F.min("first").alias("lowest"))
    linked = linked.join(lowest, "root").select(F.col("fp").alias("linked_fp"), "lowest")
    components = classes.join(linked, classes.fp == linked.linked_fp, "left").select(
        "fp", F.coalesce("lowest", "first").alias("component_id")
    )
    return rows.join(components, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, width: int = 3, distance: int = 3, segment: int = 2) -> DataFrame:
    """The rows whose doc_id is the smallest of their component, with all columns.

    Rows that share this id all stay; a component whose ids are all null keeps all rows.
    """
    found = near_duplicates(docs, width, distance, segment)
    # Most rows stay, so only the ids that go are joined to the texts.
    gone = found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    gone, _ = written(gone, "gone")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    kept = docs.select(row, F.col("doc_id").alias("id")).join(gone.select(F.col("doc_id").alias("id")), "id", "left_anti")
    return kept.select("row.*")
