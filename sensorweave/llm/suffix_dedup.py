"""Removal of byte strings that also start in an earlier document.

Only the first ``width`` bytes of a suffix matter here, so the suffix order is needed to
that depth alone, and suffixes with different prefixes never have to meet. Each window of
``width`` bytes is dealt to a bucket by the smallest hash of the ``ANCHOR``-byte strings
in it, a function of its content: equal windows share a bucket. Neighbouring windows
mostly share their smallest hash and travel as one run of text. Within a bucket, runs
whose smallest hash occurs in several documents are sorted by a difference cover modulo 3:
sampled suffixes are named by triples, names by triples of names and so on to the full
depth, the remaining suffixes follow from one byte and the name after it, and both orders
are merged. Suffixes with equal prefixes form a class; its smallest document keeps the
bytes.

A hash with very many runs, as of a passage that many documents share amid text of their
own, would fill one bucket. Its windows are dealt by their whole content instead.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.llm.common import release_shuffles, slices, text_bytes, written

#: Bytes of the strings whose hashes deal out windows.
ANCHOR = 16
#: Text a task gathers before it emits runs; equal runs within it are combined.
GATHER_BYTES = 4 << 20
#: Text per bucket on average.
BUCKET_BYTES = 8 << 20
#: Text sorted at once within a bucket.
SORT_BYTES = 1 << 19
#: Text of the documents whose ranges to remove are merged together, on average.
MERGE_BYTES = 32 << 20
#: Hashes computed at once.
HASH_STEP = 1 << 18
#: Runs of one hash from which its windows are dealt by their whole content instead, and
#: one in how many documents is counted to find such hashes.
HOT_RUNS = 1 << 15
HOT_SAMPLE = 64
#: Windows of one run at most; periodic text would make runs of any length.
RUN_WINDOWS = 256


def anchor_hashes(buffer: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the ANCHOR bytes from each position; the buffer is padded."""
    n = len(buffer) - 16
    eight = np.ndarray((n + 8,), dtype="<u8", buffer=buffer, strides=(1,))
    result = np.empty(n, np.uint32)
    for at in range(0, n, HASH_STEP):  # in steps, for the memory
        stop = min(n, at + HASH_STEP)
        mixed = eight[at:stop] * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed += eight[at + 8 : stop + 8]
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        result[at:stop] = mixed >> np.uint64(32)
    return result


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def window_runs(texts: list[bytes], width: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts as runs of one smallest hash: the joined texts, and of
    each run its text's number, start, windows and hash."""
    joined = b"".join(texts)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    empty = np.zeros(0, np.int64)
    if len(joined) < width:
        return joined, empty, empty, empty, empty
    smallest = sliding_minimum(anchor_hashes(np.frombuffer(joined + bytes(16), np.uint8)), width - ANCHOR + 1)
    smallest = smallest[: len(joined) - width + 1]
    # Each text's windows start a run and end one, and so does every RUN_WINDOWS-th window.
    starts = np.cumsum(lengths) - lengths
    long = lengths >= width
    first, stop = starts[long], (starts + lengths - width + 1)[long]
    inside = np.zeros(len(smallest) + 1, np.int8)
    inside[first] += 1
    inside[stop] -= 1
    valid = np.cumsum(inside[:-1], dtype=np.int8) > 0
    begin = np.r_[True, smallest[1:] != smallest[:-1]]
    begin[first] = True
    begin[stop[stop < len(begin)]] = True
    at = np.flatnonzero(begin)
    sizes = np.diff(np.r_[at, len(begin)])
    pieces = -(-sizes // RUN_WINDOWS)
    if (pieces > 1).any():
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = np.repeat(at, pieces) + nth * RUN_WINDOWS
        sizes = np.diff(np.r_[at, len(begin)])
    keep = valid[at]
    at, sizes = at[keep], sizes[keep]
    return joined, np.searchsorted(starts, at, side="right") - 1, at, sizes, smallest[at]


def rank_of(*parts: np.ndarray) -> np.ndarray:
    """Dense ranks of tuples, given by their parts."""
    key = parts[0].astype(np.int64)
    for part in parts[1:]:
        span = int(part.max()) + 1
        if int(key.max()) >= (1 << 62) // span:
            key = np.unique(key, return_inverse=True)[1]
        key = key * span + part
    return np.unique(key, return_inverse=True)[1]


def window_classes(strings: list[bytes], width: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the windows' equality classes, in order of the strings and their
    windows, and the number of windows of each string; by a difference cover modulo 3."""
    sizes = np.array([len(s) - width + 1 for s in strings], dtype=np.int64)
    text = np.frombuffer(b"".join(strings) + bytes(width + 27), np.uint8).astype(np.int64)
    n = len(text) - width - 27
    places = np.arange(n)
    sample = places[places % 3 != 0]
    # Names of 3, 9 and 27 bytes: triples of bytes, of names, and of names of names.
    # Steps are multiples of 3, so a sampled place leads to sampled places.
    names = np.zeros(len(text) + 27, np.int64)
    names[sample] = rank_of(text[sample], text[sample + 1], text[sample + 2])
    for step in (3, 9):
        names[sample] = rank_of(names[sample], names[sample + step], names[sample + 2 * step])
    reach = (width - 2 - 27) // 3 * 3  # the second name ends 0 to 2 bytes before width - 2
    short, middle, full = (np.zeros(len(text), np.int64) for _ in range(3))
    tail = [text[sample + i] for i in range(reach + 27, width - 2)]
    short[sample] = rank_of(names[sample], names[sample + reach], *tail)
    middle[sample] = rank_of(short[sample], text[sample + width - 2])
    full[sample] = rank_of(middle[sample], text[sample + width - 1])
    # The rest: one byte and the next name. Merged by what precedes the nearest sample.
    rest = places[places % 3 == 0]
    span = np.int64(max(short.max(), middle.max()) + 1)
    one = text[rest] * span + middle[rest + 1]
    two = (text[rest] * 256 + text[rest + 1]) * span + short[rest + 2]
    found = np.full(len(rest), -1, np.int64)
    for residue, wanted in ((1, one), (2, two)):
        own = places[places % 3 == residue]
        own = own[np.argsort(full[own], kind="stable")]
        if not len(own):
            continue
        if residue == 1:
            keys = text[own] * span + middle[own + 1]
        else:
            keys = (text[own] * 256 + text[own + 1]) * span + short[own + 2]
        at = np.minimum(np.searchsorted(keys, wanted), len(own) - 1)
        same = (keys[at] == wanted) & (found < 0)
        found[same] = full[own[at[same]]]
    fresh = found < 0
    if fresh.any():
        found[fresh] = full.max() + 1 + rank_of(one[fresh])
    full[rest] = found
    starts = np.cumsum(sizes + width - 1) - (sizes + width - 1)
    windows = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return full[windows], sizes


def covered(removed: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the byte runs covered by marked windows."""
    edges = np.flatnonzero(np.diff(np.r_[0, removed.astype(np.int8), 0]))
    return edges[::2], edges[1::2] + width - 1


def narrow(values: np.ndarray) -> np.ndarray:
    """The same non-negative numbers in as few bytes as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


class Gathered:
    """Runs of a task's documents, combined and dealt to buckets."""

    def __init__(self, buckets: int, width: int, hot: np.ndarray):
        self.buckets, self.width, self.hot = buckets, width, hot

    def __call__(self, ids: np.ndarray, hashes: np.ndarray, texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
        joined, doc, at, sizes, smallest = window_runs(texts, self.width)
        if len(self.hot):
            cool = ~np.isin(smallest, self.hot)
            doc, at, sizes, smallest = doc[cool], at[cool], sizes[cool], smallest[cool]
        if not len(doc):
            return
        base = np.cumsum([0, *map(len, texts)])
        spare = self.width - 1
        strings = [joined[a:b] for a, b in zip(at.tolist(), (at + sizes + spare).tolist(), strict=True)]
        # Equal runs of several documents: those of the smallest one travel on, the
        # others are covered by it.
        order = np.argsort(ids[doc], kind="stable")
        owner: dict[bytes, int] = {}
        own_ids = ids[doc].tolist()
        keep = np.zeros(len(doc), bool)
        for i in order.tolist():
            keep[i] = owner.setdefault(strings[i], own_ids[i]) == own_ids[i]
        # Minima are small numbers: mixed again, they spread evenly over the buckets.
        mixed = (smallest * np.uint32(0x9E3779B1)).astype(np.uint64)
        bucket = (mixed * np.uint64(self.buckets) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        pack = zstandard.ZstdCompressor(level=3)
        for b in np.flatnonzero(np.diff(edges)).tolist():
            some = order[edges[b] : edges[b + 1]]
            gone, some = some[~keep[some]], some[keep[some]]
            # Sorted strings compress best; their hashes are computed again on arrival.
            some = np.array(sorted(some.tolist(), key=strings.__getitem__), dtype=np.int64)
            used, local = np.unique(doc[np.r_[some, gone]], return_inverse=True)
            place = (at - base[doc])
            content = (
                int(ids[used].min()),
                narrow(ids[used] - ids[used].min()),
                hashes[used],
                narrow(local[: len(some)]),
                narrow(place[some]),
                narrow(sizes[some]),
                b"".join([strings[i] for i in some.tolist()]),
                narrow(local[len(some) :]),
                narrow(place[gone]),
                narrow(sizes[gone]),
            )
            yield b, pack.compress(pickle.dumps(content, protocol=5))


def smallest_hashes(joined: bytes, lengths: np.ndarray) -> np.ndarray:
    """The smallest anchor hash of each string: a run's own, as all its windows share it."""
    result = np.empty(len(lengths), np.uint32)
    stops = np.cumsum(lengths)
    at = 0
    while at < len(lengths):  # in pieces, for the memory
        begin = int(stops[at] - lengths[at])
        upto = max(at + 1, int(np.searchsorted(stops, begin + SORT_BYTES)))
        hashes = anchor_hashes(np.frombuffer(joined[begin : int(stops[upto - 1])] + bytes(16), np.uint8))
        ends = stops[at:upto] - begin
        for back in range(1, ANCHOR):
            hashes[ends - back] = np.uint32(0xFFFFFFFF)
        result[at:upto] = np.minimum.reduceat(hashes, ends - lengths[at:upto])
        at = upto
    return result


def parts_by_hash(strings: list[bytes], hashes: np.ndarray) -> Iterator[list[int]]:
    """Numbers of strings that share their hash, hash by hash, about SORT_BYTES at a time."""
    order = np.argsort(hashes, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(hashes[order]) != 0])
    part: list[int] = []
    size = 0
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        if b - a > 1:
            own = order[a:b].tolist()
            part += own
            size += sum(len(strings[i]) for i in own)
            if size >= SORT_BYTES:
                yield part
                part, size = [], 0
    if part:
        yield part


def window_hashes(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each window's bytes, in order of the strings and their windows, and
    the number of windows of each string."""
    sizes = np.array([len(s) - width + 1 for s in strings], dtype=np.int64)
    joined = b"".join(strings)
    eight = np.ndarray((len(joined),), dtype="<u8", buffer=joined + bytes(8), strides=(1,))
    n = len(joined) - width + 1
    mixed = np.zeros(n, np.uint64)
    for at in (*range(0, width - 8, 8), width - 8):
        mixed ^= eight[at : at + n]
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    starts = np.cumsum(sizes + width - 1) - (sizes + width - 1)
    return mixed[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())], sizes


def with_shared_windows(strings: list[bytes], holders: np.ndarray, width: int) -> np.ndarray:
    """Places of the strings with a window that one of another holder may hold too: its hash
    occurs under several holders. No other string can take part in what sorting finds."""
    hashes, sizes = window_hashes(strings, width)
    holder = np.repeat(holders, sizes)
    order = np.argsort(hashes)
    ordered, holder = hashes[order], holder[order]
    differs = (ordered[1:] != ordered[:-1]) | (holder[1:] == holder[:-1])
    # Neighbours of one hash and two holders mark the hash: all its windows count.
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    marked = np.add.reduceat(np.r_[~differs, False].astype(np.int64), first) > 0
    shared = np.zeros(len(hashes), bool)
    shared[order] = np.repeat(marked, np.diff(np.r_[first, len(ordered)]))
    return np.flatnonzero(np.logical_or.reduceat(shared, np.cumsum(sizes) - sizes))


def packed_by_part(ids: np.ndarray, hashes: np.ndarray, which: np.ndarray, start: np.ndarray, stop: np.ndarray, parts: int) -> pd.DataFrame:
    """Ranges of documents (``which``: their numbers), one row per part of the documents."""
    mixed = (ids.astype(np.uint64) + hashes.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    part = ((mixed >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)[which]
    order = np.lexsort((which, part))
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    pack = zstandard.ZstdCompressor(level=3)
    rows = []
    for p in np.flatnonzero(np.diff(edges)).tolist():
        some = order[edges[p] : edges[p + 1]]
        used, local = np.unique(which[some], return_inverse=True)
        content = ids[used], hashes[used], narrow(local), narrow(start[some]), narrow(stop[some] - start[some])
        rows.append((p, pack.compress(pickle.dumps(content, protocol=5))))
    return pd.DataFrame(rows, columns=["part", "ranges"])


def merge_part(blobs: list[bytes]) -> pd.DataFrame:
    """The ranges of one part's documents from all buckets: one row per document, merged."""
    unpack = zstandard.ZstdDecompressor()
    found = [pickle.loads(unpack.decompress(blob)) for blob in blobs]
    ids, hashes = (np.concatenate([f[i][f[2]] for f in found]) for i in (0, 1))
    start, length = (np.concatenate([f[i] for f in found]).astype(np.int64) for i in (3, 4))
    order = np.lexsort((start, hashes, ids))
    ids, hashes, start, stop = ids[order], hashes[order], start[order], (start + length)[order]
    new = np.r_[True, (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])]
    # Documents follow each other on one line, so that no range reaches into the next one.
    base = np.cumsum(new) * (stop.max() + 1)
    reach = np.maximum.accumulate(stop + base)
    fresh = np.r_[True, (start + base)[1:] > reach[:-1]]
    last = np.r_[fresh[1:], True]
    ranges = np.stack([start[fresh], (reach - base)[last]], axis=1).astype("<i8")
    first = np.flatnonzero(new)
    bounds = np.r_[np.flatnonzero(new[fresh]), len(ranges)].tolist()
    return pd.DataFrame(
        {"id": ids[first], "hash": hashes[first], "ranges": [ranges[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]}
    )


def settle_bucket(blobs: list[bytes], width: int, parts: int) -> pd.DataFrame:
    """Byte ranges to remove, by part of the documents, from the runs of one bucket."""
    spare = width - 1
    unpack = zstandard.ZstdDecompressor()
    contents = [pickle.loads(unpack.decompress(blob)) for blob in blobs]
    shift = np.cumsum([0] + [len(p[2]) for p in contents])
    ids = np.concatenate([p[0] + p[1].astype(np.int64) for p in contents])
    hashes = np.concatenate([p[2] for p in contents])
    doc = np.concatenate([p[3].astype(np.int64) + s for p, s in zip(contents, shift)])
    place, sizes = (np.concatenate([p[i] for p in contents]).astype(np.int64) for i in (4, 5))
    joined = b"".join([p[6] for p in contents])
    gone_place, gone_sizes = (np.concatenate([p[i] for p in contents]).astype(np.int64) for i in (8, 9))
    gone = [
        np.concatenate([p[7].astype(np.int64) + s for p, s in zip(contents, shift)]),
        gone_place,
        gone_place + gone_sizes + spare,
    ]
    del contents
    smallest = smallest_hashes(joined, sizes + spare)
    out_doc, out_start, out_stop = [gone[0]], [gone[1]], [gone[2]]
    if len(doc):
        # Only hashes met in several documents can hold windows met in several.
        order = np.argsort(smallest, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(smallest[order]) != 0])
        own = ids[doc]
        several = np.minimum.reduceat(own[order], first) != np.maximum.reduceat(own[order], first)
        some = order[np.repeat(several, np.diff(np.r_[first, len(order)]))]
        starts = np.cumsum(sizes + spare) - (sizes + spare)
        numbers: dict[bytes, int] = {}
        number = np.array(
            [
                numbers.setdefault(joined[a:b], len(numbers))
                for a, b in zip(starts[some].tolist(), (starts + sizes + spare)[some].tolist(), strict=True)
            ],
            dtype=np.int64,
        )
        if len(some):
            lowest = np.full(len(numbers), np.iinfo(np.int64).max)
            np.minimum.at(lowest, number, own[some])
            # Runs with other runs of the same hash are sorted, suffix by suffix; classes
            # never span hashes, so a part of the hashes is sorted at a time.
            hash_of = np.zeros(len(numbers), np.uint32)
            hash_of[number] = smallest[some]
            every = list(numbers)
            earlier: dict[int, np.ndarray] = {}
            for part in parts_by_hash(every, hash_of):
                # Most windows share no more than an anchor with others; only strings with a shared one are sorted.
                part = [part[i] for i in with_shared_windows([every[i] for i in part], lowest[part], width).tolist()]
                if not part:
                    continue
                classes, windows = window_classes([every[i] for i in part], width)
                holder = np.repeat(lowest[part], windows)
                best = np.full(int(classes.max()) + 1, np.iinfo(np.int64).max)
                np.minimum.at(best, classes, holder)
                less = best[classes] < holder
                edges = np.cumsum(np.r_[0, windows])
                for i in np.flatnonzero(np.add.reduceat(less, edges[:-1])).tolist():
                    earlier[part[i]] = less[edges[i] : edges[i + 1]]
            later = own[some] > lowest[number]
            out_doc.append(doc[some[later]])
            out_start.append(place[some[later]])
            out_stop.append((place + sizes + spare)[some[later]])
            if earlier:
                in_part = np.isin(number, np.fromiter(earlier, np.int64)) & ~later
                for i, u in zip(some[in_part].tolist(), number[in_part].tolist(), strict=True):
                    a, b = covered(earlier[u], width)
                    out_doc.append(np.full(len(a), doc[i]))
                    out_start.append(a + place[i])
                    out_stop.append(b + place[i])
    which, start, stop = np.concatenate(out_doc), np.concatenate(out_start), np.concatenate(out_stop)
    return packed_by_part(ids, hashes, which, start, stop, parts)


def hot_hashes(keyed: DataFrame, width: int) -> np.ndarray:
    """Sorted hashes of about HOT_RUNS runs or more, from every HOT_SAMPLE-th document.

    Which hashes these are decides how their windows travel, not what is found. There is
    at most one for each HOT_RUNS / 2 runs of the input.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            found, runs = np.unique(window_runs(batch.column(0).to_pylist(), width)[4], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(runs)], ["smallest", "runs"])

    sample = keyed.filter(F.pmod(F.xxhash64("id", F.hash("text")), F.lit(HOT_SAMPLE)) == 0).select("text")
    runs = sample.mapInArrow(count, "smallest long, runs long").groupBy("smallest").agg(F.sum("runs").alias("runs"))
    hot = runs.filter(F.col("runs") * (2 * HOT_SAMPLE) >= HOT_RUNS).select("smallest").collect()
    return np.array(sorted(r[0] for r in hot), dtype=np.uint32)


def hot_windows(
    ids: np.ndarray, texts: list[bytes], width: int, hot: np.ndarray
) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, bytes]]]:
    """Of the windows in runs of hot hashes: ranges (text's number, start, stop) of those
    that an earlier of these texts holds, and the others (text's number, start, window)."""
    joined, doc, at, sizes, smallest = window_runs(texts, width)
    some = np.flatnonzero(np.isin(smallest, hot))
    base = np.cumsum([0, *map(len, texts)])
    least: dict[bytes, int] = {}
    gone, kept = [], []
    for i in some[np.argsort(ids[doc[some]], kind="stable")].tolist():
        d, first = int(doc[i]), int(at[i])
        own, place = int(ids[d]), first - int(base[d])
        windows = [joined[p : p + width] for p in range(first, first + int(sizes[i]))]
        later = np.array([least.setdefault(w, own) < own for w in windows])
        gone += [(d, a + place, b + place) for a, b in zip(*(x.tolist() for x in covered(later, width)), strict=True)]
        kept += [(d, place + k, windows[k]) for k in np.flatnonzero(~later).tolist()]
    return gone, kept


def hot_ranges(keyed: DataFrame, width: int, hot: np.ndarray) -> DataFrame:
    """Packed ranges of windows of hot hashes. What a gather settles goes out straight; the
    smallest id of every other window is combined before and after a shuffle by content."""
    sent = keyed.sparkSession.sparkContext.broadcast(hot)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        hashes: list[int] = []
        texts: list[bytes] = []
        size = 0

        def emit() -> Iterator[pa.RecordBatch]:
            gone, kept = hot_windows(np.array(ids, np.int64), texts, width, sent.value)
            rows = [(d, a, b, None) for d, a, b in gone] + [(d, a, a + width, w) for d, a, w in kept]
            for begin in range(0, len(rows), 8192):
                which, start, stop, windows = zip(*rows[begin : begin + 8192], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[d] for d in which], pa.int64()),
                        pa.array([hashes[d] for d in which], pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(stop, pa.int64()),
                        pa.array(windows, pa.binary()),
                    ],
                    ["id", "hash", "start", "stop", "window"],
                )

        for batch in slices(batches, 64):
            for one, mark, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids.append(one)
                hashes.append(mark)
                texts.append(text)
                size += len(text)
                if size >= GATHER_BYTES // 4:  # single windows take more memory than runs
                    yield from emit()
                    ids, hashes, texts, size = [], [], [], 0
        if texts:
            yield from emit()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = np.stack([batch.column(i).to_numpy() for i in (2, 3)], axis=1).astype("<i8")
            ranges = pa.array([row.tobytes() for row in both], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ranges], ["id", "hash", "ranges"])

    rows = keyed.select("id", F.hash("text").alias("hash"), "text")
    found, _ = written(rows.mapInArrow(gather, "id long, hash int, start long, stop long, window binary"), "hot")
    waiting = found.filter("window is not null")
    least = waiting.groupBy("window").agg(F.min("id").alias("least"))
    later = waiting.join(least, "window").filter("id > least").select("id", "hash", "start", "stop")
    settled = found.filter("window is null").select("id", "hash", "start", "stop")
    return settled.unionByName(later).mapInArrow(packed, "id long, hash int, ranges binary")


def removed_ranges(docs: DataFrame, width: int = 50) -> DataFrame:
    """Packed byte ranges to remove, in pieces: ``id``, ``hash`` of the text, ``ranges``."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("id"), text_bytes().alias("text")).filter(
        F.col("id").isNotNull() & (F.octet_length("text") >= width)
    )
    total = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, int(-(-total // BUCKET_BYTES)))
    parts = max(16, int(-(-total // MERGE_BYTES)))
    hot = hot_hashes(keyed, width)
    sent = docs.sparkSession.sparkContext.broadcast(hot)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal = Gathered(buckets, width, sent.value)
        ids: list[int] = []
        hashes: list[int] = []
        texts: list[bytes] = []
        size = 0

        def emit() -> pa.RecordBatch:
            rows = list(deal(np.array(ids, np.int64), np.array(hashes, np.int32), texts))
            return pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["bucket", "runs"]
            )

        for batch in slices(batches, 64):
            for one, mark, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids.append(one)
                hashes.append(mark)
                texts.append(text)
                size += len(text)
                if size >= GATHER_BYTES:
                    yield emit()
                    ids, hashes, texts, size = [], [], [], 0
        if texts:
            yield emit()

    def settle(group: pd.DataFrame) -> pd.DataFrame:
        return settle_bucket(group["runs"].tolist(), width, parts)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        return merge_part(group["ranges"].tolist())

    runs = keyed.select("id", F.hash("text").alias("hash"), "text").mapInArrow(gather, "bucket int, runs binary")
    settled = runs.groupBy("bucket").applyInPandas(settle, "part int, ranges binary")
    ranges = settled.groupBy("part").applyInPandas(merge, "id long, hash int, ranges binary")
    return ranges.unionByName(hot_ranges(keyed, width, hot)) if len(hot) else ranges


def merged_ranges(blobs: list[bytes]) -> list[tuple[int, int]]:
    """Maximal runs of bytes in packed ranges."""
    ranges = np.frombuffer(b"".join(blobs), "<i8").reshape(-1, 2)
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    if not len(ranges):
        return []
    reach = np.maximum.accumulate(ranges[:, 1])
    fresh = np.r_[True, ranges[1:, 0] > reach[:-1]]
    last = np.r_[fresh[1:], True]
    return list(zip(ranges[fresh, 0].tolist(), reach[last].tolist(), strict=True))


def remove_repeats(docs: DataFrame, width: int = 50) -> DataFrame:
    """Every row with the spans removed and ``kept`` (bytes) of its text.

    A byte goes if it lies in a ``width``-byte string that also starts in a row with a
    smaller doc_id. Null texts are empty. Repeated rows of one id do not affect each
    other and are treated alike. A row without id is neither changed nor a reason to
    change others. Texts shorter than ``width`` stay. Other columns are ignored.
    """
    ranges = removed_ranges(docs, width).groupBy("id", "hash").agg(F.collect_list("ranges").alias("ranges"))
    # Written, so that the shuffled runs can go before the texts are shuffled.
    ranges, _ = written(ranges, "ranges")
    release_shuffles(docs.sparkSession)
    source = docs.select("doc_id", text_bytes().alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    joined = source.join(
        ranges, (F.col("doc_id").cast("long") == F.col("id")) & (F.hash("text") == F.col("hash")), "left"
    ).select("doc_id", "text", "ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spans, kept = [], []
            for raw, blobs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = merged_ranges(blobs or [])
                spans.append([{"start": a, "stop": b} for a, b in own])
                edges = [0, *(x for span in own for x in span), len(raw)]
                kept.append(b"".join([raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in batch.column(1).to_pylist()], pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                    pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    return joined.mapInArrow(
        cut, f"doc_id {id_type}, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary"
    )


def repeat_report(docs: DataFrame, width: int = 50) -> DataFrame:
    found = remove_repeats(docs, width)
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
