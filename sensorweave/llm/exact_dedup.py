"""Exact deduplication by counting quotient filters and byte verification.

Every input partition builds counting quotient filters of its texts' 64-bit
fingerprints: the top bits name a block, the next bits (the quotient) a run in it, and
the rest (the remainder) is stored sorted within its run, with a count. Nothing of a
fingerprint is lost, so the filters of a block merge exactly. Fingerprints counted more
than once mark a bitmap of fixed size; rows that hit it are compared by their bytes, all
others are unique at once. A false hit costs one comparison and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorweave.llm.common import whole_text, written

#: Fingerprints of one merged block, on average.
BLOCK_ENTRIES = 1 << 17
#: Fingerprints a task gathers before it emits its filters.
GATHER = 1 << 21
#: Bits of the bitmap of repeated fingerprints: 1 MiB, broadcast in pieces of 4 KiB.
BITMAP_BITS = 1 << 23


class QuotientFilter:
    """Sorted remainders in runs by quotient, with counts. ``block_bits`` top bits are
    the block's number and are not stored."""

    def __init__(self, fingerprints: np.ndarray, counts: np.ndarray):
        self.fingerprints, self.counts = fingerprints, counts  # sorted, distinct

    @classmethod
    def of(cls, fingerprints: np.ndarray) -> QuotientFilter:
        return cls(*np.unique(fingerprints, return_counts=True))

    def dump(self, block_bits: int) -> bytes:
        quotient_bits = max(0, int(len(self.fingerprints)).bit_length() - 3)
        rest = 64 - block_bits - quotient_bits
        quotients = (self.fingerprints >> np.uint64(rest)) & np.uint64((1 << quotient_bits) - 1)
        runs = np.bincount(quotients.astype(np.int64), minlength=1 << quotient_bits)
        remainders = self.fingerprints & np.uint64((1 << rest) - 1)
        head = np.array([quotient_bits, len(remainders)], dtype="<i8")
        parts = [head, runs.astype("<u4"), remainders.astype("<u8"), self.counts.astype("<i8")]
        return b"".join(x.tobytes() for x in parts)

    @classmethod
    def load(cls, raw: bytes, block: int, block_bits: int) -> QuotientFilter:
        quotient_bits, n = np.frombuffer(raw, "<i8", 2).tolist()
        runs = np.frombuffer(raw, "<u4", 1 << quotient_bits, 16)
        remainders = np.frombuffer(raw, "<u8", n, 16 + 4 * len(runs))
        counts = np.frombuffer(raw, "<i8", n, 16 + 4 * len(runs) + 8 * n)
        rest = 64 - block_bits - quotient_bits
        prefix = np.uint64(block << quotient_bits) + np.repeat(np.arange(len(runs), dtype=np.uint64), runs)
        high = prefix << np.uint64(rest) if rest < 64 else np.zeros(n, np.uint64)
        return cls(high | remainders, counts)

    @classmethod
    def merged(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        """The sum of several filters; sorted remainders stay sorted."""
        every = np.concatenate([f.fingerprints for f in filters])
        counts = np.concatenate([f.counts for f in filters])
        order = np.argsort(every, kind="stable")
        every, counts = every[order], counts[order]
        first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]][: len(every)])
        return cls(every[first], np.add.reduceat(counts, first) if len(first) else counts)


def repeated_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """``fp`` and ``n`` of the fingerprints that occur more than once in column ``fp``."""
    rows = fingerprints.count()
    block_bits = max(4, (-(-rows // BLOCK_ENTRIES) - 1).bit_length())

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(held: list[np.ndarray]) -> pa.RecordBatch:
            whole = QuotientFilter.of(np.concatenate(held))
            blocks = (whole.fingerprints >> np.uint64(64 - block_bits)).astype(np.int64)
            edges = np.searchsorted(blocks, np.arange((1 << block_bits) + 1))
            found = np.flatnonzero(np.diff(edges))
            blobs = [
                QuotientFilter(whole.fingerprints[a:b], whole.counts[a:b]).dump(block_bits)
                for a, b in zip(edges[found], edges[found + 1], strict=True)
            ]
            return pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(blobs, pa.binary())], ["block", "filter"])

        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
                size += batch.num_rows
            if size >= GATHER:
                yield emit(held)
                held, size = [], 0
        if held:
            yield emit(held)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        block = int(group["block"].iloc[0])
        whole = QuotientFilter.merged([QuotientFilter.load(raw, block, block_bits) for raw in group["filter"]])
        often = whole.counts > 1
        return pd.DataFrame({"fp": whole.fingerprints[often].view(np.int64), "n": whole.counts[often]})

    filters = fingerprints.mapInArrow(build, "block long, filter binary")
    return filters.groupBy("block").applyInPandas(merge, "fp long, n long")


def _bitmap(repeated: DataFrame) -> DataFrame:
    """At most BITMAP_BITS / 32768 rows of 4 KiB, whatever the number of fingerprints."""
    place = F.pmod("fp", F.lit(BITMAP_BITS))
    return repeated.groupBy(F.bitmap_bucket_number(place).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )


def _routed(docs: DataFrame, payload) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows sure to be unique, rows to compare, and the classes of equal bytes among these."""
    keyed = docs.select(
        F.col("doc_id").alias("id"),
        whole_text().alias("whole"),
        F.xxhash64(whole_text()).alias("fp"),
        payload.alias("payload"),
    )
    repeated, _ = written(repeated_fingerprints(docs.select(F.xxhash64(whole_text()).alias("fp"))), "repeated")
    place = F.pmod("fp", F.lit(BITMAP_BITS))
    at = F.bitmap_bit_position(place)
    # The byte of the bitmap that holds the fingerprint's bit.
    byte = F.conv(F.hex(F.expr("substring(bits, cast(at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    marked = (
        keyed.withColumn("at", at)
        .join(F.broadcast(_bitmap(repeated)), F.bitmap_bucket_number(place) == F.col("piece"), "left")
        .withColumn("hit", F.coalesce(F.getbit(byte, (F.col("at") % 8).cast("int")) == 1, F.lit(False)))
        .withColumn("sha", F.sha2(F.col("whole").cast("binary"), 256))
        .select("id", "whole", "fp", "sha", "payload", "hit")
    )
    unique, doubtful = marked.filter(~F.col("hit")), marked.filter("hit")
    # Grouping by the text itself compares bytes; copies meet in the map-side part first.
    classes = (
        doubtful.groupBy("fp", "whole")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select(
            F.col("fp").alias("class_fp"),
            F.sha2(F.col("whole").cast("binary"), 256).alias("class_sha"),
            "keep_id",
            "group_size",
        )
    )
    return unique, doubtful, classes


def _in_class():
    return (F.col("fp") == F.col("class_fp")) & (F.col("sha") == F.col("class_sha"))


def mark_duplicates(docs: DataFrame) -> DataFrame:
    """Every row with the row of its text that stays.

    Null texts count as empty and equal each other. Of equal texts the largest doc_id
    stays; a null id is smaller than any other, and of rows equal in id and text
    exactly one is marked as kept. Other columns are ignored; an empty table gives an
    empty result.
    """
    unique, doubtful, classes = _routed(docs, F.lit(None))
    first = F.row_number().over(Window.partitionBy("id", "fp", "sha").orderBy("sha"))
    compared = (
        doubtful.select("id", "fp", "sha")
        .withColumn("turn", first)
        .join(classes, _in_class())
        .select(
            F.col("id").alias("doc_id"),
            "keep_id",
            "group_size",
            (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == 1)).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
    )
    alone = unique.select(
        F.col("id").alias("doc_id"),
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    return alone.unionByName(compared)


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows that ``mark_duplicates`` keeps, with all their columns."""
    unique, doubtful, classes = _routed(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    kept = (
        doubtful.join(classes, _in_class() & F.col("id").eqNullSafe(F.col("keep_id")))
        .dropDuplicates(["id", "fp", "sha"])
        .select("payload.*")
    )
    return unique.select("payload.*").unionByName(kept)
