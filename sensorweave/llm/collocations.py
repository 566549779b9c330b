"""Collocations: phrases whose words occur together more often than apart would explain.

Frequent phrases are found by sampling. A sample of the pieces proposes phrases, level by
level, with a lower threshold. One pass over everything then counts every phrase whose first
and last words less one are proposed phrases: these are the proposed phrases and their
negative border, the shortest ones not proposed. Nearly all of the border is rare, so this
pass counts 64-bit hashes, and phrases of one hash together: what is frequent has a frequent
hash. A border phrase of frequent hash is a failure of the sample. A second pass counts
exactly, by their words, the phrases of frequent hash and all phrases built on failures.

Proposed phrases, frequent hashes and failures go to the tasks as bitmaps of bounded size. A
phrase that only seems to be in one is counted needlessly, which changes no result.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorweave.llm.common import dropped, slices, written

#: Longest phrase, in words.
LONGEST = 5
#: Text of one language that is counted together in a task.
BATCH_BYTES = 6 << 20
#: Bits of a bitmap for each phrase, and at most altogether (32 MiB to each executor).
BITS_EACH, MOST_BITS = 16, 1 << 28
#: A sampled phrase is proposed from this share of the count that the threshold leads to expect.
SLACK = 0.6

# Bytes that end a piece become full stops, tabs become spaces, A-Z lower case.
_ENDS = {*b".,;:!?", *range(0x0A, 0x0E)}
PIECE_BYTES = bytes(0x2E if b in _ENDS else 0x20 if b == 0x09 else b for b in range(256)).lower()
END = b"."


def words_and_ends(raw: bytes) -> list[bytes]:
    """Words in order, with a full stop where a piece ends."""
    return raw.translate(PIECE_BYTES).replace(b".", b" . ").split()


class Phrases(list):
    """Phrases, whose hashes are computed once."""

    @cached_property
    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, self, itertools.repeat(42)), np.uint64, len(self))


def hashed(phrases: DataFrame) -> DataFrame:
    """Column ``hash`` of the column ``key``, as ``Phrases`` have it."""
    return phrases.select(F.xxhash64("key").alias("hash"))


@dataclass
class Bitmap:
    """Membership of phrases by two bits of a hash; never misses a member."""

    bits: np.ndarray
    size: int

    def has(self, phrases: list[bytes]) -> np.ndarray:
        hashes = (phrases if isinstance(phrases, Phrases) else Phrases(phrases)).hashes
        found = np.ones(len(hashes), dtype=bool)
        for shift in (0, 32):
            at = (hashes >> np.uint64(shift)) & np.uint64(self.size - 1)
            found &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found

    @classmethod
    def of(cls, phrases: DataFrame) -> Bitmap:
        """Of the column ``hash`` or, without it, ``key``. Only the bitmap's set parts reach the driver."""
        if "hash" not in phrases.columns:
            phrases = hashed(phrases)
        size = min(MOST_BITS, 1 << max(15, (BITS_EACH * phrases.count()).bit_length()))
        places = F.array(*[F.shiftrightunsigned("hash", shift).bitwiseAND(F.lit(size - 1)) + 1 for shift in (0, 32)])
        # Spark's bitmap functions count bits from one.
        spread = phrases.select("hash").select(F.explode(places).alias("at"))
        parts = spread.groupBy(F.bitmap_bucket_number("at").alias("part")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")
        )
        bits = np.zeros(size // 8, dtype=np.uint8)
        for part, some in parts.toLocalIterator():
            bits[(part - 1) * 4096 : part * 4096] = np.frombuffer(some, np.uint8)
        return cls(bits, size)

    @classmethod
    def empty(cls) -> Bitmap:
        return cls(np.zeros(1 << 12, dtype=np.uint8), 1 << 15)


def named(words: list[bytes], lead: bytes, sizes: range, proposed: Bitmap, frequent: Bitmap | None) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """Size, phrases (led by the language) and counts of what a pass has to count in some text.

    Without ``frequent``, the first pass: phrases whose parts, less the last and less the first
    word, are both proposed. With it, the second: those of them that are in ``frequent``, and
    phrases that the first pass left out because a part is frequent but not proposed (a
    failure) or built on such a part.
    """
    numbers: dict[bytes, int] = defaultdict(itertools.count().__next__)
    numbers[END]
    word = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    texts = [lead + w for w in numbers]
    bare = list(numbers)
    counts = np.bincount(word, minlength=len(texts))
    real = np.arange(len(texts)) > 0
    single = Phrases(texts[1:])
    if 1 in sizes:
        yield 1, *_chosen(single, counts[1:], None if frequent is None else frequent.has(single))
    # name[i]: the number of the phrase of the present size that starts at word i, or -1.
    name = np.where(word > 0, word, -1)
    first = np.concatenate([real[:1], proposed.has(single)]) if len(texts) > 1 else real
    tainted = np.zeros(len(texts), dtype=bool)
    if frequent is not None:
        tainted[1:] = frequent.has(single) & ~first[1:]
    for size in range(2, sizes.stop):
        usable = first | tainted
        here, after = name[:-1], name[1:]
        whole = (here >= 0) & (after >= 0)
        whole[whole] = usable[here[whole]] & usable[after[whole]]
        at = np.flatnonzero(whole)
        ending = word[at + size - 1]
        keys, place, often = np.unique(here[at] * len(bare) + ending, return_inverse=True, return_counts=True)
        front, last = np.divmod(keys, len(bare))
        back = np.zeros(len(keys), dtype=np.int64)
        back[place] = after[at]
        made = Phrases([texts[a] + b" " + bare[b] for a, b in zip(front.tolist(), last.tolist(), strict=True)])
        known = first[front] & first[back]  # named by the first pass
        often_met = None if frequent is None else frequent.has(made)
        if size in sizes:
            yield size, *_chosen(made, often, None if frequent is None else often_met | ~known)
        if size + 1 == sizes.stop:
            return
        name = np.full(len(whole), -1)
        name[at] = place
        was, texts = tainted, made
        # Only what the first pass named counts as proposed, also where the bitmap errs.
        first, tainted = proposed.has(made) & known, was[front] | was[back]
        if frequent is not None:
            tainted |= often_met & ~first


def _chosen(phrases: Phrases, counts: np.ndarray, chosen: np.ndarray | None) -> tuple[Phrases, np.ndarray]:
    if chosen is None:
        return phrases, counts
    at = np.flatnonzero(chosen)
    return Phrases([phrases[i] for i in at.tolist()]), counts[at]


def sampled_pieces(docs: DataFrame, share: int) -> DataFrame:
    """One piece in ``share``, drawn by document and place, so that copies draw apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = []
            for seed, raw in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pieces = raw.translate(PIECE_BYTES).split(END)
                mixed = (np.arange(len(pieces), dtype=np.uint64) + np.uint64(seed & (2**64 - 1))) * np.uint64(0x9E3779B97F4A7C15)
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                drawn = np.flatnonzero((mixed >> np.uint64(32)) % np.uint64(share) == 0)
                texts.append(END.join([pieces[i] for i in drawn.tolist()]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["lang", "text"])

    source = docs.select("lang", "text", F.xxhash64("doc_id").alias("seed"))
    return source.mapInArrow(run, "lang string, text binary")


def _passed(docs: DataFrame, sizes: range, proposed: Bitmap, frequent: Bitmap | None, by_hash: bool = False) -> DataFrame:
    """What ``named`` gives for all texts, some text at a time: ``key`` (language, tab and phrase)
    and n, with the word occurrences of each language if ``sizes`` begin at 1. With ``by_hash``
    the key's hash takes its place, and word occurrences are left out."""
    sent = docs.sparkSession.sparkContext.broadcast((proposed, frequent))
    name, kind = ("hash", "long") if by_hash else ("key", "binary")

    def count(lang: str, raws: list[bytes]) -> Iterator[pa.RecordBatch]:
        # A full stop between texts, so that no phrase runs from one into the next.
        words = words_and_ends(END.join(raws))
        lead = lang.encode() + b"\t"
        parts: Iterator[tuple[int, list[bytes], np.ndarray]] = named(words, lead, sizes, *sent.value)
        if 1 in sizes and not by_hash:
            total = np.array([len(words) - words.count(END)])
            parts = itertools.chain([(0, [lead], total)], parts)
        for _, phrases, often in parts:
            for at in range(0, len(phrases), 1 << 16):
                stop = at + (1 << 16)
                some = pa.array(phrases.hashes[at:stop].view(np.int64)) if by_hash else pa.array(phrases[at:stop], pa.binary())
                yield pa.RecordBatch.from_arrays([some, pa.array(often[at:stop], pa.int64())], [name, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in slices(batches):
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.setdefault(lang, []).append(raw)
                size += len(raw)
                if size >= BATCH_BYTES:
                    for some, raws in held.items():
                        yield from count(some, raws)
                    held, size = {}, 0
        for some, raws in held.items():
            yield from count(some, raws)

    return docs.select("lang", "text").mapInArrow(run, f"{name} {kind}, n long")


def frequent_hashes(docs: DataFrame, proposed: Bitmap, least: int) -> DataFrame:
    """Column ``hash``: all hashes that the phrases of the first pass have ``least`` times or more."""
    sums = _passed(docs, range(1, LONGEST + 1), proposed, None, by_hash=True).groupBy("hash").agg(F.sum("n").alias("n"))
    return sums.filter(F.col("n") >= least).select("hash")


def counted(docs: DataFrame, sizes: range, proposed: Bitmap, frequent: Bitmap | None, least: int) -> DataFrame:
    """Phrases that a pass counts and that occur ``least`` times or more: lang, size, key, n.
    ``key`` is language, tab and phrase; size 0 holds all word occurrences of the language."""
    # Only keys and counts are shuffled; the rest is read off the keys that stay.
    rows = _passed(docs, sizes, proposed, frequent)
    sums = rows.groupBy("key").agg(F.sum("n").alias("n")).withColumn("key", F.col("key").cast("string"))
    phrase = F.substring_index("key", "\t", -1)
    size = F.when(phrase == "", 0).otherwise(F.char_length(phrase) - F.char_length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1)
    lang = F.expr("substring(key, 1, char_length(key) - char_length(substring_index(key, '\t', -1)) - 1)")
    kept = sums.filter((F.col("n") >= least) | F.col("key").endswith("\t"))
    return kept.select(lang.alias("lang"), size.alias("size"), "key", "n")


def frequent_phrases(docs: DataFrame, least: int = 100, share: int = 8) -> DataFrame:
    """All phrases of up to ``LONGEST`` words that occur ``least`` times or more in a language,
    with exact counts: lang, size, key, n (size 0: all word occurrences of the language).

    The sample holds one piece in ``share``; any share gives the same result. The table is
    written to the shared folder.
    """
    spark = docs.sparkSession
    source = docs.select(
        "doc_id",
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    sample, sample_path = written(sampled_pieces(source, share), "sampled-pieces")
    low = max(2, math.floor(SLACK * least / share))
    proposed, levels, paths = Bitmap.empty(), [], [sample_path]
    for size in range(1, LONGEST):
        # A longest phrase needs no proposal: it is part of the border or not counted.
        level, path = written(counted(sample, range(size, size + 1), proposed, None, low).filter("size > 0"), f"proposed-{size}")
        levels.append(level)
        paths.append(path)
        proposed = Bitmap.of(_all(levels))
    # One expansion closes the set: with what is frequent, it counts every phrase that contains a
    # failure and occurs with parts that may be frequent, so that what stays uncounted is rare.
    hashes, path = written(frequent_hashes(source, proposed, least), "frequent-hashes")
    paths.append(path)
    found, _ = written(counted(source, range(1, LONGEST + 1), proposed, Bitmap.of(hashes), least), "phrases")
    dropped(spark, *paths)
    return found


def _all(frames: list[DataFrame]) -> DataFrame:
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return merged


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, covered: int = 100, share: int = 8) -> DataFrame:
    """The ``top`` phrases of two to five words per language by their score: lang, rank, phrase,
    a, l, r, n, score.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of the cut with the lowest score
    (ties: the shortest first part), ``n`` all words of the language. Phrases with fewer than
    ``least`` occurrences are no candidates; one inside a longer candidate with at least
    ``covered`` percent of its occurrences is dropped. Order: score and a descending, phrase
    by bytes. A null text counts as empty, a null lang as ``und``; repeated rows count each; an
    empty table gives an empty result; other columns are ignored. Counts that a product of
    38 digits does not hold are an error, not a wrong result.
    """
    phrases = frequent_phrases(docs, least, share)
    totals = phrases.filter("size = 0").select("lang", F.col("n").alias("total"))
    parts = phrases.filter("size > 0").select("lang", F.substring_index("key", "\t", -1).alias("phrase"), "size", "n")
    candidates = parts.filter("size > 1").withColumn("words", F.split("phrase", " "))

    def joined(first, length):
        return F.array_join(F.slice("words", first, length), " ")

    cuts = candidates.select(
        "lang", "phrase", F.col("n").alias("a"), "size", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("front"), joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    fronts = parts.select("lang", F.col("phrase").alias("front"), F.col("n").alias("l"))
    rests = parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    score = F.expr(
        "(CAST(a AS DECIMAL(19, 0)) * CAST(total AS DECIMAL(19, 0)) * CAST(1000 AS DECIMAL(4, 0)))"
        " div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))"
    )
    scored = cuts.join(fronts, ["lang", "front"]).join(rests, ["lang", "rest"]).join(F.broadcast(totals), "lang")
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "l", "r", "a", "total")).alias("cut"))

    inner = candidates.filter("size > 2").select("lang", F.col("n").alias("longer"), "size", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length"))
    inner = inner.withColumn("first", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
    inside = inner.groupBy("lang", joined(F.col("first"), F.col("length")).alias("phrase")).agg(F.max("longer").alias("longer"))
    kept = lowest.join(inside, ["lang", "phrase"], "left").filter(F.expr(f"longer IS NULL OR 100 * longer < {covered} * cut.a"))

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    listed = kept.select("lang", "phrase", "cut.a", "cut.l", "cut.r", F.col("cut.total").alias("n"), "cut.score")
    # First within shares of a language, so that no task sorts all its phrases.
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = F.row_number().over(Window.partitionBy("lang", "some").orderBy(*order))
    listed = listed.withColumn("some", F.pmod(F.xxhash64("phrase"), F.lit(shares))).withColumn("place", some).filter(F.col("place") <= top)
    ranked = listed.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
