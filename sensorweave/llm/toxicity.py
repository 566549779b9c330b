"""Toxicity by weak supervision.

Labelled rows yield terms (words and word beginnings) that mark toxic texts far more
often than chance allows. Terms are spread over lexicon voters (words) and pattern
voters (beginnings), and one voter speaks for clean texts. A generative model
estimates the voters' accuracies and correlations on all training documents; labelled
ones keep their label, which ties the classes it finds to the one meant. Its posteriors
train a linear classifier over the terms, which scores.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sensorweave.llm.common import slices, whole_text
from sensorweave.llm.simhash import shingle_hashes
from sensorweave.llm.weak_labels import bounded_sample, expectation_maximisation, fit_logistic, vote_counts

#: Labelled rows that terms are mined from, and documents the classifier is fitted on.
SAMPLE_ROWS = 8000
#: Terms kept, by how far they are from chance (in standard deviations, at least LEAST_Z).
TERMS = 1024
LEAST_Z = 5.0
#: The least share of toxic texts among those that hold a term.
LEAST_SHARE = 0.75
BEGINNINGS = (4, 5, 6)
LEXICON_VOTERS = PATTERN_VOTERS = 6
WORD = re.compile(r"[^\W\d_]+")
KEYS = ("order_1", "order_2", "order_3")
ORDERS = np.array([1, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)


def terms_of(text: str) -> set[str]:
    """Words; beginnings of longer words, marked by a trailing hyphen; and beginnings
    that several different words share, marked by an equals sign."""
    words = set(WORD.findall(text.lower()))
    terms = set(words)
    for n in BEGINNINGS:
        starts = Counter(w[:n] for w in words if len(w) > n)
        terms.update(s + "-" for s in starts)
        terms.update(s + "=" for s, k in starts.items() if k > 1)
    return terms


def signed_z(hits_1: np.ndarray, hits_0: np.ndarray, n_1: float, n_0: float) -> np.ndarray:
    """Signed root of the likelihood ratio of a term's frequency in both classes."""
    hits, n = hits_1 + hits_0, n_1 + n_0

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12))

    ratio = part(hits_1, hits * n_1 / n) + part(hits_0, hits * n_0 / n)
    ratio += part(n_1 - hits_1, (n - hits) * n_1 / n) + part(n_0 - hits_0, (n - hits) * n_0 / n)
    return np.sign(hits_1 / max(n_1, 1) - hits_0 / max(n_0, 1)) * np.sqrt(2 * np.maximum(ratio, 0))


def without_copies(frame: DataFrame) -> DataFrame:
    """One row of each group of near copies, whose words would look far from chance:
    rows that share the smallest hash of their five-word shingles under any of three
    orders. Meant for bounded samples; ``text`` is one of the columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for raw in batch.column("text").to_pylist():
                hashes = shingle_hashes(raw.encode("utf-8"), 5)
                rows.append([int((hashes * k).min() >> np.uint64(1)) if len(hashes) else 0 for k in ORDERS])
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *KEYS])

    schema = T.StructType([*frame.schema.fields, *(T.StructField(k, T.LongType()) for k in KEYS)])
    keyed = frame.mapInArrow(run, schema)
    for key in KEYS:
        # The smallest text of a group stays, so the choice does not depend on timing.
        keyed = keyed.withColumn("turn", F.row_number().over(Window.partitionBy(key).orderBy("text"))).filter("turn = 1").drop("turn")
    return keyed.drop(*KEYS)


def mine_terms(labelled: DataFrame) -> list[tuple[str, float]]:
    """The terms of columns ``text`` and ``label`` farthest from chance that mark the
    toxic class, with the share of toxic texts among those that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in slices(batches):
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[label].update(terms_of(text))
                seen[label][""] += 1  # the rows themselves
        terms = list(seen[0] | seen[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in seen)], ["term", "n0", "n1"]
        )

    sums = labelled.mapInArrow(run, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0"), F.sum("n1"))
    sums = sums.toDF("term", "n0", "n1")
    rows = sums.filter("term = ''").first()
    if rows is None or not rows.n0 or not rows.n1:
        return []
    # A term far from chance is frequent in one class; rare ones cannot reach LEAST_Z.
    least = LEAST_Z**2 / (2 * np.log((rows.n0 + rows.n1) / min(rows.n0, rows.n1)))
    rate_1, rate_0 = F.col("n1") / rows.n1, F.col("n0") / rows.n0
    some = sums.filter("term <> ''").filter((F.col("n1") + F.col("n0") >= least) & (F.greatest(rate_1, rate_0) > 1.5 * F.least(rate_1, rate_0)))
    some = some.orderBy(F.abs(rate_1 - rate_0).desc(), "term").limit(16 * TERMS).toPandas()
    z = signed_z(some["n1"].to_numpy(float), some["n0"].to_numpy(float), rows.n1, rows.n0)
    share = (some["n1"] + 0.5 * rows.n1 / (rows.n1 + rows.n0)) / (some["n1"] + some["n0"] + 0.5)
    far = some.assign(z=z, share=share).query("z >= @LEAST_Z and share >= @LEAST_SHARE")
    far = far.sort_values(["z", "term"], ascending=[False, True]).head(TERMS)
    return list(zip(far["term"], far["share"].tolist(), strict=True))


class Matcher:
    """Numbers of the terms found in a text."""

    def __init__(self, terms: list[str]):
        numbers = {t: i for i, t in enumerate(terms)}
        self.words = {t: i for t, i in numbers.items() if t[-1] not in "-="}
        self.once, self.twice = (
            {n: {t[:-1]: i for t, i in numbers.items() if t[-1] == mark and len(t) == n + 1} for n in BEGINNINGS} for mark in "-="
        )

    def __call__(self, text: str) -> list[int]:
        words = set(WORD.findall(text.lower()))
        found = [self.words[w] for w in words & self.words.keys()]
        for n in BEGINNINGS:
            once, twice = self.once[n], self.twice[n]
            if once or twice:
                starts = [w[:n] for w in words if len(w) > n]
                distinct = set(starts)
                found += [once[s] for s in distinct & once.keys()]
                found += [twice[s] for s in distinct & twice.keys() if starts.count(s) > 1]
        return found


@dataclass
class ToxicityModel:
    terms: list[str]
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str], match: Matcher) -> list[float]:
        values = np.array([self.bias + self.weights[match(t)].sum() for t in texts])
        return (1 / (1 + np.exp(-np.clip(values, -30, 30)))).tolist()


def voter_of(terms: list[tuple[str, float]]) -> np.ndarray:
    """The voter of each term. Voters hold terms of alike reliability, so that the
    generative model can tell good voters from poor ones."""
    result = np.zeros(len(terms), np.int64)
    for words, base, voters in ((True, 0, LEXICON_VOTERS), (False, LEXICON_VOTERS, PATTERN_VOTERS)):
        own = [i for i, (t, _) in enumerate(terms) if (t[-1] not in "-=") == words]
        own.sort(key=lambda i: (-terms[i][1], terms[i][0]))
        for place, i in enumerate(own):
            result[i] = base + place * voters // len(own)
    return result


def train_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> ToxicityModel:
    """A model from training documents (``doc_id``, ``text``) and labels (``doc_id``, ``toxic``).

    At most ``sample`` labelled rows, chosen by a hash of the id, are mined for terms,
    and at most twice as many documents fit the classifier; the generative model sees
    all documents. Null labels and labels of absent documents are ignored. Without
    labels of both classes the score is the same for all texts, near 0.
    """
    texts = docs.select("doc_id", whole_text().alias("text"))
    known = labels.filter("toxic is not null and doc_id is not null").select("doc_id", (F.col("toxic") > 0).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    labelled = texts.join(F.broadcast(chosen), "doc_id").select("text", "label")
    terms = mine_terms(without_copies(labelled))
    voters = LEXICON_VOTERS + PATTERN_VOTERS + 1
    names, owner = [t for t, _ in terms], voter_of(terms)

    def vote(rows: list[str]) -> np.ndarray:
        match = Matcher(names)
        votes = np.zeros((len(rows), voters), np.int64)
        for i, text in enumerate(rows):
            found = owner[match(text)] if names else np.zeros(0, np.int64)
            votes[i, found] = 1
            votes[i, -1] = 0 if len(found) else -1
        return votes

    def labelled_votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [row.tobytes() for row in vote(batch.column(0).to_pylist()).astype(np.int8)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column(1)], ["votes", "label"])

    if not names:
        return ToxicityModel([], np.zeros(0), -10.0)
    votes, counts = vote_counts(texts, voters, vote)
    places = {row.astype(np.int8).tobytes(): i for i, row in enumerate(votes)}
    known = np.zeros((2, len(votes)))
    for row in labelled.mapInArrow(labelled_votes, "votes binary, label int").groupBy("votes", "label").count().collect():
        known[row[1], places[bytes(row[0])]] = row[2]
    start = np.clip(0.1 + 0.25 * votes.sum(axis=1), 0.05, 0.95)
    generative = expectation_maximisation(votes, counts, start, known=known)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(names)
        for batch in slices(batches):
            rows = batch.column(0).to_pylist()
            posterior = generative.posterior(vote(rows))
            found = [np.array(match(t), "<i4").tobytes() for t in rows]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(posterior)], ["found", "posterior"])

    rows = bounded_sample(texts, sample).select("text").mapInArrow(features, "found binary, posterior double").collect()
    rows.sort(key=lambda r: (bytes(r.found), r.posterior))
    x = np.zeros((len(rows), len(names)), np.float32)
    for i, row in enumerate(rows):
        x[i, np.frombuffer(bytes(row.found), "<i4")] = 1
    weights, bias = fit_logistic(x, np.array([r.posterior for r in rows]), l2=1e-4, rounds=1000)
    return ToxicityModel(names, weights.astype(float), bias)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every whole text.

    A null or empty text has the score of a text without terms. Repeated rows give
    repeated results; a null id stays null; other columns are ignored. No shuffle.
    """
    return _scored(docs.select("doc_id", whole_text().alias("text")), model)


def _scored(frame: DataFrame, model: ToxicityModel) -> DataFrame:
    """Puts ``score`` and ``predicted`` in place of column ``text``, which is the last."""
    sent = frame.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(sent.value.terms)
        for batch in slices(batches):
            scores = sent.value.scores(batch.column(batch.num_columns - 1).to_pylist(), match)
            columns = [*batch.columns[:-1], pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "score", "predicted"])

    kept = frame.drop("text").schema
    return frame.mapInArrow(run, kept.add("score", T.DoubleType()).add("predicted", T.IntegerType()))


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows whose score is below 0.5, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return _scored(docs.select(row, whole_text().alias("text")), model).filter("predicted = 0").select("row.*")
