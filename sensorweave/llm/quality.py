"""Quality scores from a weak-label model.

Overlapping heuristics vote good or bad on each text, or abstain. Expectation
maximisation over the votes of all documents estimates how often each is right,
without any label, and the posteriors train a linear scorer over hashed features:
n-grams of the text's shape and steps of its repetition figures.
"""

from __future__ import annotations

import operator
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sensorweave.llm.common import slices, whole_text
from sensorweave.llm.weak_labels import bounded_sample, expectation_maximisation, fit_logistic, vote_counts

#: Documents the scorer is fitted on.
SAMPLE_ROWS = 6000
#: Hashed features of the linear scorer.
FEATURES = 1 << 11
SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()@+/-]")

# Letters become a or A, digits 0, white space a blank; other characters stay. Bytes of
# non-ASCII characters count as small letters.
SHAPE = bytes(
    97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else 32 if b in b" \t\n\v\f\r" else b
    for b in range(256)
)
FIGURES = (
    "words", "symbols", "symbol_words", "symbol_share", "capital_words", "capital_letters", "marks", "bars",
    "wordless", "top_word", "same_next", "same_three", "distinct", "same_lines", "stops",
)


def figures(text: str) -> list[float]:
    """Plain statistics of a text, in the order of FIGURES."""
    words = text.split()
    n = max(len(words), 1)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    symbols = len(SYMBOL.findall(text))
    shape = text.encode("utf-8", "replace").translate(SHAPE)
    capitals, small = shape.count(b"A"), shape.count(b"a")
    return [
        float(len(words)),
        symbols / n,
        sum(k for w, k in counts.items() if SYMBOL.search(w)) / n if symbols else 0.0,
        symbols / max(len(text), 1),
        sum(map(str.isupper, words)) / n,
        capitals / max(capitals + small, 1),
        text.count("!") / n,
        text.count("|") / n,
        sum(k for w, k in counts.items() if not any(map(str.isalnum, w))) / n if symbols else 0.0,
        max(counts.values(), default=0) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        sum(a == b == c for a, b, c in zip(words, words[1:], words[2:], strict=False)) / n,
        len(counts) / n,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        sum(w.endswith((".", "!", "?", ":")) for w in words) / n,
    ]


def votes_of(texts: list[str]) -> np.ndarray:
    """Votes of each heuristic: -1 for a fault, 0 for none. Most faults are seen by
    several of them; texts of few words are judged by few."""
    f = np.array([figures(t) for t in texts]).reshape(-1, len(FIGURES))
    words, symbols, symbol_words, symbol_share, capital_words, capitals, marks, bars, wordless, top, same, three, distinct, lines, stops = f.T
    some, enough = words >= 3, words >= 20
    faults = [
        symbols > 0.15,
        symbol_words > 0.1,
        symbol_share > 0.04,
        some & (capital_words > 0.5),
        some & (capitals > 0.5),
        marks > 0.2,
        bars > 0.05,
        wordless > 0.1,
        enough & (top > 0.3),
        enough & (same > 0.2),
        enough & (three > 0.1),
        enough & (distinct < 0.05),
        lines > 0.3,
        enough & ((stops < 0.005) | (stops > 0.8)),
        words == 0,
    ]
    return -np.stack(faults, axis=1).astype(np.int64)


def hashed_features(texts: list[str]) -> np.ndarray:
    """Root frequencies of shape n-grams, at unit length, and steps of the figures."""
    x = np.zeros((len(texts), FEATURES), np.float32)
    half = FEATURES // 2
    for i, text in enumerate(texts):
        shape = np.frombuffer(text.encode("utf-8", "replace").translate(SHAPE), np.uint8)
        if len(shape):
            shape = shape[np.r_[True, shape[1:] != shape[:-1]]].astype(np.uint32)
            padded = np.r_[shape, 0, 0]
            grams = (padded[:-2] * np.uint32(65599) + padded[1:-1]) * np.uint32(65599) + padded[2:]
            grams = (grams * np.uint32(2654435761)) >> np.uint32(32 - half.bit_length() + 1)
            x[i, :half] = np.sqrt(np.bincount(grams, minlength=half))
            x[i, :half] /= max(float(np.linalg.norm(x[i, :half])), 1e-9)
        for k, value in enumerate(figures(text)):
            step = int(np.clip(np.log2(value + 1e-3) * 2 + 20, 0, 63))
            x[i, half + (k * 64 + step) % half] = 0.5
    return x


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        values = hashed_features(texts) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(values, -30, 30)))


def train_quality(docs: DataFrame, sample: int = SAMPLE_ROWS) -> QualityModel:
    """A model from ``doc_id`` and ``text`` alone. The label model sees every row; at
    most twice ``sample`` rows, chosen by a hash of the id, fit the scorer."""
    texts = docs.select("doc_id", whole_text().alias("text"))
    voters = votes_of([""]).shape[1]
    votes, counts = vote_counts(texts, voters, votes_of)
    if not len(votes):
        return QualityModel(np.zeros(FEATURES), 0.0)
    # One clear fault outweighs any number of things that are as they should be.
    labeller = expectation_maximisation(votes, counts, np.where((votes < 0).any(axis=1), 0.02, 0.98), correlated=False)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = batch.column(0).to_pylist()
            x = hashed_features(rows).astype(np.float16)
            posterior = labeller.posterior(votes_of(rows))
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), pa.array(posterior)], ["x", "posterior"])

    rows = bounded_sample(texts, sample).select("text").mapInArrow(features, "x binary, posterior double").collect()
    rows.sort(key=lambda r: (r.posterior, bytes(r.x)))
    x = np.frombuffer(b"".join(bytes(r.x) for r in rows), np.float16).reshape(-1, FEATURES).astype(np.float32)
    weights, bias = fit_logistic(x, np.array([r.posterior for r in rows]), l2=1e-5, rounds=400)
    return QualityModel(weights.astype(np.float32), bias)


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id``, ``score`` (1: good) and ``predicted`` of every whole text.

    Null and empty texts get the score of a text without words. Repeated rows give
    repeated results; a null id stays null; other columns are ignored. No shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = sent.value.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(scores >= 0.5).cast(pa.int32())],
                ["doc_id", "score", "predicted"],
            )

    source = docs.select("doc_id", whole_text().alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, score double, predicted int")
