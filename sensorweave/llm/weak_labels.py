"""Generative models of noisy voters, and linear models trained on their posteriors."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.llm.common import slices

VOTES = np.array([-1, 0, 1])


@dataclass
class LabelModel:
    """``log_vote[y, voter, vote + 1]`` is the log-probability of a vote given the label;
    ``weight`` discounts voters that repeat each other beyond what the label explains."""

    prior: float
    log_vote: np.ndarray
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row of votes (-1, 0 or 1)."""
        voters = np.arange(votes.shape[1])
        ratio = (self.log_vote[1] - self.log_vote[0])[voters, votes + 1] @ self.weight
        return 1 / (1 + np.exp(-np.clip(ratio + np.log(self.prior / (1 - self.prior)), -50, 50)))


def expectation_maximisation(
    votes: np.ndarray,
    counts: np.ndarray,
    start: np.ndarray,
    rounds: int = 60,
    correlated: bool = True,
    known: np.ndarray | None = None,
) -> LabelModel:
    """Accuracies of voters from distinct rows of votes and how often each occurs.

    ``start`` is a first guess of each row's probability of label 1. With ``correlated``, the correlation of each pair of
    voters within the labels is estimated from the fitted posteriors, and a voter's
    evidence is divided by how much of it the others repeat; then the fit goes on.

    ``known`` (two rows) is how many of each row's ``counts`` have label 0 and label 1. These keep
    their label; without any, nothing ties the two classes found to the label meant.
    """
    voters = votes.shape[1]
    model, prior = LabelModel(0.5, np.zeros((2, voters, 3)), np.ones(voters)), 0.5
    y = start.astype(float)
    fixed = np.zeros((2, len(votes))) if known is None else known
    free = np.maximum(counts - fixed.sum(axis=0), 0)
    for _ in range(3 if correlated else 1):
        if correlated:
            within = np.zeros((voters, voters))
            for own in ((1 - y) * free + fixed[0], y * free + fixed[1]):
                total = max(own.sum(), 1e-9)
                centred = votes - (own @ votes) / total
                cov = (centred * own[:, None]).T @ centred / total
                spread = np.sqrt(np.maximum(np.diag(cov), 1e-9))
                within += np.abs(cov / np.outer(spread, spread)) * total
            within /= max((free + fixed.sum(axis=0)).sum(), 1e-9)
            np.fill_diagonal(within, 0)
            within[within < 0.25] = 0  # what chance and the guess of the label leave is not counted
            model = LabelModel(model.prior, model.log_vote, 1 / (1 + within.sum(axis=1)))
        for _ in range(rounds):
            mass = np.stack([(1 - y) * free, y * free]) + fixed
            log_vote = np.empty((2, voters, 3))
            for k, vote in enumerate(VOTES):
                log_vote[:, :, k] = mass @ (votes == vote) + 0.5
            log_vote = np.log(log_vote / log_vote.sum(axis=2, keepdims=True))
            prior = float(np.clip(mass[1].sum() / max(mass.sum(), 1e-9), 1e-4, 1 - 1e-4))
            model = LabelModel(prior, log_vote, model.weight)
            following = model.posterior(votes)
            if np.abs(following - y).max() < 1e-6:
                break
            y = following
    return model


def vote_counts(docs: DataFrame, voters: int, vote: Callable[[list[str]], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of votes over all rows of column ``text``, and their counts.

    Each task sends each row of votes once. There are at most 3 ** voters of them,
    however many documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter[bytes] = Counter()
        for batch in slices(batches):
            totals.update(row.tobytes() for row in vote(batch.column(0).to_pylist()).astype(np.int8))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.binary()), pa.array(list(totals.values()), pa.int64())], ["votes", "n"]
        )

    rows = docs.select("text").mapInArrow(run, "votes binary, n long").groupBy("votes").agg(F.sum("n")).collect()
    votes = np.frombuffer(b"".join(bytes(r[0]) for r in rows), np.int8).reshape(-1, voters).astype(np.int64)
    order = np.lexsort(votes.T)  # so that sums do not depend on the order of arrival
    return votes[order], np.array([r[1] for r in rows], float)[order]


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels, by accelerated descent."""
    n, features = x.shape
    weights, bias = np.zeros(features, np.float32), 0.0
    if not n:
        return weights, -10.0
    step = 1.0 / (0.25 * (np.square(x).sum(axis=1).mean() + 1) + l2)
    last_w, last_b = weights, bias
    for k in range(1, rounds + 1):
        pull = (k - 1) / (k + 2)
        ahead_w, ahead_b = weights + pull * (weights - last_w), bias + pull * (bias - last_b)
        error = 1 / (1 + np.exp(-np.clip(x @ ahead_w + ahead_b, -30, 30))) - y
        last_w, last_b = weights, bias
        weights = ahead_w - step * (x.T @ error / n + l2 * ahead_w).astype(np.float32)
        bias = ahead_b - step * float(error.mean())
    return weights, bias


def bounded_sample(docs: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows and never more than twice as many, chosen by a hash of the id."""
    total = docs.count()
    share = min(1.0, rows / max(total, 1))
    picked = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    return docs.filter(picked).limit(2 * rows)
