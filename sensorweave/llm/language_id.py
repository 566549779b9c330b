"""Language identification of words and spans, also in mixed-language texts.

Per-language counts of character n-grams are gathered over all labelled training texts.
A word's score under each language is the log-probability of its n-grams; the script of
its letters leaves only the languages that use it. Along a text, a Viterbi path over the
word scores with a penalty for each switch labels every word, and neighbouring words of
one language form a span. The prediction is the language of most letters.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.llm.common import slices, whole_text

#: Hashed n-grams; the model has this many numbers per language, whatever the corpus.
FEATURES = 1 << 15
SWITCH_PENALTY = 12.0
#: Entries of the per-task word cache; it is emptied when full, which changes no result.
CACHE_ENTRIES = 300_000
OTHER_SCRIPT = -40.0  # a word's score under a language that does not use its script
WORD_FLOOR = -10.0  # below the switch penalty, so that no single odd word makes a span
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")

# First code points of blocks by script; anything else is "other".
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x32000, "other"),
]
STARTS = [start for start, _ in SCRIPTS]
NAMES = sorted({name for _, name in SCRIPTS})
SCRIPT_ROWS = {name: FEATURES + i for i, name in enumerate(NAMES)}
ROWS = FEATURES + len(NAMES)


def script_of(word: str) -> str:
    """The script of most of a word's letters; of equally many, the first met."""
    if max(word) < "\u0370":
        return "latin"
    return Counter(SCRIPTS[bisect.bisect_right(STARTS, ord(c)) - 1][1] for c in word).most_common(1)[0][0]


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of 1 to 3 characters of all words, bounds included, and their words."""
    text = "\x01" + "\x01".join(words) + "\x01\x01\x01"
    code = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    owner = np.repeat(np.arange(len(words)), sizes + 1)  # the bound before each word is its own
    n = len(owner)
    one, two, three = code[:n], code[1 : n + 1], code[2 : n + 2]
    # A bigram may start at the bound and may end in the next one, a trigram too.
    letter, pair_end = one != 1, two != 1
    mix = np.uint64(0x9E3779B97F4A7C15)
    single = one[letter] * mix
    double = (one * np.uint64(0x10001) + two + np.uint64(1 << 40)) * mix
    triple = ((one * np.uint64(0x110001) + two) * np.uint64(0x110001) + three + np.uint64(1 << 50)) * mix
    hashed = np.concatenate([single, double, triple[pair_end]])
    shift = np.uint64(64 - FEATURES.bit_length() + 1)
    return (hashed >> shift).astype(np.int64), np.concatenate([owner[letter], owner, owner[pair_end]])


def count_ngrams(training: DataFrame) -> DataFrame:
    """``lang``, ``row``, ``n``: n-grams and letters by script over all rows of columns
    ``text`` and ``lang``. Each task sends its totals, not its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            words: dict[str, Counter[str]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
            for lang, counter in words.items():
                if not counter:
                    continue
                own = totals.setdefault(lang, np.zeros(ROWS))
                some, counts = list(counter), np.fromiter(counter.values(), float, len(counter))
                grams, owner = ngrams(some)
                own += np.bincount(grams, counts[owner], ROWS)
                for word, n in counter.items():
                    own[SCRIPT_ROWS[script_of(word)]] += n * len(word)
        for lang, own in totals.items():
            rows = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(rows), pa.string()), pa.array(rows, pa.int32()), pa.array(own[rows], pa.float64())],
                ["lang", "row", "n"],
            )

    return training.mapInArrow(run, "lang string, row int, n double").groupBy("lang", "row").agg(F.sum("n").alias("n"))


class LanguageModel:
    """Log-probabilities of n-grams and candidate languages by script."""

    def __init__(self, counts: list[tuple[str, int, float]]):
        self.languages = sorted({lang for lang, _, _ in counts})
        table = np.zeros((ROWS, len(self.languages)))
        for lang, row, n in counts:
            table[row, self.languages.index(lang)] += n
        grams = table[:FEATURES]
        self.log = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * FEATURES)).astype(np.float32)
        letters = table[FEATURES:]
        share = letters / np.maximum(letters.sum(axis=0), 1)
        uses = share >= 0.01
        uses[~uses.any(axis=1)] = True
        self.uses = dict(zip(NAMES, uses, strict=True))

    def word_scores(self, words: list[str]) -> np.ndarray:
        """A row of scores per word, relative to its best language."""
        grams, owner = ngrams(words)
        order = np.argsort(owner, kind="stable")
        first = np.searchsorted(owner[order], np.arange(len(words)))
        scores = np.add.reduceat(self.log[grams[order]], first, axis=0)
        allowed = np.array([self.uses[script_of(w)] for w in words])
        scores[~allowed] = -np.inf
        scores = np.maximum(scores - scores.max(axis=1, keepdims=True), WORD_FLOOR)
        scores[~allowed] = OTHER_SCRIPT
        return scores


def best_path(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The language of each word on the path of the highest score less its switches."""
    return best_paths([scores], penalty)[0]


def best_paths(texts: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """``best_path`` of the word scores of many texts, none empty. Texts that need a pass over their
    words take it together, word by word."""
    paths: list[np.ndarray] = []
    mixed: list[int] = []
    for at, scores in enumerate(texts):
        best = int(scores.sum(axis=0).argmax())
        # m stretches in other languages need at least m - 1 switches, and one if m is 1. So
        # staying is best if no stretch gains more than half a switch costs, which decides
        # many texts without a pass over their words.
        gain = np.cumsum(scores - scores[:, best : best + 1], axis=0)
        before = np.minimum.accumulate(np.vstack([np.zeros((1, scores.shape[1])), gain[:-1]]), axis=0)
        if (gain - before).max() > penalty / 2:
            mixed.append(at)
        paths.append(np.full(len(scores), best))
    # The longest first: texts that have a word at some place are the first ones.
    mixed.sort(key=lambda at: -len(texts[at]))
    for at, path in zip(mixed, _passes([texts[at] for at in mixed], penalty), strict=True):
        paths[at] = path
    return paths


#: So many texts, or fewer, are passed one by one; a step for all costs as much as their words do.
FEW_TEXTS = 6


def _passes(texts: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """Viterbi paths of texts that come in falling order of length."""
    if not texts:
        return []
    sizes = np.array([len(scores) for scores in texts])
    together = int(sizes[FEW_TEXTS]) if len(texts) > FEW_TEXTS else 0  # words that more than a few texts have
    count = np.searchsorted(-sizes, -np.arange(max(together, 1)), side="left")  # texts with a word at that place
    starts = np.cumsum(sizes) - sizes
    scores = np.concatenate(texts).astype(float) if together else np.zeros((0, texts[0].shape[1]))
    own = np.arange(texts[0].shape[1], dtype=np.int32)
    value = scores[starts] if together else np.zeros((0, len(own)))
    came_from = [np.zeros((0, len(own)), np.int32)]
    for place in range(1, together):
        some = value[: count[place]]
        switch = some.max(axis=1, keepdims=True) - penalty
        came_from.append(np.where(some >= switch, own, some.argmax(axis=1).astype(np.int32)[:, None]))
        np.maximum(some, switch, out=some)
        some += scores[starts[: count[place]] + place]
    tails: list[list[int]] = []
    for text in range(min(FEW_TEXTS, len(texts))):
        tails.append(_one_pass(value[text].tolist() if together else None, texts[text][together:].tolist(), penalty))
    ends = value.argmax(axis=1) if together else np.zeros(0, np.int64)
    for text, tail in enumerate(tails):
        if together:
            ends[text] = tail[0]
    heads = np.zeros((len(texts), together), np.int64)
    now = ends.copy()
    for place in range(together - 1, -1, -1):
        heads[: count[place], place] = now[: count[place]]
        if place:
            now[: count[place]] = came_from[place][np.arange(count[place]), now[: count[place]]]
    return [
        np.array([*heads[text], *tails[text][1 if together else 0 :]], np.int64) if text < len(tails) else heads[text, : sizes[text]]
        for text in range(len(texts))
    ]


def _one_pass(value: list[float] | None, rows: list[list[float]], penalty: float) -> list[int]:
    """The path over ``rows`` from the values of the word before (then led by that word's language)."""
    if value is None:
        value, *rows = rows
    came_from: list[list[int]] = []
    for row in rows:
        top = max(value)
        switch, best = top - penalty, value.index(top)
        came_from.append([own if v >= switch else best for own, v in enumerate(value)])
        value = [(v if v >= switch else switch) + s for v, s in zip(value, row)]
    path = [value.index(max(value))]
    for back in reversed(came_from):
        path.append(back[path[-1]])
    return path[::-1]


#: Texts that are labelled together, and about how many words of theirs: bounds memory beside the texts.
TEXTS_AT_ONCE = 512
WORDS_AT_ONCE = 1 << 18
Labels = tuple[str, float, list[tuple[str, int, int]]]


class Labeller:
    def __init__(self, model: LanguageModel, penalty: float):
        self.model, self.penalty = model, penalty
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)), np.float32)
        self.letters = np.zeros(0, np.int64)

    def learn(self, texts: list[list[str]]) -> None:
        if not self.model.languages:
            return
        if len(self.known) > CACHE_ENTRIES:
            self.__init__(self.model, self.penalty)
        new = list(set().union(*texts).difference(self.known))
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.scores = np.concatenate([self.scores, self.model.word_scores(new)])
            self.letters = np.r_[self.letters, [len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in new]]

    def label_all(self, texts: list[str], words: list[list[str]]) -> list[Labels]:
        """``label`` of many texts."""
        found: list[Labels] = [(UNKNOWN, 0.0, [])] * len(texts)
        held: list[tuple[int, np.ndarray, np.ndarray]] = []
        size = 0
        for at, own in enumerate(words):
            if not own or not self.model.languages:
                continue
            rows = np.fromiter(map(self.known.__getitem__, own), np.int64, len(own))
            if self.letters[rows].any():
                held.append((at, rows, self.scores[rows]))
                size += len(rows)
            if size >= WORDS_AT_ONCE:
                self._label(held, texts, words, found)
                held, size = [], 0
        self._label(held, texts, words, found)
        return found

    def _label(self, held: list[tuple[int, np.ndarray, np.ndarray]], texts: list[str], words: list[list[str]], found: list[Labels]) -> None:
        paths = best_paths([scores for _, _, scores in held], self.penalty)
        for (at, rows, scores), path in zip(held, paths, strict=True):
            found[at] = self._summary(texts[at], words[at], self.letters[rows], scores, path)

    def label(self, text: str, words: list[str]) -> Labels:
        """Prediction, confidence and spans (language, start, end in code points)."""
        return self.label_all([text], [words])[0]

    def _summary(self, text: str, words: list[str], letters: np.ndarray, scores: np.ndarray, path: np.ndarray) -> Labels:
        weight = np.bincount(path, letters, len(self.model.languages))
        pick = int(weight.argmax())
        total = scores[path == pick].sum(axis=0, dtype=float)
        rival = np.delete(total, pick).max() if len(total) > 1 else total[pick] - 50
        confidence = weight[pick] / weight.sum() / (1 + np.exp(np.clip(rival - total[pick], -50, 50)))
        change = np.flatnonzero(np.diff(path)) + 1
        places = [m.span() for m in WORD.finditer(text)] if len(change) else []
        if len(places) != len(words):  # one span, or lower case changed the word count
            lead = WORD.search(text)
            spans = [(self.model.languages[pick], lead.start() if lead else 0, len(text))]
        else:
            bounds = [0, *change.tolist(), len(words)]
            spans = [
                (self.model.languages[path[a]], places[a][0], places[b - 1][1]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)
            ]
        return self.model.languages[pick], float(confidence), spans


SPANS = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def train(training: DataFrame) -> LanguageModel:
    """A model from all rows of ``text`` and ``lang``; what reaches the driver has
    FEATURES numbers per language at most."""
    rows = count_ngrams(training.select(whole_text().alias("text"), "lang").filter("lang is not null")).collect()
    return LanguageModel([tuple(row) for row in rows])


def identify(docs: DataFrame, model: LanguageModel, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``spans`` of every whole text.

    Texts that are null, empty or without a letter are "und" with score 0 and no spans,
    and so are all texts if the model knows no language. Repeated rows give repeated
    results; a null id stays null; other columns are ignored. No shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(sent.value, penalty)
        for batch in slices(batches, TEXTS_AT_ONCE):
            texts = batch.column(1).to_pylist()
            words = [WORD.findall(text.lower()) for text in texts]
            labeller.learn(words)
            found = labeller.label_all(texts, words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([[{"lang": a, "start": b, "end": c} for a, b, c in f[2]] for f in found], SPANS),
                ],
                ["doc_id", "lang_pred", "score", "spans"],
            )

    source = docs.select("doc_id", whole_text().alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {id_type}, lang_pred string, score double, spans array<struct<lang:string,start:long,end:long>>"
    )
