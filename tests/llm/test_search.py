import math
import random
import re
from collections import Counter

import numpy as np

from compare import connect, differences
from sensorweave.llm import lexical_search, queries
from sensorweave.llm.lexical_search import Postings, Sketches, Weights, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, k):
    """Every score of every pair, from the definition."""
    counted = [(doc_id, Counter(found), len(found)) for doc_id, text in docs if (found := terms(text))]
    held = Counter(term for _, tf, _ in counted for term in tf)
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    rows = []
    for item_id, text in items:
        scored = []
        for doc_id, tf, n in counted:
            m = 100 - 50 + 50 * n * n_docs // n_terms
            weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) for t in set(terms(text)) if tf[t]}
            score = sum(w * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * m)) for t, w in weight.items())
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored, key=lambda row: row[:3])[:k], 1):
            rows.append((item_id, rank, doc_id, -score))
    return rows


def plain(frame):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in frame.collect()), key=str)


def made_up(seed, n):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ä", "ä", "A1", "漢字", "x-y", "o'clock"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(pick.choices(words, weights, k=pick.choice([1, 3, 20, 200]))) for _ in range(n)]
    return texts + texts[:30] * 3  # copies tie


def test_search_equals_brute_force_also_in_several_blocks(spark, monkeypatch):
    texts = made_up(3, 200)
    docs = [(i, text) for i, text in enumerate(texts)] + [(None, texts[0]), (None, None), (5000, ""), (7, texts[7]), (9000, None)]
    items = [(i, text) for i, text in enumerate(made_up(4, 12))] + [(90, None), (91, ""), (None, "w1 w2"), (92, "unheard"), (3, "w50 w51")]
    frame = spark.createDataFrame([(i, t, 1, 2.0) for i, t in docs], "doc_id long, text string, score long, item double").repartition(5)
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, rank string")
    expected = sorted(brute_force(docs, items, 7), key=str)
    assert plain(search(frame, asked, k=7, sample=3)) == expected
    monkeypatch.setattr(lexical_search, "ITEMS_AT_ONCE", 5)
    assert plain(search(frame, asked, k=7, sample=1_000_000)) == expected


def test_bounds_are_never_below_scores():
    texts = [text.encode() for text in made_up(5, 300)] + [b" ".join(b"t%d" % i for i in range(5000))]
    numbers = {b"w%d" % i: i for i in range(60)} | {b"t77": 60}
    weights = Weights.of(len(texts), sum(len(t.split()) for t in texts), {i: i + 1 for i in range(61)}, 61)
    postings = Postings(texts, numbers, weights)
    coordinates = np.array([lexical_search.hashed(term) for term in numbers])
    seen = 0
    for width, part in postings.parts():
        sketches = Sketches(postings, width, part, len(numbers))
        for asked in (np.array([0, 5, 9]), np.arange(61)):
            bound = sketches.bounds(coordinates[asked], weights.weight[asked])
            score = sketches.scores(np.arange(len(part)), asked, weights.weight[asked])
            assert (bound >= score).all()
        assert score.max() > 0
        seen += len(part)
    assert seen == len(texts)


def test_search_handles_odd_and_very_long_texts(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one the straße"), (2, "x" * 3000), (3, None)], "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert plain(search(odd_docs, items)) == sorted(brute_force(docs, [(1, "one the straße"), (2, "x" * 3000)], 50), key=str)
    assert search(no_docs, items).collect() == []
    assert search(odd_docs, items.filter("item_id > 5")).collect() == []
    long = [(1, "alpha beta " * 300_000), (2, " ".join(f"n{i}" for i in range(300_000)) + " alpha"), (3, "beta")]
    frame = spark.createDataFrame(long, "doc_id long, text string")
    asked = [(1, "alpha n77 beta")]
    assert plain(search(frame, spark.createDataFrame(asked, "item_id long, text string"))) == sorted(brute_force(long, asked, 50), key=str)


def test_query_equals_its_sql(spark, sf_dir):
    found = queries.op12_lexical_search(spark, sf_dir)
    assert differences(found, queries.OP12_SQL, connect(sf_dir)) is None
