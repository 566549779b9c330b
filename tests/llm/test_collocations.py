import random
import re
from collections import Counter

import numpy as np
import pytest

from compare import connect, differences
from sensorweave.llm import queries
from sensorweave.llm.collocations import Bitmap, collocations, frequent_hashes, frequent_phrases, named

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def counts_of(docs):
    """Every phrase of one to five words by its definition, and the words of each language."""
    found, totals = Counter(), Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for size in range(1, 6):
                found.update((lang or "und", tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    return found, totals


def brute_force(docs, least, top, covered):
    found, totals = counts_of(docs)
    frequent = {key: n for key, n in found.items() if n >= least}
    rows = []
    for (lang, words), a in frequent.items():
        if len(words) < 2:
            continue
        longer = [n for (other, w), n in frequent.items() if other == lang and len(w) > len(words) and any(w[i : i + len(words)] == words for i in range(len(w)))]
        if any(100 * n >= covered * a for n in longer):
            continue
        cuts = [(1000 * a * totals[lang] // (found[lang, words[:k]] * found[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        rows.append((lang, -score, -a, " ".join(words).encode(), found[lang, words[:k]], found[lang, words[k:]]))
    ranks, result = Counter(), []
    for lang, score, a, phrase, left, right in sorted(rows):
        ranks[lang] += 1
        if ranks[lang] <= top:
            result.append((lang, ranks[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(result)


def plain(frame):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in frame.collect())


def made_up(seed, n):
    pick = random.Random(seed)
    words = ["the", "of", "New", "York", "Ä", "ä", "漢字", "x\x1cy", "a\xa0b", "über", *(f"w{i}" for i in range(12))]
    docs = []
    for i in range(n):
        said = [pick.choice(words) + pick.choice(["", "", "", "", ",", ".", "!\n", "\t", "\x0b"]) for _ in range(pick.choice([0, 1, 10, 60]))]
        text = " ".join(said) + pick.choice(["", " New York of the w1", " the the the the the the"])
        docs.append((i, pick.choice(["en", "en", "de", None]), text))
    return docs + [(n, None, None), (n + 1, "fr", ""), (n + 2, "en", " \t.;"), (None, "de", "w1 w2"), (3, "en", docs[3][2])]


def frame_of(spark, docs):
    rows = [(i, lang, text, 1, "x", 2.0) for i, lang, text in docs]
    schema = "doc_id long, lang string, text string, n long, key string, size double"
    return spark.createDataFrame(rows, schema).repartition(4)


def test_collocations_equal_brute_force(spark):
    docs = made_up(1, 250)
    for least, top, covered in ((8, 2000, 100), (5, 6, 60)):
        expected = brute_force([(lang, text) for _, lang, text in docs], least, top, covered)
        assert len(expected) > 10
        assert plain(collocations(frame_of(spark, docs), least, top, covered, share=2)) == expected


@pytest.mark.parametrize("share", [1, 7, 100_000])
def test_phrases_are_exact_whatever_the_sample_misses(spark, share):
    """A share of 100,000 proposes nothing: everything fails at the border and is counted by the expansion."""
    docs = made_up(2, 200)
    found, totals = counts_of([(lang, text) for _, lang, text in docs])
    expected = {(lang, len(words), " ".join(words)): n for (lang, words), n in found.items() if n >= 6}
    rows = frequent_phrases(frame_of(spark, docs), least=6, share=share).collect()
    assert len(rows) == len({(r.lang, r.size, r.key) for r in rows})
    got = {(r.lang, r["size"], r.key.removeprefix(f"{r.lang}\t")): r.n for r in rows if r["size"]}
    assert got == expected
    assert {r.lang: r.n for r in rows if not r["size"]} == dict(totals)


def test_a_full_bitmap_only_counts_more(spark, monkeypatch):
    """Every phrase seems proposed when all bits are set."""
    of = Bitmap.of.__func__
    monkeypatch.setattr(Bitmap, "of", classmethod(lambda cls, phrases: cls(np.full_like((b := of(cls, phrases)).bits, 255), b.size)))
    docs = made_up(4, 80)
    expected = brute_force([(lang, text) for _, lang, text in docs], 4, 50, 100)
    assert plain(collocations(frame_of(spark, docs), 4, 50, share=3)) == expected


def test_bitmap_holds_its_members(spark):
    keys = [f"en\tword {i} ä" for i in range(5000)]
    bitmap = Bitmap.of(spark.createDataFrame([(k,) for k in keys], "key string"))
    assert bitmap.has([k.encode() for k in keys]).all()
    assert bitmap.has([f"de\tother {i}".encode() for i in range(5000)]).mean() < 0.05
    assert not Bitmap.empty().has([b"en\tword"]).any()


def test_collocations_handle_odd_and_very_long_texts(spark, odd_docs, no_docs):
    docs = [(r.lang, r.text) for r in odd_docs.collect()]
    assert plain(collocations(odd_docs, 100, 2000)) == brute_force(docs, 100, 2000, 100)
    assert collocations(no_docs).collect() == []
    long = [(1, "en", "one two three " * 150_000 + "end"), (2, "en", "x" * 2_000_000)]
    assert plain(collocations(frame_of(spark, long), 100, 10)) == brute_force([(lang, text) for _, lang, text in long], 100, 10, 100)


def test_query_equals_its_sql(spark, sf_dir):
    assert differences(queries.op13_collocations(spark, sf_dir), queries.OP13_SQL, connect(sf_dir)) is None


def test_phrase_on_a_part_the_bitmap_wrongly_holds_is_counted():
    """``a b`` only seems proposed: ``a`` is not, so that the first pass names neither it nor ``a b c``."""

    class Held:
        def __init__(self, *phrases):
            self.phrases = {b"en\t" + p for p in phrases}

        def has(self, phrases):
            return np.array([p in self.phrases for p in phrases], dtype=bool)

    words, proposed = b"a b c d .".split() * 3, Held(b"b", b"c", b"d", b"b c", b"c d", b"b c d", b"a b")
    counted = Counter()
    for failed in (None, Held(b"a")):
        for _, phrases, often in named(words, b"en\t", range(1 if failed is None else 2, 6), proposed, failed):
            counted.update({p: n + 1000 * (p in counted) for p, n in zip(phrases, often.tolist(), strict=True)})
    assert counted[b"en\ta b c"] == counted[b"en\ta b c d"] == counted[b"en\tb c d"] == 3
    assert set(counted.values()) == {3}


def test_rare_border_phrases_are_shuffled_as_hashes_only(spark):
    """The first pass deals out a hash and a count for each phrase, and leaves what is frequent."""
    docs = made_up(5, 150)
    source = frame_of(spark, docs).selectExpr("coalesce(lang, 'und') AS lang", "CAST(coalesce(text, '') AS binary) AS text")
    keys = [(f"{lang}\t{word}",) for lang in ("en", "de", "und") for word in ("the", "of", "w1")]
    proposed = Bitmap.of(spark.createDataFrame(keys, "key string"))
    rows = frequent_hashes(source, proposed, 6)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(hash#" in plan and "hashpartitioning(key#" not in plan
    found, _ = counts_of([(lang, text) for _, lang, text in docs])
    frequent = [(f"{lang}\t{words[0]}",) for (lang, words), n in found.items() if n >= 6 and len(words) == 1]
    expected = spark.createDataFrame(frequent, "key string").selectExpr("xxhash64(key) AS hash")
    assert {r[0] for r in expected.collect()} <= {r[0] for r in rows.collect()}
    phrases = {lead + word for lead, word in ((b"en\t", b"the of"), (b"en\t", b"of the")) if found["en", tuple(word.decode().split())] >= 6}
    assert phrases and Bitmap.of(rows).has(sorted(phrases)).all()
    assert rows.count() < sum(len(words) <= 2 for _, words in found) / 2
