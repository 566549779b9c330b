"""Tokens, personal data, contamination, languages, labels, packing, and the pipeline."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sensorweave.llm import queries
from sensorweave.llm.common import fold, fold_of, table
from sensorweave.llm.decontaminate import contamination_report, remove_contamination
from sensorweave.llm.fm_index import FmIndex, suffix_array
from sensorweave.llm.language_id import LanguageModel, Labeller, best_path, best_paths, identify, train
from sensorweave.llm.packing import first_fit_decreasing, pack
from sensorweave.llm.pii import KINDS, detect, find_spans, luhn, personal_data_report
from sensorweave.llm.quality import score_quality, train_quality
from sensorweave.llm.token_counts import Counter, count_tokens
from sensorweave.llm.toxicity import drop_toxic, score_toxicity, train_toxicity
from sensorweave.llm.weak_labels import expectation_maximisation

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def odd_texts(n=1500):
    rnd = random.Random(1)
    some = "aaabbc  \n\t'sdé１٣½中𝒳​́\x1c\x1f\x85\xa0᠎🙂ΣİI.,ÀÜ<|endoftext|>"
    texts = ["".join(rnd.choice(some) for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    texts += ["".join(chr(rnd.choice([rnd.randint(0, 0x2FF), rnd.randint(0xE000, 0x2FFFF)])) for _ in range(30)) for _ in range(n)]
    return texts + ["", "a" * 3000, " " * 500, "<|endoftext|>", "x<|endoftext|><|endoftext|>y", " it's  they'll \n\n x.", "ab" * 2000]


def test_token_counts_equal_the_library(spark, sf_dir, odd_docs, no_docs):
    library = Tokenizer.from_file(BYTES)
    texts = odd_texts()
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert Counter(BYTES).count(texts) == want
    for docs in (table(spark, sf_dir, "documents"), odd_docs):
        want = []
        for doc_id, text in docs.select("doc_id", "text").collect():
            n = len(library.encode(text or "", add_special_tokens=False).ids)
            want.append((doc_id, len((text or "").encode()), n, n > 512))
        assert sorted(map(tuple, count_tokens(docs, BYTES).collect()), key=repr) == sorted(want, key=repr)
    assert count_tokens(no_docs, BYTES).count() == 0


def test_first_fit_decreasing_is_first_fit():
    rnd = random.Random(2)
    lengths = [rnd.randint(1, 64) for _ in range(300)]
    bins, offsets = first_fit_decreasing(lengths, 64)
    room = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = next((b for b, free in enumerate(room) if free >= lengths[i]), len(room))
        if b == len(room):
            room.append(64)
        assert (bins[i], offsets[i]) == (b, 64 - room[b])
        room[b] -= lengths[i]


def test_packing_holds_every_token_once(spark, sf_dir, odd_docs, no_docs):
    library = Tokenizer.from_file(WORDS)
    for docs in (table(spark, sf_dir, "documents"), odd_docs):
        rows = pack(docs, WORDS).toPandas()
        want = []
        for doc_id, text in docs.select("doc_id", "text").collect():
            ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
            for a in range(0, len(ids), 2048):
                piece = np.array(ids[a : a + 2048], "<u4")
                want.append((-1 if doc_id is None else doc_id, a, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
        got = rows.fillna({"doc_id": -1})[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]].astype(int)
        assert sorted(map(tuple, got.to_numpy().tolist())) == sorted(want)
        rows = rows.sort_values(["sequence_id", "offset"])
        by = rows.groupby("sequence_id")["length"]
        assert (by.cumsum() - rows["length"] == rows["offset"]).all() and by.sum().max() <= 2048
    assert pack(no_docs, WORDS).count() == 0


def plain_spans(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        found += [(m.start(), 1, m.end())] if all(int(x) <= 255 for x in m[0].split(".")) else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        found += [(m.start(), 2, m.end())] if 12 <= len(digits) <= 19 and luhn(digits) else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        found += [(m.start(), 3, m.end())] if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15 else []
    return sorted(found)


def test_base_spans_equal_the_plain_patterns():
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab@@..-_+ 0123456789 ()é%") for _ in range(rnd.randint(0, 80))) for _ in range(8000)]
    texts += ["".join(rnd.choice("0123456789. -+") for _ in range(rnd.randint(0, 80))) for _ in range(8000)]
    texts += ["a@" * 30 + "b.c", "@a.b", "a@b@c.d", "a@b..c@d.e.", "9" * 4000 + ".1.1.1"]
    for text in texts:
        assert [(s.start, s.kind, s.end) for s in detect(text)] == plain_spans(text)


@pytest.mark.parametrize(
    ("text", "kind", "source"),
    [
        ("mail john [at] mail (dot) example dot com now", "email", "john [at] mail (dot) example dot com"),
        ("write to john.doe at mail dot example dot com today", "email", "john.doe at mail dot example dot com"),
        ("jоhn@mаil.com", "email", "jоhn@mаil.com"),
        ("jo​hn@ma​il.com", "email", "jo​hn@ma​il.com"),
        ("call +one five five five one two three four five six seven ok", "phone", "+one five five five one two three four five six seven"),
        ("ip 192 dot 168 dot 1 dot 10", "ip", "192 dot 168 dot 1 dot 10"),
        ("４111 1111 1111 1111", "card", "４111 1111 1111 1111"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, source):
    base, added = find_spans(text)
    assert (kind, source) in [(KINDS[s.kind], text[s.start : s.end]) for s in added]


def test_personal_data_report(spark, sf_dir, odd_docs, no_docs):
    for docs in (table(spark, sf_dir, "documents"), odd_docs):
        want = []
        for doc_id, text in docs.select("doc_id", "text").collect():
            listed = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in plain_spans(text or ""))
            want.append((doc_id, hashlib.sha256(listed.encode()).hexdigest(), listed))
        got = personal_data_report(docs).select("doc_id", "base_sha256", "spans").collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)  # nothing added to clean texts
    assert personal_data_report(no_docs).count() == 0


def test_fm_index_finds_every_occurrence():
    rng = np.random.default_rng(4)
    text = rng.integers(0, 6, 3000)
    text[-1] = 0
    order = suffix_array(text)
    assert sorted(order.tolist()) == list(range(3000))
    index = FmIndex(text, 6)
    for width in (1, 3, 5):
        phrases = rng.integers(1, 6, (40, width))
        low, high = index.search(phrases)
        for phrase, a, b in zip(phrases.tolist(), low, high, strict=True):
            want = [i for i in range(3000 - width + 1) if text[i : i + width].tolist() == phrase]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def test_contamination_against_brute_force(spark, sf_dir, odd_docs, no_docs, monkeypatch):
    items = [(501, "one two"), (502, None), (503, "--"), (504, "The"), (None, "word"), (505, "")]
    short = spark.createDataFrame(items, "item_id long, text string")
    bench = table(spark, sf_dir, "benchmark").select("item_id", "text")
    for docs, tests, block in ((table(spark, sf_dir, "documents"), bench, 500_000), (odd_docs, short, 500_000), (odd_docs, bench.union(short), 300)):
        monkeypatch.setattr("sensorweave.llm.decontaminate.BLOCK_WORDS", block)
        windows = {}
        for item, text in tests.collect():
            own = words(text)
            width = min(10, len(own))
            for a in range(len(own) - width + 1) if width else ():
                windows.setdefault(tuple(own[a : a + width]), set()).update([] if item is None else [str(item)])
        want = []
        for doc_id, text in docs.select("doc_id", "text").collect():
            own, hit, found = words(text), set(), set()
            for width in {len(w) for w in windows}:
                for a in range(len(own) - width + 1):
                    if tuple(own[a : a + width]) in windows:
                        hit.update(range(a, a + width))
                        found |= windows[tuple(own[a : a + width])]
            digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
            want.append((doc_id, len(own), len(hit), len(found), digest, bool(hit)))
        got = contamination_report(docs, tests).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    docs = table(spark, sf_dir, "documents")
    clean = remove_contamination(docs, bench)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert contamination_report(clean, bench).filter("contaminated").count() == 0
    assert remove_contamination(odd_docs, short.limit(0)).exceptAll(odd_docs).count() == 0
    assert contamination_report(no_docs, bench).count() == 0


def test_best_path_equals_full_search():
    rng = np.random.default_rng(6)

    def value(scores, path, penalty):
        return scores[np.arange(len(path)), path].sum() - penalty * np.count_nonzero(np.diff(path))

    for _ in range(200):
        n, penalty = int(rng.integers(1, 7)), float(rng.uniform(0, 4))
        scores = rng.normal(0, 2, (n, 3))
        every = np.stack(np.meshgrid(*[range(3)] * n, indexing="ij"), -1).reshape(-1, n)
        best = max(value(scores, p, penalty) for p in every)
        assert value(scores, best_path(scores, penalty), penalty) == pytest.approx(best)


def test_paths_of_many_texts_are_those_of_each():
    rng = np.random.default_rng(7)
    for many in (1, 6, 7, 40):
        texts = [rng.normal(0, 2, (int(n), 4)).round(1).astype(np.float32) for n in rng.integers(1, 30, many)]
        texts[0] = rng.normal(0, 2, (90, 4)).astype(np.float32)
        found = best_paths(texts, 3.0)
        assert [path.tolist() for path in found] == [best_path(scores, 3.0).tolist() for scores in texts]
        assert any(len(set(path.tolist())) > 1 for path in found)


def test_contamination_is_found_and_cut_by_one_python_worker_a_core(spark, odd_docs):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    plan = remove_contamination(odd_docs, bench, window=3)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("MapInArrow", plan)) == 1


def test_languages(spark, sf_dir, odd_docs, no_docs):
    rows = queries.op10_language_id(spark, sf_dir).join(table(spark, sf_dir, "documents"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (fold_of(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    model = train(table(spark, sf_dir, "documents"))
    found = identify(odd_docs, model).collect()
    assert len(found) == odd_docs.count()
    assert all((r.lang_pred == "und") == (r.score == 0) for r in found)
    assert identify(no_docs, model).count() == 0
    untaught = identify(odd_docs, train(no_docs)).collect()
    assert {r.lang_pred for r in untaught} == {"und"}


def test_spans_of_mixed_text():
    import collections

    from sensorweave.llm.language_id import ROWS, SCRIPT_ROWS, ngrams

    texts = {"aa": "thing there other this that the " * 20, "bb": "ciudad que para ocho muchacho " * 20, "ru": "город улица быстро " * 20}
    counts = []
    for lang, text in texts.items():
        own = collections.Counter(text.split())
        grams, owner = ngrams(list(own))
        row = np.bincount(grams, np.array(list(own.values()), float)[owner], ROWS)
        row[SCRIPT_ROWS["cyrillic" if lang == "ru" else "latin"]] = len(text)
        counts += [(lang, int(i), row[i]) for i in np.flatnonzero(row)]
    labeller = Labeller(LanguageModel(counts), 12.0)
    text = "this other thing there, that the this other thing: город улица быстро город! ciudad que para ocho muchacho ocho que"
    own = re.findall(r"[^\W\d_]+", text.lower())
    labeller.learn([own])
    _, _, spans = labeller.label(text, own)
    assert [(lang, text[a:b].split()[0]) for lang, a, b in spans] == [("aa", "this"), ("ru", "город"), ("bb", "ciudad")]


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(8)
    y = rng.random(4000) < 0.3
    right = np.array([0.95, 0.85, 0.7, 0.85])
    votes = np.where(rng.random((4000, 4)) < right, y[:, None], ~y[:, None]) * 2 - 1
    votes = np.c_[votes, votes[:, 1]]  # a voter that repeats another
    rows, counts = np.unique(votes, axis=0, return_counts=True)
    model = expectation_maximisation(rows, counts, np.clip(0.5 + 0.2 * rows.sum(axis=1), 0.05, 0.95))
    found = np.exp(model.log_vote[1, :, 2])
    assert np.abs(found[[0, 2]] - right[[0, 2]]).max() < 0.08
    assert model.weight[1] < model.weight[0] and np.mean((model.posterior(votes) > 0.5) == y) > 0.9


def test_toxicity(spark, odd_docs, no_docs):
    rnd = random.Random(9)
    plain = ["".join(rnd.choice("aeiou") + rnd.choice("lmnrst") for _ in range(3)) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        own = rnd.choices(plain, k=60)
        toxic = int(rnd.random() < 0.2)
        if toxic:
            own[rnd.randrange(60)] = rnd.choice(["vilescum", "vileidiot", "gronk"])
            own[rnd.randrange(60)] = rnd.choice(["gronk", "vileword"])
        rows.append((i, " ".join(own)))
        labels.append((i, toxic))
    labels += [(5000, 1), (None, 1), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    learned = fold("doc_id", 5) != 0
    model = train_toxicity(docs.filter(learned), marks.filter(learned))
    held = score_toxicity(docs.filter(~learned), model).join(marks, "doc_id").collect()
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in held)
    found = score_toxicity(odd_docs, model).collect()
    assert len(found) == odd_docs.count() and not any(r.predicted for r in found)
    assert drop_toxic(odd_docs, model).exceptAll(odd_docs).count() == 0
    untaught = train_toxicity(odd_docs, marks.limit(0))
    assert not any(r.predicted for r in score_toxicity(odd_docs, untaught).collect())
    assert score_toxicity(no_docs, train_toxicity(no_docs, marks)).count() == 0


def test_quality(spark, sf_dir, odd_docs, no_docs):
    rows = queries.op9_quality(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
    found = score_quality(odd_docs, train_quality(odd_docs)).collect()
    assert len(found) == odd_docs.count() and all(0 <= r.score <= 1 for r in found)
    assert score_quality(no_docs, train_quality(no_docs)).count() == 0


def test_folds(spark):
    rows = spark.range(200).select("id", fold("id", 5).alias("fold")).collect()
    assert all(r.fold == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


def test_pipeline_stages(spark, sf_dir, odd_docs, no_docs):
    import corpus_pipeline

    docs = table(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert 0 < docs.count() <= before
    bench = table(spark, sf_dir, "benchmark")
    assert contamination_report(docs, bench).filter("contaminated").count() == 0
    assert docs.select("text").distinct().count() == docs.count()
    pieces = corpus_pipeline.run(spark, sf_dir)
    assert pieces.select("doc_id").distinct().count() == docs.count()
    for rows in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, rows, sf_dir)
            assert name == "packing" or result.columns == rows.columns
            result.count()


@pytest.mark.parametrize(
    ("text", "kind", "source"),
    [
        ("ip one nine two dot one six eight dot one dot one now", "ip", "one nine two dot one six eight dot one dot one"),
        ("ip one two seven dot zero dot zero dot one", "ip", "one two seven dot zero dot zero dot one"),
        ("ip ten 10 dot one dot 2 [dot] three", "ip", "10 dot one dot 2 [dot] three"),
        ("ip one nine two.one six eight.one.one", "ip", "one nine two.one six eight.one.one"),
        ("call +one 555 123 four five 67", "phone", "+one 555 123 four five 67"),
    ],
)
def test_short_runs_of_spelled_digits(text, kind, source):
    base, added = find_spans(text)
    assert (kind, source) in [(KINDS[s.kind], text[s.start : s.end]) for s in added]


def test_short_runs_do_not_hide_what_long_ones_show():
    _, added = find_spans("pay two ４111 1111 1111 1111 now, one of two.")
    assert [KINDS[s.kind] for s in added] == ["card"]


def test_blocks_of_a_benchmark_are_searched_one_at_a_time(spark, sf_dir, monkeypatch):
    from sensorweave.llm import decontaminate

    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    want = sorted(map(tuple, contamination_report(docs, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", max(1, sum(len(r.text.split()) for r in benchmark.collect()) // 4))
    found = contamination_report(docs, benchmark)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted(map(tuple, found.collect())) == want


def test_labels_tie_the_classes_of_the_generative_model():
    """Voters 0 to 2 fire together on one kind of toxic text, 3 to 6 on a smaller one; the last one speaks for clean texts."""
    rows = [[0] * 7 + [-1], [1, 1, 1, 0, 0, 0, 0, 0], [1, 1, 0, 0, 0, 0, 0, 0], [0, 0, 0, 1, 1, 1, 1, 0], [0, 0, 0, 1, 1, 0, 1, 0]]
    rows += [[0, 0, 0, 0, 1, 1, 1, 0], [0, 0, 0, 1, 0, 0, 0, 0], [0, 0, 0, 0, 0, 1, 0, 0]]
    votes, counts = np.array(rows), np.array([8800.0, 500, 100, 60, 40, 40, 20, 30])
    known = np.zeros((2, len(rows)))
    known[0, [0, 6, 7]], known[1, 1:6] = [3500, 7, 11], [200, 40, 25, 16, 16]
    start = np.clip(0.1 + 0.25 * votes.sum(axis=1), 0.05, 0.95)
    posterior = expectation_maximisation(votes, counts, start, known=known).posterior(votes)
    assert posterior[0] < 0.1 and all(posterior[1:6] > 0.5), posterior
    # Repeated labels of a document may outnumber its rows.
    assert np.isfinite(expectation_maximisation(votes, counts, start, known=known * 9).posterior(votes)).all()
