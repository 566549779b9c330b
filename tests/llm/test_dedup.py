"""Exact and near duplicates and repeated strings, against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from sensorweave.llm.common import table
from sensorweave.llm.components import connected_components
from sensorweave.llm.exact_dedup import QuotientFilter, drop_duplicates, mark_duplicates
from sensorweave.llm.simhash import drop_near_duplicates, grid_cells, links, near_duplicates, spanning_links
from sensorweave.llm.suffix_dedup import repeat_report, window_classes


def pairs(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_quotient_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    block, bits = 5, 4
    values = [rng.integers(0, 500, 400).astype(np.uint64) * np.uint64(0x3FFFFFFFFFF) | np.uint64(block << 60) for _ in range(3)]
    parts = [QuotientFilter.load(QuotientFilter.of(v).dump(bits), block, bits) for v in values]
    merged = QuotientFilter.merged(parts)
    want, counts = np.unique(np.concatenate(values), return_counts=True)
    assert (merged.fingerprints == want).all() and (merged.counts == counts).all()


def test_exact_duplicates_of_odd_rows(spark, odd_docs, no_docs):
    rows = mark_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    texts = {}
    for doc_id, text in odd_docs.select("doc_id", "text").collect():
        texts.setdefault(text or "", []).append(doc_id)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in texts.items()}
    for row in rows:
        ids = by_hash[row.text_sha256]
        assert row.group_size == len(ids)
        assert row.keep_id == max((i for i in ids if i is not None), default=None)
    assert sum(r.kept for r in rows) == len(texts)
    assert drop_duplicates(odd_docs).count() == len(texts)
    assert drop_duplicates(odd_docs).columns == odd_docs.columns
    assert mark_duplicates(no_docs).count() == 0


def hamming(a, b):
    return bin((a ^ b) & (2**64 - 1)).count("1")


def test_grid_meets_every_pair_within_three_bits():
    rnd = random.Random(3)
    for segment in (1, 2):
        for _ in range(300):
            a = rnd.getrandbits(64)
            b = a
            for bit in rnd.sample(range(64), 3):
                b ^= 1 << bit
            cells, owners = grid_cells(np.array([a, b], np.uint64), segment)
            assert set(cells[owners == 0].tolist()) & set(cells[owners == 1].tolist())


def test_links_connect_what_is_close_also_in_large_cells(spark, monkeypatch):
    from sensorweave.llm import simhash

    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(5)]
    values = {b ^ sum(1 << k for k in rnd.sample(range(64), rnd.randint(0, 3))) for b in base for _ in range(60)}
    monkeypatch.setattr(simhash, "CELL_BLOCK", 16)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    stars = connected_components(links(df).toDF("u", "v"))
    root = {r.node: r.root for r in stars.collect()}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    parent = {v: v for v in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in signed:
        for b in signed:
            if hamming(a, b) <= 3:
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    assert {v: root.get(v, v) for v in signed} == {v: find(v) for v in signed}


def test_spanning_links_are_few():
    keys, values = np.zeros(200, np.int64), np.zeros(200, np.uint64)
    a, _ = spanning_links(keys, values, np.zeros(200, np.int64), 3)
    assert len(a) == 199


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 201), (5, 5)], "u long, v long")
    root = {r.node: r.root for r in connected_components(edges).collect()}
    assert root == {i: 0 for i in range(101)} | {200: 200, 201: 200}


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_against_brute_force(spark, sf_dir, odd_docs, no_docs):
    for docs in (table(spark, sf_dir, "documents"), odd_docs):
        rows = [(r.doc_id, fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
        component = list(range(len(rows)))

        def find(x, component=component):
            while component[x] != x:
                x = component[x]
            return x

        for i in range(len(rows)):
            for j in range(i):
                if hamming(rows[i][1], rows[j][1]) <= 3:
                    a, b = find(i), find(j)
                    component[max(a, b)] = min(a, b)
        lowest = {}
        for i, (doc_id, _) in enumerate(rows):
            if doc_id is not None:
                lowest[find(i)] = min(lowest.get(find(i), doc_id), doc_id)
        want = [(d, f"{f:016x}", lowest.get(find(i))) for i, (d, f) in enumerate(rows)]
        found = near_duplicates(docs)
        assert pairs(found, "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)
    assert near_duplicates(no_docs).count() == 0
    assert drop_near_duplicates(odd_docs).columns == odd_docs.columns


def repeats_by_brute_force(rows, width=50):
    first = {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        for p in range(len(raw) - width + 1 if doc_id is not None else 0):
            first[raw[p : p + width]] = min(first.get(raw[p : p + width], doc_id), doc_id)
    result = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - width + 1 if doc_id is not None else 0):
            if first[raw[p : p + width]] < doc_id:
                gone[p : p + width] = b"\1" * width
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        result.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(result, key=repr)


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_repeats_of_documents_and_odd_rows(spark, sf_dir, odd_docs, no_docs):
    for docs in (table(spark, sf_dir, "documents"), odd_docs):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        assert pairs(repeat_report(docs), *COLUMNS) == repeats_by_brute_force(rows)
    assert repeat_report(no_docs).count() == 0


def test_repeats_of_mixed_strings(spark):
    rnd = random.Random(3)
    base = ["".join(rnd.choice("ab\0é") for _ in range(300)) for _ in range(5)]
    rows = [(i, "".join(b[(s := rnd.randint(0, 200)) : s + rnd.randint(0, 120)] for b in rnd.choices(base, k=4))) for i in range(120)]
    rows += [(1000 + i, "ab" * rnd.randint(0, 400)) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert pairs(repeat_report(docs), *COLUMNS) == repeats_by_brute_force(rows)


@pytest.mark.parametrize("width", [50, 51, 52])
def test_window_classes_are_the_equal_windows(width):
    rnd = random.Random(width)
    strings = [bytes(rnd.choice(b"ab") for _ in range(rnd.choice([width, width + 7, 3 * width]))) for _ in range(40)]
    strings += [s[3:] + s[:3] for s in strings] + [b"a" * 200, b"\0" * 70]
    classes, sizes = window_classes(strings, width)
    windows = [s[i : i + width] for s in strings for i in range(len(s) - width + 1)]
    assert len(classes) == len(windows) == sizes.sum()
    assert len(set(zip(classes.tolist(), windows))) == len(set(windows)) == len(set(classes.tolist()))


def five_word_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def kept_by_jaccard(rows):
    """Ids that stay, by comparing every pair of the rows (ids distinct, not null)."""
    sets = [five_word_set(text) for _, text in rows]
    lowest = list(range(len(rows)))

    def find(x):
        while lowest[x] != x:
            x = lowest[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                lowest[max(a, b)] = min(a, b)
    first = {}
    for i, (doc_id, _) in enumerate(rows):
        first[find(i)] = min(first.get(find(i), doc_id), doc_id)
    return sorted(first.values())


def edited_copies(bases, copies, seed):
    """Texts of 100 to 300 words, each with copies in which 1 to 8 words are changed."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(bases):
        words = [f"w{rnd.randrange(5000)}" for _ in range(rnd.randint(100, 300))]
        for k in range(copies + 1):
            some = list(words)
            for at in rnd.sample(range(len(words)), rnd.randint(1, 8) if k else 0):
                some[at] = f"x{rnd.randrange(5000)}"
            rows.append((len(rows), " ".join(some)))
    return rows


@pytest.mark.parametrize("sets_at_once", [1024, 4])
def test_pipeline_stage_drops_five_word_copies(spark, monkeypatch, sets_at_once):
    import corpus_pipeline
    from sensorweave.llm import minhash

    monkeypatch.setattr(minhash, "BLOCK_SETS", sets_at_once)
    rows = edited_copies(12, 14, seed=7) + [(900, "a b"), (901, "A  b"), (902, ""), (903, " "), (904, "a c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == kept_by_jaccard(rows)


def test_pipeline_stage_keeps_odd_rows(spark, odd_docs, no_docs):
    import corpus_pipeline

    kept = corpus_pipeline.near_duplicates(spark, odd_docs, "")
    assert kept.columns == odd_docs.columns
    assert {r.doc_id for r in kept.collect()} == {None, 0, 3, 4, 5, 6, 7, 8, 9}  # 1, 2 as 0; 50 as 6; 51 as 7
    assert corpus_pipeline.near_duplicates(spark, no_docs, "").count() == 0


def test_runs_of_a_hot_hash_are_dealt_by_content(spark, monkeypatch):
    from sensorweave.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", 40)
    monkeypatch.setattr(suffix_dedup, "HOT_SAMPLE", 2)
    monkeypatch.setattr(suffix_dedup, "GATHER_BYTES", 20_000)
    in_task = []  # runs of one hash that reach a bucket, seen by settling here
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(8))
    passage = " ".join(word() for _ in range(34))
    own = [(" ".join(word() for _ in range(12)), " ".join(word() for _ in range(12))) for _ in range(150)]
    rows = [(i, f"{a} {passage} {b}") for i, (a, b) in enumerate(own)]
    rows += [(500 + i, f"{a} {passage}") for i, (a, _) in enumerate(own[:40])] + [(3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    keyed = docs.selectExpr("doc_id AS id", "CAST(text AS binary) AS text")
    hot = suffix_dedup.hot_hashes(keyed, 50)
    assert len(hot)
    deal = suffix_dedup.Gathered(1, 50, hot)
    for _, blob in deal(np.array([i for i, _ in rows]), np.zeros(len(rows), np.int32), [t.encode() for _, t in rows]):
        content = suffix_dedup.pickle.loads(suffix_dedup.zstandard.ZstdDecompressor().decompress(blob))
        in_task += suffix_dedup.smallest_hashes(content[6], content[5].astype(np.int64) + 49).tolist()
    assert in_task and not set(in_task) & set(hot.tolist())
    assert pairs(repeat_report(docs), *COLUMNS) == repeats_by_brute_force(rows)


def test_settled_ranges_are_one_row_per_bucket_and_part(monkeypatch):
    """However many documents of a bucket lose bytes; only strings with a shared window are sorted."""
    from sensorweave.llm import suffix_dedup

    sorted_strings = []

    def classes_of(strings, width):
        sorted_strings.extend(strings)
        return window_classes(strings, width)

    monkeypatch.setattr(suffix_dedup, "window_classes", classes_of)
    rnd = random.Random(11)
    some = lambda n: "".join(rnd.choice("abcdefghij ") for _ in range(n))
    passage, short = some(120), some(30)  # the short one holds shared anchors, but no shared window
    rows = [(i, some(60) + (passage if i % 4 == 0 else short) + some(60)) for i in range(80)] + [(7, some(40) + passage)]
    blobs = []
    for at in range(0, len(rows), 9):
        deal = suffix_dedup.Gathered(1, 50, np.zeros(0, np.uint32))
        ids, texts = zip(*rows[at : at + 9], strict=True)
        blobs += [blob for _, blob in deal(np.array(ids), np.arange(at, at + len(ids), dtype=np.int32), [t.encode() for t in texts])]
    settled = suffix_dedup.settle_bucket(blobs, 50, 4)
    assert len(settled) <= 4 and settled["part"].is_unique
    merged = [row for blob in settled["ranges"] for row in suffix_dedup.merge_part([blob, blob]).itertuples(index=False)]
    found = {int(r.hash): [tuple(x) for x in np.frombuffer(r.ranges, "<i8").reshape(-1, 2).tolist()] for r in merged}
    assert len(found) == len(merged)
    expected = {}
    for k, (i, text) in enumerate(rows):
        gone = [p for p in range(len(text) - 49) if any(j < i and text[p : p + 50] in other for j, other in rows)]
        if gone:
            assert gone == list(range(gone[0], gone[-1] + 1))
            expected[k] = [(gone[0], gone[-1] + 50)]
    assert found == expected and len(found) == 20
    # A shared window is the passage's, or that and some bytes that happen to be alike.
    assert sorted_strings and all(any(s[p : p + 40] in passage.encode() for p in range(len(s) - 39)) for s in sorted_strings)
