import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from sensorweave.llm import queries
from sensorweave.llm.pieces import CharacterMap, Pieces, decode_pieces, encode_pieces, encoding_report

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = "ab te the  ▁▁ x12\t\né漢🦀é́ﬁ①Ａ　\xa0ㅎ㍿ｶﾞ\0"


def folding_map() -> bytes:
    """The library's own compiled map of compatibility forms."""
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    return spec.normalizer_spec.precompiled_charsmap


@pytest.fixture(scope="module")
def variants(tmp_path_factory):
    """Models with and without a map, a space in front, dropped spaces and byte fallback."""
    folder, folding = tmp_path_factory.mktemp("models"), folding_map()
    paths = [MODEL]
    for prefix, squeeze, fallback in ((True, True, True), (True, False, False), (False, True, False), (False, False, True)):
        spec = sentencepiece_model_pb2.ModelProto()
        with open(MODEL, "rb") as file:
            spec.ParseFromString(file.read())
        spec.normalizer_spec.precompiled_charsmap = folding
        spec.normalizer_spec.add_dummy_prefix, spec.normalizer_spec.remove_extra_whitespaces = prefix, squeeze
        spec.trainer_spec.byte_fallback = fallback
        for piece in spec.pieces:
            if piece.type == 6 and not fallback:
                piece.type = 3
        paths.append(str(folder / f"{prefix}-{squeeze}-{fallback}.model"))
        with open(paths[-1], "wb") as file:
            file.write(spec.SerializeToString())
    return paths


def expected(library, text):
    return [(piece.id, piece.begin, piece.end) for piece in library.encode(text, return_type="proto").pieces]


def test_pieces_and_spans_equal_the_library(variants):
    pick = random.Random(7)
    for path in variants:
        coder, library = Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)
        for _ in range(600):
            text = "".join(pick.choice(LETTERS) for _ in range(pick.randint(0, 40)))
            found = coder.encode(text)
            got = list(zip(found.ids.tolist(), found.begins.tolist(), found.ends.tolist(), strict=True))
            assert got == expected(library, text), (path, text)
            assert coder.decode(found.ids.tolist()) == library.decode(found.ids.tolist())


def test_decoding_of_any_ids_equals_the_library(variants):
    pick = random.Random(8)
    for path in variants:
        coder, library = Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)
        for _ in range(600):
            kinds = (lambda: pick.randrange(3), lambda: 3 + pick.randrange(256), lambda: pick.choice([259, 28705]), lambda: pick.randrange(32000))
            ids = [pick.choice(kinds)() for _ in range(pick.randint(0, 12))]
            assert coder.decode(ids) == library.decode(ids), (path, ids)


def test_compiled_map_takes_the_longest_prefix():
    found = CharacterMap(folding_map())
    assert found.longest("①x", 0) == ("1", 1)
    assert found.longest("ｶﾞ", 0) == ("ガ", 2)
    assert found.longest("ｶx", 0) == ("カ", 1)
    assert found.longest("ab", 0) is None


def test_long_chunks_and_very_long_texts():
    coder, library = Pieces(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in ("x" * 70_000, "漢字" * 30_000, "the end. " * 400_000, " " * 5000, "añb" * 5000):
        found = coder.encode(text)
        assert found.ids.tolist() == library.encode(text)
        assert found.begins[0] == 0 and found.ends[-1] == len(text.encode())
        assert (found.begins[1:] == found.ends[:-1]).sum() >= len(found.ids) - 1


def test_report_equals_the_library(spark, sf_dir):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op11_pieces(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert row.n_covered == len(texts[row.doc_id].encode())


def test_odd_documents(odd_docs, no_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    encoded = encode_pieces(odd_docs, MODEL)
    rows = sorted((r.doc_id or -1, r.ids, r.begins, r.ends) for r in encoded.collect())
    texts = sorted((r.doc_id or -1, library.encode(r.text or "")) for r in odd_docs.collect())
    assert [r[:2] for r in rows] == texts
    assert all(len(ids) == len(begins) == len(ends) for _, ids, begins, ends in rows)
    decoded = sorted((r.doc_id or -1, r.text) for r in decode_pieces(encoded, MODEL).collect())
    assert decoded == sorted((r.doc_id or -1, r.text or "") for r in odd_docs.collect())
    assert encoding_report(odd_docs, MODEL).count() == odd_docs.count()
    for empty in (encode_pieces(no_docs, MODEL), encoding_report(no_docs, MODEL)):
        assert empty.collect() == []


def test_unread_kinds_of_models_are_refused(tmp_path):
    spec = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        spec.ParseFromString(file.read())
    spec.trainer_spec.model_type = 1
    path = tmp_path / "scores.model"
    path.write_bytes(spec.SerializeToString())
    with pytest.raises(ValueError):
        Pieces(str(path))
