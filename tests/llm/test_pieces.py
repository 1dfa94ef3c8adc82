import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece.sentencepiece_model_pb2 import NormalizerSpec

from lendwatch.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = [
    "a", "b", "Z", "1", " ", "  ", "\t", "\n", "\r", "\x00", "\x07", "é", "́", "ﬁ", "ｆ", "㈱", "①", "é", "ß", "ﷺ", " ",
    "　", "▁", "¨", "가", "각", "가", "😀", "�", "​", "İ", "Å", "½", ".", "the", "\U0010ffff"]


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices(LETTERS, k=rng.randrange(14))) for _ in range(n)]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
@pytest.mark.parametrize("escape", [True, False])
def test_normaliser_equals_the_library(rule, prefix, squeeze, escape):
    theirs = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=prefix, remove_extra_whitespaces=squeeze, escape_whitespaces=escape)
    spec = NormalizerSpec()
    spec.ParseFromString(theirs.serialized_normalizer_spec())
    ours = P.Normaliser(spec)
    for text in ["", " ", "   ", "a", " a  b ", *texts(1, 600)]:
        want, offsets = theirs.Normalize(text, with_offsets=True)
        got, source = ours(text)
        assert got.decode() == want, text
        # The library counts characters here: compare at their beginnings.
        data, places = text.encode(), [i for i, b in enumerate(got) if b & 0xC0 != 0x80] + [len(got)]
        assert [len(data[: source[i]].decode()) for i in places] == list(offsets), text


def brute(library, text):
    found = library.encode(text, return_type="proto").pieces
    return [p.id for p in found], [p.begin for p in found], [p.end for p in found]


def test_pieces_and_spans_equal_the_library():
    ours, theirs = P.Pieces(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = [*texts(2, 1500), "", " ", " " * 40 + "x" + " " * 17, "<s> </s> <0x41> <unk>", "word " * 3000, "x" * 5000, "\n" * 3000]
    for text, (ids, starts, ends) in zip(rows, ours.encode(rows), strict=True):
        assert (ids.tolist(), starts.tolist(), ends.tolist()) == brute(theirs, text), text
        assert ours.decode(ids) == theirs.decode(ids.tolist())
        assert sum(ends - starts) == len(text.encode())


def test_a_model_with_a_character_map(tmp_path):
    """The same vocabulary behind another normaliser, without byte pieces and with a symbol."""
    from sentencepiece.sentencepiece_model_pb2 import ModelProto

    model = ModelProto()
    with open(PATH, "rb") as file:
        model.ParseFromString(file.read())
    spec = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_normalizer_spec()
    model.normalizer_spec.ParseFromString(spec)
    for piece in model.pieces:
        if piece.type == 6:
            piece.type = 5
    model.trainer_spec.byte_fallback = False
    model.pieces[300].piece, model.pieces[300].type = "ﬁ<x>", 4
    path = tmp_path / "mapped.model"
    path.write_bytes(model.SerializeToString())
    ours, theirs = P.Pieces(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))
    rows = [*texts(3, 800), "a ﬁ<x> b", "ﬁ<", "ſﬁ<x>ﬁ"]
    for text, (ids, starts, ends) in zip(rows, ours.encode(rows), strict=True):
        assert (ids.tolist(), starts.tolist(), ends.tolist()) == brute(theirs, text), text


def test_query_on_whole_tables(spark, all_docs):
    theirs = sentencepiece.SentencePieceProcessor(model_file=PATH)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for r in all_docs.collect():
        ids = theirs.encode(r.text or "")
        want.add((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(theirs.decode(ids)), len((r.text or "").encode())))
    assert {tuple(r) for r in P.encode_report(all_docs, PATH).collect()} == want


def test_edges(docs_of, monkeypatch):
    monkeypatch.setattr(P, "_SLICE", 10)
    rows = [(1, None), (1, ""), (None, "some text"), (2, "word " * 100_000), (3, " " * 1_000_000), (4, "a"), (4, "a")]
    df = docs_of(rows, 1).selectExpr("*", "1 as ids", "2 as `a.b`")
    got = {(r.doc_id, len(r.text or "")): r for r in P.encode(df, PATH).collect()}
    assert len(P.encode(df, PATH).collect()) == 7
    assert got[(1, 0)].ids == [] and got[(1, 0)].decoded == "" and got[(1, 0)]["a.b"] == 2
    assert got[(2, 500_000)].decoded == "word " * 100_000 and got[(3, 1_000_000)].ends[-1] == 1_000_000
    assert P.encode_report(docs_of([]), PATH).collect() == []
