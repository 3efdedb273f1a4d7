import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from ledgertalk.llm import piece_bpe

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = SentencePieceProcessor(model_file=PATH)
OWN = piece_bpe.pieces(PATH)


def check(text):
    ids = OWN.encoded(text).tolist()
    assert ids == LIBRARY.encode(text), text
    assert OWN.decoded([*ids, OWN.end]) == LIBRARY.decode([*ids, OWN.end]), text


@settings(max_examples=1500, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_any_text(text):
    check(text)


def test_texts_of_pieces_and_spaces():
    rnd = random.Random(7)
    signs = [*list(OWN.ids)[::7], "  ", " ", "\n", "\t", "\0", "▁", "▁▁▁", "12", "², ", "́", "<s>", "</s>", "<0x0A>", "😀"]
    for _ in range(6000):
        check("".join(rnd.choice(signs) for _ in range(rnd.randint(0, 7))))


@pytest.mark.parametrize("text", ["a" * 30_000, "ab" * 20_000, " " * 20_000, "世界" * 9_000, "=-" * 9_000])
def test_long_texts_without_cuts(text):
    check(text)


def test_without_any_cut(monkeypatch):
    """The plain backtracking over a whole text, as for a vocabulary that cannot be cut."""
    own = piece_bpe.Pieces(PATH)
    own.cut_at_spaces = own.cut_at_letters = False
    for text in ("It was the best of times,  it was\nthe worst 1859 of them. ", "ein Übermaß an Wörtern " * 40):
        assert own.encoded(text).tolist() == LIBRARY.encode(text)


def test_memory_stays_bounded(monkeypatch):
    monkeypatch.setattr(piece_bpe, "PAIRS", 20)
    own = piece_bpe.Pieces(PATH)
    own._words.most = 10
    rnd = random.Random(1)
    for _ in range(300):
        text = " ".join("".join(rnd.choice("abcdeé.,") for _ in range(rnd.randint(1, 9))) for _ in range(9))
        assert own.encoded(text).tolist() == LIBRARY.encode(text)
        assert len(own._words.young) <= 10 and len(own._words.old) <= 10 and len(own._fits) <= 20


def test_another_kind_of_model_is_refused(tmp_path):
    with pytest.raises((ValueError, OSError, RuntimeError)):
        piece_bpe.Pieces(public_tokenizers.path("word_bpe_49k.json"))


def test_rows(spark):
    rows = [(1, None, 5), (1, "", 5), (None, "twice told", 5), (2, "twice told", 5), (2, "x " * 70_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    found = piece_bpe.decode(piece_bpe.encode(docs, PATH), PATH).collect()
    assert sorted((r.doc_id or 0, r.ids, r.decoded) for r in found) == sorted(
        (i or 0, LIBRARY.encode(t or "", add_eos=True), t or "") for i, t, _ in rows
    )
    assert piece_bpe.encode(docs.limit(0), PATH).collect() == []
    bare = piece_bpe.encode(docs.filter("doc_id = 1"), PATH, end=False).collect()
    assert [r.ids for r in bare] == [[], []]


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    found = {r.doc_id: r for r in piece_bpe.decode(piece_bpe.encode(docs, PATH), PATH).collect()}
    assert len(found) == len(texts)
    for doc_id, text in texts.items():
        ids = LIBRARY.encode(text, add_eos=True)
        assert found[doc_id].ids == ids
        assert found[doc_id].decoded == LIBRARY.decode(ids)
