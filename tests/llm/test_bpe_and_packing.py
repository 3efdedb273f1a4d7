"""Encoding, decoding and packing against the tokenizers library and plain best fit."""

import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from ledgertalk.llm import bpe, packing
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)

rng = random.Random(5)
ODD = [
    None,
    "",
    " \n\t ",
    "İstanbul ΟΔΟΣ οδος Σ a\x1cb x\x1d y <|endoftext|>foo<|startoftext|> don't it's we'll . ,.,",
    "éa ́ 漢字かな, naïve.. ﬁn ǅ 123abc, a1. ½x ² ſt K Å ẞß ŉ ǰ ΐ 's's １２３ ａｂ",
    "The the the, THE. the.. ,the " * 50,
    "x" * 5000,
    "word " * 3000,
]
ODD += [
    "".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x300, 0x3000), 32, 46, 44])) for _ in range(60))
    for _ in range(300)
]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 1000, text, "en") for i, text in enumerate(ODD)]
    rows += [(None, "a null id.", "x"), (3, "twice", "y"), (3, "twice", "z"), (-9, "below zero", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, block string").repartition(3)


def test_encode_and_decode_as_the_library(docs):
    texts = Counter((r.doc_id, r.text) for r in docs.collect())
    found = bpe.encode(docs, PATH, back=True).collect()
    again = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))
    expected = Counter()
    for (doc_id, text), n in texts.items():
        ids = library_ids(text)
        expected[doc_id, tuple(ids), LIBRARY.decode(ids, skip_special_tokens=False)] += n
    assert Counter(
        (r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.decoded) for r in found
    ) == expected


def test_texts_decode_in_parts(monkeypatch):
    ids = [library_ids(text) for text in ODD]
    packed = [np.asarray(x, "<u4").tobytes() for x in ids]
    for most in (1, 100, 1 << 24):
        monkeypatch.setattr(bpe, "DECODED_AT_ONCE", most)
        assert bpe.decoded(packed, PATH).to_pylist() == [
            LIBRARY.decode(x, skip_special_tokens=False) for x in ids
        ]
    assert bpe.decoded([], PATH).to_pylist() == []


def test_rare_words_come_through_the_join(docs, monkeypatch):
    monkeypatch.setattr(bpe.frequent, "__defaults__", (5,))
    found = bpe.encode(docs, PATH).collect()
    by_id = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in found}
    assert all(by_id[i * 1000] == library_ids(text) for i, text in enumerate(ODD))


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(none, PATH), PATH).count() == 0
    assert packing.pack(none, PATH).count() == 0


def test_memory_that_is_full_still_gives_right_ids(monkeypatch):
    monkeypatch.setattr(packing, "_words", {})
    monkeypatch.setattr(bpe, "_letters", {})
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    for _ in range(2):
        for text in ODD:
            (ids,) = packing.token_bytes([text], PATH)
            assert np.frombuffer(ids, "<u4").tolist() == library_ids(text)


def plain_best_fit(lengths, size):
    """Sequences that best-fit decreasing opens, one piece at a time."""
    rooms, opened = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms.pop(at)
        else:
            room, opened = size, opened + 1
        if room > length:
            bisect.insort(rooms, room - length)
    return opened


@pytest.mark.parametrize("seed", range(6))
def test_plan_opens_as_many_sequences_as_plain_best_fit(seed):
    dice = random.Random(seed)
    size = dice.choice([10, 64, 100])
    lengths = [dice.randint(1, size) for _ in range(dice.randint(1, 400))]
    rows = packing.plan(dict(Counter(lengths)), size)
    used = defaultdict(list)
    ranks = defaultdict(int)
    for length, first, count, sequence, each, offset in rows:
        assert first == ranks[length]
        ranks[length] += count
        for j in range(count):
            used[sequence + j // each].append((offset + j % each * length, length))
    assert ranks == Counter(lengths)
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    assert len(used) == plain_best_fit(lengths, size)


def test_pack_places_every_token_once(docs, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_A_BLOCK", 20)
    size = 128
    found = packing.pack(docs, PATH, size).collect()
    of_text = Counter((r.doc_id, tuple(library_ids(r.text) + [0])) for r in docs.collect())
    pieces = Counter()
    for (doc_id, ids), n in of_text.items():
        for k, start in enumerate(range(0, len(ids), size)):
            part = ids[start : start + size]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            pieces[doc_id, k, start, len(part), crc] += n
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == pieces
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
