"""SentencePiece encoding and decoding of whole texts with a public BPE model.

A text is the sequence of its characters, spaces written as U+2581 and one put before it. The
model merges the neighbours whose joined piece has the best score, the leftmost of equals, until
none is a piece. The result is found without those merges, from left to right:

1. an Aho-Corasick automaton over all pieces gives the longest piece from each position;
2. a piece is taken if it can stand behind the one before it: merging the characters of both
   again must give just these two. Neighbours that agree pairwise are the merge result;
3. if not, its longest shorter prefix is tried; if none is left, the position is marked in a
   field of failed positions, and the piece before it gives way. A position is reached by one
   sequence only, so it fails at most once, and the work is linear in the text.

No piece of the vocabulary runs over certain places (before a space, between a letter and a
sign), which is read from the vocabulary. Texts are cut there and a worker remembers the ids of
a bounded number of words. Texts are independent of each other, so nothing is shuffled.

``encode`` gives ids, ``decode`` gives the text of ids through the id-to-piece table.

Defined results: a null or empty text has the end id alone and decodes to an empty text; U+2581
in a text decodes to a space, as the library gives it; characters without a piece become the
pieces of their bytes; repeated rows, a null or repeated doc_id are encoded each for itself; an
empty table gives an empty result; other columns are ignored. A model of another kind than the
above (other normalisation, no byte pieces) is refused with a ValueError.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from ledgertalk.llm.common import few_at_once, with_fields

SPACE = "▁"
# Words and neighbouring pieces that a worker remembers, and the longest word among them.
WORDS, PAIRS, LONGEST = 250_000, 300_000, 48
# Ids in an Arrow batch that is passed on.
IDS_AT_ONCE = 1 << 20
# Numbers that Python counts among the letters of a word are none here.
LETTERS_OR_NOT = re.compile(r"[^\W\d_²³¹¼½¾]+|[\W\d_²³¹¼½¾]+")
LETTER = re.compile(r"[^\W\d_²³¹¼½¾]")
# A space in front, then everything up to the next word.
SPACED = re.compile(f"{SPACE}({SPACE}*[^{SPACE}]*)")
# A text in which any model that is not refused must agree with the library.
PROBE = " A  probe,\tof ﬁve 12345 signs\u0001 é世\U0001f600 "


class Recent:
    """Values by text, of which the last ones used are kept: at most twice ``most``."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, text: str, make: Callable[[str], bytes]) -> bytes:
        """The value of a text that was not in ``young`` a while ago."""
        found = self.young.get(text) or self.old.get(text)
        if found is None:
            found = make(text)
        if len(text) <= LONGEST:
            if len(self.young) >= self.most:
                self.old, self.young = self.young, {}
            self.young[text] = found
        return found


class Pieces:
    """A model's vocabulary with what encoding by backtracking needs."""

    def __init__(self, path: str) -> None:
        model = SentencePieceProcessor(model_file=path)
        self.end = model.eos_id()
        size = model.get_piece_size()
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        # Bytes of every id in a decoded text: control ids read as nothing.
        self.surface: list[bytes] = [b""] * size
        self.byte_ids = [0] * 256
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.surface[i] = bytes([value])
            elif model.is_unknown(i):
                self.surface[i] = " ⁇ ".encode()
            elif not model.is_control(i):
                self.ids[piece] = i
                self.score[piece] = model.get_score(i)
                self.surface[i] = piece.replace(SPACE, " ").encode()
        self.automaton = ahocorasick.Automaton()
        for piece in {*self.ids, *"".join(self.ids)}:
            self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        joints = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.cut_at_spaces = not any(j[0] != SPACE and j[1] == SPACE for j in joints)
        self.cut_at_letters = self.cut_at_spaces and all(
            bool(LETTER.match(a)) == bool(LETTER.match(b)) for a, b in joints if a != SPACE
        )
        self._shorter: dict[str, str] = {}
        self._fits: dict[tuple[str, str], bool] = {}
        self._words = Recent(WORDS)
        if 0 in self.byte_ids or model.encode(PROBE) != self.encoded(PROBE).tolist():
            raise ValueError(f"{path} is not a BPE model with byte pieces and kept spaces")

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging neighbours, the best score first."""
        parts = list(text)
        score = self.score
        while True:
            best, at = None, 0
            for i in range(len(parts) - 1):
                found = score.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or found > best):
                    best, at = found, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, left: str, right: str) -> bool:
        """Whether ``right`` can follow ``left`` ("" at the start of a text)."""
        found = self._fits.get((left, right))
        if found is None:
            if len(self._fits) >= PAIRS:
                self._fits.clear()
            wanted = [left, right] if left else [right]
            found = self._fits[left, right] = self.merged(left + right) == wanted
        return found

    def shorter(self, piece: str) -> str:
        """The longest piece, or else character, that ``piece`` begins with, "" if none."""
        found = self._shorter.get(piece)
        if found is None:
            heads = (piece[:n] for n in range(len(piece) - 1, 1, -1))
            found = next((head for head in heads if head in self.ids), piece[: len(piece) > 1])
            self._shorter[piece] = found
        return found

    def backtracked(self, text: str) -> list[str]:
        """Pieces of a text without cuts."""
        longest = [1] * len(text)
        # Matches come by their ends: the last one written for a start is the longest.
        for end, length in self.automaton.iter(text):
            longest[end - length + 1] = length
        failed = bytearray(len(text) + 1)
        fits = self._fits
        taken: list[str] = []
        before, at = "", 0
        while at < len(text):
            piece = text[at : at + longest[at]]
            while True:
                while piece:
                    if not failed[at + len(piece)]:
                        fit = fits.get((before, piece))
                        if self.fits(before, piece) if fit is None else fit:
                            break
                    piece = self.shorter(piece)
                if piece:
                    break
                failed[at] = 1
                taken.pop()
                at -= len(before)
                piece = self.shorter(before)
                before = taken[-1] if taken else ""
            taken.append(piece)
            at += len(piece)
            before = piece
        return taken

    def _part(self, text: str) -> bytes:
        pieces = self.backtracked(text)
        try:
            return array("i", [self.ids[piece] for piece in pieces]).tobytes()
        except KeyError:
            found: list[int] = []
            for piece in pieces:
                known = self.ids.get(piece)
                found += [self.byte_ids[b] for b in piece.encode()] if known is None else [known]
            return array("i", found).tobytes()

    def _ids(self, key: str) -> bytes:
        """Ids of what follows a space, with that space. A key with U+2581 behind it is a part
        of a word that no space is before; a word of several parts is put together of them."""
        if key[-1:] == SPACE and key[0] != SPACE:
            return self._part(key[:-1])
        if not self.cut_at_letters or key.isalpha():
            return self._part(SPACE + key)
        lead = len(key) - len(key.lstrip(SPACE))
        parts = LETTERS_OR_NOT.findall(key, lead)
        if len(parts) < 2:
            return self._part(SPACE + key)
        get, known = self._words.get, self._words.young
        keys = [key[:lead] + parts[0], *[part + SPACE for part in parts[1:]]]
        return b"".join([known.get(k) or get(k, self._ids) for k in keys])

    def encoded(self, text: str) -> np.ndarray:
        """Ids of a text without an end id."""
        if not text:
            return np.empty(0, dtype="<i4")
        spaced = SPACE + text.replace(" ", SPACE)
        if not self.cut_at_spaces:
            return np.frombuffer(self._part(spaced), dtype="<i4")
        words = spaced[1:].split(SPACE)
        if "" in words:
            words = SPACED.findall(spaced)
        found = list(map(self._words.young.get, words))
        if None in found:
            get = self._words.get
            found = [
                get(word, self._ids) if ids is None else ids
                for word, ids in zip(words, found, strict=True)
            ]
        return np.frombuffer(b"".join(found), dtype="<i4")

    def decoded(self, ids: list[int]) -> str:
        text = b"".join(map(self.surface.__getitem__, ids))
        return text.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(docs: DataFrame, path: str, text_column: str = "text", end: bool = True) -> DataFrame:
    """``doc_id, ids`` for every row, ids as ``array<int>``, with the end id last if ``end``."""
    schema = with_fields(docs.select("doc_id").schema, "ids array<int>")

    def batch_of(doc_ids: pa.Array, found: list[np.ndarray]) -> pa.RecordBatch:
        offsets = np.zeros(len(found) + 1, dtype=np.int32)
        np.cumsum([len(x) for x in found], out=offsets[1:])
        values = np.concatenate(found) if found else np.empty(0, dtype="<i4")
        return pa.RecordBatch.from_arrays(
            [doc_ids, pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))],
            schema.names,
        )

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(path)
        last = np.full(int(end), known.end, dtype="<i4")
        for batch in batches:
            doc_ids = batch.column("doc_id")
            found: list[np.ndarray] = []
            start = size = 0
            for row, text in enumerate(few_at_once(batch.column("text"))):
                found.append(np.concatenate([known.encoded(text or ""), last]))
                size += len(found[-1])
                if size > IDS_AT_ONCE:
                    yield batch_of(doc_ids.slice(start, len(found)), found)
                    found, start, size = [], row + 1, 0
            if found:
                yield batch_of(doc_ids.slice(start, len(found)), found)

    return docs.select("doc_id", F.col(text_column).alias("text")).mapInArrow(ids, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows with ``decoded``: the text that their ``ids`` stand for."""
    schema = with_fields(encoded.schema, "decoded string")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(path)
        for batch in batches:
            lists = batch.column("ids")
            found = []
            # One row's ids at a time as Python numbers; a null list has none.
            for row in range(len(lists)):
                ids = lists.slice(row, 1).flatten()
                found.append(known.decoded(ids.to_numpy(zero_copy_only=False).tolist()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string())], schema.names
            )

    return encoded.mapInArrow(texts, schema)
