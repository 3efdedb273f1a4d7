"""Encoding and decoding with a public tokenizer's vocabulary, by a table of distinct words.

White space never joins two pieces of the vocabulary, so a text's ids are its words' ids one
after another; nor do letters and the points or commas behind them, and case is ignored, so
``The``, ``the`` and ``the,`` share the word ``the``. Steps:

1. every task counts its words; summed over all tasks they are the word table;
2. each word of the table that occurs twice or more is encoded once, by the tokenizers
   library; one that occurs once is encoded in its place;
3. the most frequent words, a fixed number at most, go to every task. For all others a block
   of documents asks once a word, by a join with the table, and the answers meet the block's
   documents again, which travel compressed;
4. ids are put in place by position.

``decode`` joins ids with their pieces by position in the id-to-piece table, whole columns at
once. The table has a fixed size and is known to every task, so the join needs no shuffle.
A block is a range of doc_id, cut where its texts hold too many bytes, so texts in id order
share blocks; any ids give right results.

Defined results: a null or empty text has no ids and decodes to an empty text; repeated rows
are encoded each for itself; an empty table gives an empty result; a null doc_id is kept;
other columns are ignored.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import batched, chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from ledgertalk.llm.common import compressed, decompressed, few_at_once, in_blocks, with_fields
from ledgertalk.sources.scratch import stored

# Spark runs a task on each core already.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Documents of a block, and bytes of their texts beyond which it is cut.
BLOCK_DOCS, BLOCK_BYTES = 4096, 32 << 20
# Ranges that are cut are broadcast up to this number (16 MB), joined by a shuffle beyond it.
MOST_BROADCAST_RANGES = 1_000_000
# Distinct words that a task holds before it passes them on.
HELD_WORDS = 150_000
# Most words that every task knows, and the longest of them in bytes.
FREQUENT, FREQUENT_BYTES = 1 << 18, 64
ENCODED_AT_ONCE = 2_000
TEXTS_AT_ONCE = 256
# Bytes of ids after which no further text is decoded with the ones before.
DECODED_AT_ONCE = 1 << 24
# Units whose ids a worker remembers.
REMEMBERED = 500_000


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def _letter_tokenizer(path: str) -> Tokenizer:
    """The same vocabulary for texts of lower-case letters and single spaces, which the
    normalizer and the pattern that parts words would leave as they are."""
    found = Tokenizer.from_file(path)
    found.normalizer = normalizers.Sequence([])
    found.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.CharDelimiterSplit(" "),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return found


@lru_cache(maxsize=4)
def pieces(path: str) -> pa.Array:
    """The id-to-piece table; ids without a piece read as nothing."""
    known = tokenizer(path)
    return pa.array([known.id_to_token(i) or "" for i in range(known.get_vocab_size())])


@lru_cache(maxsize=4)
def _ends_word(path: str) -> np.ndarray:
    return pc.ends_with(pieces(path), "</w>").to_numpy(zero_copy_only=False)


def words_of(text: str | None) -> list[str]:
    """Words between white space as the tokenizer knows it: Python's, but for the four
    separators U+001C to U+001F, which are no white space there."""
    if not text:
        return []
    if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
        for space in "\t\n\v\f\r":
            text = text.replace(space, " ")
        return [w for w in text.split(" ") if w]
    return text.split()


class Memory:
    """Ids by text, for one worker. When full it stays as it is, for what is frequent came
    early, unless it has come to know little of what is asked."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.known: dict[str, bytes] = {}

    def missing(self, wanted: set[str]) -> list[str]:
        unknown = [text for text in wanted if text not in self.known]
        if len(self.known) >= self.most and 4 * len(unknown) > 3 * len(wanted):
            self.known.clear()
            return list(wanted)
        return unknown

    def learn(self, texts: list[str], ids: list[bytes]) -> None:
        self.known.update(zip(texts, ids, strict=True))

    def forget_beyond(self, texts: list[str]) -> None:
        """Drop these again if there are too many by now."""
        if len(self.known) > self.most:
            for text in texts:
                del self.known[text]


_letters: dict[str, Memory] = {}


def _ids(found: list[int]) -> bytes:
    return np.asarray(found, dtype="<u4").tobytes()


def _encoded_letters(words: list[str], path: str) -> list[bytes]:
    """Ids of words that are lower-case letters only, many in one text: each ends with a piece
    that ends a word, and no other of its pieces does."""
    found: list[bytes] = []
    for at in range(0, len(words), ENCODED_AT_ONCE):
        part = words[at : at + ENCODED_AT_ONCE]
        ids = np.asarray(
            _letter_tokenizer(path)
            .encode_batch_fast([" ".join(part)], add_special_tokens=False)[0]
            .ids,
            dtype="<u4",
        )
        ends = np.flatnonzero(_ends_word(path)[ids]) + 1
        if len(ends) != len(part):
            found += _encoded_alone(part, path)
            continue
        whole = ids.tobytes()
        starts = [0, *(4 * ends[:-1]).tolist()]
        found += [whole[a:b] for a, b in zip(starts, (4 * ends).tolist(), strict=True)]
    return found


def _encoded_alone(words: list[str], path: str) -> list[bytes]:
    found: list[bytes] = []
    for at in range(0, len(words), ENCODED_AT_ONCE):
        part = tokenizer(path).encode_batch_fast(
            words[at : at + ENCODED_AT_ONCE], add_special_tokens=False
        )
        found += [_ids(x.ids) for x in part]
    return found


def _regular(letters: str) -> bool:
    """Whether letters are in normal form and their lower case is letters that do not depend
    on their place."""
    lower = letters.lower()
    return lower.isalpha() and "\u03a3" not in letters and is_normalized("NFC", lower)


def units(word: str) -> tuple[str, ...]:
    """What a word's ids are made of: its letters in lower case and the signs behind them, or
    the word itself if it has any other form."""
    core = word.rstrip(".,")
    if core.isalpha() and (core.isascii() or _regular(core)):
        return (core.lower(), word[len(core) :]) if len(core) < len(word) else (core.lower(),)
    return (word,)


def forget(path: str) -> None:
    """Drop what this worker remembers of a vocabulary."""
    _letters.pop(path, None)
    for cached in (tokenizer, _letter_tokenizer, pieces, _ends_word):
        cached.cache_clear()


def encoded_units(wanted: list[str], path: str) -> list[bytes]:
    """Ids of units as little-endian unsigned 32-bit integers."""
    letters = [u for u in wanted if u.isalpha() and (u.isascii() or _regular(u))]
    letters = [u for u in letters if u == u.lower()]
    found = dict(zip(letters, _encoded_letters(letters, path), strict=True))
    others = [u for u in wanted if u not in found]
    found.update(zip(others, _encoded_alone(others, path), strict=True))
    return [found[u] for u in wanted]


def encoded_words(words: list[str], path: str, remembered: int | None = None) -> list[bytes]:
    """Ids of whole words, through the worker's memory of units."""
    memory = _letters.setdefault(path, Memory(REMEMBERED))
    memory.most = REMEMBERED if remembered is None else remembered
    parts = list(map(units, words))
    unknown = memory.missing(set(chain.from_iterable(parts)))
    memory.learn(unknown, encoded_units(unknown, path))
    known = memory.known
    found = [known[p[0]] if len(p) == 1 else known[p[0]] + known[p[1]] for p in parts]
    memory.forget_beyond(unknown)
    return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: Counter[str] = Counter()

    def flush() -> pa.RecordBatch:
        found: dict[str, int] = {}
        for word, n in words.items():
            for unit in units(word):
                found[unit] = found.get(unit, 0) + n
        words.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
            ["unit", "n"],
        )

    for batch in batches:
        for text in few_at_once(batch.column("text")):
            words.update(words_of(text))
            if len(words) > HELD_WORDS:
                yield flush()
    yield flush()


def word_table(docs: DataFrame, path: str) -> DataFrame:
    """``unit, n, ids``: every unit that occurs twice or more in all texts, with its count."""

    def with_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.greater(batch.column("n"), 1))
            ids = encoded_units(batch.column("unit").to_pylist(), path)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.binary())], ["unit", "n", "ids"]
            )

    counts = docs.select("text").mapInArrow(_counted, "unit string, n long")
    counts = counts.groupBy("unit").agg(F.sum("n").alias("n"))
    return stored(counts.mapInArrow(with_ids, "unit string, n long, ids binary"), "words")


def frequent(table: DataFrame, most: int = FREQUENT) -> DataFrame:
    """The rows of the most frequent units, at most ``most`` of them: all above the lowest
    count that leaves no more. Counts are taken in steps of a fifth of an octave."""
    step = F.floor(5 * F.log2("n")).cast("int")
    short = table.filter(F.octet_length("unit") <= FREQUENT_BYTES).withColumn("step", step)
    # At most 5 * 63 rows.
    steps = sorted(short.groupBy("step").count().collect(), key=lambda r: -r["step"])
    lowest, total = None, 0
    for row in steps:
        total += row["count"]
        if total > most:
            break
        lowest = row["step"]
    if lowest is None:
        return short.limit(0)
    return short.filter(F.col("step") >= lowest)


def _rare(known: Broadcast[dict[str, bytes]]):
    """Units of a block's texts that are not frequent, each once."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, set[str]] = {}
        count = 0
        often = known.value

        def flush() -> Iterator[pa.RecordBatch]:
            for block, words in held.items():
                found = {u for word in words for u in units(word) if u not in often}
                listed = pa.array(list(found), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(listed), block, dtype=np.int64)), listed],
                    ["block", "unit"],
                )
            held.clear()

        for batch in batches:
            for block, text in zip(
                few_at_once(batch.column("block")), few_at_once(batch.column("text")), strict=True
            ):
                words = held.setdefault(block, set())
                count -= len(words)
                words.update(words_of(text))
                count += len(words)
                if count > HELD_WORDS:
                    yield from flush()
                    count = 0
        yield from flush()

    return find


def encode(
    docs: DataFrame, path: str, text_column: str = "text", back: bool = False
) -> DataFrame:
    """``doc_id, ids`` for every row; ids as little-endian unsigned 32-bit integers. With
    ``back``, each task decodes its ids again, as ``decode`` would, into ``decoded``."""
    blocked = in_blocks(
        docs.select("doc_id", F.col(text_column).alias("text")),
        BLOCK_DOCS,
        BLOCK_BYTES,
        MOST_BROADCAST_RANGES,
    )
    table = word_table(blocked, path)
    # At most FREQUENT rows of at most FREQUENT_BYTES.
    often = frequent(table).select("unit", "ids").toArrow()
    common = dict(zip(often["unit"].to_pylist(), often["ids"].to_pylist(), strict=True))
    shared = docs.sparkSession.sparkContext.broadcast(common)
    asked = blocked.select("block", "text").mapInArrow(_rare(shared), "block long, unit string")
    answers = asked.join(table.select("unit", "ids"), "unit").select("block", "unit", "ids")
    schema = with_fields(
        docs.select("doc_id").schema, "ids binary" + ", decoded string" * back
    )

    def in_place(rows: pa.Table, rare: pa.Table) -> pa.Table:
        often = shared.value
        here = dict(
            zip(rare.column("unit").to_pylist(), rare.column("ids").to_pylist(), strict=True)
        )
        ids: dict[str, bytes] = {}
        found = []
        for texts in batched(decompressed(rows.column("text").to_pylist()), TEXTS_AT_ONCE):
            split = [words_of(text) for text in texts]
            distinct = set(chain.from_iterable(split))
            new = {word: units(word) for word in distinct if word not in ids}
            once = [u for us in new.values() for u in us if u not in often and u not in here]
            here.update(zip(once, encoded_units(once, path), strict=True))
            for word, us in new.items():
                ids[word] = b"".join([often[u] if u in often else here[u] for u in us])
            found += [b"".join([ids[w] for w in words]) for words in split]
        columns = [rows.column("doc_id"), pa.array(found, pa.binary())]
        if back:
            columns.append(decoded(found, path))
        return pa.table(columns, names=schema.names)

    return (
        compressed(blocked)
        .groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(in_place, schema)
    )


def decoded(found: list[bytes], path: str) -> pa.ChunkedArray:
    """Texts of rows of ids: the ids' pieces, parted by spaces."""

    def join(part: list[bytes]) -> pa.Array:
        ends = np.cumsum([0, *[len(ids) // 4 for ids in part]])
        ids = pa.array(np.frombuffer(b"".join(part), dtype="<u4"))
        return pc.binary_join(
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces(path).take(ids)), " "
        )

    texts: list[pa.Array] = []
    part: list[bytes] = []
    held = 0
    for ids in found:
        part.append(ids)
        held += len(ids)
        if held >= DECODED_AT_ONCE:
            texts.append(join(part))
            part, held = [], 0
    texts.append(join(part))
    return pa.chunked_array(texts, pa.string())


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows with ``decoded``: pieces of their ids, parted by spaces, as the library's
    decode gives them for a tokenizer without a decoder."""
    schema = with_fields(encoded.schema, "decoded string")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = decoded(batch.column("ids").to_pylist(), path)
            table = pa.table([*batch.columns, found], names=schema.names)
            yield from table.to_batches()

    return encoded.mapInArrow(texts, schema)
