"""Spelling variants: words grouped with the frequent word that is one edit away.

1. every task counts its words, which are combined before the shuffle; what is frequent enough
   is the vocabulary;
2. letters are hashed to a few symbols, which makes *reduced* words: two words that are one edit
   apart have reduced words that are equal or one edit apart;
3. every distinct reduced word gives its full neighbourhood of one insertion, deletion or
   replacement over the few symbols, each neighbour as a 64-bit polynomial hash that follows from
   the word's own in one step, so a long word costs a few numbers a letter;
4. neighbours meet the reduced vocabulary by a join on that hash: a key has at most as many
   rows as a neighbourhood has members. The words behind both sides are then compared as they
   are, so neither shared symbols nor shared hashes let a wrong pair through;
5. a word's near words are counted and the largest is its form, if large enough; roots are found
   by following forms in steps that double. Counts grow by ``FORM_RATIO`` with every form, so
   there are no cycles and a few rounds reach every root.

A word has no more near words than its length and the alphabet allow, so no group grows with
the corpus but the vocabulary itself.

Defined results: a null or empty text has no words; a null doc_id reads as an empty one where
occurrences are altered; repeated rows count each; ties between near words of equal count go to
the smallest in code-point order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertalk.llm.common import few_at_once
from ledgertalk.sources.scratch import stored

# What a word is, and which occurrences lose a letter.
LONG_RUN = re.compile("[A-Za-zÀ-ÿ]{6,}")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
LEAST_LENGTH, LEAST_COUNT, ALTERED_EVERY = 6, 5, 199
FORM_RATIO = 5
# Symbols that letters are hashed to: more of them, more neighbours and fewer chance meetings.
SYMBOLS = 8
# Distinct words that a task holds before it passes them on.
HELD_WORDS = 200_000
# Neighbours that are made at once.
AT_ONCE = 1 << 20
# Odd, so that it has an inverse modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _altered(word: str, seed: int) -> str:
    """A lower-cased run as its document counts it: some lose a letter."""
    h = zlib.crc32(word.encode(), seed)
    if h % ALTERED_EVERY:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()

    def flush() -> pa.RecordBatch:
        found = {word: n for word, n in held.items() if len(word) >= LEAST_LENGTH}
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
            ["word", "n"],
        )

    for batch in batches:
        for doc_id, text in zip(
            few_at_once(batch.column("doc_id")), few_at_once(batch.column("text")), strict=True
        ):
            lower: dict[str, int] = {}
            for run, n in Counter(LONG_RUN.findall(text or "")).items():
                word = run.lower() if run.isascii() else run.translate(UPPER)
                lower[word] = lower.get(word, 0) + n
            seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for word, n in lower.items():
                held[_altered(word, seed)] += n
            if len(held) > HELD_WORDS:
                yield flush()
    yield flush()


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n``: words of enough letters that occur often enough."""
    counts = docs.select("doc_id", "text").mapInArrow(_counted, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _reduced(words: list[str]) -> list[str]:
    """The words' letters hashed to symbols, written as the first letters of the alphabet."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4") % SYMBOLS + ord("a")
    letters = codes.astype(np.uint8).tobytes().decode("ascii")
    ends = np.cumsum([len(word) for word in words]).tolist()
    return [letters[end - len(word) : end] for word, end in zip(words, ends, strict=True)]


def _symbols(reduced: list[str]) -> np.ndarray:
    """Symbols from 1 of reduced words of one length, a row each."""
    codes = np.frombuffer("".join(reduced).encode("ascii"), dtype=np.uint8)
    return (codes - (ord("a") - 1)).astype(np.uint64).reshape(len(reduced), -1)


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, BASE, dtype=np.uint64), dtype=np.uint64)


def neighbourhoods(symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of all distinct strings within one edit of each row, itself included, in parts:
    the row's number and the hash. All arithmetic is modulo 2 ** 64."""
    n, length = symbols.shape
    powers = np.concatenate([np.ones(1, np.uint64), _powers(length + 1)])
    terms = symbols * powers[:length]
    upto = np.zeros((n, length + 1), dtype=np.uint64)
    np.cumsum(terms, axis=1, dtype=np.uint64, out=upto[:, 1:])
    whole = upto[:, -1]
    numbers = np.arange(n)
    yield numbers, whole
    step = max(1, AT_ONCE // (n * SYMBOLS))
    for a in range(0, length + 1, step):
        places = np.arange(a, min(a + step, length + 1))
        before = upto[:, places]
        rest = whole[:, None] - before
        # A symbol equal to the one before gives the same string one place earlier.
        previous = np.where(places > 0, symbols[:, places - 1], 0).astype(np.uint64)
        inside = places[places < length]
        here = symbols[:, inside]
        term = terms[:, inside]
        k = len(inside)
        deleted = before[:, :k] + (rest[:, :k] - term) * np.uint64(INVERSE)
        fresh = here != previous[:, :k]
        yield np.nonzero(fresh)[0], deleted[fresh]
        for symbol in range(1, SYMBOLS + 1):
            put = np.uint64(symbol)
            replaced = whole[:, None] + (put - here) * powers[inside]
            other = here != put
            yield np.nonzero(other)[0], replaced[other]
            inserted = before + put * powers[places] + rest * np.uint64(BASE)
            new = previous != put
            yield np.nonzero(new)[0], inserted[new]


def _by_length(words: list[str]) -> Iterator[list[str]]:
    """Words of one length together, no more than ``AT_ONCE`` neighbours' worth."""
    groups: dict[int, list[str]] = {}
    for word in words:
        groups.setdefault(len(word), []).append(word)
    for length, group in groups.items():
        n = max(1, AT_ONCE // (2 * SYMBOLS * (length + 1)))
        for at in range(0, len(group), n):
            yield group[at : at + n]


def _hashes(reduced: list[str]) -> dict[str, int]:
    found: dict[str, int] = {}
    for group in _by_length(list(set(reduced))):
        symbols = _symbols(group)
        powers = np.concatenate([np.ones(1, np.uint64), _powers(symbols.shape[1] - 1)])
        own = (symbols * powers).sum(axis=1, dtype=np.uint64).view(np.int64)
        found.update(zip(group, own.tolist(), strict=True))
    return found


def _with_reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words with their reduced words and the hashes of these."""
    for batch in batches:
        reduced = _reduced(batch.column("word").to_pylist())
        hashes = _hashes(reduced)
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array(reduced, pa.string()),
                pa.array([hashes[r] for r in reduced], pa.int64()),
            ],
            ["word", "n", "reduced", "hash"],
        )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = dict(
            zip(batch.column("reduced").to_pylist(), batch.column("hash").to_pylist(), strict=True)
        )
        for group in _by_length(list(own)):
            mine = np.array([own[reduced] for reduced in group], dtype=np.int64)
            for rows, found in neighbourhoods(_symbols(group)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mine[rows]), pa.array(found.view(np.int64))], ["hash", "near"]
                )


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n`` of all pairs of words that are exactly one edit apart, in both
    directions. ``words`` is a stored table of ``word, n, reduced, hash``."""
    around = words.select("reduced", "hash").distinct()
    around = around.mapInArrow(_neighbours, "hash long, near long")
    known = words.select(F.col("hash").alias("near")).distinct()
    # Distinct, because reduced words may share a hash.
    meetings = stored(around.join(known, "near").distinct(), "reduced_pairs")
    left = words.select("hash", "word", "n")
    right = words.select(
        F.col("hash").alias("near"), F.col("word").alias("near_word"), F.col("n").alias("near_n")
    )
    return (
        meetings.join(left, "hash")
        .join(right, "near")
        .filter(F.levenshtein("word", "near_word", 1) == 1)
        .select("word", "n", F.col("near_word").alias("near"), "near_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for all words of ``word, form``: where following forms ends. Each round
    follows as many steps as all rounds before it, and ends when none leads further."""
    known = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        known = stored(
            known.join(further, "root", "left").select(
                "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
            ),
            "roots",
        )
        if known.filter("moved").isEmpty():
            return known.select("word", "root")
        known = known.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary."""
    schema = "word string, n long, reduced string, hash long"
    words = stored(vocabulary(docs).mapInArrow(_with_reduced, schema), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near"))
    found = stored(
        near_words(words)
        .groupBy("word", "n")
        .agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
        .select(
            "word",
            "n_near",
            F.when(-F.col("best.order") >= FORM_RATIO * F.col("n"), F.col("best.near")).alias("form"),
            (-F.col("best.order")).alias("best_n"),
        ),
        "near",
    )
    forms = found.filter(F.col("form").isNotNull())
    return (
        words.select("word", "n")
        .join(found, "word", "left")
        .join(roots(forms.select("word", "form")), "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"),
        )
    )
