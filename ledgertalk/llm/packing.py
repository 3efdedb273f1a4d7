"""Packing of token pieces into sequences by best-fit decreasing.

Best-fit decreasing treats pieces of one length alike, and a sequence only by the room that
it has left. So the plan is made on counts: for each length, the longest first, the tightest
open room that fits comes from a segment tree over remaining capacities, and as many pieces
go there as fit in all sequences with that room. The plan says, for each length, which ranks
go to which sequences at which offset. Its input is one count for each length up to the
sequence length, so it is as small for 100 TB as for a test, and its result is that of
best-fit decreasing over all pieces, not of many local packings.

Ranks of the pieces of a length are given in blocks of rows, so that a length which a third
of all pieces have is no single task's work.

Defined results: a null or empty text is one piece, the end id; repeated rows are pieces of
their own; an empty table gives an empty result; very long texts are cut into full pieces;
columns other than doc_id and the text are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgertalk.llm.bpe import Memory, encoded_words, forget, words_of
from ledgertalk.llm.common import give_back, with_fields
from ledgertalk.sources.scratch import stored

LENGTH = 2048
END = b"\0\0\0\0"
ID_BYTES = 4
# Rows, about, that one task numbers.
ROWS_A_BLOCK = 50_000
# Words whose ids a worker remembers, and texts cut at once.
REMEMBERED = 400_000
TEXTS_AT_ONCE = 2048

_words: dict[str, Memory] = {}


def token_bytes(
    texts: list[str | None], path: str, remembered: int | None = None
) -> list[bytes]:
    """Ids of whole texts, through the worker's memory of ``remembered`` words."""
    split = [words_of(text) for text in texts]
    memory = _words.setdefault(path, Memory(REMEMBERED))
    memory.most = REMEMBERED if remembered is None else remembered
    unknown = memory.missing(set(chain.from_iterable(split)))
    memory.learn(unknown, encoded_words(unknown, path, remembered))
    known = memory.known
    found = [b"".join([known[w] for w in words]) for words in split]
    memory.forget_beyond(unknown)
    return found


def pieces(
    docs: DataFrame,
    path: str,
    length: int = LENGTH,
    text_column: str = "text",
    remembered: int | None = None,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: a text's ids and the end id, cut where
    they exceed a sequence. With ``remembered``, a worker remembers so many words, and only
    until its task ends: for jobs in which other stages follow."""
    schema = with_fields(
        docs.select("doc_id").schema,
        "piece int, start long, length long, ids_crc32 long",
    )
    step = length * ID_BYTES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                rows, numbers, starts, lengths, sums = [], [], [], [], []
                texts = part.column("text").to_pylist()
                for i, ids in enumerate(token_bytes(texts, path, remembered)):
                    whole = memoryview(ids + END)
                    for n, start in enumerate(range(0, len(whole), step)):
                        one = whole[start : start + step]
                        rows.append(i)
                        numbers.append(n)
                        starts.append(start // ID_BYTES)
                        lengths.append(len(one) // ID_BYTES)
                        sums.append(zlib.crc32(one))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(rows, pa.int64())),
                        pa.array(numbers, pa.int32()),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )
        if remembered is not None:
            _words.pop(path, None)
            forget(path)
            give_back()

    return docs.select("doc_id", F.col(text_column).alias("text")).mapInArrow(cut, schema)


class Rooms:
    """Segment tree over remaining capacities: which of them some open sequence has."""

    def __init__(self, length: int):
        self.size = 1
        while self.size <= length:
            self.size *= 2
        self.any = [False] * (2 * self.size)
        self.bins: dict[int, deque[tuple[int, int]]] = {}

    def add(self, room: int, first: int, count: int) -> None:
        if room <= 0 or count <= 0:
            return
        held = self.bins.setdefault(room, deque())
        if held and held[-1][0] + held[-1][1] == first:
            first, count = held[-1][0], held.pop()[1] + count
        held.append((first, count))
        self._mark(room, True)

    def take(self, room: int, most: int) -> tuple[int, int]:
        """Up to ``most`` sequences with this room: the first one's number and how many."""
        held = self.bins[room]
        first, count = held.popleft()
        if count > most:
            held.appendleft((first + most, count - most))
            count = most
        if not held:
            self._mark(room, False)
        return first, count

    def _mark(self, room: int, there: bool) -> None:
        i = room + self.size
        self.any[i] = there
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least ``least``, in time logarithmic in the length."""
        i = least + self.size
        if self.any[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def plan(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing on counts: rows ``length, first_rank, ranks, first_sequence,
    each, offset``. The ranks of a row fill ``each`` places in one sequence, then the next."""
    rooms, found, sequences = Rooms(length), [], 0
    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            room = rooms.tightest(size)
            if room is None:
                room = length
                each = min(room // size, left)
                first, taken = sequences, left // each
                sequences += taken
            else:
                each = min(room // size, left)
                first, taken = rooms.take(room, left // each)
            found.append((size, rank, taken * each, first, each, length - room))
            rooms.add(room - each * size, first, taken)
            rank += taken * each
            left -= taken * each
    return found


def packed(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    spark = cut.sparkSession
    # One row for each length, at most ``length`` rows.
    counts = {row["length"]: row["count"] for row in cut.groupBy("length").count().collect()}
    blocks = spark.createDataFrame(
        [(size, 1 + n // ROWS_A_BLOCK) for size, n in sorted(counts.items())],
        "length long, blocks long",
    )
    # Bounded by the lengths and rooms that there can be, not by the rows.
    runs = spark.createDataFrame(
        plan(counts, length),
        "length long, first_rank long, ranks long, first_sequence long, each long, at long",
    )
    dealt = cut.join(F.broadcast(blocks), "length").withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "piece"), F.col("blocks"))
    )
    before = (
        dealt.groupBy("length", "block")
        .count()
        .withColumn(
            "before",
            F.sum("count").over(
                Window.partitionBy("length")
                .orderBy("block")
                .rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .select("length", "block", F.coalesce("before", F.lit(0)).alias("before"))
    )
    within = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("nth", F.row_number().over(within)).join(
        before, ["length", "block"]
    )
    rank = F.col("before") + F.col("nth") - 1
    place = F.col("rank") - F.col("first_rank")
    return (
        ranked.withColumn("rank", rank)
        .join(runs, "length")
        .filter((place >= 0) & (place < F.col("ranks")))
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("first_sequence") + F.floor(place / F.col("each"))).alias("sequence_id"),
            (F.col("at") + F.pmod(place, F.col("each")) * F.col("length")).alias("offset"),
        )
    )


def pack(
    docs: DataFrame,
    path: str,
    length: int = LENGTH,
    text_column: str = "text",
    remembered: int | None = None,
) -> DataFrame:
    """Pieces of all texts and their places; the tokens are computed once. Workers remember
    the ids of ``remembered`` words: more take memory, fewer take time."""
    return packed(stored(pieces(docs, path, length, text_column, remembered), "pieces"), length)
