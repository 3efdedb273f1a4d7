"""N-gram Jaccard join by set-relation skipping.

Documents whose sets of word shingles have a Jaccard similarity of at least the threshold
are linked; the result is each document's component. Sets are sets of 64-bit shingle hashes.
Equal sets are one set throughout. Jaccard distance is a metric, which the join uses twice.

1. *Relations first.* Sets that agree in a band of minimum hashes are compared with one of
   them, the smallest; a verified pair puts the set into that leader's star at a known
   distance. Stars are joined into components. A group of thousands of copies costs one
   comparison a member, and no pair inside a component is looked at again.
2. *Index lists.* An exact prefix filter finds all other links. Shingles are in one global
   order: by hash, but those in the prefixes of many components last. Two similar sets share
   a shingle in their prefixes, so each prefix shingle has a list; an entry is a star, with
   the bounds of its members' sizes and of what lies behind their positions. Lists are cut
   into blocks by size, and an entry skips the blocks whose sizes rule a link out. Stars that
   meet must do so in as many lists as the overlap of similar sets' prefixes requires.
   Sets that are little but common shingles would meet by the crowd; such crowds are compared
   block by block, and no pair of theirs is ever a row.
3. *Answers from answers.* Of two stars that meet, the leaders are compared. Their distance
   and the members' distances to them decide most member pairs: none can link if the
   leaders are too far apart, none need be looked at if the leaders link. For the rest each
   member is compared with the other leader, and only then are pairs of members that the
   triangle inequality leaves open compared themselves.

Defined results: a text without words, or null, has an empty set, no links and is its own
component; rows with equal doc_id are separate rows that share an id; a null doc_id has a
null component unless it links to a row with an id; repeated rows are equal sets; an empty
table gives an empty result; other columns, whatever their names, pass through
``one_of_each`` unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgertalk.llm.common import few_at_once, give_back, small_or_shuffled, with_fields
from ledgertalk.llm.components import components
from ledgertalk.sources.scratch import stored

# A shingle in the prefixes of more components than this comes late in the global order.
COMMON = 32
# A list of more stars than this pairs its entries by component.
LONG_LIST = 256
# Ids are broadcast up to this number (16 MB), joined by a shuffle beyond it.
MOST_BROADCAST_IDS = 1_000_000
# Sets of a block, and shingles of two blocks, that a task compares at once.
BLOCK_SETS, SHINGLES_AT_ONCE = 512, 4096
REMEMBERED_WORDS = 100_000

# Odd multipliers that tell places of a shingle, and seeds of minimum hashes.
PLACES = np.array(
    [
        0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
        0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
    ],
    dtype=np.uint64,
)
SEEDS = PLACES[4:]


@dataclass(frozen=True)
class Linking:
    """Words of a shingle and the least similarity, in hundredths."""

    words: int = 4
    percent: int = 85

    @property
    def far(self) -> float:
        """The largest distance of a link."""
        return 1 - self.percent / 100

    def prefix(self, n):
        """Shingles of a set of ``n`` in which a similar set must share one."""
        return n - -(-self.percent * n // 100) + 1

    def region(self, n):
        """Prefix and a reserve, for what common shingles push back."""
        p = self.prefix(n)
        return np.minimum(n, p + p // 4 + 8)

    def overlap(self, a: Column, b: Column) -> Column:
        """Least overlap of similar sets of these sizes."""
        return F.ceil((a + b) * self.percent / F.lit(100 + self.percent))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_words = _Hashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; A-Z read as a-z.

    Bytes are lowered and split as ASCII, which is the contract's notion of both.
    """
    if not text:
        return np.zeros(0, dtype=np.int64)
    split = text.encode("utf-8", "surrogatepass").lower().split()
    if not split:
        return np.zeros(0, dtype=np.int64)
    each = np.fromiter(map(_words.__getitem__, split), np.uint64, len(split))
    size = min(words, len(each))
    assert size <= len(PLACES)
    found = np.full(len(each) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        found += each[i : i + len(found)] * PLACES[i]
    return np.unique(_mixed(found).view(np.int64))


def _set_id(found: np.ndarray) -> int:
    return int.from_bytes(
        hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True
    )


def _bands(found: np.ndarray) -> list[int]:
    """Two bands of two minimum hashes."""
    least = np.array([_mixed(found.view(np.uint64) ^ seed).min() for seed in SEEDS])
    # Odd places and even places make a band each.
    bands = _mixed(least[::2] * PLACES[0] + least[1::2] * PLACES[1] + np.arange(2, dtype=np.uint64))
    return bands.view(np.int64).tolist()


def described(docs: DataFrame, linking: Linking, text_column: str = "text") -> DataFrame:
    """``doc_id, text_hash, n, set_id, bands, region`` for every row. Of equal sets in one task only the
    first carries its bands and region; the others would add nothing to any list."""
    schema = with_fields(
        docs.select("doc_id").schema,
        "text_hash long, n long, set_id long, bands array<long>, region array<long>",
    )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sizes, ids, bands, regions = [], [], [], []
            for text in few_at_once(batch.column("text")):
                found = shingles(text, linking.words)
                n = len(found)
                set_id = _set_id(found) if n else None
                first = n > 0 and set_id not in seen
                if first:
                    seen.add(set_id)
                sizes.append(n)
                ids.append(set_id)
                bands.append(_bands(found) if first else None)
                regions.append(found[: int(linking.region(n))] if first else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(regions, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "n", "set_id", "bands", "region"],
            )
        _words.clear()
        give_back()

    return docs.select(
        "doc_id", F.col(text_column).alias("text"), F.xxhash64(text_column).alias("text_hash")
    ).mapInArrow(describe, schema)


class Join:
    """One run over one table."""

    def __init__(self, docs: DataFrame, linking: Linking, text_column: str = "text"):
        self.linking = linking
        self.texts = docs.select("doc_id", F.col(text_column).alias("text"))
        self.rows = stored(described(docs, linking, text_column), "described")
        self.sets = stored(
            self.rows.filter("n > 0")
            .groupBy("set_id")
            .agg(F.min("n").alias("n"), F.min("doc_id").alias("first")),
            "sets",
        )

    def whole_sets(self, wanted: DataFrame) -> DataFrame:
        """``set_id, shingles`` (packed) of these sets, made again from one text of each."""
        words = self.linking.words
        firsts = small_or_shuffled(
            stored(wanted.distinct().join(self.sets, "set_id").select("first"), "wanted"),
            MOST_BROADCAST_IDS,
        )
        same = F.col("doc_id").eqNullSafe(F.col("first"))
        chosen = self.texts.join(firsts, same, "left_semi")

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [shingles(t, words) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_set_id(f) for f in found], pa.int64()),
                        pa.array([f.tobytes() for f in found], pa.binary()),
                    ],
                    ["set_id", "shingles"],
                )

        made = chosen.select("text").mapInArrow(make, "set_id long, shingles binary")
        return stored(made, "whole_sets")

    def distances(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b`` with ``distance`` and ``linked``, from their whole sets."""
        pairs = stored(pairs.select("a", "b").distinct(), "pairs")
        ids = pairs.select(F.col("a").alias("set_id")).unionAll(
            pairs.select(F.col("b").alias("set_id"))
        )
        whole = self.whole_sets(ids)
        # Repeated rows with one id give a set twice; pairs are made distinct again below.
        of_a = whole.select(F.col("set_id").alias("a"), F.col("shingles").alias("of_a"))
        of_b = whole.select(F.col("set_id").alias("b"), F.col("shingles").alias("of_b"))
        percent = self.linking.percent

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                far, linked = [], []
                for x, y in zip(
                    batch.column("of_a").to_pylist(), batch.column("of_b").to_pylist(), strict=True
                ):
                    x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    either = len(x) + len(y) - both
                    far.append(1 - both / either)
                    linked.append(100 * both >= percent * either)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a"), batch.column("b"), pa.array(far), pa.array(linked)],
                    ["a", "b", "distance", "linked"],
                )

        found = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "of_a", "of_b").mapInArrow(
            compare, "a long, b long, distance double, linked boolean"
        )
        return stored(found.distinct(), "distances")

    def stars(self) -> DataFrame:
        """``set_id, star, to_leader, part`` of sets that some verified pair holds: the star's
        leader, the distance to it, and the component."""
        banded = self.rows.filter(F.col("bands").isNotNull()).select(
            "set_id", "n", F.explode("bands").alias("band")
        )
        leaders = (
            banded.groupBy("band")
            .agg(F.min(F.struct("set_id", "n")).alias("l"), F.max("set_id").alias("last"))
            .filter(F.col("l.set_id") != F.col("last"))
            .select("band", F.col("l.set_id").alias("leader"), F.col("l.n").alias("leader_n"))
        )
        percent = self.linking.percent
        near = (
            banded.join(leaders, "band")
            .filter(F.col("set_id") != F.col("leader"))
            .filter(
                (100 * F.col("n") >= percent * F.col("leader_n"))
                & (100 * F.col("leader_n") >= percent * F.col("n"))
            )
            .select(F.col("set_id").alias("a"), F.col("leader").alias("b"))
        )
        linked = stored(self.distances(near).filter("linked"), "near")
        parts = components(linked)
        # A set belongs to the nearest leader that it was compared with; leaders to themselves.
        member = linked.groupBy(F.col("a").alias("set_id")).agg(
            F.min(F.struct("distance", "b")).alias("to")
        )
        leads = linked.select(F.col("b").alias("set_id")).distinct().withColumn("leads", F.lit(True))
        return stored(
            parts.select(F.col("node").alias("set_id"), F.col("label").alias("part"))
            .join(member, "set_id", "left")
            .join(leads, "set_id", "left")
            .select(
                "set_id",
                F.when(F.col("leads"), F.col("set_id")).otherwise(F.col("to.b")).alias("star"),
                F.when(F.col("leads"), 0.0).otherwise(F.col("to.distance")).alias("to_leader"),
                "part",
            ),
            "stars",
        )

    def placed(self, entries: DataFrame, stars: DataFrame) -> DataFrame:
        """Rows with ``set_id`` and their star and component; a set alone is its own."""
        few = small_or_shuffled(stars, MOST_BROADCAST_IDS)
        return entries.join(few, "set_id", "left").select(
            *entries.columns,
            F.coalesce("star", "set_id").alias("star"),
            F.coalesce("part", "set_id").alias("part"),
        )

    def index(self, stars: DataFrame) -> DataFrame:
        """The prefix shingles of all sets, as ``_prefixes`` gives them."""
        regions = self.rows.filter(F.col("region").isNotNull()).select("set_id", "n", "region")
        tokens = _tokens(self.placed(regions, stars))
        shared = (
            tokens.groupBy("token")
            .agg(F.min("part").alias("one"), F.max("part").alias("other"))
            .filter(F.col("one") != F.col("other"))
            .select("token")
        )
        entries = stored(tokens.join(shared, "token", "left_semi"), "entries")
        common = stored(_common(entries), "common")
        # Entries of sets known whole, each table written once, and those sets' ids.
        whole_entries: list[DataFrame] = []
        whole_ids: DataFrame | None = None
        while True:
            every = reduce(DataFrame.unionByName, whole_entries, entries)
            prefixes = stored(self._prefixes(every, common), "prefixes")
            heavy = prefixes.filter(F.col("token").isNull()).select("set_id").distinct()
            heavy = stored(heavy, "heavy")
            if heavy.limit(1).count() == 0:
                return prefixes
            # Sets that common shingles leave too few others: all of theirs, in order. These
            # sets' shingles may be common too, so others may follow; none comes twice.
            whole = self.whole_sets(heavy).join(heavy, "set_id", "left_semi")
            full = (
                whole.dropDuplicates(["set_id"])
                .mapInArrow(_unpacked, "set_id long, region array<long>")
                .join(self.sets.select("set_id", "n"), "set_id")
                .select("set_id", "n", "region")
            )
            full = stored(_tokens(self.placed(stored(full, "full_sets"), stars)), "full_tokens")
            wanted = small_or_shuffled(
                stored(full.select("token").distinct(), "wanted_tokens"), MOST_BROADCAST_IDS
            )
            # Sets known whole have all their entries; none may come from their regions.
            whole_ids = heavy if whole_ids is None else whole_ids.unionByName(heavy)
            few = small_or_shuffled(stored(whole_ids, "whole_ids"), MOST_BROADCAST_IDS)
            in_regions = tokens.join(wanted, "token", "left_semi")
            in_regions = in_regions.join(few, "set_id", "left_anti")
            before = entries.join(few, "set_id", "left_anti")
            entries = stored(before.unionByName(in_regions).distinct(), "entries")
            whole_entries.append(full)
            common = stored(common.unionByName(_common(full)).distinct(), "common")

    def _prefixes(self, entries: DataFrame, common: DataFrame) -> DataFrame:
        """``token, late, set_id, n, star, part, at``: prefix shingles that some other component
        has too, with their place in the global order, and whether they are common ones. A
        null token marks a set whose known shingles do not tell its prefix."""
        linking = self.linking
        late = common.withColumn("late", F.lit(True))
        grouped = entries.join(late, "token", "left").groupBy("set_id").agg(
            F.min("n").alias("n"),
            F.min("star").alias("star"),
            F.min("part").alias("part"),
            F.min("known").alias("known"),
            F.sort_array(
                F.collect_set(
                    F.struct("at", "token", F.coalesce("late", F.lit(False)).alias("late"))
                )
            ).alias("found"),
        )

        def reorder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = batch.column("found")
                flat = found.flatten()
                ends = found.offsets.to_numpy() - found.offsets[0].as_py()
                every_at = flat.field("at").to_numpy(zero_copy_only=False)
                every_token = flat.field("token").to_numpy(zero_copy_only=False)
                every_late = flat.field("late").to_numpy(zero_copy_only=False).astype(bool)
                rows: list[int] = []
                out: list[int | None] = []
                lates: list[bool | None] = []
                places: list[int | None] = []
                sizes = zip(
                    batch.column("n").to_pylist(), batch.column("known").to_pylist(), strict=True
                )
                for i, (n, known) in enumerate(sizes):
                    part = slice(ends[i], ends[i + 1])
                    pushed = np.cumsum(every_late[part])
                    after = int(pushed[-1])
                    if known < n and known - after < linking.prefix(n):
                        rows.append(i)
                        out.append(None)
                        lates.append(None)
                        places.append(None)
                        continue
                    place = np.where(
                        every_late[part], n - after + pushed - 1, every_at[part] - pushed
                    )
                    use = place < linking.prefix(n)
                    rows += [i] * int(use.sum())
                    out += every_token[part][use].tolist()
                    lates += every_late[part][use].tolist()
                    places += place[use].tolist()
                index = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out, pa.int64()),
                        pa.array(lates, pa.bool_()),
                        *[batch.column(c).take(index) for c in ("set_id", "n", "star", "part")],
                        pa.array(places, pa.int64()),
                    ],
                    ["token", "late", "set_id", "n", "star", "part", "at"],
                )

        return grouped.mapInArrow(
            reorder, "token long, late boolean, set_id long, n long, star long, part long, at long"
        )

    def meetings(self, prefixes: DataFrame) -> DataFrame:
        """``a, b``: stars, of two components, whose entries meet as similar sets' must.

        Only lists of shingles that few components have. Sets that share a common shingle in
        their prefixes are left to ``crowded``; two that share none meet in all the lists
        that the prefix filter counts on.
        """
        linking = self.linking
        step = log(100 / linking.percent)

        def block(n: str) -> Column:
            return F.floor(F.log(n) / step + 1e-9).cast("int")

        entries = stored(
            prefixes.filter(~F.col("late"))
            .groupBy("token", "star")
            .agg(
                F.min("part").alias("part"),
                F.min("n").alias("least"),
                F.max("n").alias("most"),
                F.max(F.col("n") - F.col("at")).alias("behind"),
            )
            .withColumn("low", block("least"))
            .withColumn("high", block("most")),
            "entries",
        )
        columns = ("star", "part", "least", "most", "behind", "low")
        entries = _with_turns(entries)
        # One side stands in its own blocks, the other looks into those and the next ones.
        a = entries.select(
            "token", "low", "high", "first", *[F.col(c).alias(f"{c}_a") for c in columns]
        ).withColumn("turn", F.explode("first"))
        a = a.withColumn("block", F.explode(F.sequence("low", "high"))).drop("low", "high", "first")
        b = entries.select(
            "token", "low", "high", "second", *[F.col(c).alias(f"{c}_b") for c in columns]
        ).withColumn("turn", F.explode("second"))
        b = b.withColumn(
            "block", F.explode(F.sequence(F.col("low") - 1, F.col("high") + 1))
        ).drop("low", "high", "second")
        met = (
            a.join(b, ["token", "block", "turn"])
            .filter(F.col("part_a") < F.col("part_b"))
            # Blocks that both cover: only the first counts.
            .filter(F.col("block") == F.greatest(F.col("low_a"), F.col("low_b") - 1))
            .groupBy(F.col("star_a").alias("a"), F.col("star_b").alias("b"))
            .agg(
                F.count("*").alias("lists"),
                F.max(F.least("behind_a", "behind_b")).alias("behind"),
                F.min("least_a").alias("least_a"),
                F.min("least_b").alias("least_b"),
                F.max("most_a").alias("most_a"),
                F.max("most_b").alias("most_b"),
            )
        )
        overlap = linking.overlap(F.col("least_a"), F.col("least_b"))

        def own(n: str) -> Column:
            return F.ceil(F.col(n) * linking.percent / F.lit(100))

        needed = overlap - F.greatest(own("most_a"), own("most_b")) + 1
        enough = (F.col("lists") >= needed) & (F.col("behind") >= overlap)
        return stored(met.filter(enough).select("a", "b"), "met")

    def crowded(self, prefixes: DataFrame) -> DataFrame:
        """``a, b``: links among sets that common shingles bring together.

        Such sets come in crowds: sets joined by common shingles in their prefixes. A crowd is
        cut into blocks by size and hash, pairs of blocks whose sizes allow links are the
        tasks, and a task gets all overlaps of its two blocks from one product of incidence
        matrices. Of its links it returns those that still join something, so no pairs of a
        crowd are ever rows.
        """
        linking = self.linking
        late = prefixes.filter("late").select("set_id", "token", "n", "part")
        late = stored(late, "late")
        if late.limit(1).count() == 0:
            return late.select(F.col("set_id").alias("a"), F.col("set_id").alias("b"))
        labels = components(late.select(F.col("set_id").alias("a"), F.col("token").alias("b")))
        sets = late.groupBy("set_id").agg(F.min("n").alias("n"), F.min("part").alias("part"))
        step = log(100 / linking.percent)
        sets = stored(
            sets.join(labels, sets["set_id"] == labels["node"]).select(
                "set_id",
                "part",
                F.col("label").alias("crowd"),
                F.floor(F.log("n") / step + 1e-9).cast("int").alias("class"),
            ),
            "crowds",
        )
        classes = sets.groupBy("crowd", "class").agg(
            F.ceil(F.count("*") / F.lit(BLOCK_SETS)).cast("int").alias("blocks")
        )
        dealt = sets.join(classes, ["crowd", "class"]).select(
            "set_id",
            "part",
            "crowd",
            "class",
            F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int").alias("block"),
        )
        blocks = classes.select(
            "crowd", "class", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
        )
        other = blocks.select(
            "crowd", F.col("class").alias("other_class"), F.col("block").alias("other_block")
        )
        later = (F.col("other_class") == F.col("class") + 1) | (
            (F.col("other_class") == F.col("class")) & (F.col("other_block") >= F.col("block"))
        )
        tasks = blocks.join(other, "crowd").filter(later).withColumn(
            "task", F.xxhash64("crowd", "class", "block", "other_class", "other_block")
        )
        first = tasks.select("crowd", "class", "block", "task", F.lit(0).alias("side"))
        second = tasks.select(
            "crowd",
            F.col("other_class").alias("class"),
            F.col("other_block").alias("block"),
            "task",
            F.lit(1).alias("side"),
        )
        whole = self.whole_sets(sets.select("set_id")).dropDuplicates(["set_id"])
        members = (
            dealt.join(first.unionByName(second), ["crowd", "class", "block"])
            .select("task", "side", "set_id", "part")
            .join(whole, "set_id")
        )
        percent = linking.percent

        def compare(table: pa.Table) -> pa.Table:
            return _block_links(table, percent)

        found = members.groupBy("task").applyInArrow(compare, "a long, b long")
        return stored(found, "crowd_links")

    def links(self, met: DataFrame, stars: DataFrame) -> DataFrame:
        """``a, b``: sets that link across the stars that met, enough of them to connect
        every two components that any link connects."""
        far = self.linking.far + 1e-9
        leaders = self.distances(met)
        members = stars.filter(F.col("star") != F.col("set_id"))
        radius = members.groupBy("star").agg(F.max("to_leader").alias("radius"))

        def with_radius(pairs: DataFrame, side: str) -> DataFrame:
            named = radius.select(F.col("star").alias(side), F.col("radius").alias(f"radius_{side}"))
            return pairs.join(named, side, "left").withColumn(
                f"radius_{side}", F.coalesce(f"radius_{side}", F.lit(0.0))
            )

        unlinked = leaders.filter(~F.col("linked")).select("a", "b", "distance")
        open_pairs = stored(
            with_radius(with_radius(unlinked, "a"), "b")
            .filter(F.col("radius_a") + F.col("radius_b") > 0)
            .filter(F.col("distance") <= far + F.col("radius_a") + F.col("radius_b")),
            "open_pairs",
        )
        found = [leaders.filter("linked").select("a", "b")]

        def against(side: str, other: str) -> DataFrame:
            """Members of one side's star and the other's leader, with their distance."""
            of_side = members.select(
                F.col("star").alias(side), F.col("set_id").alias("member"), "to_leader"
            )
            near = (
                open_pairs.join(of_side, side)
                .filter(F.col("distance") - F.col("to_leader") <= far + F.col(f"radius_{other}"))
                .select(side, other, "member", "to_leader", f"radius_{other}")
            )
            seen = self.distances(near.select(F.col("member").alias("a"), F.col(other).alias("b")))
            seen = seen.select(
                F.col("a").alias("member"), F.col("b").alias(other), F.col("distance").alias("across"), "linked"
            )
            return stored(near.join(seen, ["member", other]), "against")

        from_a, from_b = against("a", "b"), against("b", "a")
        found += [
            from_a.filter("linked").select(F.col("member").alias("a"), "b"),
            from_b.filter("linked").select("a", F.col("member").alias("b")),
        ]
        settled = (
            from_a.filter("linked").select("a", "b").union(from_b.filter("linked").select("a", "b"))
        ).distinct()
        x = from_a.filter(F.col("across") <= far + F.col("radius_b")).select(
            "a", "b", F.col("member").alias("x"), F.col("to_leader").alias("x_a"), F.col("across").alias("x_b")
        )
        y = from_b.filter(F.col("across") <= far + F.col("radius_a")).select(
            "a", "b", F.col("member").alias("y"), F.col("to_leader").alias("y_b"), F.col("across").alias("y_a")
        )
        left = (
            x.join(settled, ["a", "b"], "left_anti")
            .join(y, ["a", "b"])
            .filter(F.abs(F.col("x_a") - F.col("y_a")) <= far)
            .filter(F.abs(F.col("x_b") - F.col("y_b")) <= far)
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
        )
        found.append(self.distances(left).filter("linked").select("a", "b"))
        every = found[0]
        for part in found[1:]:
            every = every.unionByName(part)
        return every

    def result(self) -> DataFrame:
        """``doc_id, text_hash, n_shingles, component_id`` for every row."""
        stars = self.stars()
        prefixes = self.index(stars)
        across = self.links(self.meetings(prefixes), stars).unionByName(self.crowded(prefixes))
        inside = stars.select(F.col("set_id").alias("a"), F.col("part").alias("b"))
        labels = components(across.unionByName(inside))
        named = self.sets.join(labels, self.sets["set_id"] == labels["node"], "left").select(
            "set_id", "first", F.coalesce("label", "set_id").alias("label")
        )
        least = named.groupBy("label").agg(F.min("first").alias("least"))
        of_set = named.join(least, "label").select("set_id", "least")
        return self.rows.select("doc_id", "text_hash", "n", "set_id").join(
            of_set, "set_id", "left"
        ).select(
            "doc_id",
            "text_hash",
            F.col("n").alias("n_shingles"),
            F.when(F.col("set_id").isNull(), F.col("doc_id"))
            .otherwise(F.col("least"))
            .alias("component_id"),
        )


def _block_links(table: pa.Table, percent: int) -> pa.Table:
    """Links between two blocks of sets (or within one, if both sides are the same), as many
    as join what is not joined yet by components or by earlier links."""
    sides = table.column("side").to_numpy()
    ids = table.column("set_id").to_numpy()
    parts = table.column("part").to_numpy()
    sets = [np.frombuffer(x, np.int64) for x in table.column("shingles").to_pylist()]
    left = np.flatnonzero(sides == 0)
    right = np.flatnonzero(sides == 1)
    found: list[tuple[int, int]] = []
    if len(left) and len(right):
        sizes = np.array([len(x) for x in sets])
        flat = [np.concatenate([sets[i] for i in side]) for side in (left, right)]
        shared = np.intersect1d(flat[0], flat[1])
        both = np.zeros((len(left), len(right)), dtype=np.float32)
        rows = [np.repeat(np.arange(len(side)), sizes[side]) for side in (left, right)]
        places = [np.searchsorted(shared, x) for x in flat]
        for k in (0, 1):
            inside = places[k] < len(shared)
            inside[inside] = shared[places[k][inside]] == flat[k][inside]
            rows[k], places[k] = rows[k][inside], places[k][inside]
        for at in range(0, len(shared), SHINGLES_AT_ONCE):
            width = min(SHINGLES_AT_ONCE, len(shared) - at)
            one = []
            for k, side in enumerate((left, right)):
                here = (places[k] >= at) & (places[k] < at + width)
                hit = np.zeros((len(side), width), dtype=np.float32)
                hit[rows[k][here], places[k][here] - at] = 1
                one.append(hit)
            both += one[0] @ one[1].T
        either = sizes[left][:, None] + sizes[right][None] - both
        links = (100 * both >= percent * either) & (parts[left][:, None] != parts[right][None])
        joined: dict[int, int] = {}

        def top(x: int) -> int:
            while x in joined:
                x = joined[x]
            return x

        for i, j in np.argwhere(links):
            a, b = top(int(parts[left[i]])), top(int(parts[right[j]]))
            if a != b:
                joined[max(a, b)] = min(a, b)
                found.append((int(ids[left[i]]), int(ids[right[j]])))
    return pa.table(
        [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())],
        names=["a", "b"],
    )


def _tokens(listed: DataFrame) -> DataFrame:
    """One row for each known shingle of a set, with its place among the set's by hash."""
    return listed.select(
        "set_id",
        "n",
        "star",
        "part",
        F.size("region").alias("known"),
        F.posexplode("region").alias("at", "token"),
    )


def _common(tokens: DataFrame) -> DataFrame:
    """Shingles that more than ``COMMON`` components have."""
    parts = tokens.select("token", "part").distinct().groupBy("token").count()
    return parts.filter(F.col("count") > COMMON).select("token")


def _with_turns(entries: DataFrame) -> DataFrame:
    """The entries with arrays ``first`` and ``second``: the turns in which an entry is the one or
    the other side of its list's pairs.

    Most lists have one turn. In one of more than ``LONG_LIST`` stars the components are numbered
    by ``part``, and two of them meet in the turn of the highest bit in which their numbers
    differ, so that no two stars of one component are ever put together: a component of very
    many stars costs its list nothing of its own.
    """
    long_lists = entries.groupBy("token").agg(F.count("*").alias("stars"))
    long_lists = long_lists.filter(F.col("stars") > LONG_LIST).select("token")
    few = small_or_shuffled(stored(long_lists, "long_lists"), MOST_BROADCAST_IDS)
    # A list has few components, or its shingle would be a common one.
    by_part = Window.partitionBy("token").orderBy("part")
    numbered = (
        entries.join(few, "token", "left_semi")
        .select("token", "part")
        .distinct()
        .withColumn("number", F.row_number().over(by_part) - 1)
        .withColumn("parts", F.count("*").over(Window.partitionBy("token")))
    )
    numbered = small_or_shuffled(stored(numbered, "numbered_parts"), MOST_BROADCAST_IDS)
    bits = F.sequence(F.lit(0), F.length(F.bin(F.col("parts") - 1)) - 1)

    def turns(side: int) -> Column:
        def here(bit: Column) -> Column:
            return F.call_function("shiftright", F.col("number"), bit).bitwiseAND(1) == side

        def turn(bit: Column) -> Column:
            above = F.call_function("shiftright", F.col("number"), bit + 1)
            return F.struct(bit.alias("bit"), above.alias("above"))

        one = F.array(F.struct(F.lit(-1).alias("bit"), F.lit(0).alias("above")))
        return F.when(F.col("number").isNull(), one).otherwise(
            F.transform(F.filter(bits, here), turn)
        )

    return entries.join(numbered, ["token", "part"], "left").select(
        *[entries[c] for c in entries.columns], turns(0).alias("first"), turns(1).alias("second")
    )


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [np.frombuffer(x, np.int64) for x in batch.column("shingles").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("set_id"), pa.array(found, pa.list_(pa.int64()))], ["set_id", "region"]
        )


def linked(docs: DataFrame, linking: Linking = Linking(), text_column: str = "text") -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id`` for every row."""
    return Join(docs, linking, text_column).result()


def one_of_each(docs: DataFrame, linking: Linking) -> DataFrame:
    """One row of each component: the one with the smallest doc_id. Rows that repeat an id
    and a text are one; without an id, one row of each text stays."""
    found = stored(linked(docs, linking), "linked")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    dropped = stored(
        found.filter(~stays).select(
            F.col("doc_id").alias("dropped_id"), F.col("text_hash").alias("dropped_hash")
        ).distinct(),
        "dropped",
    )
    repeated = stored(
        found.filter(stays)
        .groupBy("doc_id", "text_hash")
        .count()
        .filter("count > 1")
        .select(F.col("doc_id").alias("repeated_id"), F.col("text_hash").alias("repeated_hash")),
        "repeated",
    )
    rows = docs.alias("d")
    text_hash = F.xxhash64("d.text")

    def same(table: str) -> Column:
        return F.col("d.doc_id").eqNullSafe(F.col(f"{table}_id")) & (
            text_hash == F.col(f"{table}_hash")
        )

    kept = rows.join(small_or_shuffled(dropped, MOST_BROADCAST_IDS), same("dropped"), "left_anti")
    few = small_or_shuffled(repeated, MOST_BROADCAST_IDS)
    kept = kept.alias("d")
    single = kept.join(few, same("repeated"), "left_anti")
    twice = kept.join(few, same("repeated"), "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(twice)
