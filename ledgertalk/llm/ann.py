"""Approximate nearest neighbours by largest inner product, on balanced posting lists.

Largest inner products become nearest points by one more coordinate that gives all vectors
one length. Then:

- *Distinct vectors.* Equal vectors are one entry with the smallest ids that an answer can
  hold, so a vector that a third of all rows share is one entry, and nothing is lost.
- *Lists.* A bounded sample is halved again and again, each time into two parts of equal size
  round two means; the means of the last parts are the centroids, so the lists of the sample
  are balanced. Every vector goes to its nearest centroid's list, and a vector near a boundary
  to further ones, unless a chosen centroid lies nearer to that centroid than the vector does.
- *Centroid search.* A neighbour graph over the centroids (their number is bounded) is in
  every task's memory; a beam walks it for a whole batch of vectors at once.
- *Pruning.* A query reads the lists whose centroid is not farther than a ratio times the
  nearest one's. The ratio is the smallest that finds ``TARGET`` of the true neighbours within
  the sample. Lists are read until they hold enough entries for a full answer.

Neighbouring lists and their queries are searched together in blocks of bounded size, a list
beyond that size in several. Scores are double precision inner products of the original
vectors; every block sends a query's best, merged by query.

Defined results: vectors that are null, zero, or hold a null or a value that is not finite
take no part, nor do vectors of another length than the commonest; a repeated vec_id is one
candidate for each of its vectors; ties go to the smaller vec_id; a table with one such
vector, or none, gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgertalk.sources.scratch import stored

K = 20
QUERY_EVERY = 20
# The index is fitted on at most so many distinct vectors, chosen by hash.
SAMPLE, SAMPLE_QUERIES = 32_768, 256
# Entries of a list, about, and most centroids.
LIST, MOST_LISTS = 128, 8_192
# Replicas of a vector, and how much farther (in squared distance) their centroids may be.
REPLICAS, BOUNDARY = 4, 1.15
NEIGHBOURS, BEAM, WALK = 24, 192, 12
# The beam that finds a vector's own few lists.
NEAR_BEAM = 32
RATIOS = tuple(1 + 0.02 * i for i in range(60))
TARGET = 0.99
# Neighbouring lists are searched together, up to so many entries, by so many queries.
BLOCK_ENTRIES, BLOCK_QUERIES = 16_384, 2_048
BATCH = 256


@dataclass(frozen=True)
class Index:
    centroids: np.ndarray
    graph: np.ndarray
    ratio: float
    length: float


def lifted(vectors: np.ndarray, length: float) -> np.ndarray:
    """Vectors with the coordinate that gives them all this length."""
    rest = np.maximum(length**2 - np.einsum("ij,ij->i", vectors, vectors), 0)
    return np.hstack([vectors, np.sqrt(rest)[:, None]])


def as_queries(vectors: np.ndarray, length: float) -> np.ndarray:
    """Queries at the same length, without a part of the new coordinate."""
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    return np.hstack([vectors / norms * length, np.zeros((len(vectors), 1))])


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    found = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.maximum(found, 0)


def halved(points: np.ndarray, parts: int) -> list[np.ndarray]:
    """Row numbers of ``parts`` (a power of two) parts of nearly equal size."""
    groups = [np.arange(len(points))]
    while len(groups) < parts:
        split = []
        for rows in groups:
            here = points[rows]
            first = here[0]
            far = here[squares(here, first[None])[:, 0].argmax()]
            means = np.stack([here[squares(here, far[None])[:, 0].argmax()], far])
            order = np.arange(len(rows))
            for _ in range(6):
                d = squares(here, means)
                order = np.argsort(d[:, 0] - d[:, 1], kind="stable")
                half = len(rows) // 2
                means = np.stack([here[order[:half]].mean(0), here[order[half:]].mean(0)])
            split += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
        groups = split
    return groups


def neighbour_graph(centroids: np.ndarray) -> np.ndarray:
    """Each centroid's nearest ones, and a few far ones by stride so that all are reached."""
    n = len(centroids)
    near = min(NEIGHBOURS, n)
    graph = np.empty((n, near), dtype=np.int64)
    for at in range(0, n, 1024):
        d = squares(centroids[at : at + 1024], centroids)
        graph[at : at + 1024] = np.argsort(d, axis=1, kind="stable")[:, :near]
    far = (np.arange(n)[:, None] + np.array([1, n // 7 + 1, n // 3 + 1, n // 2 + 1])) % n
    return np.hstack([graph, far])


def nearest_lists(
    index: Index, points: np.ndarray, beam: int = BEAM
) -> tuple[np.ndarray, np.ndarray]:
    """Centroids by a beam search of the graph, nearest first, and their squared distances."""
    found = [
        _walked(index, points[at : at + BATCH], beam) for at in range(0, len(points), BATCH)
    ]
    return np.concatenate([x for x, _ in found]), np.concatenate([d for _, d in found])


def _walked(index: Index, points: np.ndarray, beam_width: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(index.centroids)
    width = min(beam_width, n)
    # Evenly over the centroids, whose order is that of the halving.
    beam = np.tile(np.linspace(0, n - 1, width).astype(np.int64), (len(points), 1))
    own = (index.centroids * index.centroids).sum(1)

    def distance(ids: np.ndarray) -> np.ndarray:
        return own[ids] - 2 * np.einsum("ijk,ik->ij", index.centroids[ids], points)

    best = distance(beam)
    for _ in range(WALK):
        lead = beam[:, : max(4, width // 8)]
        more = index.graph[lead].reshape(len(points), -1)
        ids = np.hstack([beam, more])
        d = np.hstack([best, distance(more)])
        # One entry of each centroid: sort by id, push repeats to the end.
        order = np.argsort(ids, axis=1, kind="stable")
        ids, d = np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)
        d[:, 1:][ids[:, 1:] == ids[:, :-1]] = np.inf
        order = np.argsort(d, axis=1, kind="stable")[:, :width]
        after = np.take_along_axis(ids, order, 1)
        best = np.take_along_axis(d, order, 1)
        if np.array_equal(after, beam):
            break
        beam = after
    return beam, np.maximum(best + (points * points).sum(1)[:, None], 0)


def replicas(index: Index, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and lists of all entries: the nearest list, and those a boundary adds."""
    lists, d = nearest_lists(index, points, NEAR_BEAM)
    rows, found = [np.arange(len(points))], [lists[:, 0]]
    chosen = [[c] for c in lists[:, 0]]
    for j in range(1, min(2 * REPLICAS, lists.shape[1])):
        near = d[:, j] <= BOUNDARY * d[:, 0]
        for i in np.flatnonzero(near):
            if len(chosen[i]) >= REPLICAS:
                continue
            between = squares(index.centroids[lists[i, j]][None], index.centroids[chosen[i]])
            if (between > d[i, j]).all():
                chosen[i].append(lists[i, j])
                rows.append(np.array([i]))
                found.append(lists[i, j : j + 1])
    return np.concatenate(rows), np.concatenate(found)


def fit(sample: np.ndarray, length: float, total: int, k: int = K) -> Index:
    """Index for ``total`` distinct vectors of which these are a sample."""
    points = lifted(sample, length)
    wanted = min(MOST_LISTS, max(1, total // LIST), max(1, len(points) // 8))
    parts = 1 << (int(wanted).bit_length() - 1)
    centroids = np.stack([points[rows].mean(0) for rows in halved(points, parts)])
    index = Index(centroids, neighbour_graph(centroids), RATIOS[-1], length)
    if parts == 1:
        return index
    rows, lists = replicas(index, points)
    holds = [set() for _ in points]
    for i, c in zip(rows.tolist(), lists.tolist(), strict=True):
        holds[i].add(c)
    step = max(1, len(sample) // SAMPLE_QUERIES)
    asked = np.arange(0, len(sample), step)
    scores = sample[asked] @ sample.T
    scores[np.arange(len(asked)), asked] = -np.inf
    true = np.argsort(-scores, axis=1, kind="stable")[:, : min(k, len(sample) - 1)]
    found, d = nearest_lists(index, as_queries(sample[asked], length))
    hits = np.zeros(len(RATIOS))
    for q in range(len(asked)):
        reached = {c: d[q, j] / max(d[q, 0], 1e-12) for j, c in enumerate(found[q].tolist())}
        for x in true[q]:
            needed = min((reached.get(c, np.inf) for c in holds[x]), default=np.inf)
            hits += np.array(RATIOS) >= needed
    enough = np.flatnonzero(hits >= TARGET * true.size)
    ratio = RATIOS[int(enough[0])] if len(enough) else RATIOS[-1]
    return Index(centroids, index.graph, ratio, length)


def _double(column: str) -> Column:
    return F.col(column).cast("array<double>")


def valid(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, vector`` of the rows that take part."""
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), _double(vector_column).alias("vector")
    ).filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0))
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    rows = rows.filter(finite).filter(F.exists("vector", lambda x: x != 0))
    # A row for each length of vectors.
    lengths = rows.groupBy(F.size("vector").alias("size")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if not common:
        return rows
    return rows.filter(F.size("vector") == common[0]["size"])


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1) if len(flat) else np.zeros((0, 1))


def _entries(shared: Broadcast[Index]):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                points = lifted(matrix(batch.column("vector")), shared.value.length)
                rows, lists = replicas(shared.value, points)
                taken = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(lists, pa.int64())], [*batch.schema.names, "list"]
                )

    return assign


def grouped_lists(sizes: np.ndarray) -> np.ndarray:
    """Group of each list: runs of lists (which halving leaves side by side in space) of at
    most ``BLOCK_ENTRIES`` entries, or one longer list."""
    groups, group, held = np.zeros(len(sizes), dtype=np.int64), 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > BLOCK_ENTRIES:
            group, held = group + 1, 0
        groups[i] = group
        held += size
    return groups


def _probes(shared: Broadcast[Index], sizes: Broadcast[tuple], enough: int):
    """A row for each query and group of lists, with the query's lists in that group."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                points = as_queries(matrix(batch.column("vector")), index.length)
                lists, d = nearest_lists(index, points)
                counts, groups = sizes.value
                held = np.cumsum(counts[lists], axis=1) - counts[lists]
                use = (d <= index.ratio * d[:, :1]) | (held < enough)
                rows, places = np.nonzero(use)
                chosen = lists[rows, places]
                order = np.lexsort((groups[chosen], rows))
                rows, chosen = rows[order], chosen[order]
                of_group = groups[chosen]
                new = np.ones(len(rows), dtype=bool)
                new[1:] = (rows[1:] != rows[:-1]) | (of_group[1:] != of_group[:-1])
                starts = np.flatnonzero(new)
                taken = batch.take(pa.array(rows[starts]))
                listed = pa.ListArray.from_arrays(
                    pa.array(np.append(starts, len(rows)), pa.int32()), pa.array(chosen, pa.int64())
                )
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(of_group[starts], pa.int64()), listed],
                    [*batch.schema.names, "part", "lists"],
                )

    return choose


def _best(k: int):
    def search(queries: pa.Table, entries: pa.Table) -> pa.Table:
        asked, there = matrix(queries.column("vector")), matrix(entries.column("vector"))
        keys = entries.column("key").to_numpy()
        first = entries.column("first").to_numpy()
        ids = queries.column("key").to_numpy()
        found_q, found_x, found_s = [], [], []
        of_list = entries.column("list").to_numpy()
        order = np.argsort(of_list, kind="stable")
        names, starts = np.unique(of_list[order], return_index=True)
        members = dict(zip(names.tolist(), np.split(order, starts[1:]), strict=True))
        lists = queries.column("lists").to_pylist()
        for i in range(len(asked) if len(there) else 0):
            parts = [members[c] for c in lists[i] if c in members]
            if not parts:
                continue
            rows = np.concatenate(parts)
            # Replicas of an entry in several of the lists count once.
            rows = rows[np.unique(keys[rows], return_index=True)[1]]
            # Summed row by row, so that equal vectors have equal scores.
            scores = (there[rows] * asked[i]).sum(axis=1)
            if len(scores) > 4 * k:
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
                rows, scores = rows[scores >= least], scores[scores >= least]
            best = np.lexsort((first[rows], -scores))[:k]
            found_q.append(np.full(len(best), ids[i]))
            found_x.append(keys[rows[best]])
            found_s.append(scores[best])
        empty = [np.zeros(0, dtype=np.int64)]
        return pa.table(
            [
                pa.array(np.concatenate(found_q or empty), pa.int64()),
                pa.array(np.concatenate(found_x or empty), pa.int64()),
                pa.array(np.concatenate(found_s or empty).astype(float), pa.float64()),
            ],
            names=["query", "key", "score"],
        )

    return search


def neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``; ``is_query`` is a condition on the column ``id``."""
    spark = vectors.sparkSession
    rows = valid(vectors, id_column, vector_column).withColumn(
        "key", F.xxhash64("vector").bitwiseXOR(F.shiftleft(F.hash("vector").cast("long"), 17))
    )
    rows = stored(rows, "vectors")
    by_id = Window.partitionBy("key").orderBy("id")
    # No answer holds more than k + 1 ids of one vector; each task passes on no more.
    few = rows.select("key", "id").distinct().withColumn("nth", F.row_number().over(by_id))
    few = few.filter(F.col("nth") <= k + 1).groupBy("key").agg(
        F.sort_array(F.collect_list("id")).alias("ids")
    )
    sample_of = rows.select("key", "id").groupBy("key").agg(F.min("id").alias("id"))
    distinct = stored(
        rows.join(sample_of, ["key", "id"])
        .dropDuplicates(["key"])
        .join(few, "key")
        .select("key", F.col("id").alias("first"), "vector", "ids"),
        "distinct_vectors",
    )
    total = distinct.count()
    # At most SAMPLE rows. Cut first at a hash below which about twice as many lie, so that no
    # task passes on SAMPLE rows of its own.
    place = F.xxhash64("key", F.lit(5))
    below = min(2**63 - 1, 2**64 * 2 * SAMPLE // max(total, 1) - 2**63)
    sample = distinct.filter(place <= F.lit(below)).orderBy(place, "key").limit(SAMPLE)
    sample = matrix(sample.select("vector").toArrow().column("vector"))
    squared = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    length = float(np.sqrt(distinct.agg(F.max(squared)).first()[0] or 1.0))
    index = fit(sample, length, total, k) if total else None
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(index)

    columns = distinct.select("key", "first", "vector")
    entries = stored(
        columns.mapInArrow(_entries(shared), "key long, first long, vector array<double>, list long"),
        "entries",
    )
    # One row for each list.
    counts = dict(entries.groupBy("list").count().collect())
    sizes = np.zeros(len(index.centroids), dtype=np.int64)
    sizes[list(counts)] = list(counts.values())
    groups = grouped_lists(sizes)
    asking = rows.filter(is_query).select(F.col("id").alias("query_id"), "key").distinct()
    asking = stored(asking, "asking")
    queries = columns.join(asking.select("key").distinct(), "key", "left_semi").select("key", "vector")
    probes = stored(
        queries.mapInArrow(
            _probes(shared, spark.sparkContext.broadcast((sizes, groups)), 4 * (k + 1)),
            "key long, vector array<double>, part long, lists array<long>",
        ),
        "probes",
    )
    part_of = spark.createDataFrame(list(enumerate(groups.tolist())), "list long, part long")
    entries = entries.join(F.broadcast(part_of), "list")
    asked = probes.groupBy("part").agg(
        F.ceil(F.count("*") / F.lit(BLOCK_QUERIES)).cast("int").alias("query_blocks")
    )
    held = entries.groupBy("part").agg(
        F.ceil(F.count("*") / F.lit(BLOCK_ENTRIES)).cast("int").alias("entry_blocks")
    )
    blocks = asked.join(held, "part")

    def last(blocks_column: str) -> Column:
        return F.col(blocks_column) - 1

    one = probes.join(blocks, "part").select(
        "key",
        "vector",
        "lists",
        "part",
        F.pmod(F.xxhash64("key"), F.col("query_blocks")).cast("int").alias("query_block"),
        F.explode(F.sequence(F.lit(0), last("entry_blocks"))).alias("entry_block"),
    )
    other = entries.join(blocks, "part").select(
        "key",
        "first",
        "vector",
        "list",
        "part",
        F.pmod(F.xxhash64("key"), F.col("entry_blocks")).cast("int").alias("entry_block"),
        F.explode(F.sequence(F.lit(0), last("query_blocks"))).alias("query_block"),
    )
    task = ["part", "query_block", "entry_block"]
    found = one.groupBy(*task).cogroup(other.groupBy(*task)).applyInArrow(
        _best(k + 1), "query long, key long, score double"
    )
    # Replicas find an entry more than once; ids come to the entries left.
    best_first = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    top = (
        found.distinct()
        .join(distinct.select("key", "first", "ids"), "key")
        .withColumn("nth", F.row_number().over(best_first))
        .filter(F.col("nth") <= k + 1)
        .select("query", "score", F.explode("ids").alias("id"))
    )
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    top = (
        top.withColumn("nth", F.row_number().over(by_score))
        .filter(F.col("nth") <= k + 1)
        .groupBy(F.col("query").alias("key"))
        .agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score"))).alias("top"))
    )
    others = F.slice(
        F.filter("top", lambda x: x["id"] != F.col("query_id")), F.lit(1), F.lit(k)
    )
    answers = asking.join(stored(top, "answers"), "key").select(
        "query_id", F.posexplode(others).alias("place", "hit")
    )
    return answers.select(
        "query_id",
        (F.col("place") + 1).alias("rank"),
        F.col("hit.id").alias("vec_id"),
        F.col("hit.score").alias("score"),
    )
