"""Quality by the perplexity of a character n-gram model of trusted text.

The model is an interpolated modified Kneser-Ney model of five characters, its counts taken
from every trusted document. Grams are packed numbers (12 bits a character; beyond U+07FF
2048 numbers are shared), so counting, left extensions, discounts and back-off weights are
plain grouped sums and joins in Spark, sharded by gram.

Scoring joins counts to documents by blocks: a block of documents asks for each distinct
gram in it once, the answers come from a join on the gram and meet the block's documents
again, and each document's mean log-probability is taken over its whole text. What is asked
and answered follows the input; a gram that all documents hold is asked once a block.

A document is kept unless its perplexity exceeds its language's threshold: ``MARGIN`` times
a high quantile over the trusted documents of that language. A language without any has no
threshold and its documents are kept: a model that has seen nothing of it finds all of it
improbable, which is no evidence against one of them. For the quantile a trusted document is
scored by a model that has not counted it, nor any text of its fold. The quantile of few documents is about their largest perplexity,
which may be too low: if it is below the quantile of all languages, it is moved towards that
one, as a geometric mean with weights of its number of documents and ``PRIOR_DOCS``. It is
never moved down, for a language is less probable to a model that has seen little of it.

Defined results: a null text, or one of fewer than three characters, has no gram and no
perplexity and is kept; a null language is a language of its own; repeated rows are scored
alike; without trusted documents all are kept; an empty table gives an empty result; other
columns, whatever their names, pass through ``keep_good`` unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgertalk.llm.common import (
    few_at_once,
    give_back,
    in_blocks,
    small_or_shuffled,
    with_fields,
)
from ledgertalk.sources.scratch import stored

ORDER, BITS = 5, 12
CODES = 1 << BITS
# Documents of a block, and bytes of their texts beyond which it is cut.
BLOCK_DOCS, BLOCK_BYTES = 16384, 128 << 20
# Quantile of trusted documents' perplexity, and how far beyond it a document may lie: no
# farther, for the quantile is taken over texts that the scoring model has not counted.
# Measured on sf0.1: 527 of 571 poor documents rejected and 2 of 3,027 good ones (quantile of
# counted texts times 1.25: 494 and none).
QUANTILE, MARGIN = 0.995, 1.0
# Parts of the trusted texts; a part is scored for the quantile by a model of the others.
FOLDS = 2
# The model of all trusted texts, and the one without each fold, as endings of column names.
MODELS = ("", *(f"_{fold}" for fold in range(FOLDS)))
# A language's own quantile weighs as its number of trusted documents against so many.
PRIOR_DOCS = 5
# Rows of a frame of texts on their way to their block.
FRAME_ROWS = 512
# Trusted ids are broadcast up to this number (16 MB), joined by a shuffle beyond it.
MOST_BROADCAST_IDS = 2_000_000
# Distinct grams that a task holds before it passes them on, and characters, about, that it
# looks at once.
HELD_GRAMS = 1_000_000
CHARS_AT_ONCE = 500_000


def mask(order: int) -> int:
    return (1 << (BITS * order)) - 1


def grams(text: str | None) -> np.ndarray:
    """All five-character grams of a text as packed numbers; white space reads as one space."""
    line = f" {' '.join(text.split())} " if text else ""
    points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    if len(points) < ORDER:
        return np.zeros(0, dtype=np.int64)
    half = CODES // 2
    codes = np.where(points < half, points, half + points % half)
    found = np.zeros(len(codes) - ORDER + 1, dtype=np.int64)
    for i in range(ORDER):
        found = (found << BITS) | codes[i : i + len(found)]
    return found


def tagged(order: int, gram):
    """One key space for grams of all orders."""
    return gram | (order << (BITS * ORDER))


def _in_batches(texts: Iterable[str | None]) -> Iterator[list[np.ndarray]]:
    held, size = [], 0
    for text in texts:
        held.append(grams(text))
        size += len(held[-1])
        if size > CHARS_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def fold_of(text: Column) -> Column:
    """Equal texts are of one fold."""
    return F.coalesce(F.pmod(F.xxhash64(text), F.lit(FOLDS)), F.lit(0)).cast("long")


def counted(docs: DataFrame) -> DataFrame:
    """``gram, n, n_0, ...``: counts of the highest order over all rows of ``text``, and over
    the rows outside each fold."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds = batch.column("fold").to_numpy()
            at = 0
            for held in _in_batches(few_at_once(batch.column("text"))):
                of_row = np.repeat(folds[at : at + len(held)], list(map(len, held)))
                at += len(held)
                found, which = np.unique(np.concatenate(held), return_inverse=True)
                of_fold = [
                    np.bincount(which[of_row != fold], minlength=len(found))
                    for fold in range(FOLDS)
                ]
                n = np.bincount(which, minlength=len(found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.astype(np.int64)) for x in (found, n, *of_fold)],
                    ["gram", *(f"n{s}" for s in MODELS)],
                )
        give_back()

    schema = ", ".join(["gram long", *(f"n{s} long" for s in MODELS)])
    parts = docs.select("text", fold_of(F.col("text")).alias("fold")).mapInArrow(count, schema)
    return parts.groupBy("gram").agg(*[F.sum(f"n{s}").alias(f"n{s}") for s in MODELS])


@dataclass(frozen=True)
class Model:
    """``entries``: ``key, logp, back_off`` for grams of all orders, the last two for each of
    ``MODELS``; and each one's log-probability of a character never seen."""

    entries: DataFrame
    unseen: dict[str, float]


def discounts(counts: DataFrame) -> dict[str, tuple[float, float, float]]:
    """Chen and Goodman's three discounts of each model."""
    row = counts.agg(
        *[
            F.count(F.when(F.col(f"n{s}") == k, 1)).alias(f"n{s}_{k}")
            for s in MODELS
            for k in range(1, 5)
        ]
    ).first()
    return {s: _three(*(float(row[f"n{s}_{k}"]) for k in range(1, 5))) for s in MODELS}


def _three(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """From the numbers of counts 1 to 4."""
    if min(n1, n2, n3) == 0:
        return 0.5, 0.75, 1.0
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), k) for k, d in enumerate(found, start=1))


def model(trusted: DataFrame) -> Model:
    """Fit on all rows of ``text``, and on the rows outside each fold. The models share their
    rows: a gram that one of them has not counted has no probability there."""
    counts = {ORDER: stored(counted(trusted), f"counts{ORDER}")}
    for k in range(ORDER - 1, 0, -1):
        # Kneser-Ney: a shorter gram counts the characters that can stand before it.
        shorter = counts[k + 1].withColumn("gram", F.col("gram").bitwiseAND(F.lit(mask(k))))
        seen = [F.count_if(F.col(f"n{s}") > 0).alias(f"n{s}") for s in MODELS]
        counts[k] = stored(shorter.groupBy("gram").agg(*seen), f"counts{k}")

    probability: DataFrame | None = None
    parts: list[DataFrame] = []
    unseen: dict[str, float] = {}
    values = [f"{name}{s}" for s in MODELS for name in ("logp", "back_off")]
    nothing = F.lit(None).cast("double")

    def entry(key: Column, known: dict[str, Column]) -> list[Column]:
        return [key.alias("key"), *(known.get(v, nothing).alias(v) for v in values)]

    for k in range(1, ORDER + 1):
        of_model = discounts(counts[k])
        n = {s: F.col(f"n{s}") for s in MODELS}
        discount = {
            s: F.when(n[s] == 0, 0.0).when(n[s] == 1, d1).when(n[s] == 2, d2).otherwise(d3)
            for s, (d1, d2, d3) in of_model.items()
        }
        if k == 1:
            # One row of sums over at most ``CODES`` grams.
            row = counts[1].agg(
                *[F.sum(n[s]).alias(f"total{s}") for s in MODELS],
                *[F.sum(discount[s]).alias(f"taken{s}") for s in MODELS],
            ).first()
            found = {}
            for s in MODELS:
                total = float(row[f"total{s}"] or 1)
                # A fold's model without any text takes all characters as equally likely.
                rest = max((row[f"taken{s}"] or 0) / total, 1e-9) if row[f"total{s}"] else 1.0
                unseen[s] = math.log(rest / CODES)
                p = (n[s] - discount[s]) / F.lit(total) + rest / CODES
                found[s] = F.when(n[s] > 0, p).alias(f"p{s}")
            probability = counts[1].select("gram", *found.values())
        else:
            history = F.shiftright("gram", BITS)
            sums = [F.sum(n[s]).alias(f"total{s}") for s in MODELS]
            rests = [
                F.try_divide(F.sum(discount[s]), F.sum(n[s])).alias(f"rest{s}") for s in MODELS
            ]
            of_history = counts[k].groupBy(history.alias("history")).agg(*sums, *rests)
            weights = {f"back_off{s}": F.log(f"rest{s}") for s in MODELS}
            parts.append(
                of_history.select(*entry(tagged_column(k - 1, F.col("history")), weights))
            )
            below = probability.select(
                F.col("gram").alias("ending"), *[F.col(f"p{s}").alias(f"below{s}") for s in MODELS]
            )
            found = {}
            for s in MODELS:
                own = F.try_divide(n[s] - discount[s], F.col(f"total{s}"))
                p = own + F.col(f"rest{s}") * F.col(f"below{s}")
                found[s] = F.when(n[s] > 0, p).alias(f"p{s}")
            probability = (
                counts[k]
                .withColumn("history", history)
                .join(of_history, "history")
                .withColumn("ending", F.col("gram").bitwiseAND(F.lit(mask(k - 1))))
                .join(below, "ending")
                .select("gram", *found.values())
            )
        probability = stored(probability, f"probability{k}")
        logs = {f"logp{s}": F.log(f"p{s}") for s in MODELS}
        parts.append(probability.select(*entry(tagged_column(k, F.col("gram")), logs)))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionAll(part)
    entries = every.groupBy("key").agg(*[F.max(v).alias(v) for v in values])
    # The folds' models give quantiles only; seven digits do.
    narrow = [F.col(v).cast("float").alias(v) if v[-1].isdigit() else v for v in values]
    return Model(entries.select("key", *narrow), unseen)


def tagged_column(order: int, gram: Column) -> Column:
    return gram.bitwiseOR(F.lit(order << (BITS * ORDER)).cast("long"))


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block, key``: the distinct grams of all orders of a block's texts."""
    held: dict[int, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for block, found in held.items():
            keys = np.concatenate(
                [
                    tagged(k, pd.unique(part & mask(k)))
                    for k in range(1, ORDER + 1)
                    for part in ([found] if k == ORDER else [found, found >> BITS])
                ]
            )
            # In order, so that the shuffle compresses them well.
            keys = np.unique(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), block, dtype=np.int64)), pa.array(keys)],
                ["block", "key"],
            )

    for batch in batches:
        blocks = np.array(batch.column("block").to_pylist(), dtype=np.int64)
        for block in pd.unique(blocks):
            rows = batch.column("text").filter(pa.array(blocks == block))
            for part in _in_batches(few_at_once(rows)):
                before = held.get(int(block), np.zeros(0, dtype=np.int64))
                held[int(block)] = pd.unique(np.concatenate([before, *map(pd.unique, part)]))
        if sum(map(len, held.values())) > HELD_GRAMS:
            yield from flush()
            held.clear()
    yield from flush()
    held.clear()
    give_back()


def log_probabilities(
    found: np.ndarray, known: pd.Index, entries: dict[str, np.ndarray], unseen: dict[str, float]
) -> dict[str, np.ndarray]:
    """Each model's log-probability of each five-character gram, backing off to shorter ones."""
    result = {s: np.full(len(found), np.nan) for s in unseen}
    weight = {s: np.zeros(len(found)) for s in unseen}

    def places(keys: np.ndarray) -> np.ndarray:
        return known.get_indexer(keys) if len(known) else np.full(len(keys), -1)

    def looked_up(at: np.ndarray, values: np.ndarray) -> np.ndarray:
        return np.where(at >= 0, values[at], np.nan) if len(values) else np.full(len(at), np.nan)

    for k in range(ORDER, 0, -1):
        ending = found & mask(k)
        at = places(tagged(k, ending))
        before = places(tagged(k - 1, ending >> BITS)) if k > 1 else None
        for s in unseen:
            here = looked_up(at, entries[f"logp{s}"])
            use = np.isnan(result[s]) & ~np.isnan(here)
            result[s][use] = weight[s][use] + here[use]
            if k > 1:
                weight[s] += np.nan_to_num(looked_up(before, entries[f"back_off{s}"]))
    return {s: np.where(np.isnan(result[s]), weight[s] + unseen[s], result[s]) for s in unseen}


def framed(rows: DataFrame) -> DataFrame:
    """``block, frame``: rows of a block, several compressed together, for a shuffle."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
        for batch in batches:
            blocks = np.array(batch.column("block").to_pylist(), dtype=np.int64)
            for block in np.unique(blocks):
                here = batch.filter(pa.array(blocks == block))
                for at in range(0, len(here), FRAME_ROWS):
                    # Taken anew, so that a frame holds its own rows only.
                    part = pa.Table.from_batches([here.slice(at, FRAME_ROWS)])
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                        out.write_table(part)
                    frame = pa.array([sink.getvalue().to_pybytes()], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block], pa.int64()), frame], ["block", "frame"]
                    )

    return rows.mapInArrow(pack, "block long, frame binary")


def scored(docs: DataFrame, fitted: Model) -> DataFrame:
    """``doc_id, lang, text_hash, grams, perplexity, held_out`` for every row of ``doc_id, lang,
    text``; ``held_out`` is the perplexity under the model without the text's fold."""
    blocked = in_blocks(
        docs.select("doc_id", "lang", "text"), BLOCK_DOCS, BLOCK_BYTES, MOST_BROADCAST_IDS
    )
    asked = blocked.select("block", "text").mapInArrow(_asked, "block long, key long")
    # Tasks that read the same block ask alike. Dealt by key, the repeats meet and go before the
    # join, which needs no other exchange.
    answers = asked.repartition("key").distinct().join(fitted.entries, "key")
    unseen = fitted.unseen
    schema = with_fields(
        docs.select("doc_id", "lang").schema,
        "text_hash long, grams long, perplexity double, held_out double",
    )

    def mean_perplexity(logs: np.ndarray) -> float | None:
        return float(np.exp(-logs.mean())) if len(logs) else None

    def score(frames: pa.Table, entries: pa.Table) -> pa.Table:
        known = pd.Index(entries.column("key").to_numpy())
        values = {
            name: entries.column(name).to_numpy(zero_copy_only=False)
            for s in unseen
            for name in (f"logp{s}", f"back_off{s}")
        }
        found: list[pa.Table] = []
        for frame in frames.column("frame"):
            rows = pa.ipc.open_stream(frame.as_buffer()).read_all()
            folds = rows.column("fold").to_pylist()
            sizes: list[int] = []
            perplexity: list[float | None] = []
            held_out: list[float | None] = []
            for held in _in_batches(rows.column("text").to_pylist()):
                codes, distinct = pd.factorize(np.concatenate(held))
                logs = log_probabilities(distinct, known, values, unseen)
                at = 0
                for one in held:
                    here = codes[at : at + len(one)]
                    held_out.append(mean_perplexity(logs[f"_{folds[len(sizes)]}"][here]))
                    perplexity.append(mean_perplexity(logs[""][here]))
                    sizes.append(len(one))
                    at += len(one)
            found.append(
                pa.table(
                    [
                        rows.column("doc_id"),
                        rows.column("lang"),
                        rows.column("text_hash"),
                        pa.array(sizes, pa.int64()),
                        pa.array(perplexity, pa.float64()),
                        pa.array(held_out, pa.float64()),
                    ],
                    names=schema.names,
                )
            )
        return pa.concat_tables(found)

    with_hash = blocked.withColumn("text_hash", F.xxhash64("text")).withColumn(
        "fold", fold_of(F.col("text"))
    )
    return (
        framed(with_hash)
        .groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(score, schema)
    )


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents that some label calls good and none calls poor or toxic."""
    return (
        labels.groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0))
        .select("doc_id")
    )


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, lang, text_hash, grams, perplexity, threshold, kept`` for every row."""
    docs = docs.select("doc_id", "lang", "text")
    ids = small_or_shuffled(stored(trusted_ids(labels), "trusted_ids"), MOST_BROADCAST_IDS)
    fitted = model(docs.join(ids, "doc_id", "left_semi"))
    found = stored(scored(docs, fitted), "scores")
    good = found.join(ids, "doc_id", "left_semi").filter(F.col("perplexity").isNotNull())
    limit = F.percentile_approx("held_out", F.lit(QUANTILE), F.lit(10_000)) * MARGIN
    # One row for each language, and one for all.
    by_language = good.groupBy(F.col("lang").alias("of_lang")).agg(
        limit.alias("own"), F.count("*").alias("n")
    )
    overall = F.lit(good.agg(limit).first()[0]).cast("double")
    same = F.col("lang").eqNullSafe(F.col("of_lang"))
    smoothed = F.exp(
        (F.col("n") * F.log("own") + PRIOR_DOCS * F.log(overall)) / (F.col("n") + PRIOR_DOCS)
    )
    threshold = F.greatest("own", smoothed)
    return found.join(by_language, same, "left").select(
        "doc_id",
        "lang",
        "text_hash",
        "grams",
        "perplexity",
        threshold.alias("threshold"),
        (~F.coalesce(F.col("perplexity") > threshold, F.lit(False))).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The kept rows, with their own columns only."""
    verdicts = judged(docs, labels).filter("kept")
    rows = docs.alias("d")
    v = verdicts.select("doc_id", "lang", "text_hash").distinct().alias("v")
    same = (
        F.col("d.doc_id").eqNullSafe(F.col("v.doc_id"))
        & F.col("d.lang").eqNullSafe(F.col("v.lang"))
        & (F.xxhash64("d.text") == F.col("v.text_hash"))
    )
    return rows.join(v, same, "left_semi")
