"""Sampling and splitting by content hash.

``rand``/``randomSplit`` depend on partition layout and row order, so a retried
task or another cluster size would pick other rows. A hash of the row's own key
gives the same answer everywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_hash(keys: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws("#", *keys, F.lit(seed)))


PREFIX_DIGITS = 4


def sample(df: DataFrame, keys: Sequence[str], n: int, seed: int) -> DataFrame:
    """At most ``n`` rows, chosen by key hash. ``keys`` must identify a row.

    The final top-n is one task that merges ``n`` rows from every task before it, so rows are
    first cut at the hash prefix below which ``n`` rows lie: about ``n`` rows remain in all,
    and the cut runs right after the scan.
    """
    # A column, because an expression in the sort order is computed again per comparison.
    hashed = df.withColumn("order_hash", order_hash(keys, seed))
    hashed = hashed.filter(_prefix() <= _last_prefix(hashed, n))
    return hashed.orderBy("order_hash", *keys).limit(n).drop("order_hash")


def _prefix() -> Column:
    return F.substring("order_hash", 1, PREFIX_DIGITS)


def _last_prefix(hashed: DataFrame, n: int) -> Column:
    """Smallest prefix up to which at least ``n`` rows lie, else the largest possible one.

    The window has no partition: it runs over one count per prefix, 16 ** PREFIX_DIGITS rows.
    """
    counts = hashed.groupBy(_prefix().alias("prefix")).agg(F.count(F.lit(1)).alias("rows"))
    reached = counts.select("prefix", F.sum("rows").over(Window.orderBy("prefix")).alias("upto"))
    enough = reached.filter(F.col("upto") >= n).agg(F.min("prefix").alias("prefix"))
    return enough.select(F.coalesce("prefix", F.lit("f" * PREFIX_DIGITS))).scalar()


def train_or_eval(text: Column, ratio: float, seed: int) -> Column:
    digest = F.md5(F.concat_ws("#", text, F.lit(seed)))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10000
    return F.when(bucket < round(ratio * 10000), "train").otherwise("eval")
