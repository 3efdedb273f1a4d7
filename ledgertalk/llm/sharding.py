"""Shards of near-equal size by vector bin packing over groups of equal texts.

Sizes are vectors (bytes, tokens, rows); a token is a run without white space. A shard's
capacity is its even share of the total. Items are placed largest first, each on the shard
whose residual capacity has the highest dot product with the item, so that a shard short of
rows attracts items rich in rows.

Items number at most ``24 * pieces + buckets`` whatever the input, because

- a group larger than ``1 / pieces`` of a shard is an item of its own, and there can be no
  more than ``shards * pieces`` of these; one larger than a whole shard is cut, by a hash of
  doc_id, into items of at most ``1 / pieces`` of a shard;
- all other groups are dealt by hash over a fixed number of buckets, each one item.

So the placing itself is a small loop over fixed-size arrays, and the table from item to
shard has a proven bound. Equal texts stay in one shard unless they exceed a shard.

Defined results: a null text counts as empty (8 bytes with the fixed part); repeated rows
are separate rows of one group; an empty table gives an empty result; columns other than
doc_id and the text are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgertalk.llm.common import split_words, text_or_empty
from ledgertalk.sources.scratch import stored

SHARDS = 24
# Large groups: over 1/200 of a shard. Buckets of small groups: 200 a shard.
PIECES = 200
ROW_BYTES = 8
# Bytes count most, for their law is the one promised.
WEIGHTS = (64.0, 1.0, 1.0)


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item (rows of bytes, tokens, rows), by residual capacity."""
    whole = items.sum(axis=0)
    scaled = items / np.where(whole > 0, whole, 1) * shards * np.sqrt(WEIGHTS)
    residual = np.tile(np.sqrt(WEIGHTS), (shards, 1))
    found = np.zeros(len(items), dtype=np.int64)
    order = np.lexsort((np.arange(len(items)), -scaled[:, 0], -scaled.max(axis=1)))
    for i in order:
        shard = int(np.argmax(residual @ scaled[i]))
        residual[shard] -= scaled[i]
        found[i] = shard
    return found


def shard_rows(docs: DataFrame, shards: int = SHARDS, text_column: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row."""
    spark = docs.sparkSession
    text = text_or_empty(text_column)
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.size(split_words(text)).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("group"),
    )
    rows = stored(rows, "shard_rows")

    # A single summing row.
    whole = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    share = max(whole / shards, 1.0)
    sizes = rows.groupBy("group").agg(F.sum("size").alias("group_size"))
    # At most shards * PIECES groups can be this large.
    large = stored(sizes.filter(F.col("group_size") > share / PIECES), "large_groups")
    large = large.select("group", "group_size")
    parts = F.when(
        F.col("group_size") > share, F.ceil(F.col("group_size") * PIECES / share)
    ).otherwise(F.lit(1))
    by_id = F.xxhash64("doc_id", F.lit(7))
    bucket = F.pmod(F.xxhash64("group", F.lit(11)), F.lit(shards * PIECES))
    dealt = rows.join(large, "group", "left").select(
        "doc_id",
        "size",
        "tokens",
        "text_crc32",
        F.when(F.col("group_size").isNull(), bucket).otherwise(F.col("group")).alias("item"),
        F.when(F.col("group_size").isNull(), F.lit(-1).cast("long"))
        .otherwise(F.pmod(by_id, parts).cast("long"))
        .alias("part"),
        # Rows of an item are numbered in blocks, so that no item is one task's work.
        F.pmod(
            by_id,
            F.when(
                F.col("group_size").isNull(), F.lit(1)
            ).otherwise(F.ceil(F.col("group_size") * PIECES / share / parts)),
        )
        .cast("long")
        .alias("block"),
    )
    blocks = dealt.groupBy("item", "part", "block").agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("n")
    )
    # Bounded: see above.
    blocks = blocks.orderBy("item", "part", "block").toPandas()
    if blocks.empty:
        table = spark.createDataFrame([], "item long, part long, block long, shard int, first long")
    else:
        items = blocks.groupby(["item", "part"], sort=True)[["bytes", "tokens", "n"]].sum()
        items["shard"] = place(items[["bytes", "tokens", "n"]].to_numpy(float), shards)
        blocks = blocks.join(items["shard"], on=["item", "part"])
        blocks["first"] = blocks.groupby("shard")["n"].cumsum() - blocks["n"]
        table = spark.createDataFrame(
            blocks[["item", "part", "block", "shard", "first"]],
            "item long, part long, block long, shard int, first long",
        )
    within = Window.partitionBy("item", "part", "block").orderBy("doc_id", "text_crc32", "size")
    return dealt.withColumn("nth", F.row_number().over(within)).join(
        F.broadcast(table), ["item", "part", "block"]
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("first") + F.col("nth") - 1).alias("slot"),
    )
