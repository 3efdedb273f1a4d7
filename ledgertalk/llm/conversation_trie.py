"""Prefix trie of rebuilt conversations.

A conversation's turns are ordered by turn (null first), ties by role, then text. Every
conversation is rebuilt: it opens with the first turns of the first conversation of its family
and goes on with its own. Every distinct sequence of first turns is a node of the trie.

1. *Numbers without gathering.* Turns are numbered in blocks of turn values; block totals give
   each block its offset, so a conversation with a third of all turns is many small windows.
2. *Whole-sequence collapse.* A turn's place and content hash to 128 bits; the exclusive or over
   a conversation's turns names its whole sequence, whatever the order in which they arrive.
   Identical conversations become one weighted sequence with the smallest conv_id and the list
   of its ends. Only the turns of that one conversation go on.
3. *Leaves by anti-join.* Sequences that are a proper prefix of another one are dropped; those
   left are the leaves.
4. *Weighted prefixes.* All prefixes of the distinct sequences are added up by node. A subtree's
   bytes follow from sums over the sequences through its top, so no node visits its subtree:
   with ``total`` a sequence's bytes and ``before`` those before the node's last turn, members
   hold ``sum(weight * total) - n_convs * before`` below it. Each node belongs to its smallest
   member; the distinct nodes below hold the sum of ``owned`` bytes of the sequences through
   the top, less what the top's own sequence owns above it.

A list of ends is hashed from texts of at most ``ENDS`` ids each, made in parallel: SHA-256 is
sequential, but what one task reads is one row for that many ids.

Defined results: null role or text is empty; rows with a null conv_id belong to no conversation
and are left out; repeated rows are turns of their own; a family is ``conv_id - conv_id % 5`` with
the remainder of the sign of conv_id; turns of any length; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgertalk.sources.scratch import stored

# Conversations of a family, and one more than the most opening turns that they share.
FAMILY, MOST_SHARED = 5, 9
# Turn values, or places, of a block.
BLOCK = 256
# Ids of one text of a list of ends.
ENDS = 4096
NODE = ["depth", "x1", "x2"]


def shared_turns(conv_id: Column) -> Column:
    """How many opening turns a conversation takes from the first one of its family."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED).cast("int")


def _upto(value: Column, order: list[str], *key: str) -> Column:
    """Sum of the rows up to this one, 0 for none."""
    return F.coalesce(F.sum(value).over(Window.partitionBy(*key).orderBy(*order)), F.lit(0))


def numbered(turns: DataFrame) -> DataFrame:
    """``conv_id, place, content, bytes``: turns numbered from 1 in each conversation."""
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.floor(F.col("turn") / BLOCK).alias("block"),
        role.alias("role"),
        text.alias("text"),
    )
    in_block = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    # The length of the role keeps role and text apart.
    content = F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text"))
    rows = stored(
        rows.select(
            "conv_id",
            "block",
            F.row_number().over(in_block).alias("nth"),
            content.alias("content"),
            F.octet_length("text").cast("long").alias("bytes"),
        ),
        "turns",
    )
    blocks = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    offsets = blocks.select(
        F.col("conv_id").alias("conv"),
        F.col("block").alias("of_block"),
        (_upto(F.col("n"), ["block"], "conv_id") - F.col("n")).alias("offset"),
    )
    # A null turn makes a null block, which must meet itself.
    same = (F.col("conv_id") == F.col("conv")) & F.col("block").eqNullSafe(F.col("of_block"))
    return rows.join(offsets, same).select(
        "conv_id", (F.col("nth") + F.col("offset")).alias("place"), "content", "bytes"
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations, and ``conv_id, place, a, b, bytes`` of the rebuilt ones' turns. ``a``
    and ``b`` hash place and content."""
    rows = stored(numbered(turns), "numbered")
    conv = F.col("conv_id")
    convs = stored(rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "conversations")
    first = conv - conv % FAMILY
    plans = convs.select("conv_id", first.alias("first"), shared_turns(conv).alias("h"))
    lengths = convs.select(conv.alias("first"), F.col("n").alias("n_first"))
    plans = plans.join(lengths, "first", "left").select(
        "conv_id",
        "first",
        "h",
        F.least(F.coalesce("n_first", F.lit(0)), F.col("h")).alias("opening"),
    )
    plans = stored(plans, "plans")
    # The first of a family opens with its own turns: it is as it was.
    others = plans.filter(F.col("conv_id") != F.col("first"))
    # A family has at most FAMILY members, an opening at most MOST_SHARED - 1 turns.
    openings = rows.filter(F.col("place") < MOST_SHARED).withColumnRenamed("conv_id", "first")
    opened = (
        others.filter(F.col("opening") > 0)
        .join(openings, "first")
        .filter(F.col("place") <= F.col("opening"))
        .select("conv_id", "place", "content", "bytes")
    )
    own = (
        rows.join(plans, "conv_id")
        .filter((conv == F.col("first")) | (F.col("place") > F.col("h")))
        .select(
            "conv_id",
            F.when(conv == F.col("first"), F.col("place"))
            .otherwise(F.col("place") - F.col("h") + F.col("opening"))
            .alias("place"),
            "content",
            "bytes",
        )
    )
    hashed = opened.unionByName(own).select(
        "conv_id",
        "place",
        F.xxhash64(F.lit("a"), "place", "content").alias("a"),
        F.xxhash64(F.lit("b"), "place", "content").alias("b"),
        "bytes",
    )
    return convs.select("conv_id"), stored(hashed, "rebuilt")


def sequences(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct whole sequences with weight, and every conversation's sequence."""
    whole = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("depth"),
        F.bit_xor("a").alias("x1"),
        F.bit_xor("b").alias("x2"),
        F.sum("bytes").alias("total"),
    )
    zero = F.lit(0).cast("long")
    ends = convs.join(whole, "conv_id", "left").select(
        "conv_id", *[F.coalesce(name, zero).alias(name) for name in (*NODE, "total")]
    )
    ends = stored(ends, "ends")
    found = ends.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("weight"),
        F.first("total").alias("total"),
    )
    return stored(found, "sequences"), ends


def end_hashes(ends: DataFrame) -> DataFrame:
    """``depth, x1, x2, ends_sha256`` of every distinct sequence's conversations."""
    chunk = F.floor(F.col("conv_id") / ENDS)
    # At most ENDS ids, for a conv_id occurs once.
    texts = ends.groupBy(*NODE, chunk.alias("chunk")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come by node, then chunk: a node's digest is the only thing held.
        node, digest = None, hashlib.sha256()

        def row() -> pa.RecordBatch:
            values = [*node, digest.hexdigest()]
            return pa.RecordBatch.from_pylist(
                [dict(zip(names, values, strict=True))], schema=pa.schema(fields)
            )

        names = [*NODE, "ends_sha256"]
        fields = [*[(name, pa.int64()) for name in NODE], ("ends_sha256", pa.string())]
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in (*NODE, "ids")]
            for *here, ids in zip(*columns, strict=True):
                if here != node:
                    if node is not None:
                        yield row()
                    node, digest = here, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
        if node is not None:
            yield row()

    one_chunk = Window.partitionBy(*NODE)
    counted = stored(texts.withColumn("chunks", F.count(F.lit(1)).over(one_chunk)), "end_texts")
    # A list of one text, as almost all are, is hashed where it is.
    short = counted.filter("chunks = 1").select(*NODE, F.sha2("ids", 256).alias("ends_sha256"))
    long = (
        counted.filter("chunks > 1")
        .select(*NODE, "chunk", "ids")
        .repartition(*NODE)
        .sortWithinPartitions(*NODE, "chunk")
        .mapInArrow(hashed, "depth long, x1 long, x2 long, ends_sha256 string")
    )
    return short.unionByName(long)


def prefixes(found: DataFrame, turns: DataFrame) -> DataFrame:
    """All prefixes of the distinct sequences: node, parent, last turn's bytes, bytes before it,
    and the sequence's conv_id, weight, total and whole depth."""
    info = found.select(
        "conv_id", "weight", "total", F.col("depth").alias("whole_depth")
    )
    rows = turns.join(info, "conv_id")
    block = ["conv_id", "block"]
    rows = rows.withColumn("block", F.floor(F.col("place") / BLOCK))
    sums = rows.groupBy(*block).agg(
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("bytes").alias("bytes")
    )
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    zero = F.lit(0).cast("long")
    offsets = sums.select(
        *block,
        F.coalesce(F.bit_xor("a").over(earlier), zero).alias("a0"),
        F.coalesce(F.bit_xor("b").over(earlier), zero).alias("b0"),
        F.coalesce(F.sum("bytes").over(earlier), zero).alias("bytes0"),
    )
    inside = Window.partitionBy(*block).orderBy("place")
    inner = rows.select(
        *block,
        "place",
        "a",
        "b",
        "bytes",
        "weight",
        "total",
        "whole_depth",
        F.bit_xor("a").over(inside).alias("xa"),
        F.bit_xor("b").over(inside).alias("xb"),
        F.sum("bytes").over(inside).alias("through"),
    )
    x1 = F.col("xa").bitwiseXOR(F.col("a0"))
    x2 = F.col("xb").bitwiseXOR(F.col("b0"))
    kept = ["conv_id", "weight", "total", "whole_depth"]
    deeper = inner.join(offsets, block).select(
        F.col("place").alias("depth"),
        x1.alias("x1"),
        x2.alias("x2"),
        x1.bitwiseXOR(F.col("a")).alias("px1"),
        x2.bitwiseXOR(F.col("b")).alias("px2"),
        "bytes",
        (F.col("through") + F.col("bytes0") - F.col("bytes")).alias("before"),
        *kept,
    )
    none = ["x1", "x2", "px1", "px2", "bytes", "before"]
    root = info.select(zero.alias("depth"), *[zero.alias(name) for name in none], *kept)
    return stored(deeper.unionByName(root), "prefixes")


def trie(turns: DataFrame) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``, as the module describes."""
    convs, rows = rebuilt(turns)
    found, ends = sequences(convs, rows)
    lines = prefixes(found, rows)

    inner = lines.filter(F.col("depth") < F.col("whole_depth")).select(*NODE).distinct()
    leaves = found.join(inner, NODE, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    weight, total = F.col("weight"), F.col("total")
    nodes = stored(
        lines.join(leaves, "conv_id", "left")
        .groupBy(*NODE)
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.sum("weight").alias("n_convs"),
            F.sum(weight * total).alias("member_bytes"),
            F.count("leaf").alias("n_leaves"),
            # The same in all rows of a node.
            *[F.first(name).alias(name) for name in ("px1", "px2", "bytes", "before")],
        ),
        "nodes",
    )
    owners = stored(
        nodes.groupBy("conv_id").agg(
            F.sum("bytes").alias("owned"), F.min_by("before", "depth").alias("owned_from")
        ),
        "owners",
    )
    below = (
        lines.select(*NODE, "conv_id")
        .join(owners.select("conv_id", "owned"), "conv_id")
        .groupBy(*NODE)
        .agg(F.sum("owned").alias("owned"))
    )
    children = (
        nodes.filter("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("px1").alias("x1"), F.col("px2").alias("x2"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("x1").alias("px1"),
        F.col("x2").alias("px2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    above = F.col("before") - F.col("owned_from")
    saved = (F.col("member_bytes") - F.col("n_convs") * F.col("before")) - (F.col("owned") - above)
    return (
        nodes.join(parents, ["depth", "px1", "px2"], "left")
        .join(below, NODE)
        .join(children, NODE, "left")
        .join(end_hashes(ends), NODE, "left")
        .join(owners.select("conv_id", "owned_from"), "conv_id")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
            "n_leaves",
            saved.alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
