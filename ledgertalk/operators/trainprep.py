"""From checked chat rows to model input: text, subset, length check, packing, comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgertalk.functions.hashing import order_hash, sample
from ledgertalk.functions.text import header, render_chat, render_prompt, render_turn
from ledgertalk.sources.scratch import stored

# Hex digits of the key hash that cut a shard into slices (16 ** 3 per shard).
SLICE_DIGITS = 3
# Most characters of a conversation in one row, and turn numbers of a block.
PART_CHARS, TURN_BLOCK = 1 << 22, 256
# Hex digits of a reply's hash that cut a prompt's replies into blocks, and equal rows that are
# made anew at once.
REPLY_DIGITS, REPEATS = 2, 1 << 16


def model_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("text", render_chat(F.col("messages")))


def model_prompt(rows: DataFrame) -> DataFrame:
    return rows.withColumn("prompt", render_prompt(F.col("messages")))


def turn_text(turns: DataFrame) -> DataFrame:
    """Every turn as model text, whatever comes before or after it."""
    return turns.select(
        "conv_id", "turn", render_turn(F.col("role"), F.col("text")).alias("text")
    )


def turn_prompt(turns: DataFrame) -> DataFrame:
    """Every question, answered or not, with an open assistant header behind it."""
    asked = render_turn(F.col("role"), F.col("text"))
    return turns.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.concat(asked, header(F.lit("assistant"))).alias("prompt")
    )


def conversation_text(turns: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """``conv_id, part, start, text``: all turns of a conversation as one model text.

    A conversation of at most ``part_chars`` characters is one row, part 0. A longer one is cut
    between turns: part ``k`` begins with the first turn that starts at or behind character
    ``k * part_chars``, so a row holds less than that and one turn; a stretch in which no turn
    starts has no row. ``start`` is the part's place in the whole text.

    Turns come in order, null first, equal ones by their text. Their places are running sums
    inside blocks of turn numbers and over the blocks' totals, so no conversation is gathered
    before its parts are known to be small.
    """
    pieces = turns.select(
        "conv_id",
        "turn",
        F.floor(F.col("turn") / TURN_BLOCK).alias("block"),
        render_turn(F.col("role"), F.col("text")).alias("piece"),
    ).withColumn("chars", F.length("piece").cast("long"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    blocks = pieces.groupBy("conv_id", "block").agg(F.sum("chars").alias("total"))
    blocks = blocks.select(
        F.col("conv_id").alias("conv"),
        F.col("block").alias("of_block"),
        F.coalesce(F.sum("total").over(earlier), F.lit(0).cast("long")).alias("before"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "piece")
    same = F.col("conv_id").eqNullSafe(F.col("conv")) & F.col("block").eqNullSafe(F.col("of_block"))
    upto = F.sum("chars").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = pieces.withColumn("upto", upto).join(blocks, same)
    start = F.col("before") + F.col("upto") - F.col("chars")
    return (
        placed.select("conv_id", start.alias("start"), "piece")
        .groupBy("conv_id", F.floor(F.col("start") / part_chars).alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct("start", "piece"))).alias("pieces"))
        .select(
            "conv_id",
            "part",
            F.col("pieces")[0]["start"].alias("start"),
            F.array_join("pieces.piece", "").alias("text"),
        )
    )


def subset(rows: DataFrame, keys: Sequence[str], sizes: Mapping[str, int], seed: int) -> DataFrame:
    """``min(n, size)`` rows of each split, by key hash. One bounded top-n per split: a
    window over a split would sort the whole split in one task."""
    parts = [
        sample(rows.filter(F.col("split") == split), keys, n, seed) for split, n in sizes.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def flag_overflow(rows: DataFrame, max_tokens: int = 1024) -> DataFrame:
    return rows.withColumn("overflows", F.col("approx_tokens") > max_tokens)


def pack(
    rows: DataFrame, key: str, length: int = 1024, shards: int = 4, seed: int = 42
) -> DataFrame:
    """Packing plan: rows of a shard in hash order, laid end to end, cut every ``length`` tokens.

    The running total over a shard is built from slices of its hash range: slice totals
    (a small table) give each slice its offset, and the running total inside a slice is
    a window of its own. So the work spreads over ``shards * 16 ** SLICE_DIGITS`` groups
    of even size instead of one per shard. ``key`` must be unique.
    """
    digest = F.col("digest")
    placed = rows.select(
        key, F.col("approx_tokens"), order_hash([key], seed).alias("digest")
    ).select(
        key,
        "approx_tokens",
        "digest",
        (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % shards)
        .cast("int")
        .alias("shard"),
        F.substring(digest, 1, SLICE_DIGITS).alias("slice"),
    )
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "slice")
        .agg(F.sum("approx_tokens").alias("slice_tokens"))
        .select(
            "shard",
            "slice",
            F.coalesce(F.sum("slice_tokens").over(before), F.lit(0)).alias("offset"),
        )
    )
    inside = Window.partitionBy("shard", "slice").orderBy("digest", key)
    end = F.col("offset") + F.sum("approx_tokens").over(inside)
    laid = placed.join(offsets, ["shard", "slice"]).withColumn("end", end)
    first_pack = F.floor(F.col("start") / length)
    return laid.withColumn("start", F.col("end") - F.col("approx_tokens")).select(
        key,
        "approx_tokens",
        "shard",
        "start",
        first_pack.alias("pack_id"),
        (F.floor((F.col("end") - 1) / length) > first_pack).alias("spills"),
    )


def _numbered(rows: DataFrame, on: Sequence[str], reply: str) -> DataFrame:
    """The rows with ``nth``, their number from 1 among those of equal ``on``, by the hash of
    their replies. Rows of one prompt are numbered in blocks of that hash and the blocks' totals
    give the offsets, so a prompt with a third of all rows is many small windows; equal rows are
    counted, and made anew by number."""
    digest = F.md5(F.coalesce(F.col(reply), F.lit("")))
    counts = (
        rows.dropna(subset=list(on))
        .groupBy(*rows.columns)
        .agg(F.count(F.lit(1)).alias("times"))
        .withColumn("digest", digest)
        .withColumn("block", F.substring("digest", 1, REPLY_DIGITS))
    )
    counts = stored(counts, "replies")
    blocks = counts.groupBy(*on, "block").agg(F.sum("times").alias("total"))
    # At most 16 ** REPLY_DIGITS rows of a prompt.
    offset = F.sum("total").over(Window.partitionBy(*on).orderBy("block")) - F.col("total")
    blocks = blocks.select(*on, "block", offset.alias("offset"))
    inside = Window.partitionBy(*on, "block").orderBy("digest", *rows.columns)
    before = F.sum("times").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("times")
    placed = counts.withColumn("before", before).join(blocks, [*on, "block"])
    placed = placed.withColumn("first", F.col("offset") + F.col("before"))
    # In two steps, so that no row holds all numbers of very many equal rows.
    steps = F.sequence(F.lit(0).cast("long"), F.expr(f"(times - 1) div {REPEATS}"))
    placed = placed.withColumn("step", F.explode(steps))
    begins = F.col("step") * REPEATS
    last = F.least(begins + REPEATS, F.col("times"))
    numbers = F.sequence(F.col("first") + begins + 1, F.col("first") + last)
    return placed.select(*rows.columns, F.explode(numbers).alias("nth"))


def compare_responses(base: DataFrame, tuned: DataFrame, on: Sequence[str] = ("prompt",)) -> DataFrame:
    """Base and tuned replies to the same prompt side by side. Where a prompt repeats, the
    first reply of one side meets the first of the other, in the order of their texts' hashes;
    replies without a counterpart, or without a prompt, are left out."""
    shared = [name for name in ("prompt",) if name in tuned.columns and name not in on]
    before, after = F.col("base_response"), F.col("fine_tuned_response")
    paired = _numbered(base, on, "base_response").join(
        _numbered(tuned.drop(*shared), on, "fine_tuned_response"), [*on, "nth"]
    )
    return paired.select(
        *[name for name in base.columns if name != "base_response"],
        "base_response",
        "fine_tuned_response",
        F.length(before).alias("base_chars"),
        F.length(after).alias("fine_tuned_chars"),
        (before == after).alias("same_text"),
    )
