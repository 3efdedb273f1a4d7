"""Checks of chat JSONL lines and of raw conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgertalk.sources.scratch import stored

# The roles of an example, in order.
ROLES = ("system", "user", "assistant")


def first_fault(line: Column) -> Column:
    """Name of the first rule a line breaks, NULL for a sound line.

    The line is parsed once into a variant, which keeps JSON types apart: a number
    as content is a fault, not text. It must be the one element of a list and the one
    member of an object alike: text after the line's object cannot close both brackets
    and braces, so it is a fault too.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"line":'), line, F.lit("}")))
    elements = F.try_variant_get(listed, "$", "array<variant>")
    members = F.map_keys(F.try_variant_get(named, "$", "map<string, variant>"))
    alone = (F.size(elements) == 1) & (members == F.array(F.lit("line")))
    one = F.when(alone, elements[0])
    messages = F.try_variant_get(one, "$.messages", "array<variant>")
    roles = F.transform(messages, lambda m: F.try_variant_get(m, "$.role", "string"))

    def has_text(message: Column) -> Column:
        content = F.try_variant_get(message, "$.content", "variant")
        return F.coalesce(
            (F.schema_of_variant(content) == "STRING")
            & (F.length(F.try_variant_get(message, "$.content", "string")) > 0),
            F.lit(False),
        )

    expected = F.array(*[F.lit(role) for role in ROLES])
    return (
        F.when(one.isNull(), "not_json")
        .when(messages.isNull(), "no_message_list")
        .when(F.size(messages) != len(ROLES), "message_count")
        .when(~roles.eqNullSafe(expected), "role_order")
        .when(~F.forall(messages, has_text), "empty_content")
    )


def checked_lines(lines: DataFrame, column: str = "line", max_check: int | None = None) -> DataFrame:
    """Adds ``fault``; blank lines are skipped, ``max_check`` stops after so many lines."""
    kept = lines.filter(F.col(column).rlike(r"\S"))
    if max_check is not None:
        kept = kept.limit(max_check)
    return kept.withColumn("fault", first_fault(F.col(column)))


def checked_files(lines: DataFrame, max_check: int | None = None) -> DataFrame:
    """``file, line_no, line, fault`` of every line that is not blank; ``line`` is kept of
    faulty ones. ``max_check`` stops in each file after so many lines.

    ``lines`` are those of ``tables.read_numbered_lines``: a row knows its file, the block of
    it that one task read, and a number that grows by one along the block. Totals of blocks
    give each block its place in the file, so no file is read in one task. Where ``max_check``
    ends inside a block, the lines of that one block are ranked.
    """
    blank = ~F.col("value").rlike(r"\S")
    seen = stored(
        lines.select(
            "file",
            "block",
            "row",
            blank.alias("blank"),
            F.when(~blank, first_fault(F.col("value"))).alias("fault"),
            "value",
        ).withColumn("value", F.when(F.col("fault").isNotNull(), F.col("value"))),
        "checked_lines",
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    blocks = seen.groupBy("file", "block").agg(
        F.min("row").alias("first"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col("blank")).alias("checks"),
    )
    zero = F.lit(0).cast("long")
    blocks = stored(
        blocks.select(
            "file",
            "block",
            "first",
            "checks",
            F.coalesce(F.sum("n").over(earlier), zero).alias("lines_before"),
            F.coalesce(F.sum("checks").over(earlier), zero).alias("checks_before"),
        ),
        "blocks",
    )
    placed = seen.filter(~F.col("blank")).join(blocks, ["file", "block"])
    if max_check is not None:
        room = F.lit(max_check) - F.col("checks_before")
        whole = placed.filter(F.col("checks") <= room)
        nth = F.row_number().over(Window.partitionBy("file", "block").orderBy("row"))
        cut = placed.filter((room > 0) & (F.col("checks") > room)).withColumn("nth", nth)
        placed = whole.unionByName(cut.filter(F.col("nth") <= room).drop("nth"))
    number = F.col("lines_before") + F.col("row") - F.col("first") + 1
    return placed.select("file", number.alias("line_no"), F.col("value").alias("line"), "fault")


def violations(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("fault").isNotNull())


def fault_counts(checked: DataFrame) -> DataFrame:
    return checked.groupBy(F.coalesce("fault", F.lit("ok")).alias("result")).agg(
        F.count(F.lit(1)).alias("line_count")
    )


def conversation_checks(turns: DataFrame) -> DataFrame:
    """Role and content rules for conversations of any length.

    Turns are numbered from 0; after an optional system turn, user and assistant
    alternate. Only counts are aggregated, so no conversation is sorted or gathered.
    """
    role, turn = F.col("role"), F.col("turn")
    even = turn % 2 == 0
    counted = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("turn_count"),
        F.countDistinct("turn").alias("numbers"),
        F.min("turn").alias("first"),
        F.max("turn").alias("last"),
        F.count_if(role == "system").alias("system_turns"),
        F.count_if((role == "system") & (turn == 0)).alias("opening_turns"),
        F.count_if((role == "user") & even).alias("user_even"),
        F.count_if((role == "user") & ~even).alias("user_odd"),
        F.count_if((role == "assistant") & even).alias("reply_even"),
        F.count_if((role == "assistant") & ~even).alias("reply_odd"),
        F.count_if(F.length("text") > 0).alias("with_text"),
    )
    n = F.col("turn_count")
    opened = (
        (F.col("opening_turns") == 1)
        & (F.col("system_turns") == 1)
        & (F.col("user_odd") + F.col("reply_even") == n - 1)
    )
    plain = (F.col("system_turns") == 0) & (F.col("user_even") + F.col("reply_odd") == n)
    return counted.select(
        "conv_id",
        "turn_count",
        (F.col("system_turns") > 0).alias("has_system"),
        ((F.col("first") == 0) & (F.col("last") == n - 1) & (F.col("numbers") == n)).alias(
            "numbered"
        ),
        (opened | plain).alias("roles_ok"),
        (F.col("with_text") == n).alias("content_ok"),
    )
