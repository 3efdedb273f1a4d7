"""Inputs derived from the parquet tables of a scale-factor directory.

Everything here is a projection or an equi-join of whole tables; nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertalk.functions.text import chat, tokens_by_chars
from ledgertalk.sources.scratch import rounds


# Column types of the tables read here, so that no footer is read to plan a query.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def transactions(
    spark: SparkSession, sf_dir: str, chosen: Callable[..., Column] | None = None
) -> DataFrame:
    """Raw transaction feed: returns, missing and too-short descriptions, competing
    names, zero and negative prices, NULL customers and exact duplicates.

    The dimension joins run on the order and line sides before the two meet, so the
    large line table is shuffled for its joins only once per key. What depends on the line
    alone is computed before them: a shuffled line is five numbers, then five and a name.
    ``chosen``, a condition on the order's key, makes the feed of a part of the orders.
    """
    line, order = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    if chosen is not None:
        line, order = line.filter(chosen("l_orderkey")), order.filter(chosen("o_orderkey"))
    orders = (
        order.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_custkey", "o_orderdate", "n_name")
    )
    cancelled = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") >= 6)
    supplier = F.col("l_suppkey") % 50
    quantity = (
        F.when(cancelled, -F.col("l_quantity"))
        .when(supplier == 0, 0)
        .when(supplier == 1, F.lit(None))
        .otherwise(F.col("l_quantity"))
    )
    conditions = {
        "cancelled": cancelled,
        "spaced": F.col("l_linenumber") % 5 == 0,
        "repeated": (F.col("l_orderkey") % 20 == 0) & (F.col("l_linenumber") == 1),
        "free": supplier == 2,
        "negative": supplier == 3,
    }
    # One number for all conditions, a bit each; an unknown one does not hold.
    marks = sum(F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions.values()))

    def marked(name: str) -> Column:
        return F.col("marks").bitwiseAND(1 << list(conditions).index(name)) != 0

    price = (
        F.when(marked("free"), 0.0)
        .when(marked("negative"), -F.col("p_retailprice"))
        .otherwise(F.col("p_retailprice") * (1 - F.col("l_discount")))
    )
    lines = (
        line.select(
            "l_orderkey",
            "l_partkey",
            "l_discount",
            quantity.cast("int").alias("quantity"),
            marks.alias("marks"),
        )
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select("l_orderkey", "l_partkey", "p_name", "quantity", price.alias("price"), "marks")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    code = F.col("l_partkey").cast("string")
    description = (
        F.when(F.col("l_partkey") % 97 == 0, F.lit(None).cast("string"))
        .when(F.col("l_partkey") % 89 == 0, "??")
        .when(
            marked("spaced"),
            F.concat(F.lit("  "), "p_name", F.lit(" "), code, F.lit(" ")),
        )
        .otherwise(F.concat(F.upper("p_name"), F.lit(" "), code))
    )
    return lines.select(
        F.concat(
            F.when(marked("cancelled"), "C").otherwise(""), F.col("l_orderkey").cast("string")
        ).alias("InvoiceNo"),
        code.alias("StockCode"),
        description.alias("Description"),
        F.col("quantity").alias("Quantity"),
        F.col("o_orderdate").cast("string").alias("InvoiceDate"),
        F.col("price").alias("UnitPrice"),
        F.when(F.col("o_custkey") % 10 == 0, F.lit(None))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("CustomerID"),
        F.col("n_name").alias("Country"),
        # One scan emits the repeated rows too; a union would run the joins twice.
        F.explode(
            F.when(marked("repeated"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        ).alias("copy"),
    ).drop("copy")


def transactions_in_rounds(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """``transactions`` of all orders, in parts to be written one after another."""
    for chosen in rounds(table(spark, sf_dir, "lineitem")):
        yield transactions(spark, sf_dir, chosen)


def exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn with the assistant turn right after it, as chat messages.

    Keyed by (conv_id, turn), so a conversation that holds a large share of all turns
    still spreads over tasks; no conversation is gathered whole. Conversations without a
    system turn give two messages.
    """
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("question")
    )
    answered = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    opening = turns.filter((F.col("role") == "system") & (F.col("turn") == 0)).select(
        "conv_id", F.col("text").alias("system")
    )
    pair = chat(user=F.col("question"), assistant=F.col("answer"))
    whole = chat(system=F.col("system"), user=F.col("question"), assistant=F.col("answer"))
    return (
        asked.join(answered, ["conv_id", "turn"])
        .join(opening, "conv_id", "left")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("system").isNull(), pair).otherwise(whole).alias("messages"),
        )
    )


def damaged_jsonl(exchange_rows: DataFrame) -> DataFrame:
    """``conv_id, turn, line``: chat JSONL in which known kinds of damage occur."""
    line = F.to_json(F.struct("messages"))
    kind = F.col("conv_id") % 7
    blank = F.transform(
        "messages",
        lambda m: F.struct(
            m["role"].alias("role"),
            F.when(m["role"] == "user", "").otherwise(m["content"]).alias("content"),
        ),
    )
    return exchange_rows.select(
        "conv_id",
        "turn",
        F.when(kind == 1, F.substring(line, F.lit(1), F.length(line) - 3))
        .when(kind == 2, '{"x":1}')
        .when(kind == 3, '{"messages":"none"}')
        .when(kind == 4, F.to_json(F.struct(F.reverse("messages").alias("messages"))))
        .when(kind == 5, F.to_json(F.struct(blank.alias("messages"))))
        .otherwise(line)
        .alias("line"),
    )


def model_responses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two response tables: the first and the last assistant turn of every conversation, to a
    prompt that is the first word of its first question and that many share."""
    turns = table(spark, sf_dir, "conversations")

    def reply(pick, name: str) -> DataFrame:
        asked = F.when(F.col("role") == "user", F.col("turn"))
        said = F.when(F.col("role") == "assistant", F.col("turn"))
        return (
            turns.groupBy("conv_id")
            .agg(F.min_by("text", asked).alias("question"), pick("text", said).alias(name))
            .filter(F.col("question").isNotNull() & F.col(name).isNotNull())
            .select(F.substring_index("question", " ", 1).alias("prompt"), name)
        )

    return reply(F.min_by, "base_response"), reply(F.max_by, "fine_tuned_response")


def training_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``step, loss`` where only some steps logged a loss."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("step"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("loss"),
    )


def document_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, approx_tokens`` over whole texts."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", tokens_by_chars(F.col("text")).alias("approx_tokens")
    )


# Files of ``damaged_files``.
DAMAGED_FILES = 4


def damaged_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The damaged lines, some blank, in files by conversation, each in order of its turns."""
    lines = damaged_jsonl(exchanges(spark, sf_dir))
    shard = F.col("conv_id") % DAMAGED_FILES
    text = F.when(F.col("turn") % 3 == 2, "").otherwise(F.col("line"))
    lines.select(shard.alias("shard"), "conv_id", "turn", text.alias("value")).repartition(
        DAMAGED_FILES, "shard"
    ).sortWithinPartitions("shard", "conv_id", "turn").select("shard", "value").write.partitionBy(
        "shard"
    ).text(path)
