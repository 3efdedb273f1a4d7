"""Report tables: counts, token-length distributions, rankings, previews.

Distributions start from a (value, count) table, which Spark combines before the
shuffle; everything after it is as small as the number of distinct lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgertalk.config import Recipe
from ledgertalk.functions.hashing import sample, train_or_eval
from ledgertalk.sources.scratch import stored
from ledgertalk.functions.text import approx_tokens
from ledgertalk.operators.clean import is_cancellation

# Metric names of the summary table.
CANCELLED_METRIC = {"n": "cancel_or_return_rows", "s": "cancellation_or_invalid_rows"}
# Right-open token buckets.
TOKEN_BUCKETS = (
    (100, "000-099"),
    (200, "100-199"),
    (300, "200-299"),
    (400, "300-399"),
    (600, "400-599"),
)
LAST_BUCKET = "600+"


def rows() -> Column:
    return F.count(F.lit(1))


def with_split(examples: DataFrame, recipe: Recipe) -> DataFrame:
    """The same JSON always falls on the same side, whatever else is in the run."""
    return examples.withColumn(
        "split", train_or_eval(F.col("json"), recipe.train_ratio, recipe.seed)
    )


def token_lengths(examples: DataFrame, profile: str = "n") -> DataFrame:
    kept = [name for name in ("split", "example_type") if name in examples.columns]
    return examples.select(*kept, approx_tokens(profile, F.col("json")).alias("approx_tokens"))


def split_counts(examples: DataFrame) -> DataFrame:
    return examples.groupBy("split", "example_type").agg(rows().alias("count"))


def split_pivot(counts: DataFrame) -> DataFrame:
    return (
        counts.groupBy("example_type").pivot("split", ["eval", "train"]).sum("count").na.fill(0)
    )


def token_summary(lengths: DataFrame) -> DataFrame:
    """Exact quantiles per split: the smallest length that covers the wanted share."""
    upto = Window.partitionBy("split").orderBy("approx_tokens")
    whole = Window.partitionBy("split")
    covered = (
        lengths.groupBy("split", "approx_tokens")
        .agg(rows().alias("n"))
        .withColumn("covered", F.sum("n").over(upto))
        .withColumn("total", F.sum("n").over(whole))
    )

    def quantile(share: float) -> Column:
        return F.min(F.when(F.col("covered") >= F.col("total") * share, F.col("approx_tokens")))

    return covered.groupBy("split").agg(
        F.sum("n").alias("sample_count"),
        F.min("approx_tokens").alias("min_tokens"),
        quantile(0.25).alias("p25_tokens"),
        quantile(0.50).alias("median_tokens"),
        quantile(0.75).alias("p75_tokens"),
        F.max("approx_tokens").alias("max_tokens"),
    )


def token_bucket(tokens: Column) -> Column:
    bucket = F
    for edge, name in TOKEN_BUCKETS:
        bucket = bucket.when(tokens < edge, name)
    return bucket.otherwise(LAST_BUCKET)


def token_hist(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy(
        "split", token_bucket(F.col("approx_tokens")).alias("token_bucket")
    ).agg(rows().alias("count"))


def token_describe(lengths: DataFrame) -> DataFrame:
    """count, mean, sample deviation, extremes and interpolated quartiles.

    Sums are exact integers, so the result does not depend on partitioning.
    """
    tokens, n = F.col("approx_tokens"), F.col("n")
    wide = "decimal(38,0)"

    def quartile(share: float) -> Column:
        return F.percentile(tokens, F.lit(share), n)

    summed = (
        lengths.groupBy("approx_tokens")
        .agg(rows().alias("n"))
        .agg(
            F.sum("n").alias("count"),
            F.sum(tokens * n).alias("total"),
            F.sum(tokens.cast("bigint") * tokens * n).alias("squares"),
            F.min(tokens).alias("min"),
            quartile(0.25).alias("p25"),
            quartile(0.50).alias("p50"),
            quartile(0.75).alias("p75"),
            F.max(tokens).alias("max"),
        )
    )
    count = F.col("count")
    spread = count.cast(wide) * F.col("squares") - F.col("total").cast(wide) * F.col("total")
    variance = spread.cast("double") / (count.cast("double") * (count - 1))
    return summed.select(
        "count",
        (F.col("total") / count).alias("mean"),
        F.when(count > 1, F.sqrt(variance)).alias("std"),
        "min",
        "p25",
        "p50",
        "p75",
        "max",
    )


def token_hist50(lengths: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins are listed.

    The counts are stored once: the bounds and the bins read them.
    """
    counts = stored(lengths.groupBy("approx_tokens").agg(rows().alias("n")), "length_counts")
    low = counts.agg(F.min("approx_tokens")).scalar()
    high = counts.agg(F.max("approx_tokens")).scalar()
    inside = F.least(
        F.floor((F.col("approx_tokens") - F.col("low")) * bins / (F.col("high") - F.col("low"))),
        F.lit(bins - 1),
    )
    place = F.when(F.col("low") == F.col("high"), bins // 2).otherwise(inside)
    counted = (
        counts.select("approx_tokens", "n", low.alias("low"), high.alias("high"))
        .groupBy(place.cast("int").alias("bin"))
        .agg(F.sum("n").alias("count"))
    )
    numbers = lengths.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), low.alias("low"), high.alias("high")
    )
    start = F.col("low") + F.col("bin") * (F.col("high") - F.col("low")) / bins
    return (
        numbers.filter(F.col("low").isNotNull())
        .join(counted, "bin", "left")
        .select("bin", start.alias("bin_start"), F.coalesce("count", F.lit(0)).alias("count"))
    )


def country_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy("Country").agg(rows().alias("line_count"))


def top_countries(counts: DataFrame, n: int = 15) -> DataFrame:
    return counts.orderBy(F.desc("line_count"), "Country").limit(n)


def top_products(ranked: DataFrame, n: int = 25) -> DataFrame:
    """Best-selling products by number of orders, price rounded for print."""
    return (
        ranked.orderBy(F.desc("order_count"), "StockCode")
        .limit(n)
        .select(
            "StockCode",
            "ProductName",
            "order_count",
            "units_sold",
            F.round("avg_price", 2).alias("avg_price"),
        )
    )


def summary(
    txn: DataFrame, bought: DataFrame, profile: str = "n", examples: DataFrame | None = None
) -> DataFrame:
    """``metric, value``: one aggregate per table, no count on the driver."""
    read = txn.agg(
        rows().alias("raw_rows"), F.count_if(is_cancellation()).alias(CANCELLED_METRIC[profile])
    )
    table = _long(read).unionByName(_long(bought.agg(rows().alias("clean_purchase_rows"))))
    return table if examples is None else table.unionByName(example_counts(examples))


def example_counts(examples: DataFrame) -> DataFrame:
    """The part of ``summary`` that counts examples."""
    return _long(
        examples.agg(
            rows().alias("total_sft_examples"),
            F.count_if(F.col("split") == "train").alias("train_examples"),
            F.count_if(F.col("split") == "eval").alias("eval_examples"),
        )
    )


def _long(counts: DataFrame) -> DataFrame:
    return counts.unpivot([], counts.columns, "metric", "value")


def preview(examples: DataFrame, recipe: Recipe, n: int = 20) -> DataFrame:
    return sample(examples.select("json"), ["json"], n, recipe.seed)


def loss_curve(log: DataFrame) -> DataFrame:
    """Logged losses by step; a log without a loss column gives no rows."""
    if "loss" not in log.columns:
        return log.sparkSession.createDataFrame([], "step bigint, loss double")
    return log.dropna(subset=["loss"]).select("step", "loss").orderBy("step")
