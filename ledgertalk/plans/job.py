"""Whole runs: transactions to chat data, chat data checks, training input, report tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertalk.config import Recipe
from ledgertalk.functions.text import messages_json, tokens_by_chars
from ledgertalk.operators import clean, examples, quality, report, trainprep
from ledgertalk.plans.stages import Kept, all_examples
from ledgertalk.sources.scratch import packed, stored
from ledgertalk.sources.sinks import write_csv, write_lines, write_parquet
from ledgertalk.sources.tables import (
    read_chat_jsonl,
    read_csv_parts,
    read_numbered_lines,
    read_transactions,
    require_columns,
)

# Rows of each split that go to training, unless the command says otherwise.
SUBSET = {"train": 60000, "validation": 5000}


def build(
    spark: SparkSession,
    source: str,
    target: str,
    recipe: Recipe,
    files: int | None = None,
    parsed: Callable[[], None] | None = None,
) -> DataFrame:
    """Raw CSV to line items, JSONL and statistics under ``target``; returns the examples.

    The raw text is parsed once. Every output is derived from stored tables, so all of
    them describe the same examples. ``files`` is the number of JSONL files per split; without
    it their bytes decide. ``parsed`` is called when ``source`` is not needed any more.
    """
    txn = clean.normalize(read_transactions(spark, source), recipe.profile)
    kept = Kept(txn, recipe.profile, f"{target}/clean_purchases_parquet")
    kept.read()
    if parsed is not None:
        parsed()
    kept.settle()
    products = kept.ranked_products(recipe)
    rows = report.with_split(all_examples(kept, recipe, products), recipe)
    rows = examples.require_some(packed(rows, "examples"))
    kept.drop("baskets")

    for split in ("train", "eval"):
        write_lines(rows.filter(F.col("split") == split), f"{target}/{split}_jsonl", files=files)
    if recipe.profile == "s":
        _write_eda(kept, rows, products, recipe, target)
    else:
        _write_stats(kept, rows, products, target)
    return rows


def _write_stats(kept: Kept, rows: DataFrame, products: DataFrame, target: str) -> None:
    stats = f"{target}/stats"
    write_parquet(rows.select("example_type", "json"), f"{target}/examples_with_type_parquet")
    write_csv(report.split_counts(rows), f"{stats}/split_counts_csv")
    lengths = report.token_lengths(rows, "n").select("example_type", "approx_tokens")
    write_csv(lengths, f"{stats}/token_lengths_csv", files=None)
    write_csv(
        report.country_counts(kept.lines),
        f"{stats}/country_counts_csv",
        order=[F.desc("line_count"), "Country"],
    )
    write_csv(products, f"{stats}/product_stats_csv", order=[F.desc("order_count"), "StockCode"])
    write_csv(kept.counts.unionByName(report.example_counts(rows)), f"{stats}/summary_csv")


def _write_eda(
    kept: Kept, rows: DataFrame, products: DataFrame, recipe: Recipe, target: str
) -> None:
    eda = f"{target}/eda"
    lengths = report.token_lengths(rows, "s")
    write_csv(
        report.split_counts(rows), f"{eda}/example_type_by_split", order=["split", "example_type"]
    )
    write_csv(report.token_summary(lengths), f"{eda}/token_length_summary", order=["split"])
    write_csv(
        report.token_hist(lengths), f"{eda}/token_length_histogram", order=["split", "token_bucket"]
    )
    write_csv(kept.counts, f"{eda}/cleaning_summary")
    write_csv(
        report.top_products(products),
        f"{eda}/top_products",
        order=[F.desc("order_count"), "StockCode"],
    )
    write_lines(report.preview(rows, recipe), f"{target}/samples/sample_jsonl")


def checked(spark: SparkSession, path: str, max_check: int | None = None) -> DataFrame:
    """Every checked line of a JSONL file or folder with its file and number; ``max_check``
    lines of each file at most."""
    return quality.checked_files(read_numbered_lines(spark, path), max_check)


def validate(spark: SparkSession, path: str, max_check: int | None = None) -> DataFrame:
    """Lines per check result of a JSONL file or folder."""
    return quality.fault_counts(checked(spark, path, max_check))


def compare(spark: SparkSession, base: str, tuned: str, target: str) -> None:
    """Two CSV tables of replies, ``prompt, base_response`` and ``prompt, fine_tuned_response``,
    side by side. Replies may hold line breaks."""

    def replies(path: str, name: str) -> DataFrame:
        found = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True)
        return require_columns(found, ("prompt", name)).select("prompt", name)

    both = trainprep.compare_responses(
        replies(base, "base_response"), replies(tuned, "fine_tuned_response")
    )
    write_csv(both, target, files=None)


def losses(spark: SparkSession, log: str, target: str) -> None:
    """The loss curve of a training log in CSV: ``step, loss`` of the steps that have one."""
    found = require_columns(spark.read.csv(log, header=True), ("step",))
    types = {"step": "bigint", "loss": "double"}
    found = found.withColumns(
        {name: F.col(name).try_cast(types[name]) for name in types if name in found.columns}
    )
    write_csv(report.loss_curve(found), target, order=["step"])


def prepare(
    spark: SparkSession,
    train: str,
    validation: str,
    target: str,
    max_tokens: int,
    seed: int,
    sizes: Mapping[str, int] = SUBSET,
) -> None:
    """JSONL splits to model text, generation prompts, length flags and a packing plan.

    ``example_id`` is the hash of the messages and the line's number among equal lines.
    """
    rows = read_chat_jsonl(spark, {"train": train, "validation": validation})
    # Equal lines are counted and numbered again, so that no task holds all of them.
    counted = rows.groupBy("split", "messages").agg(F.count(F.lit(1)).alias("times"))
    rows = counted.select(
        "split",
        "messages",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))).alias("nth"),
    ).withColumn("example_id", F.concat_ws("-", F.md5(messages_json()), "nth"))
    chosen = trainprep.subset(rows, ["example_id"], sizes, seed).drop("nth")
    chosen = stored(chosen, "chosen")
    prompts = trainprep.model_prompt(chosen).select("split", "example_id", "prompt")
    write_parquet(prompts, f"{target}/model_prompt_parquet")
    text = trainprep.model_text(chosen)
    sized = text.withColumn("approx_tokens", tokens_by_chars(F.col("text")))
    ready = stored(
        trainprep.flag_overflow(sized, max_tokens).select(
            "split", "example_id", "text", "approx_tokens", "overflows"
        ),
        "model_text",
        f"{target}/model_text_parquet",
    )
    plan = trainprep.pack(ready.filter("split = 'train'"), "example_id", max_tokens, seed=seed)
    write_parquet(plan, f"{target}/packing_parquet")


def figures_s(spark: SparkSession, eda: str, target: str) -> None:
    """Report tables from the ``eda`` folders of a run in profile s."""
    counts = read_csv_parts(
        spark, f"{eda}/example_type_by_split", "split string, example_type string, count bigint"
    )
    buckets = read_csv_parts(
        spark, f"{eda}/token_length_histogram", "split string, token_bucket string, count bigint"
    )
    products = read_csv_parts(
        spark,
        f"{eda}/top_products",
        "StockCode string, ProductName string, order_count bigint, units_sold bigint, avg_price double",
    )
    write_csv(report.split_pivot(counts), f"{target}/split_pivot", order=["example_type"])
    both = report.split_pivot(buckets.withColumnRenamed("token_bucket", "example_type"))
    write_csv(
        both.withColumnRenamed("example_type", "token_bucket"),
        f"{target}/token_buckets",
        order=["token_bucket"],
    )
    write_csv(
        products.orderBy(F.desc("order_count"), "StockCode").limit(15),
        f"{target}/top15_products",
        order=[F.desc("order_count"), "StockCode"],
    )


def figures(spark: SparkSession, stats: str, target: str) -> None:
    """Report tables from the statistics folders of a run in profile n."""
    counts = read_csv_parts(
        spark, f"{stats}/split_counts_csv", "split string, example_type string, count bigint"
    )
    lengths = read_csv_parts(
        spark, f"{stats}/token_lengths_csv", "example_type string, approx_tokens int"
    )
    countries = read_csv_parts(
        spark, f"{stats}/country_counts_csv", "Country string, line_count bigint"
    )
    products = read_csv_parts(
        spark,
        f"{stats}/product_stats_csv",
        "StockCode string, ProductName string, order_count bigint, units_sold bigint, "
        "avg_price double, country_count bigint",
    )
    write_csv(report.split_pivot(counts), f"{target}/split_pivot", order=["example_type"])
    write_csv(report.token_describe(lengths), f"{target}/token_describe")
    write_csv(report.token_hist50(lengths), f"{target}/token_hist50", order=["bin"])
    write_csv(
        report.top_countries(countries),
        f"{target}/top_countries",
        order=[F.desc("line_count"), "Country"],
    )
    write_csv(
        products.orderBy(F.desc("order_count"), "StockCode").limit(15),
        f"{target}/top15_products",
        order=[F.desc("order_count"), "StockCode"],
    )
