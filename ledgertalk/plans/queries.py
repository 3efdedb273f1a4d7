"""Every operator as a query over the tables of a scale-factor directory.

Results are flat: arrays come back as joined text, messages as JSON.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertalk.config import Recipe
from ledgertalk.functions.text import messages_json
from ledgertalk.operators import baskets as bk
from ledgertalk.operators import catalog, clean, examples, orders, quality, report, trainprep
from ledgertalk.plans import job
from ledgertalk.plans.stages import Kept, all_examples
from ledgertalk.session import tuned
from ledgertalk.sources import testdata, tables
from ledgertalk.sources.scratch import (
    ROUNDS,
    Shelf,
    discard,
    in_rounds,
    rounds,
    scratch_path,
    shuffles_discarded,
    stored,
)
from ledgertalk.sources.sinks import write_lines

# Run size of the queries: at sf0.01 there are 1,957 products, so that both cuts bite. No test
# basket has more than 13 products, so the cap is 8.
SIZES = dict(
    max_products=1000, max_orders=10000, max_recs=1000, max_cancellations=2000, basket_cap=8
)
RECIPES = {profile: Recipe.for_profile(profile, **SIZES) for profile in ("n", "s")}
SUBSET_SIZES = {"train": 400, "eval": 60}
PACK_LENGTH = 1024
PACK_SHARDS = 4


class Feed(Shelf):
    """Stages over one input directory, each built at most once per query.

    ``txn``, ``purchases`` and ``cancellations`` are lazy. What needs product names starts
    from the stored ``bought`` and ``names``; what needs every stage goes through ``kept``.
    A stored table goes when the next one is made from it, so that disk holds two at a time.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, profile: str = "n"):
        self.spark, self.sf_dir, self.profile = spark, sf_dir, profile
        self.recipe = RECIPES[profile]

    @cached_property
    def txn(self) -> DataFrame:
        return clean.normalize(testdata.transactions(self.spark, self.sf_dir), self.profile)

    @cached_property
    def purchases(self) -> DataFrame:
        # Profile s reads the transactions twice.
        txn = self.kept.txn if self.profile == "s" else self.txn
        return clean.purchases(txn, self.profile)

    @cached_property
    def cancellations(self) -> DataFrame:
        return clean.cancellations(self.txn)

    @cached_property
    def wanted(self) -> DataFrame:
        """Purchase lines with their repeats: stored, the joins' shuffle files are gone before
        those of duplicate removal are written."""
        parts = testdata.transactions_in_rounds(self.spark, self.sf_dir)
        parts = (clean.normalize(part, self.profile) for part in parts)
        return self.keep_in_rounds((part.filter(clean.is_purchase()) for part in parts), "wanted")

    @cached_property
    def bought(self) -> DataFrame:
        # Repeats agree in the key of the rounds.
        parts = in_rounds(self.wanted, "InvoiceNo", "StockCode")
        bought = self.keep_in_rounds(
            (clean.purchases(part, self.profile) for part in parts), "bought"
        )
        self.drop("wanted")
        return bought

    @cached_property
    def names(self) -> DataFrame:
        """Read back from a file, so that its size is known when the join is planned and,
        if it is too large to broadcast, the hot codes of the other side can be split."""
        return self.keep(catalog.product_names(self.bought), "names")

    @cached_property
    def name_ids(self) -> DataFrame:
        return catalog.name_ids(self.names)

    @cached_property
    def lines(self) -> DataFrame:
        return catalog.line_items(self.bought, self.names)

    @cached_property
    def kept(self) -> Kept:
        return Kept(self.txn, self.profile)

    @cached_property
    def baskets(self) -> DataFrame:
        # The names first: the lines they are from go with the baskets made.
        names, parts = self.name_ids, in_rounds(self.bought, "InvoiceNo")
        found = self.keep_in_rounds(
            (bk.baskets(part, self.recipe.basket_cap, names) for part in parts), "baskets"
        )
        self.drop("bought")
        return found

    @cached_property
    def named_baskets(self) -> DataFrame:
        parts, names = in_rounds(self.baskets, "InvoiceNo"), self.names
        found = self.keep_in_rounds(
            (bk.named_baskets(part, names) for part in parts), "named_baskets"
        )
        self.drop("baskets")
        return found

    @cached_property
    def stats(self) -> DataFrame:
        return catalog.product_stats(self.bought, self.names)

    @cached_property
    def kept_stats(self) -> DataFrame:
        return stored(self.stats, "product_stats")

    @cached_property
    def orders(self) -> DataFrame:
        names, bought = self.names, self.bought
        # Twice the rounds: lines and then named items are shuffled.
        parts = in_rounds(bought, *orders.ORDER_KEY, n=2 * ROUNDS)
        found = self.keep_in_rounds(
            (orders.order_base(part, self.recipe, names=names) for part in parts), "orders"
        )
        self.drop("bought", "names")
        return found

    @cached_property
    def recs(self) -> DataFrame:
        baskets, names = self.baskets, self.name_ids
        counts = (
            bk.rec_counts(baskets, start=chosen("src_code")) for chosen in rounds(baskets)
        )
        found = self.keep_in_rounds(
            (bk.top_recs(part, names, self.recipe) for part in counts), "recs"
        )
        self.drop("baskets")
        return found

    @cached_property
    def examples(self) -> DataFrame:
        return all_examples(self.kept, self.recipe)

    @cached_property
    def split_examples(self) -> DataFrame:
        return report.with_split(self.examples, self.recipe)

    @cached_property
    def lengths(self) -> DataFrame:
        return report.token_lengths(self.split_examples, self.profile)


def joined(df: DataFrame, column: str, separator: str) -> DataFrame:
    return df.withColumn(column, F.array_join(column, separator))


def dated(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("string"))


def as_json(df: DataFrame) -> DataFrame:
    return df.select("example_type", messages_json().alias("json"))


def flat_orders(df: DataFrame) -> DataFrame:
    flat = joined(df, "items", "; ")
    return dated(flat, "invoice_date") if "invoice_date" in df.columns else flat


def flat_cancellations(df: DataFrame) -> DataFrame:
    return joined(df, "items", "; ")


def flat_recs(df: DataFrame) -> DataFrame:
    return joined(df, "recs", ", ")


Query = Callable[[SparkSession, str], DataFrame]
StageQuery = Callable[[Feed], DataFrame]


def stage_queries() -> dict[str, StageQuery]:
    """Queries that exist in both profiles."""
    return {
        "normalize_txn": lambda f: dated(f.txn, "InvoiceDate"),
        "purchases": lambda f: dated(f.purchases, "InvoiceDate"),
        "line_items": lambda f: dated(f.lines, "InvoiceDate"),
        "product_stats": lambda f: f.stats,
        "product_ranking": lambda f: catalog.most_ordered(f.kept_stats, f.recipe.max_products),
        "order_base": lambda f: flat_orders(f.orders),
        "order_sample": lambda f: flat_orders(
            orders.order_sample(f.kept.purchases, f.recipe, f.kept.names)
        ),
        "cancellation_base": lambda f: flat_cancellations(
            orders.cancellation_base(f.cancellations, f.recipe)
        ),
        "cancel_sample": lambda f: flat_cancellations(
            orders.cancellation_sample(f.kept.cancellations, f.recipe)
        ),
        "basket_items": lambda f: bk.basket_items(f.baskets, f.names),
        "top_recs": lambda f: flat_recs(f.recs),
        "rec_sample": lambda f: flat_recs(bk.rec_sample(f.baskets, f.name_ids, f.recipe)),
        "ex_product": lambda f: as_json(examples.product_examples(f.stats, f.profile)),
        "ex_order": lambda f: as_json(examples.order_examples(f.orders, f.profile)),
        "ex_rec": lambda f: as_json(examples.rec_examples(f.recs, f.profile)),
        "ex_cancel": lambda f: as_json(
            examples.cancel_examples(
                orders.cancellation_base(f.cancellations, f.recipe), f.profile
            )
        ),
        "sft_examples": lambda f: f.examples,
        "train_eval_split": lambda f: f.split_examples,
        "token_lengths": lambda f: f.lengths.select("example_type", "approx_tokens"),
        "split_counts": lambda f: report.split_counts(f.split_examples),
    }


def n_queries() -> dict[str, StageQuery]:
    return {
        "cancellations": lambda f: f.cancellations,
        "txn_class_counts": lambda f: clean.class_counts(f.txn),
        "description_counts": lambda f: catalog.description_counts(f.purchases),
        "product_names": lambda f: catalog.product_names(f.purchases),
        "basket_sizes": lambda f: bk.basket_sizes(f.purchases),
        "copurchase_pairs": lambda f: bk.copurchase_pairs(f.baskets, f.names),
        "directed_pairs": lambda f: bk.directed_pairs(f.named_baskets),
        "pair_counts": lambda f: bk.pair_counts(bk.rec_counts(f.baskets), f.name_ids),
        "country_counts": lambda f: report.country_counts(f.purchases),
        "top_countries": lambda f: report.top_countries(report.country_counts(f.purchases)),
        "top15_products": lambda f: catalog.most_ordered(f.kept_stats, 15).select(
            "StockCode", "ProductName", "order_count"
        ),
        "cleaning_summary": lambda f: report.summary(
            f.kept.txn, f.kept.purchases, "n", f.split_examples
        ),
        "split_pivot": lambda f: report.split_pivot(report.split_counts(f.split_examples)),
        "token_describe": lambda f: report.token_describe(f.lengths),
        "token_hist50": lambda f: report.token_hist50(f.lengths),
        "csv_roundtrip": csv_roundtrip,
    }


def s_queries() -> dict[str, StageQuery]:
    return {
        "cleaning_summary_s": lambda f: report.summary(f.kept.txn, f.kept.purchases, "s"),
        "token_summary": lambda f: report.token_summary(f.lengths),
        "token_hist": lambda f: report.token_hist(f.lengths),
        "top_products": lambda f: money_as_text(report.top_products(f.stats)),
        "sample_preview": lambda f: report.preview(f.examples, f.recipe),
    }


def money_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_price", F.format_number("avg_price", 2))


def csv_roundtrip(feed: Feed) -> DataFrame:
    """The feed written as CSV text, then read through the transaction reader."""
    raw = tables.read_transactions(feed.spark, raw_csv(feed.spark, feed.sf_dir))
    return clean.normalize(raw, "n")


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat rows split, written as two JSONL folders and read back with their split."""
    rows = testdata.exchanges(spark, sf_dir).select(messages_json().alias("json"))
    rows = stored(report.with_split(rows, RECIPES["n"]), "chat_rows")
    paths = {}
    for split, wanted in (("train", "train"), ("validation", "eval")):
        paths[split] = scratch_path(spark, split)
        write_lines(rows.filter(F.col("split") == wanted), paths[split], files=None)
    return tables.read_chat_jsonl(spark, paths).select("split", messages_json().alias("json"))


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.checked_lines(testdata.damaged_jsonl(testdata.exchanges(spark, sf_dir)))


# Lines of each file that ``sft_max_check`` checks, and characters of a part of
# ``conversation_text``: the longest test conversations have several parts.
MAX_CHECK = 25
PART_CHARS = 4000


def fault_lines(spark: SparkSession, sf_dir: str, max_check: int | None = None) -> DataFrame:
    """The damaged lines written as files, then checked where they are."""
    path = scratch_path(spark, "damaged")
    testdata.damaged_files(spark, sf_dir, path)
    shard = F.regexp_extract("file", r"shard=(\d+)", 1).cast("bigint").alias("shard")
    return job.checked(spark, path, max_check).select(shard, "line_no", "line", "fault")


# Rows of a raw CSV file: compressed, it is read by one task.
RAW_ROWS = 1 << 20


def raw_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "raw_csv")
    for part in testdata.transactions_in_rounds(spark, sf_dir):
        with shuffles_discarded(spark):
            files = part.write.mode("append").option("maxRecordsPerFile", RAW_ROWS)
            files.csv(path, header=True, compression="gzip")
    return path


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw CSV as it is read, before any cleaning; prices as numbers for the comparison."""
    rows = tables.read_transactions(spark, raw_csv(spark, sf_dir))
    return rows.withColumn("UnitPrice", F.col("UnitPrice").cast("double"))


def built(read: Callable[[SparkSession, str], DataFrame], profile: str) -> Query:
    """A whole run from raw CSV into a folder, of which one output is read back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out, raw = scratch_path(spark, "out"), raw_csv(spark, sf_dir)
        # The text goes once it is parsed.
        job.build(spark, raw, out, RECIPES[profile], parsed=lambda: discard(spark, raw))
        return read(spark, out)

    return query


def built_queries() -> dict[str, Query]:
    def jsonl(spark: SparkSession, out: str) -> DataFrame:
        paths = {split: f"{out}/{split}_jsonl" for split in ("train", "eval")}
        return tables.read_chat_jsonl(spark, paths).select("split", messages_json().alias("json"))

    def parquet(name: str) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, out: spark.read.parquet(f"{out}/{name}")

    def csv(name: str, schema: str) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, out: tables.read_csv_parts(spark, f"{out}/{name}", schema)

    counts = "split string, example_type string, count bigint"
    ranking = (
        "StockCode string, ProductName string, order_count bigint, units_sold bigint, "
        "avg_price double, country_count bigint"
    )
    summary = (
        "split string, sample_count bigint, min_tokens int, p25_tokens int, median_tokens int, "
        "p75_tokens int, max_tokens int"
    )
    lengths = "example_type string, approx_tokens int"
    return {
        "built_line_items": built(parquet("clean_purchases_parquet"), "n"),
        "built_typed_examples": built(parquet("examples_with_type_parquet"), "n"),
        "built_jsonl": built(jsonl, "n"),
        "built_split_counts": built(csv("stats/split_counts_csv", counts), "n"),
        "built_token_lengths": built(csv("stats/token_lengths_csv", lengths), "n"),
        "built_ranking": built(csv("stats/product_stats_csv", ranking), "n"),
        "built_jsonl_s": built(jsonl, "s"),
        "built_token_summary_s": built(csv("eda/token_length_summary", summary), "s"),
    }


def document_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    recipe = RECIPES["n"]
    rows = testdata.document_lengths(spark, sf_dir)
    rows = rows.withColumn(
        "split",
        report.train_or_eval(F.col("doc_id").cast("string"), recipe.train_ratio, recipe.seed),
    )
    return trainprep.subset(rows, ["doc_id"], SUBSET_SIZES, recipe.seed)


def other_queries() -> dict[str, Query]:
    return {
        "sft_validate": lambda s, d: quality.fault_counts(checked(s, d)),
        "sft_violations": lambda s, d: quality.violations(checked(s, d)).select(
            "conv_id", "turn", "fault"
        ),
        "sft_fault_lines": lambda s, d: quality.violations(fault_lines(s, d)),
        "sft_max_check": lambda s, d: quality.fault_counts(fault_lines(s, d, MAX_CHECK)),
        "conv_role_check": lambda s, d: quality.conversation_checks(
            testdata.table(s, d, "conversations")
        ),
        "chat_render": lambda s, d: trainprep.model_text(testdata.exchanges(s, d)).select(
            "conv_id", "turn", "text"
        ),
        "chat_prompt": lambda s, d: trainprep.model_prompt(testdata.exchanges(s, d)).select(
            "conv_id", "turn", "prompt"
        ),
        "turn_text": lambda s, d: trainprep.turn_text(testdata.table(s, d, "conversations")),
        "turn_prompt": lambda s, d: trainprep.turn_prompt(testdata.table(s, d, "conversations")),
        "conversation_text": lambda s, d: trainprep.conversation_text(
            testdata.table(s, d, "conversations"), PART_CHARS
        ),
        "jsonl_roundtrip": jsonl_roundtrip,
        "csv_scan": csv_scan,
        "response_compare": lambda s, d: trainprep.compare_responses(
            *testdata.model_responses(s, d)
        ),
        "loss_curve": lambda s, d: report.loss_curve(testdata.training_log(s, d)),
        "train_subset": document_subset,
        "seq_overflow": lambda s, d: trainprep.flag_overflow(
            testdata.document_lengths(s, d), PACK_LENGTH
        ),
        "seq_pack": lambda s, d: trainprep.pack(
            testdata.document_lengths(s, d),
            "doc_id",
            PACK_LENGTH,
            PACK_SHARDS,
            RECIPES["n"].seed,
        ),
    }


def _on_feed(stage: StageQuery, profile: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    # The session is the caller's; what these plans need against hot keys is set on it.
    return stage(Feed(tuned(spark), sf_dir, profile))


def _on_tables(query: Query, spark: SparkSession, sf_dir: str) -> DataFrame:
    return query(tuned(spark), sf_dir)


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name, stage in stage_queries().items():
        found[name] = partial(_on_feed, stage, "n")
        found[f"{name}_s"] = partial(_on_feed, stage, "s")
    for name, stage in n_queries().items():
        found[name] = partial(_on_feed, stage, "n")
    for name, stage in s_queries().items():
        found[name] = partial(_on_feed, stage, "s")
    for name, query in {**other_queries(), **built_queries()}.items():
        found[name] = partial(_on_tables, query)
    return found
