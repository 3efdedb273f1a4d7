"""Baskets, co-purchase pairs and recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgertalk.config import Recipe
from ledgertalk.functions.hashing import sample


def basket_sizes(lines: DataFrame) -> DataFrame:
    """Distinct products per invoice; counted in two steps, so a huge invoice spreads."""
    return lines.groupBy("InvoiceNo").agg(F.countDistinct("StockCode").alias("basket_size"))


def baskets(lines: DataFrame, cap: int, names: DataFrame) -> DataFrame:
    """``InvoiceNo, items``: distinct products, sorted by code, of invoices with at most ``cap``.

    An item is ``StockCode, name_id``: names themselves take no part in baskets and pairs.
    Repeated lines are dropped by code before ``names`` (``catalog.name_ids``) are joined.

    ``cap + 1`` products are enough to see that an invoice is over the cap, so each
    task passes on no more than that and no group grows beyond it. An oversized invoice
    is dropped whole and a kept one is complete: the result equals counting first.
    """
    by_code = Window.partitionBy("InvoiceNo").orderBy("StockCode")
    products = lines.select("InvoiceNo", "StockCode").distinct()
    return (
        products.join(names.select("StockCode", "name_id"), "StockCode")
        .withColumn("place", F.row_number().over(by_code))
        .filter(F.col("place") <= cap + 1)
        .groupBy("InvoiceNo")
        .agg(F.sort_array(F.collect_list(F.struct("StockCode", "name_id"))).alias("items"))
        .filter(F.size("items") <= cap)
    )


def named(rows: DataFrame, names: DataFrame, **columns: str) -> DataFrame:
    """Adds the name of each code: ``named(pairs, names, a_name="a_code")``."""
    for name, code in columns.items():
        rows = rows.join(
            names.select(F.col("StockCode").alias(code), F.col("ProductName").alias(name)), code
        )
    return rows


def basket_items(basket_rows: DataFrame, names: DataFrame) -> DataFrame:
    """One row per (invoice, product) of the kept baskets, with the basket's size."""
    items = basket_rows.select(
        "InvoiceNo",
        F.explode("items.StockCode").alias("StockCode"),
        F.size("items").alias("basket_size"),
    )
    return named(items, names, ProductName="StockCode").select(
        "InvoiceNo", "StockCode", "ProductName", "basket_size"
    )


def copurchase_pairs(basket_rows: DataFrame, names: DataFrame) -> DataFrame:
    """Unordered product pairs of each basket, smaller code first.

    Items are sorted, so every later item pairs with an earlier one inside the row:
    no self-join and no shuffle.
    """
    codes = F.col("items.StockCode")
    pairs = basket_rows.select("InvoiceNo", F.posexplode(codes).alias("at", "a_code"), "items")
    pairs = pairs.select(
        "InvoiceNo",
        "a_code",
        F.explode(F.slice(codes, F.col("at") + 2, F.size("items"))).alias("b_code"),
    )
    return named(pairs, names, a_name="a_code", b_name="b_code").select(
        "InvoiceNo", "a_code", "a_name", "b_code", "b_name"
    )


def _both_ways(
    basket_rows: DataFrame, sources: DataFrame | None = None, start: Column | None = None
) -> DataFrame:
    """``InvoiceNo, src_code, other``: each pair in both directions, ``other`` an item.
    ``sources`` (src_code) keeps only pairs that start there, before any pair is formed, and so
    does ``start``, a condition on src_code."""
    starts = basket_rows.filter(F.size("items") > 1).select(
        "InvoiceNo", F.explode("items.StockCode").alias("src_code"), "items"
    )
    if start is not None:
        starts = starts.filter(start)
    if sources is not None:
        starts = starts.join(sources.select("src_code"), "src_code", "left_semi")
    return starts.select("InvoiceNo", "src_code", F.explode("items").alias("other")).filter(
        F.col("other.StockCode") != F.col("src_code")
    )


def named_baskets(basket_rows: DataFrame, names: DataFrame) -> DataFrame:
    """``InvoiceNo, items`` of baskets that have pairs; an item is ``StockCode, ProductName``."""
    items = basket_rows.filter(F.size("items") > 1).select(
        "InvoiceNo", F.explode("items.StockCode").alias("StockCode")
    )
    item = F.struct("StockCode", "ProductName")
    return (
        named(items, names, ProductName="StockCode")
        .groupBy("InvoiceNo")
        .agg(F.collect_list(item).alias("items"))
    )


def directed_pairs(basket_rows: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Each pair in both directions, with names. Names join the items, not their pairs; without
    ``names`` the rows are those of ``named_baskets``."""
    if names is not None:
        basket_rows = named_baskets(basket_rows, names)
    return (
        basket_rows.select("InvoiceNo", F.explode("items").alias("src"), "items")
        .select("InvoiceNo", "src", F.explode("items").alias("other"))
        .filter(F.col("other.StockCode") != F.col("src.StockCode"))
        .select(
            "InvoiceNo",
            F.col("src.StockCode").alias("src_code"),
            F.col("src.ProductName").alias("src_name"),
            F.col("other.ProductName").alias("rec_name"),
        )
    )


def rec_counts(
    basket_rows: DataFrame, sources: DataFrame | None = None, start: Column | None = None
) -> DataFrame:
    """``src_code, name_id, score``: baskets per product and recommended name, counted by the
    name's number. Two codes under one name add up."""
    return (
        _both_ways(basket_rows, sources, start)
        .groupBy("src_code", F.col("other.name_id").alias("name_id"))
        .agg(F.count(F.lit(1)).alias("score"))
    )


def _with_rec_name(counts: DataFrame, names: DataFrame) -> DataFrame:
    texts = names.select("name_id", F.col("ProductName").alias("rec_name")).distinct()
    return counts.join(texts, "name_id").drop("name_id")


def pair_counts(counts: DataFrame, names: DataFrame) -> DataFrame:
    """``rec_counts`` with both names."""
    return named(_with_rec_name(counts, names), names, src_name="src_code").select(
        "src_code", "src_name", "rec_name", "score"
    )


def top_recs(counts: DataFrame, names: DataFrame, recipe: Recipe) -> DataFrame:
    """``src_code, src_name, recs``: best names in rank order, at least two of them.

    Pairs are ranked by the names' numbers, which are in the order of the names; names are
    attached to the ranked ones, a product's own to its one row. Ranks are cut per task before
    the shuffle; the final grouping sees at most ``recs_per_product`` rows per product.
    """
    best = Window.partitionBy("src_code").orderBy(F.desc("score"), F.asc("name_id"))
    placed = counts.withColumn("place", F.row_number().over(best))
    ranked = (
        _with_rec_name(placed.filter(F.col("place") <= recipe.recs_per_product), names)
        .groupBy("src_code")
        .agg(
            F.sort_array(F.collect_list(F.struct("place", "rec_name")))
            .getField("rec_name")
            .alias("recs")
        )
        .filter(F.size("recs") >= 2)
    )
    return named(ranked, names, src_name="src_code").select("src_code", "src_name", "recs")


def recommendable(basket_rows: DataFrame) -> DataFrame:
    """``src_code`` of products that were bought with at least two different names.

    That is what ``size(recs) >= 2`` asks, answered without pairs: per basket the
    smallest and largest name number among the other items, then the extremes over all
    baskets differ exactly if two names exist. Numbers are aggregated by hash, texts by sort.
    """
    by_name = F.array_sort(
        F.transform("items", lambda i: F.struct(i["name_id"].alias("name"), i["StockCode"].alias("code")))
    )
    others = basket_rows.filter(F.size("items") > 1).select(by_name.alias("named")).select(
        F.explode("named").alias("item"),
        F.element_at("named", 1).alias("low"),
        F.element_at("named", 2).alias("low_next"),
        F.element_at("named", -1).alias("high"),
        F.element_at("named", -2).alias("high_next"),
    )

    def other(first: str, second: str):
        mine = F.col(f"{first}.code") == F.col("item.code")
        return F.when(mine, F.col(f"{second}.name")).otherwise(F.col(f"{first}.name"))

    return (
        others.select(
            F.col("item.code").alias("src_code"),
            other("low", "low_next").alias("low"),
            other("high", "high_next").alias("high"),
        )
        .groupBy("src_code")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .filter(F.col("low") != F.col("high"))
        .select("src_code")
    )


def rec_sample(basket_rows: DataFrame, names: DataFrame, recipe: Recipe) -> DataFrame:
    """``sample(top_recs)``, but products are drawn first and only their pairs counted."""
    chosen = sample(recommendable(basket_rows), ["src_code"], recipe.max_recs, recipe.rec_seed)
    return top_recs(rec_counts(basket_rows, chosen), names, recipe)
