"""Order and cancellation summaries, whole or for chosen keys only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgertalk.config import Recipe
from ledgertalk.functions.hashing import sample
from ledgertalk.functions.numbers import sum_of_parts, sum_parts
from ledgertalk.functions.text import count_text, fill, money
from ledgertalk.operators.firsts import first_values
from ledgertalk.sources.scratch import packed

ORDER_KEY = ("InvoiceNo", "Country")


def item_text() -> Column:
    return fill(
        "{name} x{qty} at £{price}",
        name=F.col("ProductName"),
        qty=count_text("Quantity"),
        price=money(F.col("UnitPrice")),
    )


# Parts into which the lines of a large order are dealt by their code.
PARTS = 64
# Orders are counted by a hash of their key into so many groups. Those in a group of more than
# ``LARGE`` lines, and of more than a few times the mean, count as large.
ORDER_GROUPS = 1 << 16
LARGE = 1 << 18


def order_base(
    lines: DataFrame,
    recipe: Recipe,
    chosen: DataFrame | None = None,
    names: DataFrame | None = None,
) -> DataFrame:
    """First items, total, distinct products and, in profile s, first date of every order.

    ``chosen`` limits the work to those keys before anything is shuffled. Product names join the
    kept items only: given ``names``, ``lines`` need none.
    """
    if names is None:
        names = lines.select("StockCode", "ProductName").distinct()
    return with_item_texts(order_facts(lines, recipe, chosen), names)


def order_facts(lines: DataFrame, recipe: Recipe, chosen: DataFrame | None = None) -> DataFrame:
    """``order_base`` without the items' texts. ``lines`` should be stored: they are read thrice.

    Lines are shuffled once, by order; sums, distinct products and the first items come from the
    one sort that the ranks need. Only large orders are dealt into parts, for which lines are
    counted first.

    Orders are keyed by one struct, which is never NULL even where Country is.
    """
    facts = lines.withColumn("order_id", F.struct(*ORDER_KEY))
    if chosen is not None:
        wanted = chosen.select(F.struct(*ORDER_KEY).alias("order_id"))
        facts = facts.join(wanted, "order_id", "left_semi")
    group = F.pmod(F.xxhash64("order_id"), F.lit(ORDER_GROUPS)).cast("int").alias("group")
    counts = packed(facts.groupBy(group).agg(F.count(F.lit(1)).alias("lines")), "order_groups")
    mean = counts.agg(F.sum("lines") / ORDER_GROUPS).scalar()
    # At most ``ORDER_GROUPS`` rows.
    large = counts.filter(F.col("lines") > F.greatest(F.lit(LARGE), 4 * mean)).select("group")
    large = F.broadcast(packed(large, "large_orders"))
    grouped = facts.withColumn("group", group)
    part = F.pmod(F.xxhash64("StockCode"), F.lit(PARTS)).cast("int")
    most = grouped.join(large, "group", "left_anti")
    rest = grouped.join(large, "group", "left_semi").withColumn("part", part)
    return _summed(most, ["order_id"], recipe).unionByName(
        _summed(rest, ["order_id", "part"], recipe)
    )


def _summed(facts: DataFrame, part: Sequence[str], recipe: Recipe) -> DataFrame:
    """Orders from their lines, shuffled by ``part``: by order, or by order and part.

    A code lies in one part, so the distinct counts of parts add up, and an order with a third
    of all lines is ``PARTS`` groups. What an order's parts then bring together is one row each
    with at most ``items_per_order`` items. An order that is its only part is not moved again.
    """
    line = ("StockCode", "Quantity", "UnitPrice")
    dated = ["InvoiceDate"] if recipe.profile == "s" else []
    in_order = Window.partitionBy(*part).orderBy(*line)
    ranked = (
        facts.select(*part, *line, *dated)
        .repartition(*part)
        .select(
            *part,
            *line,
            *dated,
            (F.col("Quantity") * F.col("UnitPrice")).alias("LineTotal"),
            F.row_number().over(in_order).alias("place"),
            F.lag("StockCode").over(in_order).alias("previous"),
        )
    )
    first = F.when(F.col("place") <= recipe.items_per_order, F.struct(*line))
    new_code = ~F.col("StockCode").eqNullSafe(F.col("previous"))
    of_parts = ranked.groupBy(*part).agg(
        *sum_parts(F.col("LineTotal"), "total"),
        F.count_if(new_code).alias("codes"),
        F.collect_list(first).alias("items"),
        *[F.min(name).alias(name) for name in dated],
    )
    return of_parts.groupBy("order_id").agg(
        sum_of_parts("total").alias("order_total"),
        F.sum("codes").alias("unique_items"),
        F.slice(
            F.array_sort(F.flatten(F.collect_list("items"))), 1, recipe.items_per_order
        ).alias("items"),
        *[F.min(name).alias("invoice_date") for name in dated],
    )


def with_item_texts(whole: DataFrame, names: DataFrame) -> DataFrame:
    """``order_facts`` with the texts of its items under their products' names."""
    kept = ["order_id", *[name for name in whole.columns if name not in ("order_id", "items")]]
    lists = whole.select(*kept, F.posexplode("items").alias("place", "item")).select(
        *kept, "place", "item.*"
    )
    placed = F.struct("place", item_text().alias("text"))
    named = lists.join(names.select("StockCode", "ProductName"), "StockCode").groupBy(*kept)
    return (
        named.agg(F.sort_array(F.collect_list(placed)).getField("text").alias("items"))
        .filter(F.col("unique_items") > 0)
        .select("order_id.*", "items", *kept[1:])
    )


def sampled_order_keys(lines: DataFrame, recipe: Recipe) -> DataFrame:
    return sample(
        lines.select(*ORDER_KEY).distinct(), ORDER_KEY, recipe.max_orders, recipe.order_seed
    )


def order_sample(lines: DataFrame, recipe: Recipe, names: DataFrame | None = None) -> DataFrame:
    """``sample(order_base)``, but the keys are drawn first and only their orders summarised."""
    return order_base(lines, recipe, sampled_order_keys(lines, recipe), names)


def describable(cancelled: DataFrame, recipe: Recipe) -> DataFrame:
    """Profile s skips lines without description, n names them."""
    if recipe.profile == "s":
        return cancelled.filter(F.col("Description").isNotNull())
    return cancelled.withColumns(
        {
            # Fixed value: stand-in for a missing description.
            "Description": F.coalesce("Description", F.lit("Unknown item")),
            "Quantity": F.coalesce("Quantity", F.lit(0)),
        }
    )


def cancellation_base(
    cancelled: DataFrame, recipe: Recipe, chosen: DataFrame | None = None
) -> DataFrame:
    """First descriptions and net quantity of every cancelled or adjusted invoice."""
    facts = describable(cancelled, recipe).select("InvoiceNo", "Description", "Quantity")
    if chosen is not None:
        facts = facts.join(chosen.select("InvoiceNo"), "InvoiceNo", "left_semi")
    totals = facts.groupBy("InvoiceNo").agg(F.sum("Quantity").alias("net_quantity"))
    items = first_values(
        facts.select("InvoiceNo", "Description"),
        "InvoiceNo",
        ["Description"],
        F.col("Description"),
        recipe.items_per_cancellation,
        "items",
    )
    return totals.join(items, "InvoiceNo").select("InvoiceNo", "items", "net_quantity")


def sampled_cancellation_keys(cancelled: DataFrame, recipe: Recipe) -> DataFrame:
    invoices = describable(cancelled, recipe).select("InvoiceNo").distinct()
    return sample(invoices, ["InvoiceNo"], recipe.max_cancellations, recipe.cancel_seed)


def cancellation_sample(cancelled: DataFrame, recipe: Recipe) -> DataFrame:
    return cancellation_base(cancelled, recipe, sampled_cancellation_keys(cancelled, recipe))
