"""Canonical product names, line items and product statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgertalk.functions.numbers import mean_of_parts, sum_parts
from ledgertalk.sources.scratch import packed


def description_counts(bought: DataFrame) -> DataFrame:
    return bought.groupBy("StockCode", "Description").agg(F.count(F.lit(1)).alias("count"))


def product_names(bought: DataFrame) -> DataFrame:
    """Most frequent description per StockCode, ties to the smallest text.

    A minimum of (negative count, text) is combined before the shuffle, so a code with very
    many spellings does not land in one task.
    """
    least = F.min(F.struct((-F.col("count")).alias("rarity"), "Description"))
    return (
        description_counts(bought)
        .groupBy("StockCode")
        .agg(least.getField("Description").alias("ProductName"))
    )


def name_ids(names: DataFrame) -> DataFrame:
    """``StockCode, ProductName, name_id``: equal names have equal numbers, in the order of names.

    The numbers are stored: they are those of one run, and only their order counts. Where a
    name itself is not needed, its number takes its place in shuffles, ranks and minima. A sort
    by ranges puts names in order over all tasks, and ids increase along the partitions.
    """
    numbered = names.select("ProductName").distinct().orderBy("ProductName")
    numbered = packed(
        numbered.select("ProductName", F.monotonically_increasing_id().alias("name_id")), "name_ids"
    )
    both = names.join(numbered, "ProductName").select("StockCode", "ProductName", "name_id")
    return packed(both, "names")


def line_items(bought: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Purchases under their canonical name.

    ``names`` should be a stored table. Its size is then known: small, it is broadcast and
    no purchase is shuffled by code; large, both sides of the merge join come straight
    from a shuffle, which is the shape in which Spark splits hot codes at run time.
    """
    names = product_names(bought) if names is None else names
    return (
        bought.drop("Description")
        .join(names.select("StockCode", "ProductName"), "StockCode")
        .withColumn("LineTotal", F.col("Quantity") * F.col("UnitPrice"))
    )


def product_stats(lines: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Orders, units, mean price and countries per product.

    Two levels instead of distinct counts, which would read every line once for each of them
    and once more: lines are added up by (code, invoice), then by code; countries are counted
    apart from distinct (code, country). Both combine before their shuffle, so a hot code
    spreads by its invoices.

    A code has one name. Given ``names``, purchases are grouped by code alone and the
    name joins the few result rows, so it takes no part in the large shuffle.
    """
    key = ["StockCode", "ProductName"] if names is None else ["StockCode"]
    of_orders = lines.groupBy(*key, "InvoiceNo").agg(
        F.sum("Quantity").alias("units"), *sum_parts(F.col("UnitPrice"), "price")
    )
    measured = of_orders.groupBy(*key).agg(
        F.count("InvoiceNo").alias("order_count"),
        F.sum("units").alias("units_sold"),
        mean_of_parts("price").alias("avg_price"),
    )
    countries = (
        lines.select(*key, "Country")
        .distinct()
        .groupBy(*key)
        .agg(F.count("Country").alias("country_count"))
    )
    measured = measured.join(countries, key)
    if names is not None:
        measured = measured.join(names.select("StockCode", "ProductName"), "StockCode")
    return measured.select(
        "StockCode", "ProductName", "order_count", "units_sold", "avg_price", "country_count"
    )


# Characters of a code by which products of one count are cut.
CODE_PREFIX = 4


def most_ordered(stats: DataFrame, n: int) -> DataFrame:
    """The ``n`` products with most orders, ties to the smallest code. ``stats`` should be a
    stored table: it is read three times.

    The final top-n is one task that merges ``n`` rows from every task before it, so rows are
    first cut at the count that ``n`` products reach, and those of just this count at the
    prefix of their codes that completes ``n``. The windows without partition run over one row
    per distinct count, or prefix of a code of one count.
    """
    reached = stats.groupBy("order_count").agg(F.count(F.lit(1)).alias("rows"))
    down = Window.orderBy(F.desc("order_count"))
    reached = reached.select("order_count", F.sum("rows").over(down).alias("upto"))
    # No such count if there are fewer than n products: all stay.
    least = reached.filter(F.col("upto") >= n).agg(F.max("order_count")).scalar()
    prefix = F.substring("StockCode", 1, CODE_PREFIX)
    ties = stats.filter(F.col("order_count") == least).groupBy(prefix.alias("prefix"))
    ties = ties.agg(F.count(F.lit(1)).alias("rows"))
    above = stats.filter(F.col("order_count") > least).agg(F.count(F.lit(1))).scalar()
    up = Window.orderBy("prefix")
    ties = ties.select("prefix", (F.sum("rows").over(up) + above).alias("upto"))
    last = ties.filter(F.col("upto") >= n).agg(F.min("prefix")).scalar()
    count = F.col("order_count")
    kept = least.isNull() | (count > least) | ((count == least) & (prefix <= last))
    return stats.filter(kept).orderBy(F.desc("order_count"), "StockCode", "ProductName").limit(n)
