"""The tables that several outputs share, and the examples built from them."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from ledgertalk.config import Recipe
from ledgertalk.operators import baskets as bk
from ledgertalk.operators import catalog, clean, examples, orders, report
from ledgertalk.sources.scratch import Shelf, in_rounds, packed


class Kept(Shelf):
    """Shared tables, each written when first asked for and then read from parquet.

    - ``txn`` replaces repeated parsing of the raw text;
    - ``purchases`` holds the result of the widest shuffle, duplicate removal;
    - ``names`` gets a known size, so that Spark can choose the join with it up front;
    - ``lines`` feeds products, orders and baskets with only the columns each needs.

    A whole run calls ``read`` and ``settle`` first, which drop what its outputs do not read.
    """

    def __init__(self, txn: DataFrame, profile: str, lines_path: str | None = None):
        self._raw, self._profile, self._lines_path = txn, profile, lines_path

    def read(self) -> None:
        """The raw rows are read here and not again."""
        self.txn

    def settle(self) -> None:
        """Line items, cancellations and the counts of their sources, which are dropped."""
        self.purchases
        self.counts
        self.cancellations = self.keep(self.cancellations, "cancellations")
        self.drop("txn")
        self.lines
        self.drop("purchases")

    @cached_property
    def txn(self) -> DataFrame:
        return self.keep(self._raw, "txn")

    @cached_property
    def cancellations(self) -> DataFrame:
        return clean.cancellations(self.txn)

    @cached_property
    def purchases(self) -> DataFrame:
        # Repeats agree in the key of the rounds.
        parts = in_rounds(self.txn, "InvoiceNo", "StockCode")
        return self.keep_in_rounds(
            (clean.purchases(part, self._profile) for part in parts), "purchases"
        )

    @cached_property
    def counts(self) -> DataFrame:
        return self.keep(report.summary(self.txn, self.purchases, self._profile), "counts")

    @cached_property
    def names(self) -> DataFrame:
        return self.keep(catalog.product_names(self.purchases), "names")

    @cached_property
    def name_ids(self) -> DataFrame:
        return catalog.name_ids(self.names)

    @cached_property
    def lines(self) -> DataFrame:
        names, parts = self.names, in_rounds(self.purchases, "InvoiceNo", "StockCode")
        lines = (catalog.line_items(part, names) for part in parts)
        return self.keep_in_rounds(lines, "lines", self._lines_path)

    def ranked_products(self, recipe: Recipe) -> DataFrame:
        names, parts = self.names, in_rounds(self.lines, "StockCode")
        stats = self.keep_in_rounds(
            (catalog.product_stats(part, names) for part in parts), "product_stats"
        )
        ranked = packed(catalog.most_ordered(stats, recipe.max_products), "ranked_products")
        self.drop("product_stats")
        return ranked

    def baskets(self, cap: int) -> DataFrame:
        names, parts = self.name_ids, in_rounds(self.lines, "InvoiceNo")
        return self.keep_in_rounds((bk.baskets(part, cap, names) for part in parts), "baskets")


def all_examples(kept: Kept, recipe: Recipe, products: DataFrame | None = None) -> DataFrame:
    """All four kinds at their sample sizes.

    Orders, products to recommend for and cancellations are drawn by key before their
    details are gathered, so that cost follows the sample and not the input.
    """
    profile = recipe.profile
    if products is None:
        products = kept.ranked_products(recipe)
    order_keys = packed(orders.sampled_order_keys(kept.lines, recipe), "order_keys")
    cancel_keys = packed(
        orders.sampled_cancellation_keys(kept.cancellations, recipe), "cancellation_keys"
    )
    basket_rows = kept.baskets(recipe.basket_cap)
    return examples.combine(
        examples.product_examples(products, profile),
        examples.order_examples(
            orders.order_base(kept.lines, recipe, order_keys, kept.names), profile
        ),
        examples.rec_examples(bk.rec_sample(basket_rows, kept.name_ids, recipe), profile),
        examples.cancel_examples(
            orders.cancellation_base(kept.cancellations, recipe, cancel_keys), profile
        ),
    )
