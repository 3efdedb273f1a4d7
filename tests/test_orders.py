from ledgertalk.config import Recipe
from ledgertalk.functions.hashing import sample
from ledgertalk.operators import clean, orders

N = Recipe()


def test_items_are_ordered_and_cut_but_totals_are_whole(lines_of):
    rows = [("1", f"P{i:02d}", f"ITEM {i}", "2", "1.50") for i in range(20)]
    (row,) = orders.order_base(lines_of(rows), N).collect()
    assert row["items"] == [f"ITEM {i} x2 at £1.50" for i in range(12)]
    assert (row.unique_items, row.order_total) == (20, 60.0)


def test_same_code_lines_keep_repeated_texts_in_order(lines_of):
    rows = [("1", "A", "TIN", "3", "1"), ("1", "A", "TIN", "1", "9"), ("1", "A", "TIN", "1", "1234.5")]
    (row,) = orders.order_base(lines_of(rows), N).collect()
    assert row["items"] == ["TIN x1 at £9.00", "TIN x1 at £1,234.50", "TIN x3 at £1.00"]


def test_one_invoice_in_two_countries_and_in_none(lines_of):
    rows = [("1", "A", "TIN", "1", "1", c) for c in ("UK", "France", None)]
    found = {r.Country: r["items"] for r in orders.order_base(lines_of(rows), N).collect()}
    assert set(found) == {"UK", "France", None}
    drawn = orders.order_sample(lines_of(rows), Recipe(max_orders=3))
    assert {r.Country for r in drawn.collect()} == {"UK", "France", None}


def test_first_date_only_in_s(lines_of):
    rows = [
        ("1", "A", "TIN", "1", "1", "UK", "2011-02-02 00:00:00"),
        ("1", "B", "BOX", "1", "1", "UK", "2011-01-01 10:00:00"),
    ]
    assert "invoice_date" not in orders.order_base(lines_of(rows), N).columns
    s = Recipe.for_profile("s")
    (row,) = orders.order_base(lines_of(rows, "s"), s).collect()
    assert str(row.invoice_date) == "2011-01-01 10:00:00"


def test_sampling_first_equals_sampling_last(lines_of):
    rows = [(str(i % 40), f"P{i % 7}", f"ITEM {i % 7}", "1", "1") for i in range(200)]
    lines = lines_of(rows)
    recipe = Recipe(max_orders=9)
    late = sample(orders.order_base(lines, recipe), orders.ORDER_KEY, 9, recipe.order_seed)
    early = orders.order_sample(lines, recipe)
    assert sorted(late.collect()) == sorted(early.collect())


def test_cancellations_name_unknown_items_in_n_and_skip_them_in_s(raw):
    rows = [("C1", "A", None, None, "1"), ("C1", "B", "BOX", "-2", "1"), ("C2", "B", None, "-1", "1")]
    cancelled = clean.cancellations(clean.normalize(raw(rows)))
    n = {r.InvoiceNo: r for r in orders.cancellation_base(cancelled, N).collect()}
    assert n["C1"]["items"] == ["BOX", "Unknown item"] and n["C1"].net_quantity == -2
    assert n["C2"]["items"] == ["Unknown item"]
    (only,) = orders.cancellation_base(cancelled, Recipe.for_profile("s")).collect()
    assert (only.InvoiceNo, only["items"], only.net_quantity) == ("C1", ["BOX"], -2)


def test_cancellation_items_are_cut_at_eight(raw):
    rows = [("C1", f"P{i}", f"ITEM {i}", "-1", "1") for i in range(9)]
    cancelled = clean.cancellations(clean.normalize(raw(rows)))
    (row,) = orders.cancellation_sample(cancelled, N).collect()
    assert row["items"] == [f"ITEM {i}" for i in range(8)] and row.net_quantity == -9


def test_a_hot_invoice_gathers_only_its_first_items(spark):
    """A third of all rows in one order: right results, and the rank cut runs before the shuffle."""
    from pyspark.sql import functions as F

    lines = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("InvoiceNo"),
        F.lit("UK").alias("Country"),
        F.format_string("P%05d", "id").alias("StockCode"),
        F.lit("TIN").alias("ProductName"),
        F.lit(1).alias("Quantity"),
        F.lit(0.1).alias("UnitPrice"),
        F.lit(0.1).alias("LineTotal"),
        F.lit("2011").alias("InvoiceDate"),
    )
    base = orders.order_base(lines, N)
    hot = base.filter("InvoiceNo = 'HOT'").first()
    assert (hot.unique_items, hot.order_total, len(hot["items"])) == (10000, 1000.0, 12)
    assert base.count() == 20001
    # The hot order is dealt into parts, and no part of it holds more than a few hundredths.
    parts = lines.filter("InvoiceNo = 'HOT'").groupBy(
        F.pmod(F.xxhash64("StockCode"), F.lit(orders.PARTS)).alias("part")
    )
    sizes = [r["count"] for r in parts.count().collect()]
    assert len(sizes) == orders.PARTS and max(sizes) < 10000 / orders.PARTS * 1.6


def test_lines_are_shuffled_once_and_without_names(spark, lines_of):
    from ledgertalk.sources.scratch import stored

    lines = stored(lines_of([("1", "A", "TIN", "1", "1"), ("1", "B", "BOX", "1", "1")]), "lines")
    names = stored(lines.select("StockCode", "ProductName").distinct(), "names")
    plan = orders.order_base(lines, N, names=names)._jdf.queryExecution().executedPlan().toString()
    # Below the first grouping by part there is one exchange, by order and part.
    below = plan[plan.index("Window "):].split("BroadcastExchange")[0]
    assert below.count("Exchange") == 1 and "hashpartitioning(order_id" in below
    assert below.count("FileScan") == 1 and "ProductName" not in below


def test_parts_of_an_order_add_up(spark, monkeypatch, lines_of):
    rows = [("1", f"P{i % 17:02d}", f"ITEM {i % 17}", str(1 + i % 3), f"{i % 5 + 1}.5") for i in range(90)]
    lines = lines_of(rows)
    found = {}
    for parts in (1, 3, 64):
        monkeypatch.setattr(orders, "PARTS", parts)
        (found[parts],) = orders.order_base(lines, N).collect()
    assert found[1] == found[3] == found[64] and found[1].unique_items == 17
