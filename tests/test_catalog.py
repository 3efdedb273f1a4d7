from ledgertalk.operators import catalog, clean


def test_name_is_most_frequent_then_smallest(raw):
    rows = [("1", "A", "RED", "1", "1"), ("2", "A", "RED", "1", "1"), ("3", "A", "BLUE", "1", "1")]
    rows += [("4", "B", "ZINC", "1", "1"), ("5", "B", "ALUM", "1", "1")]
    bought = clean.purchases(clean.normalize(raw(rows)))
    names = {r.StockCode: r.ProductName for r in catalog.product_names(bought).collect()}
    assert names == {"A": "RED", "B": "ALUM"}
    lines = catalog.line_items(bought)
    assert lines.count() == 5 and "Description" not in lines.columns
    assert {(r.StockCode, r.ProductName) for r in lines.collect()} == set(names.items())


def test_stats_count_distinct_orders_and_countries(lines_of):
    lines = lines_of(
        [
            ("1", "A", "TIN", "2", "1.10", "UK"),
            ("1", "A", "TIN", "3", "2.20", "France"),
            ("2", "A", "TIN", "4", "3.30", "UK"),
        ]
    )
    (row,) = catalog.product_stats(lines).collect()
    assert (row.order_count, row.units_sold, row.country_count) == (2, 9, 2)
    assert row.avg_price == 6.6 / 3


def test_ranking_breaks_ties_by_code(lines_of):
    rows = [("1", code, f"ITEM {code}", "1", "1") for code in ("C", "A", "B")]
    rows.append(("2", "B", "ITEM B", "1", "1"))
    ranked = catalog.most_ordered(catalog.product_stats(lines_of(rows)), 2)
    assert [r.StockCode for r in ranked.collect()] == ["B", "A"]


def test_sums_are_exact_for_very_large_prices(spark):
    from pyspark.sql import functions as F

    from ledgertalk.functions.numbers import exact_sum

    df = spark.createDataFrame([(1e18,), (0.1,), (0.2,)], "v double")
    assert df.agg(exact_sum(F.col("v")).alias("s")).first().s == 1e18
    small = spark.createDataFrame([(0.1,)] * 30, "v double")
    assert small.agg(exact_sum(F.col("v")).alias("s")).first().s == 3.0


def test_stats_read_each_line_once_a_measure(spark, lines_of):
    """Distinct counts would expand every line; two levels do not."""
    lines = lines_of([("1", "A", "TIN", "2", "1.10", None), ("2", "A", "TIN", "2", "2.30", "UK")])
    stats = catalog.product_stats(lines, catalog.name_ids(lines.select("StockCode", "ProductName").distinct()))
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "SortAggregate" not in plan
    (row,) = stats.collect()
    assert (row.order_count, row.country_count, row.avg_price) == (2, 1, 1.7)


def test_stats_with_prices_that_have_no_decimals(spark):
    rows = [("1", "A", 1, 1e35, "UK"), ("2", "A", 1, 1e35, "UK"), ("1", "B", 1, float("inf"), "UK"), ("2", "B", 1, 2.0, "UK")]
    lines = spark.createDataFrame(
        [(*r, "NAME") for r in rows],
        "InvoiceNo string, StockCode string, Quantity int, UnitPrice double, Country string, ProductName string",
    )
    found = {r.StockCode: r.avg_price for r in catalog.product_stats(lines).collect()}
    assert found == {"A": 1e35, "B": float("inf")}


def test_ranking_cut_keeps_all_that_count(spark):
    rows = [(f"{a}{i:03d}", "X", 1 + (i * 7) % 5) for a in ("AAAA", "AAAB", "B", "") for i in range(60)]
    stats = spark.createDataFrame(rows, "StockCode string, ProductName string, order_count long")
    wanted = [code for code, _, n in sorted(rows, key=lambda r: (-r[2], r[0]))]
    for n in (0, 1, 47, 48, 49, 130, 239, 240, 500):
        found = catalog.most_ordered(stats, n)
        assert [r.StockCode for r in found.collect()] == wanted[:n]
    # What reaches the last task is cut at count and prefix.
    cut = catalog.most_ordered(stats, 50)._jdf.queryExecution().optimizedPlan().toString()
    assert cut.count("scalar-subquery") >= 2


def test_name_numbers_tell_names_apart(spark):
    rows = [("A", "MUG"), ("B", "MUG"), ("C", "CUP")]
    found = catalog.name_ids(spark.createDataFrame(rows, "StockCode string, ProductName string"))
    ids = {r.StockCode: r.name_id for r in found.collect()}
    assert ids["A"] == ids["B"] != ids["C"]
