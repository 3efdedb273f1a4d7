import random
from collections import Counter
from itertools import permutations

import pytest

from ledgertalk.config import Recipe
from ledgertalk.functions.hashing import sample
from ledgertalk.operators import baskets as bk
from ledgertalk.operators import catalog
from ledgertalk.sources.scratch import stored


def table(spark, rows):
    return spark.createDataFrame(rows, "InvoiceNo string, StockCode string, ProductName string")


def names_of(lines):
    return catalog.name_ids(lines.select("StockCode", "ProductName").distinct())


def brute_baskets(rows, cap):
    found = {}
    for invoice, code, name in rows:
        found.setdefault(invoice, {})[code] = name
    return {invoice: items for invoice, items in found.items() if len(items) <= cap}


def brute_recs(rows, cap):
    scores = Counter()
    for items in brute_baskets(rows, cap).values():
        for (a, a_name), (_, b_name) in permutations(items.items(), 2):
            scores[a, a_name, b_name] += 1
    found = {}
    for (code, name, other), score in scores.items():
        found.setdefault((code, name), []).append((-score, other))
    ranked = {key: [other for _, other in sorted(recs)[:5]] for key, recs in found.items()}
    return scores, {key: recs for key, recs in ranked.items() if len(recs) >= 2}


def random_rows(seed):
    rng = random.Random(seed)
    # Fewer names than codes, so that several codes share one.
    names = {f"P{i:02d}": f"NAME {rng.randrange(9)}" for i in range(14)}
    rows = []
    for invoice in range(60):
        for _ in range(rng.choice([1, 1, 2, 3, 5, 9])):
            code = rng.choice(sorted(names))
            rows.append((str(invoice), code, names[code]))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_baskets_pairs_and_recommendations_equal_brute_force(spark, seed):
    rows = random_rows(seed)
    cap = 4
    names = names_of(table(spark, rows))
    kept = bk.baskets(table(spark, rows), cap, names)
    expected = brute_baskets(rows, cap)
    assert {r.InvoiceNo: [i.StockCode for i in r["items"]] for r in kept.collect()} == {
        invoice: sorted(items) for invoice, items in expected.items()
    }
    items = bk.basket_items(kept, names).collect()
    assert all(r.basket_size == len(expected[r.InvoiceNo]) for r in items)
    assert {(r.InvoiceNo, r.StockCode, r.ProductName) for r in items} == {
        (invoice, *item) for invoice, found in expected.items() for item in found.items()
    }

    scores, recs = brute_recs(rows, cap)
    directed = bk.directed_pairs(kept, names)
    assert Counter((r.src_code, r.src_name, r.rec_name) for r in directed.collect()) == scores
    pairs = bk.copurchase_pairs(kept, names).collect()
    assert 2 * len(pairs) == sum(scores.values())
    assert all(r.a_code < r.b_code for r in pairs)
    both = [((r.a_code, r.a_name, r.b_name), (r.b_code, r.b_name, r.a_name)) for r in pairs]
    assert Counter(pair for two in both for pair in two) == scores

    counts = bk.rec_counts(kept)
    counted = bk.pair_counts(counts, names).collect()
    assert {(r.src_code, r.src_name, r.rec_name): r.score for r in counted} == scores
    found = bk.top_recs(counts, names, Recipe())
    assert {(r.src_code, r.src_name): r.recs for r in found.collect()} == recs
    assert {r.src_code for r in bk.recommendable(kept).collect()} == {code for code, _ in recs}

    recipe = Recipe(max_recs=4)
    late = sample(found, ["src_code"], 4, recipe.rec_seed)
    assert sorted(late.collect()) == sorted(bk.rec_sample(kept, names, recipe).collect())


def test_sizes_count_distinct_products(spark):
    rows = [("1", "A", "X"), ("1", "A", "X"), ("1", "B", "Y"), ("2", "A", "X")]
    found = {r.InvoiceNo: r.basket_size for r in bk.basket_sizes(table(spark, rows)).collect()}
    assert found == {"1": 2, "2": 1}


def test_cap_drops_the_whole_basket_and_keeps_one_at_the_cap(spark):
    rows = [("1", f"P{i}", f"N{i}") for i in range(5)] + [("2", f"P{i}", f"N{i}") for i in range(6)]
    lines = table(spark, rows)
    assert [r.InvoiceNo for r in bk.baskets(lines, 5, names_of(lines)).collect()] == ["1"]


def test_two_codes_with_one_name_add_up_and_may_recommend_themselves(spark):
    rows = [("1", "A", "MUG"), ("1", "B", "MUG"), ("1", "C", "CUP")]
    names = names_of(table(spark, rows))
    kept = bk.baskets(table(spark, rows), 10, names)
    counts = {
        (r.src_code, r.rec_name): r.score
        for r in bk.pair_counts(bk.rec_counts(kept), names).collect()
    }
    assert counts[("C", "MUG")] == 2 and counts[("A", "MUG")] == 1


def test_a_hot_invoice_stays_bounded(spark):
    from pyspark.sql import functions as F

    lines = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise((F.col("id") / 6).cast("int").cast("string")).alias("InvoiceNo"),
        F.format_string("P%05d", F.col("id")).alias("StockCode"),
        F.format_string("N%05d", F.col("id")).alias("ProductName"),
    )
    names = names_of(lines)
    kept = bk.baskets(lines, 8, names)
    assert kept.filter("InvoiceNo = 'HOT'").count() == 0
    assert bk.basket_items(kept, names).count() == 20000
    plan = kept._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan


def test_no_name_is_in_baskets_or_pairs(spark):
    lines = stored(table(spark, random_rows(1)), "lines")
    names = names_of(lines)
    kept = bk.baskets(lines, 5, names)
    for df in (kept, bk.rec_counts(kept), bk.recommendable(kept)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "ProductName" not in plan and "rec_name" not in plan
        # Texts would be aggregated by sorting.
        assert "SortAggregate" not in plan
