import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgertalk.config import Recipe
from ledgertalk.operators import report


@pytest.fixture(params=["mixed", "equal", "two"])
def lengths(spark, request):
    rng = random.Random(5)
    values = {
        "mixed": [rng.randrange(20, 900) for _ in range(700)],
        "equal": [7, 7, 7],
        "two": [1, 4],
    }[request.param]
    rows = [("train" if i % 3 else "eval", "kind", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "split string, example_type string, approx_tokens int")
    return df, pd.DataFrame(rows, columns=["split", "kind", "tokens"])


def test_summary_quantiles_are_exact(lengths):
    df, frame = lengths
    for row in report.token_summary(df).collect():
        values = sorted(frame[frame.split == row.split].tokens)
        expected = [values[math.ceil(p * len(values)) - 1] for p in (0.25, 0.5, 0.75)]
        assert [row.p25_tokens, row.median_tokens, row.p75_tokens] == expected
        assert (row.sample_count, row.min_tokens, row.max_tokens) == (
            len(values),
            values[0],
            values[-1],
        )


def test_describe_equals_pandas(lengths):
    df, frame = lengths
    row = report.token_describe(df).first()
    expected = frame.tokens.describe()
    found = [row["count"], row["mean"], row["std"], row["min"], row.p25, row.p50, row.p75, row["max"]]
    assert found == pytest.approx(list(expected))


def test_histogram_equals_numpy(lengths):
    df, frame = lengths
    counts, edges = np.histogram(frame.tokens, bins=50)
    rows = sorted(report.token_hist50(df).collect())
    assert [r["count"] for r in rows] == list(counts)
    if frame.tokens.nunique() > 1:
        assert [r.bin_start for r in rows] == pytest.approx(list(edges[:-1]))


def test_bucket_edges_are_right_open(spark):
    values = [0, 99, 100, 199, 200, 299, 300, 399, 400, 599, 600, 5000]
    df = spark.createDataFrame([("train", v) for v in values], "split string, approx_tokens int")
    found = {r.token_bucket: r["count"] for r in report.token_hist(df).collect()}
    assert found == dict.fromkeys(["000-099", "100-199", "200-299", "300-399", "400-599", "600+"], 2)


def test_pivot_fills_missing_splits(spark):
    counts = spark.createDataFrame(
        [("train", "a", 5), ("eval", "a", 1), ("train", "b", 2)],
        "split string, example_type string, count bigint",
    )
    rows = {r.example_type: (r.eval, r.train) for r in report.split_pivot(counts).collect()}
    assert rows == {"a": (1, 5), "b": (0, 2)}


def test_token_estimates(spark):
    df = spark.createDataFrame([("ab cd\te\nf  g",), ("",), ("12345",)], "json string")
    n = [r.approx_tokens for r in report.token_lengths(df, "n").collect()]
    s = [r.approx_tokens for r in report.token_lengths(df, "s").collect()]
    assert n == [5, 1, 1] and s == [3, 0, 2]


def test_loss_curve_drops_steps_without_loss(spark):
    log = spark.createDataFrame([(2, 0.5, 1), (1, None, 1), (0, 0.7, 1)], "step int, loss double, x int")
    assert [tuple(r) for r in report.loss_curve(log).collect()] == [(0, 0.7), (2, 0.5)]
    assert report.loss_curve(log.drop("loss")).count() == 0


def test_preview_is_a_fixed_choice(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("json"))
    first = sorted(r.json for r in report.preview(df, Recipe()).collect())
    again = sorted(r.json for r in report.preview(df.repartition(7), Recipe()).collect())
    assert first == again and len(first) == 20
