"""Sums and means of prices."""

import math
import random

import pytest
from ledgertalk.functions.numbers import exact_mean, exact_sum
from pyspark.sql import functions as F

CASES = {
    "small": ([0.00004, 0.00003], 0.000035),
    "places": ([1.12344, 1.12344, 2.005], (1.12344 * 2 + 2.005) / 3),
    "nan": ([math.nan, 1.5], math.nan),
    "infinite": ([math.inf, 1.5], math.inf),
    "both": ([math.inf, -math.inf], math.nan),
    "huge": ([1e35, 1e35], 1e35),
    "nulls": ([None, 2.0], 2.0),
    "none": ([None], None),
}


@pytest.mark.parametrize("name", CASES)
def test_mean_and_sum(spark, name):
    values, mean = CASES[name]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = df.agg(exact_mean(F.col("v")).alias("m"), exact_sum(F.col("v")).alias("s")).first()
    if mean is None:
        assert found.m is None and found.s is None
    elif math.isnan(mean):
        assert math.isnan(found.m) and math.isnan(found.s)
    else:
        count = sum(v is not None for v in values)
        assert found.m == pytest.approx(mean, rel=1e-9, abs=1e-9)
        assert found.s == pytest.approx(mean * count, rel=1e-9, abs=1e-9)


def test_order_does_not_matter(spark):
    dice = random.Random(1)
    values = [round(dice.uniform(0, 1000), 2) * dice.randint(1, 50) for _ in range(3000)]
    sums = set()
    for n in (1, 3, 7):
        dice.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(n)
        sums.add(df.agg(exact_sum(F.col("v"))).first()[0])
    assert len(sums) == 1
