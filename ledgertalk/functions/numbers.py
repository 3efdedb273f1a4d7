"""Order-independent sums and means of prices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums of doubles change with the order in which partitions arrive, so prices are summed as
# decimals of eight places. A value that has none (NaN, an infinity, 1e30 and beyond) makes
# the plain sum or mean of doubles the result, which NaN and infinities decide in any order.
EXACT = "decimal(38,8)"


def _plain(value: Column) -> Column:
    return F.count(F.when(value.isNotNull() & value.try_cast(EXACT).isNull(), 1)) > 0


def _sum(value: Column) -> Column:
    return F.sum(value.try_cast(EXACT)).cast("double")


def exact_sum(value: Column) -> Column:
    return F.when(_plain(value), F.sum(value)).otherwise(_sum(value))


def exact_mean(value: Column) -> Column:
    return F.when(_plain(value), F.avg(value)).otherwise(_sum(value) / F.count(value))


def sum_parts(value: Column, name: str) -> list[Column]:
    """Aggregates of a first level, from which ``sum_of_parts`` and ``mean_of_parts`` give at a
    second level what ``exact_sum`` and ``exact_mean`` give at once."""
    bad = F.count(F.when(value.isNotNull() & value.try_cast(EXACT).isNull(), 1))
    return [
        bad.alias(f"{name}_bad"),
        F.sum(value).alias(f"{name}_plain"),
        F.sum(value.try_cast(EXACT)).alias(f"{name}_exact"),
        F.count(value).alias(f"{name}_n"),
    ]


def sum_of_parts(name: str) -> Column:
    exact = F.sum(f"{name}_exact").cast("double")
    return F.when(F.sum(f"{name}_bad") > 0, F.sum(f"{name}_plain")).otherwise(exact)


def mean_of_parts(name: str) -> Column:
    return sum_of_parts(name) / F.sum(f"{name}_n")
