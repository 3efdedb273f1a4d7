"""The first k values of each group, gathered without ever holding a group whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_values(
    df: DataFrame, key: str, order: Sequence[str], value: Column, k: int, alias: str
) -> DataFrame:
    """``key, alias`` with alias an array of at most ``k`` values in ``order``.

    The rank filter is applied per task before the shuffle (WindowGroupLimit), so a
    group with a third of all rows sends ``k`` rows per task; ``collect_list`` then
    sees at most ``k`` rows. ``value`` is computed for the kept rows only.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    kept = df.withColumn("place", place).filter(F.col("place") <= k)
    placed = F.struct("place", value.alias("value"))
    return kept.groupBy(key).agg(
        F.sort_array(F.collect_list(placed)).getField("value").alias(alias)
    )
