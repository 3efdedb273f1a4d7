"""Writers. All overwrite their folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _in_files(df: DataFrame, files: int | None) -> DataFrame:
    # repartition, not coalesce: coalesce(1) would also pull the work before it into one task.
    return df if files is None else df.repartition(files)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


# Bytes of a file of lines, unless the number of files is given.
FILE_BYTES = 256 << 20


def files_for(df: DataFrame, column: str) -> int:
    """Files of about ``FILE_BYTES`` that the lines of ``column`` fill; at least one."""
    size = F.sum(F.octet_length(column).cast("long") + 1)
    total = df.agg(F.coalesce(size, F.lit(0)).alias("total")).first()["total"]
    return max(1, -(-total // FILE_BYTES))


def write_lines(df: DataFrame, path: str, column: str = "json", files: int | None = None) -> None:
    """One text line per row of ``column``, in ``files`` files or else in as many as their bytes
    need. ``df`` should be stored: it is read once more to measure them."""
    lines = df.select(df[column].alias("value"))
    lines = _in_files(lines, files_for(lines, "value") if files is None else files)
    lines.write.mode("overwrite").text(path)


def write_csv(
    df: DataFrame, path: str, files: int | None = 1, order: Sequence[Column | str] = ()
) -> None:
    """``order`` sorts the rows inside each file; with one file that is the whole table."""
    table = _in_files(df, files)
    if order:
        table = table.sortWithinPartitions(*order)
    table.write.mode("overwrite").csv(path, header=True)
