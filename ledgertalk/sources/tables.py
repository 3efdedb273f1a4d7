"""Readers: transaction CSV, chat JSONL, numbered lines, folders of CSV parts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgertalk.sources.schemas import CHAT_ROW, TRANSACTION_COLUMNS


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Raw transaction CSV, every field as text under its header name.

    No schema inference: that would read the whole input once more and turn codes
    into numbers. Doubled quotes inside quoted fields are understood.
    """
    raw = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=False)
    return require_columns(raw)


def require_columns(df: DataFrame, needed: Iterable[str] = TRANSACTION_COLUMNS) -> DataFrame:
    missing = [name for name in needed if name not in df.columns]
    if missing:
        raise ValueError(f"rows lack {missing}; the input has {df.columns}")
    return df


def read_chat_jsonl(spark: SparkSession, splits: Mapping[str, str]) -> DataFrame:
    """``{"train": path, "validation": path}`` as one table with a ``split`` column."""
    tables = [
        spark.read.schema(CHAT_ROW).json(path).withColumn("split", F.lit(split))
        for split, path in splits.items()
    ]
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table)
    return merged


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, file, block, row``: text lines with the file they are from, the offset of the
    block of it that one task reads, and a number that grows by one along the block."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_csv_parts(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """All ``part-*`` CSV files of a folder; an absent or empty folder is an error."""
    try:
        df = spark.read.schema(schema).csv(folder, header=True, pathGlobFilter="part-*")
        found = bool(df.inputFiles())
    except AnalysisException as error:
        raise FileNotFoundError(f"{folder} holds no part-* file of a table") from error
    if not found:
        raise FileNotFoundError(f"{folder} holds no part-* file of a table")
    return df
