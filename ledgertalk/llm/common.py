"""What several operators of this package share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegralType, StructField, StructType

from ledgertalk.sources.scratch import stored

# Fixed value: white space that separates words in all contracts of this package.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def split_words(text: Column) -> Column:
    """Maximal runs without white space, in order; no words for an empty text."""
    return F.array_remove(F.split(text, SPACES), "")


def total(array: Column) -> Column:
    """Sum of an array of longs, 0 if it is empty."""
    return F.aggregate(array, F.lit(0).cast("long"), lambda a, x: a + x)


def small_or_shuffled(df: DataFrame, rows: int) -> DataFrame:
    """A stored table as the small side of a join: broadcast if it is counted to have at most
    ``rows`` rows, left to a shuffle join beyond that. The result is the same either way."""
    return F.broadcast(df) if df.count() <= rows else df


def with_fields(schema: StructType, fields: str) -> StructType:
    """A schema and further fields, given as ``name type, ...``."""
    return StructType([*schema.fields, *StructType.fromDDL(fields).fields])


def in_blocks(docs: DataFrame, block_docs: int, block_bytes: int, most_rows: int) -> DataFrame:
    """The rows of ``docs``, which has ``doc_id`` and ``text``, with a long ``block`` in front.

    A block is a range of ``block_docs`` numbers, which lie near each other in the files, so that
    few tasks share it. A range whose texts hold more than ``block_bytes`` is cut by a hash of id
    and text into as many blocks as its bytes need; rows without an id are a range like others.
    Ids that are not numbers are dealt by their hash, their ranges counted from the bytes of all
    texts. The same row is always in the same block. Rows that repeat both the id and the text
    are in one block. Block numbers may meet by hash, which makes a block larger and no more.
    """
    size = F.octet_length("text").cast("long")
    if isinstance(docs.schema["doc_id"].dataType, IntegralType):
        number = F.expr(f"doc_id div {block_docs}").cast("long")
    else:
        whole = docs.agg(F.sum(size)).first()[0] or 0
        number = F.pmod(F.xxhash64("doc_id"), F.lit(whole // block_bytes + 1))
        number = F.when(F.col("doc_id").isNotNull(), number)
    ranged = docs.select(F.coalesce(number, F.lit(-(2**63))).alias("range"), *docs.columns)
    bytes_of = ranged.groupBy("range").agg(F.sum(size).alias("bytes"))
    # Each holds more than ``block_bytes``, so they are few beside the texts.
    large = bytes_of.filter(F.col("bytes") > block_bytes).select(
        F.col("range").alias("large"), F.ceil(F.col("bytes") / block_bytes).alias("parts")
    )
    large = small_or_shuffled(stored(large, "large_ranges"), most_rows)
    part = F.pmod(F.xxhash64("doc_id", "text"), F.col("parts"))
    block = F.when(F.col("parts").isNull(), F.col("range")).otherwise(F.xxhash64("range", part))
    found = ranged.join(large, F.col("range") == F.col("large"), "left")
    return found.select(block.alias("block"), *docs.columns)


def few_at_once(column: pa.Array, rows: int = 512) -> Iterator:
    """Values of an Arrow column, of which few are Python objects at a time."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()


def give_back() -> None:
    """Return to the system what a task has freed. A Python worker outlives its task, and what
    it keeps is missing to the workers of the next stage on the same machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    # Only the GNU C library has this.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def compressed(df: DataFrame) -> DataFrame:
    """The rows with ``text`` as compressed bytes, for a shuffle; null and empty as null."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            at = batch.schema.names.index("text")
            packed = [
                packer.compress(t.encode("utf-8", "surrogatepass")) if t else None
                for t in few_at_once(batch.column(at))
            ]
            arrays = list(batch.columns)
            arrays[at] = pa.array(packed, pa.binary())
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    fields = [
        StructField("text", BinaryType()) if f.name == "text" else f for f in df.schema.fields
    ]
    return df.mapInArrow(pack, StructType(fields))


def decompressed(packed: list[bytes | None]) -> Iterator[str | None]:
    """The texts of ``compressed``, one after another."""
    unpacker = zstandard.ZstdDecompressor()
    for one in packed:
        yield unpacker.decompress(one).decode("utf-8", "surrogatepass") if one else None
