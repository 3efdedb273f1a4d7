"""Intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``. Only a local session without that
    setting gets a folder of its own; a cluster session must name a shared one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="ledgertalk-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_folder(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{scratch_root(spark)}/ledgertalk/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_folder(spark)}/{uuid.uuid4().hex}/{name}"


def discard(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables once its outputs are written."""
    discard(spark, scratch_folder(spark))


# Fixed value: Spark's switch for removing the shuffle files of a query when it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_discarded(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when the write has ended. Otherwise they stay until
    the driver happens to collect its garbage, and those of all steps of a run add up."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write once, read back: consumers share one computation, prune columns from
    parquet, and a lost executor re-reads a file instead of replaying the lineage.

    Without ``path`` the table goes to the shared scratch folder.
    """
    path = path or scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite") -> DataFrame:
    """``stored`` for tables that grow with the input: denser files, and no shuffle file stays."""
    path = path or scratch_path(df.sparkSession, name)
    with shuffles_discarded(df.sparkSession):
        df.write.mode(mode).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Work on tables of more than ``ROUND_BYTES`` is done in ``ROUNDS`` parts, unless a step asks for more.
ROUNDS = 4
ROUND_BYTES = 32 << 20

# A condition on key columns that holds for the rows of one round.
Chosen = Callable[..., Column]


def rounds(table: DataFrame, n: int = ROUNDS) -> Iterator[Chosen]:
    """Conditions that deal rows out by their keys, so that the shuffle files of one part of the
    work are gone before those of the next are written. Rows of equal keys are of one round, a
    table of little size is one round. ``table`` is the scan that decides."""
    size = int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    n = n if size > ROUND_BYTES else 1

    def chosen(nth: int) -> Chosen:
        return lambda *keys: F.pmod(F.xxhash64(*keys, F.lit("round")), F.lit(n)) == nth if n > 1 else F.lit(True)

    for nth in range(n):
        yield chosen(nth)


def in_rounds(table: DataFrame, *keys: str, n: int = ROUNDS) -> Iterator[DataFrame]:
    """The rows of ``table`` by ``rounds``."""
    return (table.filter(chosen(*keys)) for chosen in rounds(table, n))


class Shelf:
    """Packed tables by name, each dropped once the tables made from it are written.

    A table that a cached property holds is kept under that property's name: dropped, it is made
    again if it is asked for again. Plans that still read a table must have run before its drop.
    """

    def keep(self, df: DataFrame, name: str, path: str | None = None) -> DataFrame:
        return self.keep_in_rounds([df], name, path)

    def keep_in_rounds(
        self, parts: Iterable[DataFrame], name: str, path: str | None = None
    ) -> DataFrame:
        """One table of the parts, each written before the next is made."""
        mode = "overwrite"
        for part in parts:
            path = path or scratch_path(part.sparkSession, name)
            table = packed(part, name, path, mode)
            mode = "append"
        self.__dict__.setdefault("_kept_at", {})[name] = (table.sparkSession, path)
        return table

    def drop(self, *names: str) -> None:
        for name in names:
            self.__dict__.pop(name, None)
            discard(*self._kept_at.pop(name))
