"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters the contracts name.
BLANK = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where none is set, a temporary one on a local
    master, whose driver and executor are one process, and an error on any other."""
    if base := spark.conf.get("spark.checkpoint.dir", None):
        return base.rstrip("/")
    set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if set_dir.isDefined():
        return set_dir.get().rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = "file://" + tempfile.mkdtemp(prefix="tessera-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


_scopes: list[list[Scratch]] = []


@contextmanager
def scratch_scope() -> Iterator[None]:
    """Deletes at its end all tables that operators called inside it have written.

    Operators return lazy results that read such tables: write or collect those before the scope ends.
    """
    opened: list[Scratch] = []
    _scopes.append(opened)
    try:
        yield
    finally:
        _scopes.remove(opened)
        for scratch in opened:
            scratch.close()


#: Rows of an Arrow batch while an operator's table is written: lists of hashes make wide rows.
BATCH_ROWS = 2_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def _short_batches(spark: SparkSession) -> Iterator[None]:
    """At most BATCH_ROWS rows in an Arrow batch, then the session's own limit again."""
    own = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, min(BATCH_ROWS, int(own)) if int(own) > 0 else BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, own)


class Scratch:
    """Tables of one operator run, written below the shared folder.

    A written table cuts the lineage and survives the loss of any executor.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/tessera-{uuid.uuid4().hex}"
        if _scopes:
            _scopes[-1].append(self)

    def save(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        writer = df.write.mode("overwrite")
        with _short_batches(self.spark):
            (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Have shuffle files of finished rounds deleted, which Spark does once the driver has collected their plans.

        Only disk depends on it: results don't, and a pass that comes too early leaves the files to the next one.
        """
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            self._delete(f"{self.root}/{name}")

    def close(self) -> None:
        """Delete all tables of the run."""
        self._delete(self.root)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: A side of a join up to this many rows is broadcast (some 16 to 60 bytes each); of larger ones only the rows of hot keys.
BROADCAST_ROWS = 200_000
#: A key with more than this share of the rows is hot. So there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1e-5


def join_unique(left: DataFrame, right: DataFrame, key: str, scratch: Scratch | None = None, most: int = BROADCAST_ROWS, share: float = HOT_SHARE) -> DataFrame:
    """Left join with ``right``, which has one row for each ``key``; no task gets all rows of a hot key.

    A ``right`` of up to ``most`` rows is broadcast. Of a longer one the rows of hot keys are, at most 1 / ``share``; the rest meets by shuffle.
    ``right`` is read more than once, so it has to be a written table. ``left`` is written where ``scratch`` is given.
    """
    if right.count() <= most:
        return left.join(F.broadcast(right), key, "left")
    if scratch:
        left = scratch.save(left, f"left_{uuid.uuid4().hex}")
    least = left.count() * share
    hot = F.broadcast(left.groupBy(key).count().filter(F.col("count") > least).select(key))
    warm = left.join(hot, key, "left_semi").join(F.broadcast(right.join(hot, key, "left_semi")), key, "left")
    return warm.unionByName(left.join(hot, key, "left_anti").join(right, key, "left"))


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow body after which the worker, which Spark uses again, keeps no memory of the task."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            del batches
            gc.collect()
            give_back()

    return body


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def text_of(name: str) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def words_of(c: Column) -> Column:
    """Maximal runs of characters that are not ASCII white space."""
    return F.filter(F.split(c, f"{BLANK}+"), lambda w: w != "")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name near ``name`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
