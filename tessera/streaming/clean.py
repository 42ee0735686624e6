"""Raw result pages from a folder, cleaned as they arrive; objects merged batch by batch into a bucketed store.

The store keeps one row per object in buckets of the hash of its keys. A batch rewrites the buckets that its keys fall into
and no others, into a folder of its own; one pointer file names the folder of each bucket and is replaced in one
step, so readers see the store before or after a batch, never between, and a batch that runs again changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.items import merge_first
from ..operators.tables import ColumnSpec, clean_table
from ..plans.written import Pointer

#: Buckets of a new store. A store keeps its own number: choose about (objects at the end) / (a million).
BUCKETS = 64


def raw_stream(spark: SparkSession, folder: str, names: list[str], per_trigger: int = 100, arrival: str = "") -> DataFrame:
    """Lines of tab-separated pages (without header) as they arrive; ``arrival`` names a column for the page's time, if wanted."""
    cells = F.split("value", "\t", -1)
    lines = spark.readStream.option("maxFilesPerTrigger", per_trigger).text(folder)
    if arrival:
        lines = lines.select("value", F.col("_metadata.file_modification_time").alias(arrival))
    lines = lines.filter("value <> ''")
    return lines.select(*(F.coalesce(F.get(cells, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)), *([arrival] if arrival else []))


def clean_stream(raw: DataFrame, columns: list[ColumnSpec]) -> DataFrame:
    """The stateless part of cleaning; repeats are dropped where objects are merged."""
    return clean_table(raw, columns, distinct=False)


def once_within(stream: DataFrame, keys: list[str], arrival: str, delay: str) -> DataFrame:
    """Rows of which no equal ``keys`` came in the ``delay`` before. State goes after that time, and pages later than it are left out."""
    return stream.withWatermark(arrival, delay).dropDuplicatesWithinWatermark(keys)


class Store:
    """One row per object (keys, attributes) below ``path``; of each attribute the earliest non-empty value wins."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], attributes: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.attributes = spark, path.rstrip("/"), keys, attributes
        self._file = Pointer(spark, f"{self.path}/current.json")
        self.buckets = self.pointer()["buckets"] or buckets

    def pointer(self) -> dict:
        """The last batch (None before the first), the number of buckets, and the folder that each filled bucket is in."""
        return self._file.read() or {"batch": None, "buckets": 0, "folders": {}}

    def _point(self, state: dict) -> None:
        self._file.replace(state)

    def _schema(self) -> str:
        return ", ".join(f"`{c}` string" for c in [*self.keys, *self.attributes])

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self._schema())
        return self.spark.read.schema(self._schema()).parquet(*(f"{self.path}/{f}" for f in folders))

    def current(self) -> DataFrame:
        """The store's rows, as the last batch left them."""
        return self._read(sorted(self.pointer()["folders"].values()))

    def merge(self, batch: DataFrame, number: int) -> None:
        """Merge a batch, as foreachBatch calls it; a number that was merged already changes nothing."""
        state = self.pointer()
        if state["batch"] is not None and number <= state["batch"]:
            return
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        rows = batch.select(*(F.col(c).cast("string").alias(c) for c in [*self.keys, *self.attributes])).persist()
        try:
            touched = [str(r.b) for r in rows.select(bucket.alias("b")).distinct().collect()]
            if touched:
                old = self._read([state["folders"][b] for b in touched if b in state["folders"]])
                every = old.withColumn("new__", F.lit(0)).unionByName(rows.withColumn("new__", F.lit(1)))
                merged = merge_first(every, self.keys, self.attributes, F.struct("new__", *self.attributes))
                folder = f"batch={number}-{uuid.uuid4().hex[:8]}"
                merged.withColumn("bucket", bucket).write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        finally:
            rows.unpersist()
        if touched:
            state["folders"] |= {b: f"{folder}/bucket={b}" for b in touched}
        self._point({"batch": number, "buckets": self.buckets, "folders": state["folders"]})

    def clean(self) -> int:
        """Delete bucket folders that the pointer doesn't name, and say how many; readers that began before may need them."""
        live, gone = set(self.pointer()["folders"].values()), 0
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for batch in fs.listStatus(path(self.path)):
            name = batch.getPath().getName()
            if not name.startswith("batch="):
                continue
            for part in fs.listStatus(batch.getPath()):
                if part.isDirectory() and f"{name}/{part.getPath().getName()}" not in live:
                    fs.delete(part.getPath(), True)
                    gone += 1
        return gone


def merge_into(store: Store) -> Callable[[DataFrame, int], None]:
    """The foreachBatch function of a store."""
    return store.merge


def start(stream: DataFrame, store: Store, checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(merge_into(store)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
