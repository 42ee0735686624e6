"""Tables that a query writes on its way, which cut the lineage and show every reader the same rows; pointer files."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share; where none is set, a temporary folder on a local master only."""
    if base := spark.conf.get("spark.checkpoint.dir", None):
        return base.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = "file://" + tempfile.mkdtemp(prefix="tessera-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


_open: list[list[str]] = []


@contextmanager
def written_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the tables that were written inside it. Collect or write lazy results that read them before."""
    made: list[str] = []
    _open.append(made)
    try:
        yield
    finally:
        _open.remove(made)
        for path in made:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def new_folder(spark: SparkSession) -> str:
    """A name below the shared folder that nothing has yet; it goes with the scope that it is asked for in."""
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table below the shared folder."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Pointer:
    """A small JSON file that says which folders of a store count, replaced in one step."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._jvm = spark, spark._jvm
        self._at = self._path(path)
        self._fs = self._at.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def read(self) -> dict | None:
        if not self._fs.exists(self._at):
            return None
        stream = self._fs.open(self._at)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def replace(self, state: dict) -> None:
        new = self._path(f"{self._at.getParent().toString()}/.{self._at.getName()}-{uuid.uuid4().hex}")
        out = self._fs.create(new, True)
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._spark._jsc.hadoopConfiguration())
        context.rename(self._fs.makeQualified(new), self._fs.makeQualified(self._at), options)
