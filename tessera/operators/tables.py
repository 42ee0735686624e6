"""Cleaning a raw result table: decode, filter, transform, explode, require, deduplicate, in one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.terms import clean_term, compile_filter, compile_transform


@dataclass(frozen=True)
class ColumnSpec:
    """One output column: where it comes from and what is done to it.

    ``variable`` names an input column; ``value`` makes a constant instead. ``name`` is the output's.
    """

    name: str
    variable: str = ""
    transform: str = ""
    filter: str = ""
    value: str | None = None
    required: bool = False


class RunStatistics:
    """Counts of one run of ``clean_table``, gathered as its plan runs: pass a new one, run the plan once, then read ``counts``.

    rows_in, and filtered: rows that a required column's filter drops, before columns are multiplied; empty and no_key: multiplied
    rows without any value of their own, and without a required one; rows_out. missing: variables that the table doesn't have.
    """

    def __init__(self) -> None:
        self.read, self.multiplied, self.result = Observation(), Observation(), Observation()
        self.missing: list[str] = []

    @property
    def counts(self) -> dict[str, int]:
        """All figures. Adaptive execution drops the observation of a result that it finds empty, which then is 0."""
        try:
            result = self.result.get
        except Py4JJavaError:
            result = {"rows_out": 0}
        return {**self.read.get, **self.multiplied.get, **result, "missing": len(self.missing)}


def clean_table(raw: DataFrame, columns: list[ColumnSpec], decode: bool = True, distinct: bool = True, observation: Observation | None = None, statistics: RunStatistics | None = None) -> DataFrame:
    """The cleaned table of ``columns``, all strings, missing values empty.

    For each row: decode terms; test filters on the decoded value, before its transform (a required column
    that fails drops the row, another is blanked and still transformed); transform; multiply
    rows over columns that split; drop rows without any value of their own, then rows without a
    required value; drop repeated rows. A variable that ``raw`` doesn't have is empty throughout. ``observation``
    counts rows in and rows that a required column's filter drops, ``statistics`` all of a run's six figures.
    """
    have = set(raw.columns)
    if statistics is not None:
        observation = statistics.read
        statistics.missing = list(dict.fromkeys(c.variable for c in columns if c.value is None and c.variable not in have))
    value = lambda c: F.coalesce(F.col(f"`{c.variable}`").cast("string"), F.lit("")) if c.variable in have else F.lit("")
    decoded = raw.select(*((clean_term(value(c)) if decode else value(c)).alias(f"c{i}") if c.value is None else F.lit(c.value).alias(f"c{i}") for i, c in enumerate(columns)))
    keep: list[Column] = []
    shaped: list[Column] = []
    lists: list[int] = []
    for i, c in enumerate(columns):
        col = F.col(f"c{i}")
        if c.value is not None:
            shaped.append(col)
            continue
        if c.filter:
            ok = compile_filter(c.filter)(col)
            if c.required:
                keep.append(ok)
            else:
                col = F.when(ok, col).otherwise("")
        run, listed = compile_transform(c.transform)
        col = run(col)
        if listed:
            lists.append(i)
            col = F.when(F.size(col) > 0, col).otherwise(F.array(F.lit("")))
        shaped.append(col.alias(f"c{i}"))
    passes = reduce(lambda a, b: a & b, keep, F.lit(True))
    if observation is not None:
        decoded = decoded.withColumn("ok__", passes).observe(observation, F.count("*").alias("rows_in"), F.count(F.when(~F.col("ok__"), 1)).alias("filtered")).filter("ok__").drop("ok__")
    elif keep:
        decoded = decoded.filter(passes)
    out = decoded.select(*shaped)
    for i in lists:
        out = out.withColumn(f"c{i}", F.explode(f"c{i}"))
    own = [F.col(f"c{i}") != "" for i, c in enumerate(columns) if c.value is None]
    needed = [F.col(f"c{i}") != "" for i, c in enumerate(columns) if c.required]
    some, whole = reduce(lambda a, b: a | b, own, F.lit(False)), reduce(lambda a, b: a & b, needed, F.lit(True))
    if statistics is not None:
        out = out.observe(statistics.multiplied, F.count(F.when(~some, 1)).alias("empty"), F.count(F.when(some & ~whole, 1)).alias("no_key"))
    out = out.filter(some & whole).toDF(*(c.name for c in columns))
    out = out.distinct() if distinct else out
    return out.observe(statistics.result, F.count("*").alias("rows_out")) if statistics is not None else out
