"""Objects of several sources that are one because they agree in any declared key; the contract of loading them.

A source loads whole or not at all: two of its objects that agree in a key are a violation, and the source is refused.
Of what loads, objects that agree in a key, directly or over others, are merged; fields take the value of the best-ranked
source, differing values of sources of one rank are conflicts, and every value keeps its source.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.written import written
from .integrate import by_priority


@dataclass
class Loaded:
    """What a load makes: objects (obj, fields, <field>_source, <field>_conflict, n_rows), members (row_id, obj),
    violations (rule, source, subject, n), provenance (obj, field, source, value)."""

    objects: DataFrame
    members: DataFrame
    violations: DataFrame
    provenance: DataFrame


def key_values(rows: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """(row_id, source, key, value) of the declared keys, name -> fields: a key counts where all its fields have a value."""
    parts = []
    for name, fields in keys.items():
        full = reduce(lambda a, b: a & b, (F.col(f).isNotNull() & (F.col(f).cast("string") != "") for f in fields))
        value = F.to_json(F.array(*(F.col(f).cast("string") for f in fields)))
        parts.append(F.when(full, F.struct(F.lit(name).alias("key"), value.alias("value"))))
    found = rows.select("row_id", "source", F.explode(F.array_compact(F.array(*parts))).alias("k"))
    return found.select("row_id", "source", "k.key", "k.value")


def equivalence_classes(pairs: DataFrame) -> DataFrame:
    """(node, least): each node of ``pairs`` (a, b) with the smallest node it is connected to.

    Rounds of two steps: each node hands its larger neighbours, then its smaller ones, to the smallest it sees, until
    nothing changes, after about as many rounds as the number of nodes has digits in base two. Steps are minimums and
    joins, so a node that very many pairs have is never gathered; each round is written.
    """
    both = pairs.select("a", "b").union(pairs.select("b", "a")).filter("a <> b").distinct()
    now, seen = written(both), None
    while True:
        least = now.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        up = now.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = up.groupBy("a").agg(F.min("b").alias("m"))
        down = up.join(least, "a")
        stars = written(down.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b"))).distinct())
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("least")).union(stars.select("b", "b")).distinct()
        now, seen = stars.union(stars.select("b", "a")), state


def duplicate_keys(found: DataFrame) -> DataFrame:
    """(rule, source, subject, n): keys that several objects of one source have; subject is key=value."""
    groups = found.groupBy("source", "key", "value").agg(F.count_distinct("row_id").alias("n")).filter("n > 1")
    return groups.select(F.lit("duplicate key").alias("rule"), "source", F.concat_ws("=", "key", "value").alias("subject"), "n")


def load(rows: DataFrame, keys: dict[str, list[str]], fields: list[str], ranks: dict[str, dict[str, int]] | dict[str, int], order: Column | None = None) -> Loaded:
    """Merge ``rows`` (row_id: long, unique; source; key fields; fields) into objects.

    An object's number is its smallest row_id. Rows without any key are objects of their own. ``ranks`` as in ``by_priority``:
    sources without a rank share the last one, so their differing values conflict; values of one rank go by ``order``, by
    default row_id. Links of rows over a key are stars around its smallest row, so a value that very many rows share
    makes a link for each row. Fields and keys may hold nulls and empty texts, which are no values.
    """
    rows = written(rows)
    found = written(key_values(rows, keys))
    doubled = written(duplicate_keys(found))
    refused = doubled.select("source").distinct()
    kept, held = rows.join(refused, "source", "left_anti"), found.join(refused, "source", "left_anti")
    heads = held.groupBy("key", "value").agg(F.min("row_id").alias("head"), F.count("*").alias("n")).filter("n > 1").select("key", "value", "head")
    stars = held.join(heads, ["key", "value"]).filter("row_id <> head").select(F.col("row_id").alias("a"), F.col("head").alias("b")).distinct()
    classes = equivalence_classes(stars)
    members = written(kept.select("row_id").join(classes.withColumnRenamed("node", "row_id"), "row_id", "left").select("row_id", F.coalesce("least", "row_id").alias("obj")))
    placed = kept.join(members, "row_id")
    merged = by_priority(placed, ["obj"], fields, "source", ranks, order if order is not None else F.col("row_id"))
    objects = written(merged.join(placed.groupBy("obj").agg(F.count("*").alias("n_rows")), "obj"))
    values = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields)))
    provenance = placed.select("obj", "source", values.alias("v")).filter("v.value <> ''").select("obj", "v.field", "source", "v.value").distinct()
    clashes = objects.select("obj", F.explode(F.array_compact(F.array(*(F.when(F.col(f"{f}_conflict"), F.struct(F.lit(f).alias("field"), F.col(f"{f}_source").alias("source"))) for f in fields)))).alias("c"))
    clashes = clashes.select(F.lit("conflict").alias("rule"), "c.source", F.concat_ws(".", F.col("obj").cast("string"), "c.field").alias("subject"), F.lit(1).cast("long").alias("n"))
    return Loaded(objects, members, doubled.unionByName(clashes), provenance)
