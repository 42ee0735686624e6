"""Objects from cleaned rows: identity, merging, links both ways, ambiguity, numbering.

Order decides which value wins, so every input row carries its place: ``ord``, a struct or number that
is unique among the rows of an object. All merges are aggregates by identity, with a partial
step before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.written import written


def identity(cls: str, keys: list[str], values: dict[str, Column]) -> Column:
    """(cls, key_field, key_value): the first key attribute with a value, else all values sorted by name; null without any."""
    text = {k: F.coalesce(v.cast("string"), F.lit("")) for k, v in values.items()}
    every = F.concat_ws("|", *(F.when(text[k] != "", F.concat(F.lit(k + "="), text[k])) for k in sorted(text)))
    field, value = F.when(every != "", F.lit("*")), F.when(every != "", every)
    for k in reversed([k for k in keys if k in text]):
        field, value = F.when(text[k] != "", F.lit(k)).otherwise(field), F.when(text[k] != "", text[k]).otherwise(value)
    return F.when(value.isNotNull(), F.struct(F.lit(cls).alias("cls"), field.alias("key_field"), value.alias("key_value")))


def merge_first(rows: DataFrame, keys: list[str], attributes: list[str], order: Column, conflicts: bool = False) -> DataFrame:
    """One row per object: of each attribute the first non-empty value by ``order``.

    With ``conflicts``, also how many further distinct values each attribute had.
    """
    aggs = []
    for a in attributes:
        filled = F.col(a).isNotNull() & (F.col(a).cast("string") != "")
        aggs.append(F.min_by(F.when(filled, F.col(a)), F.when(filled, order)).alias(a))
        if conflicts:
            aggs.append(F.greatest(F.count_distinct(F.when(filled, F.col(a))) - 1, F.lit(0)).cast("long").alias(f"{a}_conflicts"))
    return rows.groupBy(*keys).agg(*aggs)


def merge_last(rows: DataFrame, keys: list[str], references: list[str], order: Column) -> DataFrame:
    """One row per object: of each reference the last non-empty target by ``order``."""
    aggs = []
    for r in references:
        filled = F.col(r).isNotNull() & (F.col(r).cast("string") != "")
        aggs.append(F.max_by(F.when(filled, F.col(r)), F.when(filled, order)).alias(r))
    return rows.groupBy(*keys).agg(*aggs)


def merge_collection(rows: DataFrame, keys: list[str], target: str, order: Column | None = None) -> DataFrame:
    """One row per object: its distinct targets, by first appearance, or sorted without ``order``."""
    filled = rows.filter(F.col(target).isNotNull())
    if order is None:
        return filled.groupBy(*keys).agg(F.sort_array(F.collect_set(target)).alias(target))
    first = filled.groupBy(*keys, target).agg(F.min(order).alias("first__"))
    return first.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("first__", target))), lambda x: x[target]).alias(target))


def both_ways(edges: DataFrame, src: str, dst: str, field: str, reverse: str) -> DataFrame:
    """(src, field, dst) of an edge table and of its reverse; links of an object to itself are skipped."""
    e = edges.select(F.col(src).cast("string").alias("src"), F.col(dst).cast("string").alias("dst")).filter("src <> dst").distinct()
    return e.select("src", F.lit(field).alias("field"), "dst").union(e.select(F.col("dst").alias("src"), F.lit(reverse).alias("field"), F.col("src").alias("dst")))


def resolve_ambiguity(objects: DataFrame, value: str, within: list[str], preferred: Column) -> DataFrame:
    """Blank ``value`` where several objects hold it, except on the only preferred holder.

    Holders are counted by an aggregate and joined back, so a value that very many objects hold is never gathered in one task.
    """
    keyed = objects.withColumn("pref__", preferred.cast("int"))
    held = keyed.filter(F.col(value).isNotNull() & (F.col(value) != ""))
    counts = held.groupBy(*within, value).agg(F.count("*").alias("holders__"), F.sum("pref__").alias("prefs__")).filter("holders__ > 1")
    out = keyed.join(counts, [*within, value], "left")
    keep = F.col("holders__").isNull() | ((F.col("prefs__") == 1) & (F.col("pref__") == 1))
    return out.withColumn(value, F.when(keep, F.col(value)).otherwise("")).select(*objects.columns)


def numbered(objects: DataFrame, order: list[Column], name: str = "item_no") -> DataFrame:
    """Dense numbers from 1 in ``order``, without sorting everything in one task.

    Rows are range-partitioned and numbered within their partition, and written so once: the ranges come from a sample, so a
    second run may cut them elsewhere. The sizes of the partitions before, one number each, are added.
    """
    placed = written(objects.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part__", F.spark_partition_id()).withColumn("pos__", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    sizes = {r.part__: r.n for r in placed.groupBy("part__").agg(F.count("*").alias("n")).collect()}
    starts, at = [], 0
    for p in sorted(sizes):
        starts.append((p, at))
        at += sizes[p]
    side = F.broadcast(objects.sparkSession.createDataFrame(starts, "part__ int, start__ long"))
    return placed.join(side, "part__", "left").withColumn(name, F.col("pos__") + F.coalesce("start__", F.lit(0)) + 1).drop("part__", "pos__", "start__")


def with_provenance(items: DataFrame, data_set: str, data_source: str) -> DataFrame:
    """Each item with its data set and source; items of these two classes stay without."""
    own = F.col("cls").isin("DataSet", "DataSource")
    return items.select("*", F.when(~own, F.lit(data_set)).alias("data_set"), F.when(~own, F.lit(data_source)).alias("data_source"))


def items_xml(items: DataFrame, links: DataFrame) -> DataFrame:
    """Lines of Items XML: ``items`` (no: long, cls, attrs: map), ``links`` (src_no, field, dst_no, many: boolean).

    Links to items that don't exist are left out, values are written in ASCII. Lines come with their order (no, place).
    """
    from ..functions.terms import to_ascii, xml_quoted

    label = lambda c: F.concat(F.lit('"0_'), c.cast("string"), F.lit('"'))
    live = links.join(items.select(F.col("no").alias("dst_no")), "dst_no", "left_semi")
    many = live.groupBy("src_no", "field", "many").agg(F.sort_array(F.collect_set("dst_no")).alias("dst"))
    element = F.when(F.col("many"), F.concat(F.lit("<collection name="), xml_quoted(F.col("field")), F.lit(">"), F.array_join(F.transform("dst", lambda d: F.concat(F.lit("<reference ref_id="), label(d), F.lit("/>"))), ""), F.lit("</collection>"))).otherwise(F.concat(F.lit("<reference name="), xml_quoted(F.col("field")), F.lit(" ref_id="), label(F.get("dst", F.size("dst") - 1)), F.lit("/>")))
    linked = many.select("src_no", "field", element.alias("x")).groupBy("src_no").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("field", "x"))), lambda e: e["x"]), "").alias("links"))
    attrs = F.array_join(F.transform(F.array_sort(F.map_entries("attrs")), lambda e: F.concat(F.lit("<attribute name="), xml_quoted(e["key"]), F.lit(" value="), xml_quoted(to_ascii(e["value"])), F.lit("/>"))), "")
    body = items.join(linked, items.no == linked.src_no, "left")
    return body.select("no", F.concat(F.lit("<item id="), label(F.col("no")), F.lit(" class="), xml_quoted(F.col("cls")), F.lit(">"), attrs, F.coalesce("links", F.lit("")), F.lit("</item>")).alias("line"))


def split_objects(rows: DataFrame, groups: dict[str, dict[str, str]], keys: dict[str, list[str]], order: Column) -> DataFrame:
    """Long items of wide rows: item (identity struct), field, value, ord.

    ``groups``: class -> {field: column}. A group whose columns are all empty makes no object in that row.
    """
    parts = []
    for cls, fields in groups.items():
        item = identity(cls, keys.get(cls, []), {f: F.col(c) for f, c in fields.items()})
        pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for f, c in fields.items()))
        parts.append(rows.select(item.alias("item"), F.explode(pairs).alias("p"), order.alias("ord")).filter("item IS NOT NULL AND p.value <> ''").select("item", "p.field", "p.value", "ord"))
    return reduce(DataFrame.unionByName, parts)


def first_per(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``, as an aggregate."""
    rest = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r__"))
    return picked.select(*keys, "r__.*")


def rank_in(rows: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Running numbers within (small) groups such as columns of a table."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
