"""The object graph of a source: cleaned tables and their mapping rows to merged, linked and numbered items."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.terms import fits_type
from ..plans.catalog import ATTRIBUTE, COLLECTION, Catalog
from ..plans.resolve import MappingRow, query_rows, tables_of
from .items import identity, numbered

ITEM = "struct<cls:string,key_field:string,key_value:string>"


@dataclass(frozen=True)
class Group:
    """Columns of a row that make one object: (field, column) pairs of one class, reached through ``via``."""

    cls: str
    via: str
    columns: tuple[tuple[str, Column], ...]
    constants_only: bool


def groups_of(rows: list[MappingRow], table: str, root: str, catalog: Catalog) -> list[Group]:
    """Groups of a table's columns; columns of the root class or an ancestor without a link are the root's own.

    Of two columns of one group with the same field the later one counts.
    """
    found: dict[tuple[str, str], dict[str, tuple[Column, bool]]] = {}
    for i, r in enumerate(query_rows(rows, table)):
        own = not r.via and catalog.is_a(root, r.im_class) if root in catalog.classes else r.im_class == root
        key = (root, "") if own else (r.im_class, r.via)
        found.setdefault(key, {})[r.im_field] = (F.col(f"c{i}"), r.kind == "const")
    return [Group(cls, via, tuple((f, c) for f, (c, _) in fields.items()), all(k for _, k in fields.values())) for (cls, via), fields in found.items()]


def _item(g: Group, catalog: Catalog) -> Column:
    """Identity from all raw values; null where only constants or nothing has one, unless the group is constants only."""
    keys = catalog.key_attributes(g.cls) if g.cls in catalog.classes else []
    return identity(g.cls, keys, dict(g.columns))


def object_graph(tables: dict[str, DataFrame], rows: list[MappingRow], root: str, catalog: Catalog, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(attributes, links) of a source's cleaned ``tables``, whose columns are in the order of their mapping rows.

    attributes: item, field, value: of each the first non-empty value by (table, ``order`` column or the row's values).
    Values that don't parse as the field's type are dropped after identity is decided.
    links: src, field, dst, many: forward and reverse. A single reference keeps its last target, a collection each once; an
    object isn't linked to itself, and links that the model doesn't have are left out.
    """
    attrs, links = [], []
    for n, t in enumerate(t for t in tables_of(rows) if t in tables):
        df = tables[t]
        place = F.struct(F.lit(n).alias("t"), (F.col(f"`{order}`") if order else F.xxhash64(*(f"`{c}`" for c in df.columns))).cast("long").alias("r"))
        cols = [c for c in df.columns if c != order]
        df = df.select(place.alias("ord"), *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(f"c{i}") for i, c in enumerate(cols)))
        groups = groups_of(rows, t, root, catalog)
        items = {(g.cls, g.via): _item(g, catalog) for g in groups}
        for g in groups:
            declared = catalog.all_fields(g.cls) if g.cls in catalog.classes else {}
            good = lambda f, c: (c != "") & (fits_type(c, declared[f].type) if f in declared else F.lit(True))
            pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.when(good(f, c), c).alias("value")) for f, c in g.columns))
            attrs.append(df.select(items[g.cls, g.via].alias("item"), "ord", F.explode(pairs).alias("p")).filter("item IS NOT NULL").select("item", "p.field", "p.value", "ord"))
            source = (root, "")
            name = g.via.rpartition(".")[2] or (catalog.implicit_link(root, g.cls) if g.cls != root and root in catalog.classes else None)
            owner = g.via.rpartition(".")[0]
            if owner and owner != root:
                source = next((k for k in items if catalog.is_a(k[0], owner) and k != (g.cls, g.via)), source)
            if not name or (g.cls, g.via) == source or source not in items or source[0] not in catalog.classes:
                continue
            f = catalog.all_fields(source[0]).get(name)
            if f is None or f.kind == ATTRIBUTE:
                continue
            edge = df.select(items[source].alias("src"), items[g.cls, g.via].alias("dst"), "ord").filter("src IS NOT NULL AND dst IS NOT NULL AND src <> dst")
            links.append(edge.select("src", F.lit(name).alias("field"), "dst", F.lit(f.kind == COLLECTION).alias("many"), "ord"))
            back = catalog.all_fields(g.cls).get(f.reverse) if f.reverse and g.cls in catalog.classes else None
            if back is not None:
                links.append(edge.select(F.col("dst").alias("src"), F.lit(back.name), F.col("src").alias("dst"), F.lit(back.kind == COLLECTION), "ord"))
    spark = next(iter(tables.values())).sparkSession
    every = reduce(DataFrame.unionByName, attrs) if attrs else spark.createDataFrame([], f"item {ITEM}, field string, value string, ord struct<t:int,r:long>")
    merged = every.groupBy("item", "field").agg(F.min_by("value", F.when(F.col("value").isNotNull(), F.col("ord"))).alias("value"))
    if not links:
        return merged, spark.createDataFrame([], f"src {ITEM}, field string, dst {ITEM}, many boolean")
    edges = reduce(DataFrame.unionByName, [x.toDF("src", "field", "dst", "many", "ord") for x in links])
    single = edges.filter("NOT many").groupBy("src", "field").agg(F.max_by("dst", "ord").alias("dst")).select("src", "field", "dst", F.lit(False).alias("many"))
    return merged, edges.filter("many").select("src", "field", "dst", "many").distinct().unionByName(single)


def number_graph(attributes: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(no, cls, attrs) and (src_no, field, dst_no, many) as the items writer takes them; numbers by class and key."""
    items = attributes.groupBy("item").agg(F.map_from_entries(F.collect_list(F.when(F.col("value").isNotNull(), F.struct("field", "value")))).alias("attrs"))
    no = numbered(items.select("item", "attrs"), [F.col("item")], "no")
    key = no.select("item", "no")
    out = links.join(key.select(F.col("item").alias("src"), F.col("no").alias("src_no")), "src").join(key.select(F.col("item").alias("dst"), F.col("no").alias("dst_no")), "dst")
    return no.select("no", F.col("item.cls").alias("cls"), "attrs"), out.select("src_no", "field", "dst_no", "many")


def hierarchy_rollup(links: DataFrame, closure: DataFrame) -> DataFrame:
    """(src, dst) of links to a node and to all its ancestors; ``closure``: child, ancestor."""
    up = closure.select(F.col("child").alias("dst"), "ancestor")
    return links.select("src", "dst").join(up, "dst").select("src", F.col("ancestor").alias("dst")).distinct()
