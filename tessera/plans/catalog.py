"""The object model: classes with multiple inheritance, fields, keys; and path resolution over it."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .written import written

ATTRIBUTE, REFERENCE, COLLECTION = "attribute", "reference", "collection"
#: Fields preferred as a class's key, in this order, where it has several keys.
PREFERRED = ("primaryIdentifier", "identifier", "primaryAccession", "name", "symbol")


@dataclass
class Field:
    name: str
    kind: str = ATTRIBUTE
    type: str = "java.lang.String"
    reverse: str = ""
    term: str = ""


@dataclass
class ClassDef:
    name: str
    extends: list[str] = field(default_factory=list)
    fields: dict[str, Field] = field(default_factory=dict)
    keys: list[list[str]] = field(default_factory=list)
    term: str = ""


class Catalog:
    """Classes by name. Declaring a class or field again adds to it: the first type stays, gaps are filled."""

    def __init__(self, classes: Iterable[ClassDef] = ()):
        self.classes: dict[str, ClassDef] = {}
        for c in classes:
            self.declare(c)

    def declare(self, new: ClassDef) -> None:
        old = self.classes.setdefault(new.name, ClassDef(new.name))
        old.extends += [x for x in new.extends if x not in old.extends]
        old.term = old.term or new.term
        old.keys += [k for k in new.keys if k not in old.keys]
        for f in new.fields.values():
            own = old.fields.setdefault(f.name, Field(f.name, f.kind, f.type, f.reverse, f.term))
            own.reverse, own.term = own.reverse or f.reverse, own.term or f.term

    def load_xml(self, text: str) -> Catalog:
        """Classes of a model document: class elements with attribute, reference and collection children."""
        for c in ET.fromstring(text).iter("class"):
            made = ClassDef(c.get("name", ""), [x.rpartition(".")[2] for x in (c.get("extends") or "").split() if x], term=c.get("term", ""))
            for e in c:
                if e.tag in (ATTRIBUTE, REFERENCE, COLLECTION):
                    kind = e.get("type") if e.tag == ATTRIBUTE else (e.get("referenced-type") or "").rpartition(".")[2]
                    made.fields[e.get("name", "")] = Field(e.get("name", ""), e.tag, kind or "java.lang.String", e.get("reverse-reference", ""), e.get("term", ""))
            self.declare(made)
        return self

    def load_keys(self, text: str) -> Catalog:
        """Lines Class.key[_name] = field[, field]; classes that aren't declared are left out."""
        for line in text.splitlines():
            m = re.match(r"\s*(\w+)\.key(?:_\w+)?\s*=\s*(.+?)\s*$", line)
            if m and m[1] in self.classes:
                names = [x.strip() for x in m[2].split(",") if x.strip()]
                if names not in self.classes[m[1]].keys:
                    self.classes[m[1]].keys.append(names)
        return self

    def ancestors(self, name: str) -> list[str]:
        """Nearest first, each once, whatever cycles there are."""
        out, front = [], list(self.classes[name].extends) if name in self.classes else []
        while front:
            following: list[str] = []
            for c in front:
                if c != name and c not in out and c in self.classes:
                    out.append(c)
                    following += self.classes[c].extends
            front = following
        return out

    def descendants(self, name: str) -> list[str]:
        return [c for c in self.classes if name in self.ancestors(c)]

    def is_a(self, name: str, other: str) -> bool:
        return name == other or other in self.ancestors(name)

    def all_fields(self, name: str) -> dict[str, Field]:
        """Own and inherited fields, the farthest ancestor's first; of one name the nearest declaration."""
        out: dict[str, Field] = {}
        for c in [*reversed(self.ancestors(name)), name]:
            out.update(self.classes[c].fields if c in self.classes else {})
        return out

    def keys_for(self, name: str) -> list[list[str]]:
        """Keys of the nearest class that declares any."""
        for c in [name, *self.ancestors(name)]:
            if c in self.classes and self.classes[c].keys:
                return self.classes[c].keys
        return []

    def key_attributes(self, name: str) -> list[str]:
        """Attributes that alone identify an object, preferred ones first; without a key, a preferred attribute."""
        known = self.all_fields(name)
        single = [k[0] for k in self.keys_for(name) if k[0] in known and known[k[0]].kind == ATTRIBUTE]
        if not single:
            single = [p for p in PREFERRED if p in known and known[p].kind == ATTRIBUTE][:1]
        rank = {p: i for i, p in enumerate(PREFERRED)}
        return sorted(dict.fromkeys(single), key=lambda k: rank.get(k, len(rank)))

    def resolve(self, path: str) -> list[tuple[str, Field]]:
        """(owner class, field) of each step of Class.field.field; an attribute ends a path."""
        head, *steps = path.split(".")
        if head not in self.classes:
            raise ValueError(f"unknown class {head!r} in {path!r}")
        out, cls = [], head
        for i, s in enumerate(steps):
            f = self.all_fields(cls).get(s)
            if f is None:
                raise ValueError(f"{cls} has no field {s!r} in {path!r}")
            if f.kind == ATTRIBUTE and i < len(steps) - 1:
                raise ValueError(f"attribute {s!r} can't be followed in {path!r}")
            out.append((cls, f))
            cls = f.type
        return out

    def implicit_link(self, root: str, cls: str) -> str | None:
        """The first reference or collection of ``root`` whose range is ``cls`` or one of its ancestors."""
        return next((f.name for f in self.all_fields(root).values() if f.kind != ATTRIBUTE and self.is_a(cls, f.type)), None)

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        """The catalog as DataFrames: classes, extends, fields, keys."""
        return {
            "classes": spark.createDataFrame([(c.name, c.term) for c in self.classes.values()], "cls string, term string"),
            "extends": spark.createDataFrame([(c.name, x) for c in self.classes.values() for x in c.extends], "cls string, parent string"),
            "fields": spark.createDataFrame([(c.name, f.name, f.kind, f.type, f.reverse) for c in self.classes.values() for f in c.fields.values()], "cls string, field string, kind string, type string, reverse string"),
            "keys": spark.createDataFrame([(c.name, i, ",".join(k)) for c in self.classes.values() for i, k in enumerate(c.keys)], "cls string, key_no int, fields string"),
        }


def closure(edges: DataFrame, child: str, parent: str, alone: DataFrame | None = None) -> DataFrame:
    """(child, ancestor, depth) with the shortest depth, each node its own ancestor at depth 0, and so each of ``alone``'s only column.

    Reach doubles each round: a shortest path of more than ``reach`` edges begins with one of just ``reach``, so only pairs that far
    apart are followed, by all known pairs. It ends where no two nodes are so far apart: cycles end, and a chain of a
    thousand nodes takes ten rounds. Each round's new pairs are written, so every pair is written once.
    """
    e = edges.select(F.col(child).alias("child"), F.col(parent).alias("ancestor")).distinct()
    nodes = e.select("child").union(e.select("ancestor"))
    nodes = (nodes.union(alone) if alone is not None else nodes).distinct()
    depth = lambda n: F.lit(n).cast("long").alias("depth")
    far = e.filter(~F.col("child").eqNullSafe(F.col("ancestor"))).select("child", "ancestor", depth(1))
    known = new = written(nodes.select("child", F.col("child").alias("ancestor"), depth(0)).union(far))
    reach = 1
    while not (front := new.filter(F.col("depth") == reach)).isEmpty():
        on = known.select(F.col("child").alias("via"), F.col("ancestor").alias("end"), F.col("depth").alias("more")).filter("more > 0")
        step = front.withColumnRenamed("ancestor", "via").join(on, "via").select("child", F.col("end").alias("ancestor"), (F.col("depth") + F.col("more")).alias("depth"))
        # Known pairs are no farther apart than ``reach``, so those whose least depth is beyond it are new. The pairs hardly
        # repeat: they are dealt out before they are grouped, else a task would hold those of a whole file.
        pairs = known.union(step).repartition("child", "ancestor")
        new = written(pairs.groupBy("child", "ancestor").agg(F.min("depth").alias("depth")).filter(F.col("depth") > reach))
        known, reach = known.union(new), 2 * reach
    return known


def inherited_fields(tables: dict[str, DataFrame]) -> DataFrame:
    """(cls, field, kind, type, declared_in) of own and inherited fields, the nearest declaration of each."""
    edges = tables["extends"].select(F.col("cls").alias("c"), F.col("parent").alias("p"))
    up = closure(edges, "c", "p", tables["classes"].select("cls"))
    fields = tables["fields"].withColumnRenamed("cls", "ancestor")
    return up.join(fields, "ancestor").groupBy(F.col("child").alias("cls"), "field").agg(F.min_by(F.struct("kind", "type", F.col("ancestor").alias("declared_in")), F.struct("depth", "ancestor")).alias("f")).select("cls", "field", "f.*")
