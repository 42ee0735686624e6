"""Path queries over an object model whose classes are DataFrames.

A query is a root class, a view of paths, constraints on paths and a sort order. Every path
prefix becomes one join, inner where a view or a constraint needs it.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .catalog import ATTRIBUTE, Catalog

OPERATORS = ("!=", ">=", "<=", "=", ">", "<", "IS NOT NULL", "IS NULL", "NOT LIKE", "LIKE", "NOT IN", "IN")


@dataclass
class Constraint:
    path: str
    op: str
    value: object = None


@dataclass
class PathQuery:
    view: list[str]
    constraints: list[Constraint] = field(default_factory=list)
    sort: list[tuple[str, str]] = field(default_factory=list)


@dataclass(frozen=True)
class Link:
    """How a reference or collection is stored: ``on`` maps columns of the class to columns of the target, through an optional table.

    ``through``: (table, {class column: table column}, {table column: target column}).
    """

    on: tuple[tuple[str, str], ...] = ()
    through: tuple[str, tuple[tuple[str, str], ...], tuple[tuple[str, str], ...]] | None = None


def parse_constraint(text: str) -> Constraint:
    """path op value; IN lists are in parentheses, values may be quoted."""
    for op in OPERATORS:
        pad = rf"\s*{re.escape(op)}\s*" if not op[0].isalpha() else rf"\s+{op}(?:\s+|$)"
        m = re.match(rf"^\s*([\w.]+){pad}(.*)$", text, re.S | re.I)
        if m:
            raw = m[2].strip()
            if op in ("IN", "NOT IN"):
                return Constraint(m[1], op, [v.strip().strip("\"'") for v in raw.strip("()").split(",")])
            return Constraint(m[1], op, None if op.startswith("IS") else raw.strip("\"'"))
    raise ValueError(f"no operator in {text!r}")


def parse_query_xml(text: str) -> PathQuery:
    """A query element with view, sortOrder and constraint children."""
    q = ET.fromstring(text)
    q = q if q.tag == "query" else q.find(".//query")
    sort = (q.get("sortOrder") or "").split()
    return PathQuery((q.get("view") or "").split(), [Constraint(c.get("path"), c.get("op"), c.get("value")) for c in q.iter("constraint")], list(zip(sort[::2], sort[1::2], strict=False)))


def condition(c: Column, op: str, value: object) -> Column:
    """A constraint as a boolean; LIKE uses * for any text. Numbers are compared as the column's type."""
    op = op.upper()
    if op == "=":
        return c == value
    if op == "!=":
        return c != value
    if op in ("IS NULL", "IS NOT NULL"):
        return c.isNull() if op == "IS NULL" else c.isNotNull()
    if op in ("IN", "NOT IN", "ONE OF", "NONE OF"):
        return c.isin(*value) if op in ("IN", "ONE OF") else ~c.isin(*value)
    if op in ("LIKE", "NOT LIKE"):
        pattern = str(value).replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_").replace("*", "%")
        return c.like(pattern) if op == "LIKE" else ~c.like(pattern)
    return {"<": c < value, "<=": c <= value, ">": c > value, ">=": c >= value}[op]


class Mine:
    """A catalog with the tables of its classes. ``columns``: (class, attribute) -> column; ``links``: (class, field) -> Link."""

    def __init__(self, catalog: Catalog, tables: dict[str, DataFrame], columns: dict[tuple[str, str], str], links: dict[tuple[str, str], Link]):
        self.catalog, self.tables, self.columns, self.links = catalog, tables, columns, links

    def _lookup(self, cls: str, name: str, found: dict) -> object:
        for c in [cls, *self.catalog.ancestors(cls)]:
            if (c, name) in found:
                return found[c, name]
        raise ValueError(f"{cls}.{name} has no place in the tables")

    def run(self, query: PathQuery, names: list[str] | None = None) -> DataFrame:
        """The view's rows, distinct, sorted if asked; column names are paths with _ for dots, or ``names``."""
        paths = [*query.view, *(c.path for c in query.constraints), *(p for p, _ in query.sort)]
        root = paths[0].split(".")[0]
        nodes: dict[str, str] = {root: root}  # path prefix -> class
        for p in paths:
            at = root
            for owner, f in self.catalog.resolve(p):
                if f.kind != ATTRIBUTE:
                    at += "." + f.name
                    nodes[at] = f.type
                elif owner != nodes[at]:
                    raise ValueError(f"{p} doesn't start at {root}")
        needed: dict[str, set[str]] = {n: set() for n in nodes}
        for p in paths:
            node, _, attr = p.rpartition(".")
            if node in nodes:
                needed[node].add(attr)
        for n in nodes:
            if n != root:
                parent, _, name = n.rpartition(".")
                link = self._lookup(nodes[parent], name, self.links)
                needed[parent] |= {"@" + a for a, _ in (link.through[1] if link.through else link.on)}
                needed[n] |= {"@" + b for _, b in (link.through[2] if link.through else link.on)}

        def column(node: str, attr: str) -> str:
            return attr[1:] if attr.startswith("@") else self._lookup(nodes[node], attr, self.columns)

        label = lambda node, attr: f"{node}.{attr}"

        def read(node: str) -> DataFrame:
            df = self.tables[nodes[node]].select(*(F.col(column(node, a)).alias(label(node, a)) for a in sorted(needed[node])))
            tests = [condition(F.col(f"`{c.path}`"), c.op, c.value) for c in query.constraints if c.path.rpartition(".")[0] == node]
            return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df

        out = read(root)
        for n in sorted((n for n in nodes if n != root), key=lambda n: n.count(".")):
            parent, _, name = n.rpartition(".")
            link = self._lookup(nodes[parent], name, self.links)
            target = read(n)
            if link.through:
                mid_name, first, second = link.through
                mid = self.tables[mid_name].select(*(F.col(b).alias(f"{n}<{b}") for _, b in first), *(F.col(a).alias(f"{n}>{a}") for a, _ in second)).distinct()
                out = out.join(mid, reduce(lambda x, y: x & y, [F.col(f"`{label(parent, '@' + a)}`") == F.col(f"`{n}<{b}`") for a, b in first]))
                out = out.join(target, reduce(lambda x, y: x & y, [F.col(f"`{n}>{a}`") == F.col(f"`{label(n, '@' + b)}`") for a, b in second]))
            else:
                out = out.join(target, reduce(lambda x, y: x & y, [F.col(f"`{label(parent, '@' + a)}`") == F.col(f"`{label(n, '@' + b)}`") for a, b in link.on]))
        order = [F.col(f"`{p}`").asc() if d.lower() == "asc" else F.col(f"`{p}`").desc() for p, d in query.sort]
        shown = list(dict.fromkeys([*query.view, *(p for p, _ in query.sort)]))
        out = out.select(*(F.col(f"`{p}`") for p in shown)).distinct()
        if order:
            out = out.orderBy(*order)
        return out.select(*(F.col(f"`{p}`").alias(n) for p, n in zip(query.view, names or [p.replace(".", "_") for p in query.view], strict=True)))


@dataclass
class Template:
    """A stored query with editable constraints."""

    title: str
    query: PathQuery
    editable: tuple[int, ...] = (0,)

    def with_values(self, *values: object) -> PathQuery:
        cs = [Constraint(c.path, c.op, c.value) for c in self.query.constraints]
        for i, v in zip(self.editable, values, strict=False):
            cs[i].value = v
        return PathQuery(self.query.view, cs, self.query.sort)


def listing(templates: dict[str, Template]) -> list[dict[str, object]]:
    """What a service lists of its templates: name, title, view, and of each editable constraint its place, path, operator and default."""
    asked = lambda t: [{"place": i, "path": t.query.constraints[i].path, "op": t.query.constraints[i].op, "value": t.query.constraints[i].value} for i in t.editable]
    return [{"name": n, "title": t.title, "view": list(t.query.view), "constraints": asked(t)} for n, t in sorted(templates.items())]
