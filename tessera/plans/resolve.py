"""Mapping resolution: which class a subject is and which field a predicate fills, by tiers of rules.

Every tier yields a candidate or nothing, and the first that yields decides. The same cascade over
DataFrames of candidates is operators.integrate.cascade; this one works on a schema, which is small.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field, fields, replace

from ..operators.tables import ColumnSpec
from .catalog import ATTRIBUTE, Catalog
from .schema import Predicate, Subject, TreeNode, expand, parse_outline, walk

LOADABLE = ("sure", "guess", "human")
#: The predicate of a row that stands for the subject's own IRI.
SELF = "-self-"


@dataclass(frozen=True)
class SubjectRule:
    im_class: str
    type: str = ""
    source: str = ""
    subject: str = ""
    role: str = ""
    status: str = "guess"


@dataclass(frozen=True)
class PredicateRule:
    pred: str
    im: str = ""
    cls: str = ""
    source: str = ""
    subject: str = ""
    column: str = ""
    status: str = "guess"
    transform: str = ""
    filter: str = ""
    value: str = ""
    required: str = ""
    table: str = ""
    #: Constants that come with the column: (Class.field, value, the link Class.field that they hang off, or nothing).
    consts: tuple[tuple[str, str, str], ...] = ()


@dataclass
class Rules:
    subjects: list[SubjectRule] = field(default_factory=list)
    predicates: list[PredicateRule] = field(default_factory=list)
    prefixes: dict[str, str] = field(default_factory=dict)
    #: Constants of a source: (Class.field, value).
    constants: list[tuple[str, str]] = field(default_factory=list)

    @classmethod
    def load(cls, text: str) -> Rules:
        """Rules of an outline with ``prefixes`` (a map), ``subjects`` and ``predicates`` (lists of maps) and ``consts`` (Class.field: value).

        A subject's keys are type or source and subject, im_class, role, status; a predicate's pred, im, class, source, subject, column,
        status, transform, filter, value, required, table, const (Class.field: value) and const_via (Class.field: the link). Notes and
        other keys are passed over; a rule without its im_class or pred is an error.
        """
        data = parse_outline(text) or {}
        known = lambda kind: {f.name for f in fields(kind)}
        out = cls(prefixes={str(k): str(v) for k, v in (data.get("prefixes") or {}).items()}, constants=[(str(k), str(v)) for k, v in (data.get("consts") or {}).items()])
        for r in data.get("subjects") or []:
            if "im_class" not in r:
                raise ValueError(f"subject rule without im_class: {r}")
            out.subjects.append(SubjectRule(**{k: str(v) for k, v in r.items() if k in known(SubjectRule)}))
        for r in data.get("predicates") or []:
            if "pred" not in r:
                raise ValueError(f"predicate rule without pred: {r}")
            via = r.get("const_via") or {}
            consts = tuple((str(k), str(v), str(via.get(k) or "")) for k, v in (r.get("const") or {}).items())
            plain = {k: str(v) for k, v in r.items() if k in known(PredicateRule) - {"consts", "cls"} and v is not None}
            out.predicates.append(PredicateRule(**plain, cls=str(r.get("class") or ""), consts=consts))
        return out


@dataclass
class MappingRow:
    subject: str
    predicate: str
    column: str
    kind: str
    im_class: str = ""
    im_field: str = ""
    via: str = ""
    status: str = "todo"
    basis: str = ""
    required: str = ""
    table: str = "main"
    transform: str = ""
    filter: str = ""
    value: str = ""
    multi: bool = False
    note: str = ""
    consts: tuple[tuple[str, str, str], ...] = ()

    @property
    def key(self) -> tuple[str, str, str]:
        return self.subject, self.predicate, self.column

    @property
    def loadable(self) -> bool:
        return self.status in LOADABLE and bool(self.im_class and self.im_field)


def norm(iri: str) -> str:
    """A form in which http and https, and X:1 and X_1, are the same."""
    return re.sub(r"([A-Za-z]+):(\d+)$", r"\1_\2", re.sub(r"^https://", "http://", iri))


def _first(candidates: Iterable) -> object:
    return next((c for c in candidates if c is not None), None)


class Resolver:
    """Resolves a source's schema against an object model."""

    def __init__(self, catalog: Catalog, rules: Rules, source: str, prefixes: dict[str, str]):
        self.catalog, self.rules, self.source = catalog, rules, source
        self.prefixes = rules.prefixes | prefixes  # the source's own come first
        self.terms = {norm(c.term): c.name for c in catalog.classes.values() if c.term}

    def iri(self, curie: str) -> str:
        return norm(expand(str(curie), self.prefixes))

    def bind(self, s: Subject) -> tuple[str, str, str]:
        """(class, status, tier): rule by name, class term, rule by type, class of the same name, todo."""
        types = {self.iri(t) for t in s.types}
        own = lambda r: r.source in ("", self.source)
        return _first(
            [
                next(((r.im_class, r.status, "rule by name") for r in self.rules.subjects if r.source == self.source and r.subject == s.name), None),
                next(((self.terms[t], "sure", "term") for t in sorted(types) if t in self.terms), None),
                next(((r.im_class, r.status, "rule by type") for r in self.rules.subjects if own(r) and r.type and self.iri(r.type) in types), None),
                (s.name, "sure", "name") if s.name in self.catalog.classes else None,
                ("", "todo", ""),
            ]
        )

    def role(self, s: Subject, given: dict[str, str]) -> str:
        """What a person set, then what a rule says, then nothing."""
        types = {self.iri(t) for t in s.types}
        by_rule = next((r.role for r in self.rules.subjects if r.role and (r.source == self.source and r.subject == s.name or r.type and r.source in ("", self.source) and self.iri(r.type) in types)), "")
        return given.get(s.name, "") or by_rule

    def _rule(self, node: TreeNode, p: Predicate, column: str, specific: bool) -> dict | None:
        iri = self.iri(p.curie)
        for r in self.rules.predicates:
            fits = self.iri(r.pred) == iri and bool(r.source or r.subject) == specific and r.source in ("", self.source)
            fits = fits and r.subject in ("", node.subject.name) and r.column in ("", column)
            if fits and (not r.cls or node.im_class and self.catalog.is_a(node.im_class, r.cls)):
                cls, _, name = r.im.partition(".")
                if cls and node.im_class and self.catalog.is_a(node.im_class, cls):
                    cls = node.im_class  # the concrete class for its ancestor
                return {"im_class": cls, "im_field": name, "status": r.status, "basis": "rule", "transform": r.transform, "filter": r.filter, "value": r.value, "required": r.required, "table": r.table or "main", "consts": r.consts}
        return None

    def subject_row(self, node: TreeNode, rows: list[MappingRow]) -> MappingRow:
        """The column of the subject's own IRI: as a rule for it says, else a root's key where no predicate carries that, else dropped.

        Rules for every subject alike don't count: an IRI is an identifier of some classes only.
        """
        out = MappingRow(node.subject.name, SELF, node.subject.name[:1].lower() + node.subject.name[1:], "iri", basis="subject")
        for r in self.rules.predicates:
            fits = r.pred == SELF and r.source in ("", self.source) and r.subject in ("", node.subject.name) and (r.source or r.subject or r.cls)
            if fits and (not r.cls or node.im_class and self.catalog.is_a(node.im_class, r.cls)):
                cls, _, name = r.im.partition(".")
                return replace(out, im_class=cls, im_field=name, status=r.status, basis="rule", transform=r.transform or "iri_localname", required=r.required, consts=r.consts)
        key = self.catalog.key_attributes(node.im_class)[:1] if node.im_class else []
        if node.parent is None and key and not any((r.im_class, r.im_field, r.via) == (node.im_class, key[0], "") for r in rows):
            return replace(out, im_class=node.im_class, im_field=key[0], status="guess", transform="iri_localname", required="yes", note="no predicate carries the key")
        return replace(out, status="drop", note="the subject's own IRI")

    def _term(self, node: TreeNode, p: Predicate, strict: bool) -> dict | None:
        iri = self.iri(p.curie)
        flat = lambda x: re.sub(r"[^a-z0-9]", "", x.rpartition("/")[2].rpartition("#")[2].lower())
        for f in self.catalog.all_fields(node.im_class).values():
            if f.term and (norm(f.term) == iri if strict else flat(f.term) == flat(iri)):
                return {"im_class": node.im_class, "im_field": f.name, "status": "sure" if strict else "guess", "basis": "term" if strict else "loose term"}
        return None

    def _name(self, node: TreeNode, p: Predicate, column: str) -> dict | None:
        local = re.sub(r"^.*[:/#]", "", p.curie)
        hit = next((f for f in self.catalog.all_fields(node.im_class).values() if f.kind == ATTRIBUTE and f.name.lower() in (local.lower(), column.lower())), None)
        return hit and {"im_class": node.im_class, "im_field": hit.name, "status": "guess", "basis": "name"}

    def row(self, node: TreeNode, p: Predicate, column: str, kind: str) -> MappingRow:
        """A predicate's field: source rule, strict term, generic rule, loose term, name, todo."""
        out = MappingRow(node.subject.name, p.curie, column, kind, multi=p.multi)
        if kind in ("link", "bnode"):
            out.status, out.basis = "link", "structure"
        known = bool(node.im_class)
        hit = _first(
            [
                self._rule(node, p, column, True),
                self._term(node, p, True) if known and kind != "bnode" else None,
                self._rule(node, p, column, False) if known and kind != "bnode" else None,
                self._term(node, p, False) if known and kind != "bnode" else None,
                self._name(node, p, column) if known and kind in ("literal", "iri") else None,
            ]
        )
        if hit:
            out = replace(out, **hit)
        elif kind in ("literal", "iri"):
            out.note = f"no match on {node.im_class}" if known else "subject has no class"
        if out.loadable:
            keys = self.catalog.key_attributes(node.im_class) if node.im_class else []
            if node.parent is None and out.im_class == node.im_class and keys[:1] == [out.im_field]:
                out.required = "yes"
            f = self.catalog.all_fields(out.im_class).get(out.im_field)
            if f is None:
                out.basis += "+new field"
            elif f.kind != ATTRIBUTE:
                out.via, target = f"{out.im_class}.{out.im_field}", self.catalog.key_attributes(f.type)
                out.im_class, out.im_field = f.type, target[0] if target else ""
                out.status = out.status if target else "link" if kind == "link" else "todo"
            elif out.im_class != node.im_class and node.im_class:
                link = self.catalog.implicit_link(node.im_class, out.im_class)
                out.via = out.via or (f"{node.im_class}.{link}" if link else "")
        return out

    def build(self, subjects: list[Subject], roots: list[str], roles: dict[str, str] | None = None, only_sure: bool = False) -> tuple[list[MappingRow], list[TreeNode]]:
        """Rows of all predicates reached from ``roots``, with their tables, constants and collisions resolved."""
        nodes, unreached = walk(subjects, roots)
        for n in nodes:
            n.im_class = self.bind(n.subject)[0] or (n.parent.im_class if n.parent and n.subject.name == "[]" else "")
            n.role = self.role(n.subject, roles or {}) or n.role
        rows: list[MappingRow] = []
        for n in nodes:
            for p in n.subject.predicates:
                for o in p.objects:
                    # An object whose subjects all stand elsewhere in the tree leads back: its IRI is a column.
                    kind = "bnode" if o.inline else "link" if o.subjects and (p.curie, o.name) in n.leads else "iri" if o.subjects or isinstance(o.example, str) and re.match(r"^<.*>$|^[A-Za-z][\w.-]*:\S+$", o.example) else "literal"
                    rows.append(self.row(n, p, o.name, kind))
        rows += [self.subject_row(n, rows) for n in nodes if n.subject.name != "[]"]
        assign_tables(rows, nodes)
        for r in pruned(rows, nodes):
            r.table = "drop"
        for r in [r for r in rows if r.consts and r.table != "drop"]:
            for path, value, via in r.consts:
                cls, _, name = path.partition(".")
                # The link is part of the column's name, so constants of one field that hang off different links stay apart.
                column = "_".join(x for x in ("const", cls, name, via.replace(".", "_")) if x)
                rows.append(MappingRow(r.subject, "-const-", column, "const", cls, name, via=via, status=r.status, basis="constant", table=r.table, value=value, note=f"constant for {r.column}"))
        for path, value in self.rules.constants:
            cls, _, name = path.partition(".")
            rows.append(MappingRow("*", "", name, "const", cls, name, status="sure", basis="constant", table="*", value=value))
        split_collisions(rows)
        rows += [MappingRow(s, "", "", "skip", status="drop", table="drop", note="unreachable") for s in unreached]
        return ([r for r in rows if not only_sure or r.status != "guess"]), nodes


def assign_tables(rows: list[MappingRow], nodes: list[TreeNode]) -> None:
    """A table of its own for every branch of many values, so that branches don't multiply each other.

    Rows that aren't mapped have one too, so that a person who maps one needs to give its field only.
    """
    by = {n.subject.name: n for n in nodes}
    for r in rows:
        n = by[r.subject]
        if n.role == "skip":
            r.table = "drop"
        elif r.table == "main":
            prefix = "" if sum(x.parent is None for x in nodes) < 2 else f"{n.root}_"
            at, branch = n, ""
            while at.parent:
                if at.via.multi:
                    branch = at.subject.name if at.subject.name != "[]" else re.sub(r"\W+", "_", at.via.curie)
                at = at.parent
            if r.multi and not branch:
                branch = r.column
            r.table = prefix + (branch or "main")


def pruned(rows: list[MappingRow], nodes: list[TreeNode]) -> list[MappingRow]:
    """Rows of subjects below one that is skipped."""
    gone: set[int] = set()
    for n in nodes:  # breadth first, so parents come before
        if n.role == "skip" or n.parent and id(n.parent) in gone:
            gone.add(id(n))
    names = {n.subject.name for n in nodes if id(n) in gone}
    return [r for r in rows if r.subject in names]


def split_collisions(rows: list[MappingRow]) -> None:
    """Of columns that write one field of one object in one table, the first stays; later ones get tables _2, _3."""
    seen: dict[tuple, int] = {}
    for r in rows:
        if r.loadable and r.kind != "const" and r.table not in ("drop", "*"):
            k = (r.table, r.im_class, r.via, r.im_field)
            seen[k] = seen.get(k, 0) + 1
            if seen[k] > 1:
                r.table = f"{r.table}_{seen[k]}"


def tables_of(rows: list[MappingRow]) -> list[str]:
    return list(dict.fromkeys(r.table for r in rows if r.loadable and r.table not in ("drop", "*")))


def query_rows(rows: list[MappingRow], table: str) -> list[MappingRow]:
    """A table's own columns, the required ones of live tables, and constants; empty if only keys would be left."""
    live = set(tables_of(rows))
    own = [r for r in rows if r.loadable and r.table == table]
    if not own or table != "main" and all(r.required == "yes" for r in own):
        return []
    keys = [r for r in rows if r.loadable and r.required == "yes" and r.table in live]
    constants = [r for r in rows if r.loadable and r.table == "*"]
    return list({r.key + (r.im_class, r.im_field): r for r in [*keys, *own, *constants]}.values())


def specs_of(rows: list[MappingRow], table: str) -> list[ColumnSpec]:
    """The cleaning specification of a table; names are Class.field, numbered where they repeat."""
    out: list[ColumnSpec] = []
    used: dict[str, int] = {}
    for r in query_rows(rows, table):
        name = f"{r.im_class}.{r.im_field}"
        used[name] = used.get(name, 0) + 1
        name = name if used[name] == 1 else f"{name}~{used[name]}"
        out.append(ColumnSpec(name, r.column, r.transform, r.filter, r.value if r.kind == "const" else None, r.required == "yes"))
    return out


def unique_variables(names: list[str]) -> list[str]:
    """x, x2, x3 for repeated names."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        seen[n] = seen.get(n, 0) + 1
        out.append(n if seen[n] == 1 else f"{n}{seen[n]}")
    return out
