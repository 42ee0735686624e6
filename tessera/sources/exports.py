"""Exports of models and mappings: schema documents, additions, project files, status reports."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from xml.sax.saxutils import quoteattr

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.terms import markdown_cell
from ..plans.catalog import ATTRIBUTE, COLLECTION, Catalog
from ..plans.resolve import MappingRow
from ..plans.schema import Subject

# Ranges of attribute types.
RANGES = {"java.lang.String": "string", "java.lang.Integer": "integer", "int": "integer", "java.lang.Double": "double", "java.lang.Boolean": "boolean"}


def schema_document(catalog: Catalog, name: str) -> dict:
    """Classes and slots of a model as a nested document."""
    classes = {}
    for c in sorted(catalog.classes):
        d = catalog.classes[c]
        slots = {}
        for f in d.fields.values():
            slot = {"range": RANGES.get(f.type, "string") if f.kind == ATTRIBUTE else f.type}
            if f.kind == COLLECTION:
                slot["multivalued"] = True
            if f.term:
                slot["slot_uri"] = f.term
            slots[f.name] = slot
        classes[c] = {k: v for k, v in (("is_a", d.extends[0] if d.extends else None), ("mixins", d.extends[1:]), ("class_uri", d.term), ("attributes", slots)) if v}
    return {"name": name, "classes": classes}


def additions_xml(rows: list[MappingRow], catalog: Catalog) -> str:
    """Fields that mappings write and the model doesn't have, as a model document; unknown classes get a parent to set."""
    new: dict[str, list[str]] = {}
    for r in rows:
        if r.loadable and r.kind != "skip" and not (r.im_class in catalog.classes and r.im_field in catalog.all_fields(r.im_class)):
            new.setdefault(r.im_class, [])
            if r.im_field not in new[r.im_class]:
                new[r.im_class].append(r.im_field)
    out = ["<classes>"]
    for c in sorted(new):
        parent = "" if c in catalog.classes else ' extends="TODO-set-parent"'
        out.append(f"  <class name={quoteattr(c)}{parent}>")
        out += [f'    <attribute name={quoteattr(f)} type="java.lang.String"/>' for f in new[c]]
        out.append("  </class>")
    return "\n".join([*out, "</classes>", ""])


def model_xml(catalog: Catalog, only: list[str] | None = None) -> str:
    """Classes of a catalog, all or some, as a model document that ``Catalog.load_xml`` reads back."""
    out = ["<classes>"]
    for c in (catalog.classes[n] for n in (only if only is not None else catalog.classes)):
        more = (f" extends={quoteattr(' '.join(c.extends))}" if c.extends else "") + (f" term={quoteattr(c.term)}" if c.term else "")
        out.append(f'  <class name={quoteattr(c.name)}{more} is-interface="true">')
        for f in c.fields.values():
            of = f"type={quoteattr(f.type)}" if f.kind == ATTRIBUTE else f"referenced-type={quoteattr(f.type)}" + (f" reverse-reference={quoteattr(f.reverse)}" if f.reverse else "")
            out.append(f"    <{f.kind} name={quoteattr(f.name)} {of}{f' term={quoteattr(f.term)}' if f.term else ''}/>")
        out.append("  </class>")
    return "\n".join([*out, "</classes>", ""])


def merged_additions(texts: list[str]) -> str:
    """The additions of several sources as one document: each class and field once, the first declaration of each."""
    every = Catalog()
    for text in texts:
        every.load_xml(text)
    return model_xml(every)


def relabelled_schema(subjects: list[Subject], rows: list[MappingRow], classes: dict[str, str]) -> str:
    """The schema in its own notation with each variable called Class.field, as it is mapped; what isn't is marked so.

    ``classes``: subject -> class.
    """
    by = {r.key: r for r in rows}
    shown = lambda x: "" if x is None else f" {x}" if re.match(r"^<.*>$|^[A-Za-z][\w.-]*:\S+$", str(x)) else f' "{x}"'

    def lines(s: Subject, pad: str) -> list[str]:
        out = [f"{pad}- {s.name}[{classes.get(s.name, '?') or '?'}]{' ' + s.example if s.example else ''}:"]
        out += [f"{pad}  - a: {s.types[0] if len(s.types) == 1 else '[' + ', '.join(s.types) + ']'}"] if s.types else []
        for p in s.predicates:
            out.append(f"{pad}  - {p.curie}{p.cardinality}:")
            for o in p.objects:
                r = by.get((s.name, p.curie, o.name))
                if o.inline:
                    out += lines(o.inline, pad + "    ")
                elif r is not None and r.loadable:
                    out.append(f"{pad}    - {r.im_class}.{r.im_field}:{shown(o.example)}  # {o.name} ({r.status}){' via ' + r.via if r.via else ''}")
                else:
                    out.append(f"{pad}    - {o.name}:{shown(o.example)}  # UNMAPPED ({r.status if r else 'no row'})")
        return out

    return "\n".join(x for s in subjects for x in lines(s, "")) + "\n"


def parse_project(text: str) -> list[dict[str, str]]:
    """Sources of a project document in order: name, type, version."""
    return [{k: s.get(k, "") for k in ("name", "type", "version")} for s in ET.fromstring(text).iter("source")]


def allow_tokens(sources: list[dict[str, str]]) -> list[str]:
    """/name/ and /type/ of each source, in order, each once."""
    return list(dict.fromkeys(f"/{s[k]}/" for s in sources for k in ("name", "type") if s[k]))


def project_xml(names: list[tuple[str, str]]) -> str:
    """A project document of (name, type) in load order."""
    lines = [f"    <source name={quoteattr(n)} type={quoteattr(t)}/>" for n, t in names]
    return "\n".join(["<project>", "  <sources>", *lines, "  </sources>", "</project>", ""])


def parse_priorities(text: str) -> dict[str, list[str]]:
    """Lines Class.field = source, source, *."""
    out = {}
    for line in text.splitlines():
        m = re.match(r"^\s*([\w.]+)\s*=\s*(.*?)\s*$", line)
        if m and not line.lstrip().startswith("#"):
            out[m[1]] = [x.strip() for x in m[2].split(",") if x.strip()]
    return out


def priority_lines(priorities: dict[str, list[str]]) -> str:
    return "".join(f"{k} = {', '.join(v)}\n" for k, v in sorted(priorities.items()))


def key_lines(catalog: Catalog, used: list[str]) -> list[str]:
    """Lines of a key file for the used classes: keys stand under the class that declares them, once.

    A class without any gets its key attribute as a draft, or a warning that its objects never merge.
    """
    out: list[str] = []
    done: set[str] = set()
    for name in sorted(dict.fromkeys(used)):
        owner = next((c for c in [name, *catalog.ancestors(name)] if c in catalog.classes and catalog.classes[c].keys), None)
        if owner is None:
            own = catalog.key_attributes(name) if name in catalog.classes else []
            out += [f"# DRAFT: no key is declared for {name}", f"{name}.key_{own[0].lower()} = {own[0]}"] if own else [f"# WARNING: {name} has no key and no identifier, its objects never merge"]
            continue
        if owner != name:
            out.append(f"# {name} has the keys of {owner}")
        if owner not in done:
            done.add(owner)
            keys = catalog.classes[owner].keys
            out += [f"{owner}.key{'' if len(keys) == 1 else f'_{i + 1}'} = {', '.join(k)}" for i, k in enumerate(keys)]
    return out


def carried_fields(declared: Catalog, live: Catalog, used: set[str]) -> list[tuple[str, str]]:
    """(class, field) that used classes or their ancestors declare and the live model lacks."""
    need = {x for c in used for x in [c, *declared.ancestors(c)] if x in declared.classes}
    return sorted((c, f) for c in need for f in declared.classes[c].fields if c not in live.classes or f not in live.classes[c].fields)


def status_report(rows: DataFrame) -> DataFrame:
    """Markdown lines of mapping rows by status: (status, n, line)."""
    counts = rows.groupBy("status").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set(F.col("subject"))), ", ").alias("subjects"))
    return counts.select("status", "n", F.concat(F.lit("| "), "status", F.lit(" | "), F.col("n").cast("string"), F.lit(" | "), markdown_cell(F.col("subjects")), F.lit(" |")).alias("line"))


def trim_config(lines: DataFrame, catalog: Catalog) -> DataFrame:
    """Configuration lines (path, line) whose class or field path resolves in the model."""

    def ok(path: str) -> bool:
        try:
            catalog.resolve(path)
        except ValueError:
            return False
        return True

    paths = [r.path for r in lines.select("path").distinct().collect()]  # a configuration is as long as the model
    known = lines.sparkSession.createDataFrame([(p,) for p in paths if ok(p)], "path string")
    return lines.join(known, "path", "left_semi")
