"""The mapping of a source as a file that people edit: resolved anew, merged with their edits, written beside its base.

A source's folder holds ``model.yaml`` (graph schema), ``prefix.yaml``, and what ``translate`` writes: ``mapping.tsv`` to be edited
and ``mapping.base.tsv``, the rows as they were resolved. What differs between the two is an edit, which the next
translation keeps. These files are as long as a schema, so they are read and written as files.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..operators.integrate import three_way_merge
from .catalog import Catalog
from .resolve import MappingRow, Resolver, Rules
from .schema import parse_prefixes, parse_schema

KEYS = ["subject", "predicate", "column"]
#: Columns of a mapping file: the key, what may be edited, and the constants that a rule gave, which aren't edited.
CELLS = ["kind", "im_class", "im_field", "via", "status", "basis", "required", "table", "transform", "filter", "value", "multi", "note"]


def _flat(text: object) -> str:
    return str(text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ")


def write_rows(rows: list[dict[str, str]], path: Path) -> None:
    """Rows below a header, in place of the file that is there in one step."""
    new = path.with_name(f".{path.name}-{uuid.uuid4().hex}")
    new.write_text("\n".join("\t".join(_flat(r.get(c)) for c in [*KEYS, *CELLS]) for r in [{c: c for c in [*KEYS, *CELLS]}, *rows]) + "\n", encoding="utf-8")
    os.replace(new, path)


def read_rows(path: Path) -> list[dict[str, str]]:
    """Rows of a mapping file; none where there is no file. Missing cells are empty."""
    if not path.exists():
        return []
    lines = [x.split("\t") for x in path.read_text(encoding="utf-8").split("\n") if x]
    return [dict(zip(lines[0], r + [""] * len(lines[0]))) for r in lines[1:]] if lines else []


def as_row(r: MappingRow) -> dict[str, str]:
    return {f.name: ("yes" if r.multi else "") if f.name == "multi" else str(getattr(r, f.name) or "") for f in fields(MappingRow) if f.name in {*KEYS, *CELLS}}


def mapping_rows(rows: list[dict[str, str]]) -> list[MappingRow]:
    return [MappingRow(**{k: v for k, v in r.items() if k in {*KEYS, *CELLS} - {"multi"}}, multi=r.get("multi") == "yes") for r in rows]


def _frame(spark: SparkSession, rows: list[dict[str, str]]) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(c, "") for c in [*KEYS, *CELLS]) for r in rows], ", ".join(f"`{c}` string" for c in [*KEYS, *CELLS]))


def translate(spark: SparkSession, folder: str | Path, catalog: Catalog, rules: Rules, roots: list[str] | None = None, roles: dict[str, str] | None = None) -> tuple[list[MappingRow], dict[str, int]]:
    """The source's mapping rows, and how many are fresh, edited and stale.

    The folder's name is the source's. Edited cells stay; rows that the schema no longer has stay, dropped and marked, if they
    were edited. Roots are by default the first subject. Rows keep the order of the schema, stale ones come last.
    """
    folder = Path(folder)
    prefixes = parse_prefixes((folder / "prefix.yaml").read_text()) if (folder / "prefix.yaml").exists() else {}
    subjects = parse_schema((folder / "model.yaml").read_text())
    resolved, _ = Resolver(catalog, rules, folder.name, prefixes).build(subjects, roots or [s.name for s in subjects[:1]], roles)
    fresh = [as_row(r) for r in resolved]
    edited, base = folder / "mapping.tsv", folder / "mapping.base.tsv"
    order = {tuple(r[k] for k in KEYS): i for i, r in enumerate(fresh)}
    if edited.exists():
        merged = three_way_merge(_frame(spark, fresh), _frame(spark, read_rows(edited)), _frame(spark, read_rows(base)) if base.exists() else None, KEYS, CELLS)
        rows = sorted((r.asDict() for r in merged.collect()), key=lambda r: (order.get(tuple(r[k] for k in KEYS), len(order)), *(r[k] for k in KEYS)))
    else:
        rows = [{**r, "origin": "fresh"} for r in fresh]
    write_rows(rows, edited)
    write_rows(fresh, base)
    counts = {o: sum(r["origin"] == o for r in rows) for o in ("fresh", "edited", "stale")}
    return mapping_rows([{k: v for k, v in r.items() if k != "origin"} for r in rows]), counts
