"""Command line: ``python -m tessera.cli COMMAND``; it ends with 1 if something failed or is incomplete."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import checks, objects
from .operators.tables import RunStatistics, clean_table
from .plans import resolve, translate
from .plans.catalog import Catalog
from .plans.written import written_scope
from .sources import cache, endpoint, exports, readers, writers


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera")
    sub = p.add_subparsers(dest="command", required=True)
    q = sub.add_parser("query", help="run a registered query and write its rows")
    q.add_argument("name")
    q.add_argument("sf_dir")
    q.add_argument("out")
    s = sub.add_parser("schema", help="write a model's schema document")
    s.add_argument("model")
    s.add_argument("out")
    f = sub.add_parser("fetch", help="scan an endpoint with a query and write wire terms")
    f.add_argument("endpoint")
    f.add_argument("query")
    f.add_argument("out")
    f.add_argument("--limit", type=int)
    f.add_argument("--force", action="store_true")
    f.add_argument("--dry-run", action="store_true")
    for name, text in (("translate", "resolve a source's schema to the model and merge the edits of its mapping"), ("tsv", "clean a source's raw tables"), ("items", "make items documents of a source's cleaned tables"), ("all", "translate, tsv and items")):
        t = sub.add_parser(name, help=text)
        t.add_argument("folder", help="the source's folder: model.yaml, prefix.yaml, raw/TABLE.tsv; results go below it")
        t.add_argument("model", help="the object model, with its keys in the file of the same name ending in .properties")
        t.add_argument("--rules", help="a rule file")
        t.add_argument("--root", help="the root subject, by default the first")
    k = sub.add_parser("check", help="check the mappings of sources against the model, and print keys that their classes need")
    k.add_argument("model")
    k.add_argument("folders", nargs="+")
    c = sub.add_parser("cache", help="save, verify, restore or list raw files")
    c.add_argument("action", choices=("save", "verify", "restore", "list"))
    c.add_argument("root")
    c.add_argument("group", nargs="?")
    c.add_argument("folder", nargs="?")
    c.add_argument("--meta", type=json.loads, default={})
    return p


def fetch(args: argparse.Namespace, send: endpoint.Send | None = None) -> str:
    """fetched, kept, dry, partial, failed or skip-empty."""
    text, out = Path(args.query).read_text(), Path(args.out)
    names = endpoint.variables(text)
    if not names:
        return "skip-empty"
    if out.exists() and not args.force:
        return "kept"
    if args.dry_run:
        return "dry"
    send = send or endpoint.http_send(args.endpoint)
    if args.limit:
        done = endpoint.Scan(names)
        rows = endpoint.scan_pages(send, text, limit=args.limit, scan=done)
    else:
        rows, done = endpoint.scan(send, text)
    part = out.with_name(out.name + ".part")
    with open(part, "w", encoding="utf-8") as f:
        f.write("\t".join("?" + n for n in names) + "\n")
        for r in rows:
            f.write("\t".join(r) + "\n")
    if done.status == "failed":
        part.unlink()
    else:
        part.replace(out)
    return done.status


def source(args: argparse.Namespace, spark: SparkSession) -> int:
    """The commands over a source's folder; 1 where the mapping has nothing to load or a table's raw file is missing.

    Cleaned tables go to tsv/TABLE, with positional column names, as tables of the mapping may name a field twice; items documents to
    items. Runs print what they counted.
    """
    folder = Path(args.folder)
    text, keys = Path(args.model).read_text(), Path(args.model).with_suffix(".properties")
    catalog = Catalog().load_xml(text).load_keys(keys.read_text() if keys.exists() else "")
    rules = resolve.Rules.load(Path(args.rules).read_text()) if args.rules else resolve.Rules()
    if args.command in ("translate", "all"):
        _, counts = translate.translate(spark, folder, catalog, rules, [args.root] if args.root else None)
        print("translate:", ", ".join(f"{n} {k}" for k, n in counts.items()))
    rows = translate.mapping_rows(translate.read_rows(folder / "mapping.tsv"))
    tables = resolve.tables_of(rows)
    failed = not tables
    if args.command in ("tsv", "all"):
        for t in tables:
            specs = [replace(s, name=f"c{i}") for i, s in enumerate(resolve.specs_of(rows, t))]
            raw = folder / "raw" / f"{t}.tsv"
            if not specs or not raw.exists():
                failed |= bool(specs)
                continue
            seen = RunStatistics()
            clean_table(readers.read_wire_tsv(spark, str(raw), clean=False), specs, statistics=seen).write.mode("overwrite").parquet(str(folder / "tsv" / t))
            print(f"tsv {t}:", ", ".join(f"{n} {k}" for k, n in seen.counts.items()))
    if args.command in ("items", "all"):
        clean = {t: spark.read.parquet(str(folder / "tsv" / t)) for t in tables if (folder / "tsv" / t).exists()}
        root = next((r.im_class for r in rows if r.required == "yes" and r.loadable), "")
        if not clean or not root:
            return 1
        items, links = objects.number_graph(*objects.object_graph(clean, rows, root, catalog))
        writers.write_items(items, links, str(folder / "items"))
        print(f"items: {readers.read_items_xml(spark, str(folder / 'items')).count()}")
    return int(failed)


def check(args: argparse.Namespace, spark: SparkSession) -> int:
    """Findings of the rules over the sources' mappings and items documents; 1 if any is hard."""
    path = Path(args.model)
    keys = path.with_suffix(".properties")
    catalog = Catalog().load_xml(path.read_text()).load_keys(keys.read_text() if keys.exists() else "")
    sources, items, links, used = {}, [], [], []
    for folder in map(Path, args.folders):
        rows = translate.mapping_rows(translate.read_rows(folder / "mapping.tsv"))
        used += [r.im_class for r in rows if r.loadable]
        sources[folder.name] = rows, next((r.im_class for r in rows if r.required == "yes" and r.loadable), "")
        if (folder / "items").exists():
            name = F.lit(folder.name).alias("source")
            items.append(readers.read_items_xml(spark, str(folder / "items")).select(name, "id", "cls"))
            links.append(readers.read_item_links(spark, str(folder / "items")).select(name, "src", "dst"))
    tables = {n: reduce(DataFrame.unionByName, t) for n, t in (("items", items), ("links", links)) if t}
    found = checks.findings(checks.Project.of(spark, catalog, columns=checks.project_columns(spark, sources), **tables))
    rows = found.orderBy("severity", "rule", "source", "subject").collect()  # as long as the mappings
    for r in rows:
        print(f"{r.severity} {r.rule} {r.source}: {r.subject}")
    print("\n".join(exports.key_lines(catalog, used)))
    return int(any(r.severity == "hard" for r in rows))


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command in ("translate", "tsv", "items", "all"):
        spark = SparkSession.builder.getOrCreate()
        with written_scope(spark):
            return source(args, spark)
    if args.command == "check":
        spark = SparkSession.builder.getOrCreate()
        with written_scope(spark):
            return check(args, spark)
    if args.command == "query":
        from .queries import QUERIES

        spark = SparkSession.builder.getOrCreate()
        with written_scope(spark):
            QUERIES[args.name](spark, args.sf_dir).write.mode("overwrite").parquet(args.out)
        return 0
    if args.command == "schema":
        document = exports.schema_document(Catalog().load_xml(Path(args.model).read_text()), Path(args.model).stem)
        Path(args.out).write_text(json.dumps(document, indent=1))
        return 0
    if args.command == "fetch":
        status = fetch(args)
        print(status)
        return int(status in ("failed", "partial"))
    if args.action == "list":
        print("\n".join(cache.groups(args.root)))
        return 0
    if args.action == "verify":
        problems = cache.verify(args.root, args.group)
        print("\n".join(problems))
        return int(bool(problems))
    if args.action == "save":
        base = Path(args.folder)
        cache.save(args.root, args.group, {str(p.relative_to(base)): p for p in base.rglob("*") if p.is_file()}, args.meta)
        return 0
    return int(not cache.restore(args.root, args.group, args.folder, args.meta))


if __name__ == "__main__":
    sys.exit(main())
