import argparse

from test_plans import PLANTS, model
from test_sources import QUERY, server

from tessera import cli
from tessera.operators.items import items_xml
from tessera.operators.objects import hierarchy_rollup, number_graph, object_graph
from tessera.operators.tables import clean_table
from tessera.plans import resolve as R
from tessera.plans import schema as Sc
from tessera.plans.catalog import closure


def test_from_raw_table_to_linked_items(spark):
    rules = R.Rules(predicates=[R.PredicateRule("ex:alias", "Alias.value", "Named"), R.PredicateRule("ex:spans", "Plant.height", "Plant")], prefixes={"dct": "http://purl.org/dc/terms/"})
    rows, _ = R.Resolver(model(), rules, "src", {"ex": "http://ex.org/"}).build(Sc.parse_schema(PLANTS), ["Plant"])
    raw = {
        "main": spark.createDataFrame([('"1"', '"Lyon"'), ('"2"', '"Bonn"')], "id string, city string"),
        "alias": spark.createDataFrame([('"1"', '"rose"'), ('"1"', '"rosa"'), ('"2"', '""')], "id string, alias string"),
        "ex_spans": spark.createDataFrame([('"1"', '"NR"'), ('"2"', '"1.5"')], "id string, ex_spans string"),
    }
    assert set(R.tables_of(rows)) == set(raw)
    clean = {t: clean_table(df, R.specs_of(rows, t)) for t, df in raw.items()}
    attributes, links = object_graph(clean, rows, "Plant", model())
    got = {(r["item"].cls, r["item"].key_value, r.field): r.value for r in attributes.collect()}
    assert got["Plant", "2", "height"] == "1.5" and got["Plant", "1", "height"] is None
    assert {k[1] for k in got if k[0] == "Alias"} == {"value=rose", "value=rosa"}
    edges = {(r.src.cls, r.src.key_value, r.field, r.dst.cls, r.dst.key_value, r.many) for r in links.collect()}
    assert ("Plant", "1", "aliases", "Alias", "value=rose", True) in edges and ("Alias", "value=rose", "plant", "Plant", "1", False) in edges
    items, numbered_links = number_graph(attributes, links)
    lines = [r.line for r in items_xml(items, numbered_links).orderBy("no").collect()]
    assert lines[0].startswith('<item id="0_1" class="Alias">') and '<reference name="plant" ref_id=' in lines[0]
    assert sum('<collection name="aliases">' in x for x in lines) == 1


def test_rollup(spark):
    up = closure(spark.createDataFrame([("a", "b"), ("b", "c")], "c string, p string"), "c", "p")
    got = hierarchy_rollup(spark.createDataFrame([("x", "a"), ("y", "c")], "src string, dst string"), up)
    assert sorted(map(tuple, got.collect())) == [("x", "a"), ("x", "b"), ("x", "c"), ("y", "c")]


def test_fetch_and_cache_commands(tmp_path):
    (tmp_path / "q.rq").write_text(QUERY)
    args = argparse.Namespace(endpoint="x", query=str(tmp_path / "q.rq"), out=str(tmp_path / "o.tsv"), limit=None, force=False, dry_run=False)
    send, _ = server([(f"k{i:03d}", str(i)) for i in range(12)], cut=5)
    assert cli.fetch(args, send) == "fetched" and len((tmp_path / "o.tsv").read_text().splitlines()) == 13
    assert cli.fetch(args, send) == "kept"
    args.force = True
    assert cli.fetch(args, lambda q: (500, "no")) == "failed" and (tmp_path / "o.tsv").exists()
    data = tmp_path / "d"
    data.mkdir()
    (data / "a").write_text("x")
    root = str(tmp_path / "cache")
    assert cli.main(["cache", "save", root, "g", str(data), "--meta", '{"s": 1}']) == 0
    assert cli.main(["cache", "verify", root, "g"]) == 0
    assert cli.main(["cache", "restore", root, "g", str(tmp_path / "r"), "--meta", '{"s": 2}']) == 1
    assert cli.main(["cache", "restore", root, "g", str(tmp_path / "r"), "--meta", '{"s": 1}']) == 0


def test_a_source_from_its_schema_to_items_documents(spark, tmp_path, capsys):
    """translate, tsv and items in one command; an edit of the mapping is kept by the next translation, a stale row is marked."""
    from test_plans import KEYS, MODEL

    from tessera.plans import translate as Tr
    from tessera.sources import readers

    folder = tmp_path / "garden"
    (folder / "raw").mkdir(parents=True)
    (folder / "model.yaml").write_text(PLANTS)
    (folder / "prefix.yaml").write_text("ex: <http://ex.org/>\ndct: <http://purl.org/dc/terms/>\n")
    (tmp_path / "model.xml").write_text(MODEL)
    (tmp_path / "model.properties").write_text(KEYS)
    (tmp_path / "rules.yaml").write_text("predicates:\n  - pred: ex:alias\n    im: Alias.value\n    class: Named\n    status: sure\n")
    (folder / "raw/main.tsv").write_text('id\tcity\n"1"\t"Lyon"\n"2"\t"Bonn"\n\t"nowhere"\n"1"\t"Lyon"\n')
    (folder / "raw/alias.tsv").write_text('id\talias\n"1"\t"rose"\n"2"\t""\n')
    command = ["all", str(folder), str(tmp_path / "model.xml"), "--rules", str(tmp_path / "rules.yaml"), "--root", "Plant"]
    assert cli.main(command) == 0
    said = capsys.readouterr().out
    assert "tsv main: 4 rows_in, 0 filtered, 0 empty, 1 no_key, 2 rows_out" in said
    items = {(r.cls, tuple(sorted(r.attrs.items()))) for r in readers.read_items_xml(spark, str(folder / "items")).collect()}
    assert ("Plant", (("identifier", "1"),)) in items and ("Alias", (("value", "rose"),)) in items
    assert {r.field for r in readers.read_item_links(spark, str(folder / "items")).collect()} >= {"aliases", "plant"}
    assert cli.main(["check", str(tmp_path / "model.xml"), str(folder)]) == 0
    said = capsys.readouterr().out
    assert "hard" not in said and "Plant.key = identifier" in said
    # A person maps the nick name, and the motto goes from the schema after an edit.
    rows = Tr.read_rows(folder / "mapping.tsv")
    for r in rows:
        if r["column"] == "ex_nick":
            r.update(im_class="Plant", im_field="label")
        if r["column"] == "ex_motto":
            r.update(note="look again")
    Tr.write_rows(rows, folder / "mapping.tsv")
    (folder / "model.yaml").write_text(PLANTS.replace('  - ex:motto: "sub rosa"\n', ""))
    assert cli.main(["translate", *command[1:]]) == 0
    by = {r["column"]: r for r in Tr.read_rows(folder / "mapping.tsv")}
    assert (by["ex_nick"]["im_field"], by["ex_nick"]["status"]) == ("label", "human")
    assert by["ex_motto"]["status"] == "drop" and by["ex_motto"]["note"].startswith("STALE") and "look again" in by["ex_motto"]["note"]
    assert list(by)[-1] == "ex_motto"
    by["ex_nick"]["im_field"] = "colour"
    Tr.write_rows(list(by.values()), tmp_path / "other.tsv")
    (tmp_path / "other").mkdir()
    (tmp_path / "other.tsv").rename(tmp_path / "other/mapping.tsv")
    assert cli.main(["check", str(tmp_path / "model.xml"), str(tmp_path / "other")]) == 1
    assert "hard unknown_field other: Plant.colour" in capsys.readouterr().out
    again = (folder / "mapping.tsv").read_text()
    assert cli.main(["translate", *command[1:]]) == 0 and (folder / "mapping.tsv").read_text() == again
    (folder / "raw/alias.tsv").unlink()
    assert cli.main(["tsv", *command[1:]]) == 1


def test_tables_written_on_the_way_go_with_their_scope(spark, tmp_path):
    from tessera.plans import written as W
    from tessera.queries import QUERIES

    with W.written_scope(spark):
        kept = W.written(spark.range(5))
        with W.written_scope(spark):
            inner = W.new_folder(spark)
            spark.range(3).write.parquet(inner)
            assert W.written(spark.range(7)).count() == 7
        assert kept.count() == 5 and not spark._jvm.org.apache.hadoop.fs.Path(inner).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(inner))
    out = str(tmp_path / "out")
    assert cli.main(["query", "item_ids", "/root/testdata/sf0.001", out]) == 0
    assert spark.read.parquet(out).count() == QUERIES["item_ids"](spark, "/root/testdata/sf0.001").count()


def test_a_pointer_is_replaced_whole(spark, tmp_path):
    from tessera.plans.written import Pointer

    at = Pointer(spark, f"file://{tmp_path}/store/current.json")
    assert at.read() is None
    for state in ({"n": 1}, {"n": 2, "text": "é" * 5_000}):
        at.replace(state)
        assert Pointer(spark, f"file://{tmp_path}/store/current.json").read() == state
    assert [p.name for p in (tmp_path / "store").iterdir() if not p.name.endswith(".crc")] == ["current.json"]
