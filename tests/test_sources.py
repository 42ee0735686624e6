import json
import re

import pytest

from tessera.model import catalog
from tessera.operators.tables import ColumnSpec
from tessera.plans.resolve import MappingRow
from tessera.sources import cache, endpoint, exports, readers, writers
from tessera.streaming import clean as stream


def put(tmp_path, name, text):
    (tmp_path / name).write_bytes(text.encode())
    return str(tmp_path / name)


def test_wire_tsv(spark, tmp_path):
    p = put(tmp_path, "t.tsv", '?id\t"?name"\r\n"1"\t"a \\"b\\""@en\r\n\r\n<x>\n')
    df = readers.read_wire_tsv(spark, p)
    assert df.columns == ["id", "name"] and sorted(map(tuple, df.collect())) == [("1", 'a "b"'), ("x", "")]


def test_only_the_first_line_is_a_header(spark, tmp_path):
    p = put(tmp_path, "h.tsv", '?"k"\t"?v"\n"k"\t"v"\n?"k"\t"?v"\n# x\ty "z" w\textra\n')
    df = readers.read_wire_tsv(spark, p)
    assert df.columns == ["k", "v"] and sorted(map(tuple, df.collect())) == [("# x", 'y "z" w'), ('?"k"', "?v"), ("k", "v")]
    assert [readers.header_name(x) for x in ('?"x"', '"?x"', " ?x ", "'x'", "x")] == ["x"] * 5
    block = "".join(f"# key{i}: {i}\n" for i in range(1500))
    df, meta = readers.read_exchange(spark, put(tmp_path, "e.tsv", block + "a\text_b\n1\t2\na\text_b\n#3\t4\n"))
    assert len(meta) == 1500 and meta["key1499"] == "1499" and sorted(map(tuple, df.collect())) == [("#3", "4"), ("1", "2"), ("a", "ext_b")]


def test_result_json_and_csv(spark, tmp_path):
    body = {"head": {"vars": ["a", "b"]}, "results": {"bindings": [{"a": {"type": "uri", "value": "http://x"}, "b": {"type": "literal", "value": 'q"\n', "xml:lang": "en"}}, {"a": {"type": "bnode", "value": "n"}}]}}
    got = [tuple(r) for r in readers.read_result_json(spark, put(tmp_path, "r.json", json.dumps(body))).collect()]
    assert got == [("<http://x>", '"q\\"\\n"@en'), ("_:n", "")] == endpoint.decode(json.dumps(body), ["a", "b"])
    got = [tuple(r) for r in readers.read_result_csv(spark, put(tmp_path, "r.csv", 'a,b\nhttp://x,"v ""q"""\n')).collect()]
    assert got == [("http://x", '"v \\"q\\""')]
    assert readers.sniff("{}") == "json" and readers.sniff("a\tb") == "tsv" and readers.sniff("a,b") == "csv"


def test_exchange_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("s", "p", "sure"), ("s", "q", "guess")], "subject string, predicate string, status string")
    lines = writers.exchange_lines(writers.mapping_exchange(rows), {"mapping_set_id": "x"}).orderBy("no").collect()
    df, meta = readers.read_exchange(spark, put(tmp_path, "m.tsv", "\n".join(r.line for r in lines)))
    assert meta == {"mapping_set_id": "x"} and df.filter("status = 'guess'").first().predicate_id == "skos:closeMatch"


def test_items_round_trip(spark, tmp_path):
    items = spark.createDataFrame([(1, "Gene", {"pubMedId": "12", "name": "α<"}), (2, "Gene", {"pubMedId": "7"})], "no long, cls string, attrs map<string,string>")
    links = spark.createDataFrame([(1, "other", 2, False), (1, "ghost", 9, False)], "src_no long, field string, dst_no long, many boolean")
    out = str(tmp_path / "items")
    writers.write_items(items, links, out)
    back = {r.id: r for r in readers.read_items_xml(spark, out).collect()}
    assert back["0_1"].attrs == {"pubMedId": "12", "name": "alpha<"}
    assert [r.id for r in readers.cited_ids(spark, [out]).collect()] == ["7", "12"]
    assert [tuple(r) for r in readers.read_item_links(spark, out).collect()] == [("0_1", "other", "0_2", False)]
    writers.write_tsv(spark.createDataFrame([("a\tb", None)], "x string, y string"), str(tmp_path / "w"))


def test_every_part_of_an_items_document_is_one(spark, tmp_path):
    """Items and links of many parts come back as they were, each part has its root, and links lead over parts."""
    import xml.etree.ElementTree as ET

    items = spark.range(1, 301).selectExpr("id AS no", "concat('C', id % 3) AS cls", "map('name', concat('<n> & \"', id, '\"'), 'b', 'β') AS attrs").repartition(5)
    links = items.selectExpr("no AS src_no", "'next' AS field", "no % 300 + 1 AS dst_no", "false AS many").union(items.selectExpr("no", "'all'", "no * 7 % 400", "true")).union(items.selectExpr("no", "'all'", "no * 11 % 300 + 1", "true"))
    out = tmp_path / "items"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_items(items, links, str(out))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(out.glob("part-*"))
    assert len(parts) > 1 and all(ET.parse(p).getroot().tag == "items" for p in parts)
    back = {r.id: (r.cls, r.attrs) for r in readers.read_items_xml(spark, str(out)).collect()}
    assert len(back) == 300 and back["0_17"] == ("C2", {"name": '<n> & "17"', "b": "beta"})
    got = sorted(map(tuple, readers.read_item_links(spark, str(out)).collect()))
    want = {(f"0_{s}", f, f"0_{d}", m) for s, f, d, m in map(tuple, links.collect()) if 1 <= d <= 300}
    assert got == sorted(want)


def test_lists_and_files(spark, tmp_path):
    assert [r.value for r in readers.read_list(spark, put(tmp_path, "l.txt", "a b # c\n\nd\n")).collect()] == ["a", "b", "d"]
    d = tmp_path / "files"
    d.mkdir()
    for n, t in (("1", "x"), ("2", "x"), ("3", "y")):
        (d / n).write_text(t)
    assert readers.distinct_files(spark, str(d)).count() == 2


def test_cache(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one")
    (tmp_path / "é.txt").write_text("")
    at = cache.save(tmp_path / "c", "g", {"a.txt": tmp_path / "a.txt", "sub/é.txt": tmp_path / "é.txt"}, {"scope": "full"})
    assert cache.verify(tmp_path / "c", "g") == [] and cache.groups(tmp_path / "c") == ["g"]
    plain = cache.save(tmp_path / "c", "h", {"a.txt": tmp_path / "a.txt", "sub/b.txt": tmp_path / "a.txt"}, {})
    assert readers.verify_manifest(spark, str(plain), str(plain / "MD5SUMS")).count() == 0
    (plain / "data/a.txt").write_text("two")
    (plain / "data/new").write_text("n")
    assert sorted((r.file, r.problem) for r in readers.verify_manifest(spark, str(plain), str(plain / "MD5SUMS")).collect()) == [("data/a.txt", "changed"), ("data/new", "unlisted")]
    target = tmp_path / "t"
    target.mkdir()
    (target / "stray").write_text("s")
    assert not cache.restore(tmp_path / "c", "g", target, {"scope": "panel"})
    assert cache.restore(tmp_path / "c", "g", target, {"scope": "full"}) and not (target / "stray").exists() and (target / "sub/é.txt").exists()
    (at / "data/a.txt").write_text("two")
    (at / "data/new").write_text("n")
    assert cache.verify(tmp_path / "c", "g") == ["unlisted data/new", "changed data/a.txt"]
    with pytest.raises(ValueError):
        cache.entry(tmp_path, "../x")


QUERY = "SELECT ?k ?v WHERE { ?k <p> ?v OPTIONAL { ?k <q> ?w } }"


def server(rows, cut=10**9, cap=10**9, bad=()):
    """A stand-in endpoint that cuts pages at ``cut`` rows and refuses sorted scans beyond ``cap``."""
    calls = []

    def send(q):
        calls.append(q)
        n = re.search(r"LIMIT (\d+)", q)
        at = int((re.search(r"OFFSET (\d+)", q) or [0, 0])[1])
        if "COUNT" in q:
            return 200, f"n\n{len(rows)}\n"
        if "VALUES" in q:
            keys = re.findall(r"<(k\d+)>", re.search(r"VALUES \?k \{(.*?)\}", q)[1])
            return (500, "no") if set(keys) & set(bad) else (200, "k\tv\n" + "".join(f"<{k}>\t{v}\n" for k, v in rows if k in keys))
        if at + int(n[1]) > cap and "DISTINCT" not in q:
            return 500, "sorted cap"
        if "DISTINCT ?k" in q:
            return 200, "k\n" + "".join(f"<{k}>\n" for k in sorted({k for k, _ in rows})[at : at + int(n[1])])
        return 200, "k\tv\n" + "".join(f"<{k}>\t{v}\n" for k, v in rows[at : at + min(int(n[1]), cut)])

    return send, calls


def test_pages_behind_a_cutting_endpoint():
    rows = [(f"k{i:03d}", str(i)) for i in range(20)]
    send, _ = server(rows, cut=6)
    done = endpoint.Scan(["k", "v"])
    assert [r[1] for r in endpoint.scan_pages(send, QUERY, 10, scan=done)] == [str(i) for i in range(20)] and done.status == "fetched"
    assert len(list(endpoint.scan_pages(server(rows)[0], QUERY, 8, limit=11))) == 11


def test_batches_over_the_cap():
    rows = [(f"k{i:03d}", str(i)) for i in range(30)]
    got, done = endpoint.scan(server(rows, cap=10)[0], QUERY, 10, cap=10, batch=7)
    assert sorted(r[1] for r in got) == sorted(str(i) for i in range(30)) and done.status == "fetched"
    got, done = endpoint.scan(server(rows, cap=10, bad=("k003",))[0], QUERY, 10, cap=10, batch=7)
    assert len(list(got)) == 23 and done.status == "partial"


@pytest.mark.parametrize("per_key", [1, 3, 7])
def test_a_cap_met_midway_goes_on_by_keys(per_key):
    """The count fails, so only the refused page tells of the cap: keys seen whole aren't asked for again, and no row is lost or doubled."""
    rows = [(f"k{i // per_key:03d}", str(i)) for i in range(40)]
    send, calls = server(rows, cap=25)
    got, done = endpoint.scan(lambda q: (500, "no counts") if "COUNT" in q else send(q), QUERY, 10, batch=4)
    assert sorted(int(r[1]) for r in got) == list(range(40)) and done.status == "fetched"
    batches = [q for q in calls if "VALUES" in q]
    assert batches and not any("<k000>" in q for q in batches)


def test_a_cap_midway_without_a_safe_key_is_partial():
    rows = [(f"k{i:03d}", str(i)) for i in range(40)]
    got, done = endpoint.scan(server(rows, cap=25)[0], "SELECT ?k ?v WHERE { ?s <p> ?v OPTIONAL { ?s <q> ?k } }", 10)
    assert len(list(got)) == 20 and done.status == "partial"
    other, cut = endpoint.scan(lambda q: (503, "busy") if "OFFSET 20" in q else server(rows)[0](q), QUERY, 10)
    assert len(list(other)) == 20 and cut.status == "partial" and "busy" in cut.errors[0]


def test_a_failed_batch_after_the_cap_is_partial():
    rows = [(f"k{i:03d}", str(i)) for i in range(40)]
    got, done = endpoint.scan(server(rows, cap=25, bad=("k030",))[0], QUERY, 10, batch=4)
    assert len(list(got)) == 36 and done.status == "partial"


def test_redirected_posts_keep_their_query():
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    seen = []

    class Handler(BaseHTTPRequestHandler):
        def answer(self, body=b""):
            seen.append((self.command, len(self.path) < 100 or "query=" in self.path, "query=" in body.decode() or "query=" in self.path))
            if self.path == "/old":
                self.send_response(302)
                self.send_header("Location", "/new")
                self.end_headers()
                return
            self.send_response(200)
            self.end_headers()
            self.wfile.write(b"k\n")

        def do_GET(self):
            self.answer()

        def do_POST(self):
            self.answer(self.rfile.read(int(self.headers.get("Content-Length") or 0)))

        def log_message(self, *_):
            pass

    server_ = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server_.serve_forever, daemon=True).start()
    try:
        send = endpoint.http_send(f"http://127.0.0.1:{server_.server_port}/old")
        assert send("SELECT ?k WHERE {}") == (200, "k\n") and seen[-1] == ("GET", True, True)
        assert send("SELECT ?k WHERE {} #" + "x" * 5_000) == (200, "k\n") and seen[-1] == ("POST", True, True)
    finally:
        server_.shutdown()


def test_a_range_is_whole_or_an_error():
    rows = [(f"k{i:03d}", str(i)) for i in range(20)]
    send, calls = server(rows, cut=4)
    assert [r[1] for r in endpoint.read_range(send, QUERY, 5, 10)] == [str(i) for i in range(5, 15)] and len(calls) == 3
    with pytest.raises(OSError):
        list(endpoint.read_range(send, QUERY, 15, 10))


def test_a_cut_list_of_keys_makes_a_partial_scan():
    rows = [(f"k{i:03d}", str(i)) for i in range(30)]
    send, _ = server(rows, cap=10)

    def cutting(q):
        return (500, "sorted cap") if "DISTINCT ?k" in q and "OFFSET 20" in q else send(q)

    got, done = endpoint.scan(cutting, QUERY, 10, cap=10, batch=7)
    assert len(list(got)) == 20 and done.status == "partial"


def test_query_texts():
    assert endpoint.domain_query(QUERY, "k").startswith("SELECT DISTINCT ?k WHERE") and endpoint.domain_query(QUERY, "w") is None
    assert endpoint.with_limit("SELECT ?a WHERE {} LIMIT 5", None).endswith("LIMIT 5") and endpoint.with_limit("SELECT ?a WHERE {} LIMIT 5", 0).endswith("{}")
    assert endpoint.with_order("SELECT ?a ?b WHERE {}").endswith("ORDER BY ?a")
    assert endpoint.EndpointSource({"query": QUERY, "endpoint": "x", "rows": "25", "page": "10"}).schema() == "`k` string, `v` string"


def test_exports(spark):
    doc = exports.schema_document(catalog(), "star")
    assert doc["classes"]["Customer"]["is_a"] == "Party" and doc["classes"]["Region"]["attributes"]["nations"] == {"range": "Nation", "multivalued": True}
    rows = [MappingRow("s", "p", "c", "literal", "Part", "colour", status="sure"), MappingRow("s", "p", "d", "literal", "New", "x", status="sure"), MappingRow("s", "p", "e", "literal", "Part", "name", status="sure")]
    xml = exports.additions_xml(rows, catalog())
    assert "colour" in xml and "TODO-set-parent" in xml and '"name" type' not in xml
    sources = exports.parse_project(exports.project_xml([("a", "t1"), ("b", "t1")]))
    assert exports.allow_tokens(sources) == ["/a/", "/t1/", "/b/"]
    p = {"Gene.name": ["x", "*"]}
    assert exports.parse_priorities(exports.priority_lines(p)) == p
    assert ("Part", "brand") in exports.carried_fields(catalog(), type(catalog())(), {"Part"})
    report = exports.status_report(spark.createDataFrame([("a|b", "sure"), ("c", "sure")], "subject string, status string")).first()
    assert report.n == 2 and report.line == "| sure | 2 | a\\|b, c |"
    lines = spark.createDataFrame([("Part.name", "1"), ("Part.nope", "2"), ("Customer.nation.region.name", "3")], "path string, line string")
    assert sorted(r.line for r in exports.trim_config(lines, catalog()).collect()) == ["1", "3"]


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    put(src, "1.tsv", '"1"\t"a"\n"2"\t""\n')
    cleaned = stream.clean_stream(stream.raw_stream(spark, str(src), ["id", "name"]), [ColumnSpec("id", "id", required=True), ColumnSpec("name", "name")])
    store = stream.Store(spark, str(tmp_path / "store"), ["id"], ["name"])
    run = lambda: stream.start(cleaned, store, str(tmp_path / "ck")).awaitTermination()
    run()
    put(src, "2.tsv", '"1"\t"z"\n"2"\t"b"\n"3"\t"c"\n')
    run()
    assert sorted(map(tuple, store.current().select("id", "name").collect())) == [("1", "a"), ("2", "b"), ("3", "c")]


def test_model_files_by_allowed_tokens(spark, tmp_path):
    for path, text in {"bio/core.xml": "<c/>", "copy/core.xml": "<c/>", "a/genomic_additions.xml": "<g/>", "sources/go/go_additions.xml": "<go/>", "sources/hp/hp_additions.xml": "<hp/>",
                       "sources/go/test/go_additions.xml": "<t/>", "sources/go/go_keys.properties": "k", "sources/hp/hp_keys.properties": "h", "sources/go/notes.xml": "<n/>"}.items():
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text(text)
    got = lambda allow: [(r.path.split(str(tmp_path))[1], r.kind) for r in readers.model_files(spark, str(tmp_path), allow).collect()]
    core = [("/a/genomic_additions.xml", "core"), ("/bio/core.xml", "core")]
    go = [("/sources/go/go_additions.xml", "additions"), ("/sources/go/go_keys.properties", "keys")]
    assert got(["/go/"]) == core + go and got([]) == core
    assert got(None) == core + go + [("/sources/hp/hp_additions.xml", "additions"), ("/sources/hp/hp_keys.properties", "keys")]


def test_tables_that_may_be_missing(spark, tmp_path):
    assert readers.read_tsv(spark, str(tmp_path / "none.tsv")).count() == 0
    assert [tuple(r) for r in readers.read_tsv(spark, put(tmp_path, "t.tsv", 'a\tb\n"x\t\n')).collect()] == [('"x', "")]


def test_additions_and_schemas_as_text():
    from test_plans import FLEET

    from tessera.plans import schema as Sc
    from tessera.plans.catalog import Catalog
    from tessera.plans.pathquery import listing
    from tessera.queries import TEMPLATES

    whole = exports.model_xml(catalog())
    assert exports.model_xml(Catalog().load_xml(whole)) == whole
    one, two = '<m><class name="A"><attribute name="x" type="int"/></class></m>', '<m><class name="A" extends="B"><attribute name="x" type="java.lang.String"/><collection name="ys" referenced-type="Y" reverse-reference="a"/></class></m>'
    assert exports.merged_additions([one, two]) == '<classes>\n  <class name="A" extends="B" is-interface="true">\n    <attribute name="x" type="int"/>\n    <collection name="ys" referenced-type="Y" reverse-reference="a"/>\n  </class>\n</classes>\n'
    rows = [MappingRow("Vessel", "sh:imo", "imo", "literal", "Ship", "number", status="sure"), MappingRow("Vessel", "sh:homePort", "port", "link", "Port", "code", via="Ship.home", status="human"), MappingRow("Vessel", "sh:callsign", "sign", "literal", status="todo")]
    text = exports.relabelled_schema(Sc.parse_schema(FLEET), rows, {"Vessel": "Ship"})
    for line in ("- Vessel[Ship] sh:imo9300001:", '    - Ship.number: "9300001"  # imo (sure)', "    - Port.code: \"Port\"  # port (human) via Ship.home", '    - sign: "D5XY2"  # UNMAPPED (todo)', "- Port[?] sh:NLRTM:", "  - sh:engine?:"):
        assert line in text.splitlines()
    first = listing(TEMPLATES)[0]
    assert first["name"] == "template_documents" and first["constraints"] == [{"place": 0, "path": "Document.lang", "op": "=", "value": "en"}]
