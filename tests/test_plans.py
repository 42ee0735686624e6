import pytest
from pyspark.sql import functions as F

from tessera.operators import integrate as G
from tessera.plans import patterns as P
from tessera.plans import resolve as R
from tessera.plans import schema as Sc
from tessera.plans.catalog import COLLECTION, Catalog, closure, inherited_fields
from tessera.plans.pathquery import Constraint, Link, Mine, PathQuery, parse_constraint, parse_query_xml

MODEL = """<model>
<class name="Named"><attribute name="identifier" type="java.lang.String" term="http://purl.org/dc/terms/identifier"/><attribute name="label" type="java.lang.String"/></class>
<class name="Plant" extends="Named" term="http://ex.org/Plant"><attribute name="height" type="java.lang.Double"/><reference name="garden" referenced-type="Garden"/><collection name="aliases" referenced-type="Alias" reverse-reference="plant"/></class>
<class name="Garden" extends="Named"/><class name="Garden"><attribute name="city" type="java.lang.String"/></class>
<class name="Alias"><attribute name="value" type="java.lang.String"/><reference name="plant" referenced-type="Plant"/></class>
</model>"""
KEYS = "Plant.key = identifier\nGarden.key_a = identifier\nAlias.key_v = plant, value\nGhost.key = x\n"


def model():
    return Catalog().load_xml(MODEL).load_keys(KEYS)


def test_catalog():
    c = model()
    assert c.ancestors("Plant") == ["Named"] and c.descendants("Named") == ["Plant", "Garden"]
    assert list(c.all_fields("Plant")) == ["identifier", "label", "height", "garden", "aliases"]
    assert set(c.all_fields("Garden")) == {"identifier", "label", "city"}
    assert c.key_attributes("Plant") == ["identifier"] and c.key_attributes("Alias") == []
    assert [f.name for _, f in c.resolve("Plant.garden.city")] == ["garden", "city"]
    assert c.implicit_link("Plant", "Alias") == "aliases" and c.all_fields("Plant")["aliases"].kind == COLLECTION
    for bad in ("Nope.x", "Plant.nope", "Plant.label.city"):
        with pytest.raises(ValueError):
            c.resolve(bad)


def test_closure_with_a_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("d", "a")], "c string, p string")
    got = {(r.child, r.ancestor): r.depth for r in closure(edges, "c", "p").collect()}
    assert got["a", "c"] == 1 and got["d", "c"] == 2 and got["c", "c"] == 0 and len(got) == 10
    assert {(r.cls, r.field) for r in inherited_fields(model().tables(spark)).collect()} >= {("Garden", "label"), ("Alias", "value"), ("Plant", "identifier")}


def test_closure_of_a_long_chain_and_of_random_graphs(spark, monkeypatch):
    """Depths are shortest ones; 150 links in a row take eight rounds."""
    import random

    from tessera.plans import catalog as C

    rounds, write = [], C.written
    monkeypatch.setattr(C, "written", lambda df: (rounds.append(1), write(df))[1])
    chain = spark.createDataFrame([(i, i + 1) for i in range(150)], "c long, p long")
    got = {(r.child, r.ancestor): r.depth for r in closure(chain, "c", "p").collect()}
    assert got == {(i, j): j - i for i in range(151) for j in range(i, 151)} and len(rounds) <= 9
    rng = random.Random(5)
    edges = [(rng.randrange(40), rng.randrange(40)) for _ in range(70)]
    want = {}
    for start in {x for e in edges for x in e}:
        front, seen, depth = [start], {start: 0}, 0
        while front:
            depth += 1
            front = [b for b in {b for a in front for x, b in edges if x == a} if b not in seen]
            seen.update(dict.fromkeys(front, depth))
        want.update({(start, k): d for k, d in seen.items()})
    assert {(r.child, r.ancestor): r.depth for r in closure(spark.createDataFrame(edges, "c long, p long"), "c", "p").collect()} == want


FLEET = """\
# ports, and the vessels that call there
- Vessel sh:imo9300001:
  - a: [sh:Vessel, sh:Asset]
  - sh:imo:
    - imo: "9300001"
  - sh:callsign?:
    - sign: 'D5XY2'   # as broadcast
  - sh:homePort:
    - port: Port
  - sh:visited*:
    - stop: [Port, Berth]
  - sh:engine?:
    - []:
      - sh:kilowatts+:
        - power: 1200
- Port sh:NLRTM:
  - a: sh:Port
  - sh:portName{1,3}: "Rotterdam"

- Berth <http://ships.example/berth/7>:
  - sh:depth{0,1}:
    - depth: 14
- Beacon sh:b1:
  - a: sh:Light
"""


@pytest.mark.parametrize("change", [("", ""), ("\n", "\r\n"), ("  ", "\t")])
def test_schema(change):
    subjects = Sc.parse_schema(FLEET.replace(*change) if change[0] else FLEET)
    vessel, port, berth, beacon = subjects
    assert (vessel.name, vessel.example, vessel.types) == ("Vessel", "sh:imo9300001", ["sh:Vessel", "sh:Asset"])
    assert (berth.example, berth.types, beacon.predicates) == ("<http://ships.example/berth/7>", [], [])
    kinds = {p.curie: (p.multi, p.optional) for s in (vessel, port, berth) for p in s.predicates}
    assert kinds == {"sh:imo": (False, False), "sh:callsign": (False, True), "sh:homePort": (False, False), "sh:visited": (True, True), "sh:engine": (False, True), "sh:portName": (True, False), "sh:depth": (False, True)}
    by = {p.curie: p.objects[0] for p in vessel.predicates}
    assert (by["sh:callsign"].example, by["sh:homePort"].subjects, by["sh:visited"].subjects) == ("D5XY2", ["Port"], ["Port", "Berth"])
    assert [(p.curie, p.cardinality) for p in by["sh:engine"].inline.predicates] == [("sh:kilowatts", "+")]
    nodes, unreached = Sc.walk(subjects, ["Vessel"])
    assert [(n.path, n.multi_path) for n in nodes] == [("Vessel", False), ("Vessel/sh:homePort/Port", False), ("Vessel/sh:visited/Berth", True), ("Vessel/sh:engine/[]", False)]
    assert unreached == ["Beacon"]


def test_a_subject_that_is_missing_is_an_example():
    (only,) = Sc.parse_schema("- Crate sh:c1:\n  - sh:inside?:\n    - cargo: Grain\n")
    assert (only.predicates[0].objects[0].subjects, only.predicates[0].objects[0].example) == ([], "Grain")


def test_endpoint_and_prefixes():
    assert Sc.parse_endpoint("endpoint: https://ships.example/q") == ("https://ships.example/q", [])
    assert Sc.parse_endpoint("endpoint:\n  - https://ships.example/q\n  - graph:\n    - http://ships.example/2024\n    - http://ships.example/2025\n")[1] == ["http://ships.example/2024", "http://ships.example/2025"]
    known = Sc.parse_prefixes("sh: <http://ships.example/>\nun: http://un.example/locode/\n")
    assert Sc.expand("un:NLRTM", known) == "http://un.example/locode/NLRTM" and Sc.expand("<urn:x>", known) == "urn:x" and Sc.expand("no:1", known) == "no:1"


PLANTS = """\
- Garden ex:jardin:
  - ex:city:
    - city: "Lyon"
- Plant ex:rosa:
  - a: ex:Plant
  - ex:motto: "sub rosa"
  - ex:nick: "queen"
  - dct:identifier:
    - id: "P-17"
  - ex:alias*:
    - alias: "dog rose"
  - ex:garden?:
    - garden: Garden
  - ex:spans{1,2}: 3
- Weed ex:couch:
  - a: ex:Weed
"""


def resolved(roles=None, **rules):
    rules.setdefault("predicates", []).insert(0, R.PredicateRule("ex:alias", "Alias.value", "Named"))
    r = R.Resolver(model(), R.Rules(prefixes={"dct": "http://purl.org/dc/terms/"}, **rules), "src", {"ex": "http://ex.org/"})
    return r.build(Sc.parse_schema(PLANTS), ["Plant"], roles)


def test_mapping():
    rows, nodes = resolved(constants=[("Garden.city", "Lyon")])
    by = {(r.subject, r.column): r for r in rows}
    assert nodes[0].im_class == "Plant" and nodes[1].im_class == "Garden" and len(nodes) == 2
    key = by["Plant", "id"]
    assert (key.im_class, key.im_field, key.status, key.required, key.table) == ("Plant", "identifier", "sure", "yes", "main")
    alias = by["Plant", "alias"]
    assert (alias.im_class, alias.im_field, alias.via, alias.table) == ("Alias", "value", "Plant.aliases", "alias")
    assert by["Plant", "garden"].status == "link" and by["Garden", "city"].basis == "name"
    assert by["Weed", ""].note == "unreachable"
    assert R.tables_of(rows) == ["main", "alias"]
    assert [s.name for s in R.specs_of(rows, "alias")] == ["Plant.identifier", "Alias.value", "Garden.city"]
    skipped, _ = resolved({"Garden": "skip"})
    assert {r.table for r in skipped if r.subject == "Garden"} == {"drop"}


def test_collisions_get_their_own_table():
    rows, _ = resolved(predicates=[R.PredicateRule("ex:city", "Garden.label"), R.PredicateRule("ex:motto", "Plant.label"), R.PredicateRule("ex:nick", "Plant.label")])
    tables = [r.table for r in rows if (r.im_class, r.im_field) == ("Plant", "label")]
    assert len(tables) == len(set(tables)) == 2
    assert R.unique_variables(["x", "y", "x", "x"]) == ["x", "y", "x2", "x3"]


CYCLE = """\
- Guild ex:g1:
  - a: ex:Guild
  - ex:name: "smiths"
  - ex:within*:
    - above: Guild
  - ex:seat?:
    - seat: Town
- Town ex:t1:
  - a: ex:Town
  - ex:hosts*:
    - host: Guild
  - ex:twin?:
    - twin: [Town, Guild]
"""
GUILDS = """<model><class name="Guild" term="http://ex.org/Guild"><attribute name="identifier" type="java.lang.String"/><attribute name="name" type="java.lang.String"/><collection name="parents" referenced-type="Guild"/><reference name="town" referenced-type="Town"/></class>
<class name="Town" term="http://ex.org/Town"><attribute name="identifier" type="java.lang.String"/><reference name="survey" referenced-type="Survey"/></class><class name="Survey"><attribute name="name" type="java.lang.String"/></class></model>"""
RULES = """\
prefixes:
  ex: http://ex.org/
consts:
  Survey.name: all
subjects:
  - type: ex:Town
    im_class: Town
    status: sure
predicates:
  - pred: ex:within
    im: Guild.parents
    status: sure
    transform: iri_localname
    note: passed over
  - pred: -self-
    class: Town
    im: Town.identifier
    status: sure
    const:
      Survey.name: census
    const_via:
      Survey.name: Town.survey
"""


def test_back_edges_subject_columns_and_constants_through_links():
    catalog = Catalog().load_xml(GUILDS).load_keys("Guild.key = identifier\nTown.key = identifier\n")
    rules = R.Rules.load(RULES)
    assert rules.constants == [("Survey.name", "all")] and rules.predicates[1].consts == (("Survey.name", "census", "Town.survey"),)
    rows, nodes = R.Resolver(catalog, rules, "src", {"ex": "http://ex.org/"}).build(Sc.parse_schema(CYCLE), ["Guild"])
    assert [n.path for n in nodes] == ["Guild", "Guild/ex:seat/Town"]
    by = {(r.subject, r.predicate, r.column): r for r in rows}
    within = by["Guild", "ex:within", "above"]  # an edge back to its own subject is a column, and keeps the link
    assert (within.kind, within.im_class, within.im_field, within.via, within.table) == ("iri", "Guild", "identifier", "Guild.parents", "above")
    assert by["Guild", "ex:seat", "seat"].kind == "link"
    assert {by["Town", "ex:hosts", "host"].kind, by["Town", "ex:twin", "twin"].kind} == {"iri"}
    own = by["Guild", R.SELF, "guild"]  # no predicate carries the root's key
    assert (own.im_class, own.im_field, own.status, own.required, own.transform) == ("Guild", "identifier", "guess", "yes", "iri_localname")
    town = by["Town", R.SELF, "town"]
    assert (town.im_class, town.im_field, town.status) == ("Town", "identifier", "sure")
    const = by["Town", "-const-", "const_Survey_name_Town_survey"]
    assert (const.kind, const.via, const.value, const.table, const.status) == ("const", "Town.survey", "census", town.table, "sure")
    assert [r.value for r in rows if r.table == "*"] == ["all"]
    for bad in ("subjects:\n  - type: x\n", "predicates:\n  - im: A.b\n"):
        with pytest.raises(ValueError):
            R.Rules.load(bad)


def rows_of(*rows):
    names = ("im_class", "im_field", "kind", "value", "required", "transform")
    return [dict(zip(names, r, strict=True)) for r in rows]


TAXON = ("Organism", "taxonId")


@pytest.mark.parametrize(
    "row,taxa,want",
    [
        ((*TAXON, "literal", '"9606"', "yes", ""), ["10090"], '"10090"'),
        ((*TAXON, "literal", '"9606"', "yes", ""), ["9606", "10090"], '"9606" "10090"'),
        ((*TAXON, "iri", "up:9606", "yes", ""), ["4", "5"], "up:4 up:5"),
        ((*TAXON, "literal", "", "yes", ""), ["4"], "taxid:4"),
        ((*TAXON, "literal", '"9606"', "", ""), ["4"], None),
    ],
)
def test_taxon_scope(row, taxa, want):
    rows = rows_of(row)
    scoped, done = G.taxon_scope(rows, taxa, ["9606"])
    if row[3] == '"9606"' and want:
        want = " ".join(f"taxid:{t}" for t in taxa)  # literals have no prefix of their own, the taxon's is preferred
    assert (scoped[0]["value"], done) == ((want, "restricted") if want else (row[3], "absent")) and rows == rows_of(row)


def test_scopes_beside_constants():
    const, queried = (*TAXON, "const", "9606", "", ""), (*TAXON, "iri", "taxid:9606", "yes", "")
    assert G.taxon_scope(rows_of(const), ["9606"], ["9606"])[1] == "default"
    for taxa in (["10090"], ["9606", "10090"]):
        assert G.taxon_scope(rows_of(const), taxa, ["9606"]) == (None, "skipped")
    one, _ = G.taxon_scope(rows_of(const, queried), ["7227"], ["9606"])
    assert [r["value"] for r in one] == ["7227", "taxid:7227"]
    two, _ = G.taxon_scope(rows_of(const, queried), ["7227", "6239"], ["9606"])
    assert [r["value"] for r in two] == ["taxid:7227 taxid:6239"]


def test_gene_scope():
    rows = rows_of(("Gene", "primaryIdentifier", "iri", "", "", "iri_localname"), ("Gene", "symbol", "literal", "", "", ""))
    scoped, done = G.gene_scope(rows, "Gene", "primaryIdentifier", ["a", "b"])
    assert (scoped[0]["value"], scoped[0]["required"], done) == ('~"a" ~"b"', "yes", "restricted") and scoped[1] == rows[1] and rows[0]["required"] == ""
    assert G.gene_scope(rows, "Gene", "symbol", ["BRCA2"])[0][1]["value"] == '"BRCA2"'
    assert G.gene_scope(rows, "Gene", "nope", ["a"]) == (None, "skipped") and G.gene_scope(rows, "Gene", "symbol", []) == (rows, "default")
    assert G.gene_scope(rows_of(("Gene", "symbol", "const", "x", "", "")), "Gene", "symbol", ["a"]) == (None, "skipped")


def test_priorities():
    existing = {"Tree.height": ["survey", "atlas", "*"], "Tree.age": ["atlas"], "Tree.rank": ["*"]}
    writers = {"Tree.height": ["drone", "lidar", "notes"], "Tree.rank": ["extra1", "extra2"], "Tree.crown": ["drone", "notes"], "Tree.bark": ["extra1"], "Tree.root": ["drone"]}
    got = G.merge_priorities(existing, writers, {"drone": "survey", "lidar": "survey"}, {"extra1": "atlas", "extra2": "atlas"})
    assert got == {"Tree.height": ["drone", "lidar", "atlas", "notes", "*"], "Tree.age": ["atlas"], "Tree.rank": ["atlas", "extra1", "extra2", "*"], "Tree.crown": ["drone", "notes"], "Tree.bark": ["atlas", "extra1", "*"]}
    assert G.arranged(["a", "b", "c"], {"r": ["b", "c"]}, {"s": "a"}) == ["a", "s", "r"]


def test_conflicts(spark):
    rows = spark.createDataFrame([(1, "x", "a"), (1, "y", "b"), (2, "x", "u"), (2, "x2", "u"), (3, None, "a")], "k int, v string, s string")
    got = {r.k: (r.v, r.v_source, r.v_conflict) for r in G.by_priority(rows, ["k"], ["v"], "s", {"b": 0}, F.col("v")).collect()}
    assert got == {1: ("y", "b", False), 2: ("x", "u", True), 3: (None, None, False)}


def test_merge_without_base(spark):
    make = lambda *r: spark.createDataFrame(r, "k int, f string, status string, note string")
    cells = ["f", "status", "note"]
    got = {r.k: (r.f, r.status, r.origin) for r in G.three_way_merge(make((1, "a", "sure", ""), (2, "b", "guess", "")), make((1, "EDIT", "sure", ""), (2, "b", "drop", ""), (3, "z", "sure", "STALE x")), None, ["k"], cells).collect()}
    assert got == {1: ("EDIT", "human", "edited"), 2: ("b", "drop", "edited"), 3: ("z", "drop", "stale")}


def test_rows_that_only_the_disk_has(spark):
    make = lambda *r: spark.createDataFrame(r, "k string, f string, status string, note string")
    fresh, cells = make(("new", "n", "sure", "")), ["f", "status", "note"]
    base = make(("auto", "a", "sure", ""), ("edited", "b", "sure", ""))
    disk = make(("auto", "a", "sure", ""), ("edited", "B", "sure", "mine"), ("hand", "h", "human", ""))
    once = G.three_way_merge(fresh, disk, base, ["k"], cells)
    got = {r.k: (r.f, r.status, r.note, r.origin) for r in once.collect()}
    assert got == {"new": ("n", "sure", "", "fresh"), "edited": ("B", "drop", G.STALE + "; mine", "stale"), "hand": ("h", "drop", G.STALE, "stale")}
    again = G.three_way_merge(fresh, once.drop("origin"), fresh, ["k"], cells)  # the next base has neither
    assert {r.k: (r.f, r.status, r.note) for r in again.collect()} == {k: x[:3] for k, x in got.items()}


def test_closures_without_a_bound(spark):
    pairs = lambda edges: {(r.child, r.ancestor): r.depth for r in closure(spark.createDataFrame(edges, "c string, p string"), "c", "p").collect()}
    chain = pairs([(f"n{i}", f"n{i + 1}") for i in range(60)])
    assert chain["n0", "n60"] == 60 and len(chain) == 61 * 62 // 2
    diamonds = pairs([e for i in range(12) for e in ((f"t{i}", f"l{i}"), (f"t{i}", f"r{i}"), (f"l{i}", f"t{i + 1}"), (f"r{i}", f"t{i + 1}"))])
    assert diamonds["t0", "t12"] == 24  # by 4,096 paths
    assert pairs([("a", "b"), ("b", "c"), ("c", "a")])["a", "c"] == 2


def test_columns_told_apart_are_no_cross_product(spark):
    rows = spark.createDataFrame([("t", "s", "p", "", None), ("t", "s", "p", None, "x"), ("t", "s", "q", "", ""), ("t", "s", "q", "", ""), ("t", "s", "r", "equals:a", ""), ("t", "s", "r", "", "")], "table string, subject string, predicate string, filter string, value string")
    assert [(r.predicate, r.n) for r in G.cross_products(rows).collect()] == [("q", 2)]


def test_patterns(spark):
    t = spark.createDataFrame([("a", "rdf:type", "T"), ("a", "name", "A"), ("a", "tag", "x"), ("a", "tag", "y"), ("b", "rdf:type", "T"), ("b", "name", "B"), ("c", "name", "C"), ("a", "to", "n1"), ("n1", "label", "N")], "s string, p string, o string")
    node = P.Node("s", (P.Leaf("name", "name"), P.Leaf("tag", "tag", True)), (P.Branch("to", P.Node("n", (P.Leaf("label", "label"),)), True),), ("T",))
    for single in (set(), {"name", "label"}):
        got = P.Compiler(t, single).run(P.Pattern(node, ["s", "name", "tag", "label"]))
        assert sorted(map(tuple, got.collect()), key=str) == [("a", "A", "x", "N"), ("a", "A", "y", "N"), ("b", "B", None, None)]
    text = P.to_sparql(P.Pattern(node, ["s", "name"]), {"ex": "http://ex/"})
    assert "SELECT DISTINCT ?s ?name" in text and "OPTIONAL { ?s tag ?tag . }" in text and "?s a T ." in text


def test_path_query_text(spark):
    q = parse_query_xml('<query view="Plant.label Plant.garden.city" sortOrder="Plant.label desc"><constraint path="Plant.garden.city" op="=" value="Lyon"/></query>')
    assert q.view == ["Plant.label", "Plant.garden.city"] and q.sort == [("Plant.label", "desc")] and q.constraints[0] == Constraint("Plant.garden.city", "=", "Lyon")
    assert parse_constraint("a.b NOT IN (x, 'y')") == Constraint("a.b", "NOT IN", ["x", "y"])
    assert parse_constraint("a.b IS NOT NULL").op == "IS NOT NULL" and parse_constraint("s>=0.5") == Constraint("s", ">=", "0.5")
    plants = spark.createDataFrame([("1", "rose", "g1"), ("2", "fern", "g2"), ("3", "moss", None)], "id string, label string, g string")
    gardens = spark.createDataFrame([("g1", "Lyon"), ("g2", "Bonn")], "id string, city string")
    through = spark.createDataFrame([("1", "g1"), ("3", "g1")], "p string, g string")
    mine = Mine(model(), {"Plant": plants, "Garden": gardens, "pg": through}, {("Plant", "label"): "label", ("Garden", "city"): "city"}, {("Plant", "garden"): Link((("g", "id"),))})
    assert [tuple(r) for r in mine.run(q).collect()] == [("rose", "Lyon")]
    mine.links["Plant", "garden"] = Link(through=("pg", (("id", "p"),), (("g", "id"),)))
    assert [tuple(r) for r in mine.run(q).collect()] == [("rose", "Lyon"), ("moss", "Lyon")]
    with pytest.raises(ValueError):
        mine.run(PathQuery(["Plant.nope"]))


def test_a_pattern_reads_only_the_columns_of_its_predicates(spark):
    """Over tables a predicate is a projection: no column that the pattern doesn't ask for is read, and nothing is unpivoted."""
    from tessera.queries import QUERIES

    plan = QUERIES["bgp_path"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "c_mktsegment" not in plan and "o_orderstatus" not in plan and "c_name" in plan
    t = P.Triples((P.TripleTable(spark.createDataFrame([(1, "a", None), (2, None, "z")], "k int, x string, y string"), "k", "n:", {"x": "px", "y": "py"}, ("T",)),)).backward("px", "of")
    assert sorted(map(tuple, t.of("px", "of").collect())) == [("a", "of", "n:1"), ("n:1", "px", "a")]
    assert t.of().count() == 5 and t.of("none").count() == 0


def test_priorities_with_several_stock_sources_and_overrides():
    got = G.merge_priorities({"Gene.name": ["a", "b", "c", "*"]}, {"Gene.name": ["extra"], "Gene.note": ["extra"]}, {}, {"extra": ["a", "b"]}, {"Gene.type": ["x", "y"]})
    assert got == {"Gene.name": ["a", "b", "extra", "c", "*"], "Gene.note": ["a", "b", "extra", "*"], "Gene.type": ["x", "y"]}


def test_a_later_type_replaces_and_mixed_lists_keep_references():
    crate, box = Sc.parse_schema("- Crate sh:c1:\n  - a: sh:Old\n  - a: [sh:New, sh:Thing]\n  - sh:holds*:\n    - inner: [Box, 'loose']\n- Box sh:b1:\n  - a: sh:Box\n")
    assert crate.types == ["sh:New", "sh:Thing"] and crate.predicates[0].objects[0].subjects == ["Box"] and box.types == ["sh:Box"]


def test_key_lines():
    from tessera.sources.exports import key_lines

    assert key_lines(model(), ["Plant", "Alias", "Garden", "Named", "Plant"]) == ["Alias.key = plant, value", "Garden.key = identifier", "# DRAFT: no key is declared for Named", "Named.key_identifier = identifier", "Plant.key = identifier"]


def test_closure_writes_each_pair_once(spark, monkeypatch):
    from tessera.plans import catalog as C

    rows, own = [], C.written

    def counted(df):
        out = own(df)
        rows.append(out.count())
        return out

    monkeypatch.setattr(C, "written", counted)
    edges = spark.createDataFrame([(f"n{i}", f"n{i // 2}") for i in range(1, 60)] + [("n0", "n0"), (None, "n1")], "c string, p string")
    found = C.closure(edges, "c", "p", spark.createDataFrame([("alone",), ("n3",), ("alone",)], "cls string"))
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) == sum(rows)
    want = {(a, a, 0) for a in ["alone", None, *(f"n{i}" for i in range(60))]} | {(f"n{i}", f"n{i >> d}", d) for i in range(60) for d in range(1, i.bit_length() + 1)}
    want |= {(None, "n1", 1), (None, "n0", 2)}
    assert set(got) == want
