import pytest

from tessera.operators import checks as K
from tessera.plans.catalog import Catalog

MODEL = """<model>
<class name="Thing"><attribute name="label" type="java.lang.String"/></class>
<class name="Vessel" extends="Thing"><attribute name="imo" type="java.lang.String"/><reference name="home" referenced-type="Port" reverse-reference="vessels"/><collection name="calls" referenced-type="Place"/></class>
<class name="Tug" extends="Vessel"><attribute name="pull" type="java.lang.Double"/></class>
<class name="Place" extends="Thing"/>
<class name="Port" extends="Place"><attribute name="code" type="java.lang.String"/><collection name="vessels" referenced-type="Vessel" reverse-reference="home"/></class>
<class name="Berth" extends="Place"><reference name="owner" referenced-type="Firm" reverse-reference="berths"/></class>
<class name="Firm"/>
</model>"""


def model():
    return Catalog().load_xml(MODEL).load_keys("Vessel.key = imo\n")


def columns(spark, *rows):
    """(source, table, column, cls, field) and any of via, kind, required, root, subject, predicate, discriminated."""
    base = {"source": "s", "table": "main", "column": "c", "via": "", "kind": "literal", "required": False, "root": False, "subject": "S", "predicate": "", "discriminated": False}
    made = [{**base, "predicate": f"p{i}", **r} for i, r in enumerate(rows)]
    names = [x.split()[0] for x in K.SCHEMAS["columns"].split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in made], K.SCHEMAS["columns"])


def project(spark, *rows, core=("Thing", "Place"), **tables):
    make = {k: spark.createDataFrame(v, K.SCHEMAS[k]) for k, v in tables.items()}
    return K.Project.of(spark, model(), core, columns=columns(spark, *rows), **make)


def found(p, *names):
    return sorted((r.rule, r.severity, r.source, r.subject) for r in K.findings(p, names).collect())


def col(cls, field, **more):
    return {"cls": cls, "field": field, **more}


def test_classes_fields_and_links(spark):
    p = project(spark, col("Tug", "imo", root=True), col("Tug", "label"), col("Tug", "home"), col("Boat", "x"), col("New", "x"), col("Tug", "speed"), col("Tug", "rating"),
                col("Port", "code", via="Tug.home"), col("Port", "code", via="Tug.calls"), col("Firm", "n", via="Tug.home"), col("Port", "code", via="Tug.imo"), col("Port", "code", via="Tug.nope"),
                additions=[("New", None), ("Tug", "rating"), ("Firm", "n"), ("New", "x")])
    names = ("unknown_class", "unknown_field", "not_attribute", "via_unknown", "via_attribute", "via_range", "via_widens")
    assert found(p, *names) == [
        ("not_attribute", "hard", "s", "Tug.home reference"), ("unknown_class", "hard", "s", "Boat"), ("unknown_field", "hard", "s", "Tug.speed"),
        ("via_attribute", "hard", "s", "Tug.imo"), ("via_range", "hard", "s", "Tug.home Firm"), ("via_unknown", "hard", "s", "Tug.nope"), ("via_widens", "soft", "s", "Tug.calls Port"),
    ]


def test_keys_collisions_and_products(spark):
    p = project(spark, col("Tug", "imo"), col("Place", "label"), col("Firm", "n", required=True), col("Port", "code", table="t", column="a"), col("Port", "code", table="t", column="b"),
                col("Port", "code", table="t", column="k", kind="const"), col("Port", "label", predicate="q", table="u"), col("Port", "code", predicate="q", table="u", kind="iri"),
                col("Port", "label", predicate="r", table="v"), col("Port", "code", predicate="r", table="v", discriminated=True), draft_keys=[("Firm",)])
    assert found(p, "no_key", "draft_key", "collision", "cross_product") == [
        ("collision", "hard", "s", "t Port.code "), ("cross_product", "hard", "s", "u S q"), ("draft_key", "soft", "s", "Firm"), ("no_key", "soft", "s", "Place"), ("no_key", "soft", "s", "Port"),
    ]


def test_items_and_sources(spark):
    p = project(spark, items=[("s", "1", "Tug"), ("s", "2", "Raft"), ("t", "1", "Raft")], links=[("s", "1", "2"), ("s", "1", "3"), ("t", "1", "2")],
                order=[("a", 1), ("b", 2), ("c", 3)], replaces=[("a", "b"), ("c", "gone"), ("a", "x")], alongside=[("a", "c"), ("c", "a"), ("b", "absent"), ("a", "x")])
    assert found(p, "unknown_item_class", "dangling_reference", "replaces_and_alongside", "alongside_absent", "load_order", "still_active") == [
        ("alongside_absent", "soft", "b", "absent"), ("dangling_reference", "hard", "s", "1"), ("dangling_reference", "hard", "t", "1"), ("load_order", "hard", "a", "c"),
        ("replaces_and_alongside", "hard", "a", "x"), ("still_active", "soft", "a", "b"), ("unknown_item_class", "hard", "s", "Raft"), ("unknown_item_class", "hard", "t", "Raft"),
    ]


def test_coverage_counts_subclasses_implied_links_and_reverse_ends(spark):
    """Tug.label covers Thing.label, the port column of a tug table implies Tug.home, and that writes Port.vessels."""
    p = project(spark, col("Tug", "label", root=True), col("Port", "code"), replaces=[("s", "old"), ("s", "older")],
                declared=[("old", "Thing", "label"), ("old", "Vessel", "home"), ("old", "Port", "vessels"), ("old", "Port", "code"), ("old", "Vessel", "imo"), ("older", "Firm", "n"), ("older", "Berth", "owner"), ("other", "Berth", "owner")],
                accepted=[("s", "Vessel.imo"), ("s", "Firm"), ("s", "Port.code")])
    assert {(r.cls, r.field) for r in p.written_fields.collect()} == {("Tug", "label"), ("Port", "code"), ("Tug", "home"), ("Port", "vessels")}
    assert found(p, "coverage_gap", "accepted_gap", "unused_acceptance") == [
        ("accepted_gap", "soft", "s", "old Vessel.imo"), ("accepted_gap", "soft", "s", "older Firm.n"), ("coverage_gap", "hard", "s", "older Berth.owner (class)"), ("unused_acceptance", "soft", "s", "Port.code"),
    ]


def test_reverse_ends(spark):
    p = project(spark, additions=[("Vessel", "home"), ("Berth", "owner")])
    assert found(p, "unresolved_reverse") == [("unresolved_reverse", "hard", "", "Berth.owner Firm.berths"), ("unresolved_reverse", "hard", "", "Vessel.home Port.vessels")]
    assert found(project(spark, core=("Port",), additions=[("Vessel", "home"), ("Firm", "berths"), ("Berth", "owner")]), "unresolved_reverse") == []


def test_all_rules(spark):
    p = project(spark, col("Tug", "imo", root=True, required=True))
    assert K.passes(K.findings(p))
    assert not K.passes(K.findings(project(spark, col("Boat", "x")), ["unknown_class"]))
    with pytest.raises(ValueError):
        K.findings(p, ["nope"])
    assert len(K.RULES) == 21 and all(f.__doc__ for _, f in K.RULES.values())


def test_carried_definitions(spark):
    p = project(spark)
    written = spark.createDataFrame([("Tug", "pull"), ("Tug", "home"), ("Thing", "label"), ("Tug", "label"), ("Berth", "owner"), ("Tug", "nope"), ("Gone", "x")], "cls string, field string")
    classes, fields = K.carried_definitions(p, written)
    assert {r.cls: r.parents for r in classes.collect()} == {"Tug": "Vessel", "Vessel": "Thing", "Berth": "Place", "Port": "Place", "Firm": ""}
    assert sorted(map(tuple, fields.collect())) == [
        ("Berth", "owner", "reference", "Firm", "berths"), ("Firm", "berths", "collection", "Berth", "owner"), ("Port", "vessels", "collection", "Tug", "home"),
        ("Tug", "home", "reference", "Port", "vessels"), ("Tug", "label", "attribute", "java.lang.String", ""), ("Tug", "pull", "attribute", "java.lang.Double", ""),
    ]
    live = spark.createDataFrame([("Place", "label")], "cls string, field string")
    _, fields = K.carried_definitions(p, spark.createDataFrame([("Place", "label"), ("Thing", "label"), ("Port", "vessels"), ("Vessel", "home")], "cls string, field string"), live)
    assert sorted((r.cls, r.field) for r in fields.collect()) == [("Port", "vessels"), ("Thing", "label"), ("Vessel", "home")]


def test_links_and_their_fields_are_kept_once_not_once_a_column(spark):
    """Forty columns with one implied and one own link; only the classes that links name have their fields looked up."""
    p = project(spark, col("Tug", "imo", root=True), *(col("Port", "code", column=f"c{i}") for i in range(40)), *(col("Port", "code", via="Tug.home", column=f"v{i}") for i in range(40)))
    assert [tuple(r) for r in p.implied_links.collect()] == [("s", "Port", "Tug", "home")]
    assert [tuple(r) for r in p.links_used.collect()] == [("s", "Tug", "home")]
    assert {r.cls for r in p.known_of(spark.createDataFrame([("Tug",), ("Tug",), ("Nope",)], "cls string")).collect()} == {"Tug"}
    assert {r.via_field: r.via_type for r in p.via_kinds.collect()}["home"] == "Port"


def test_fields_that_are_written_ask_no_subclass(spark, monkeypatch):
    """Coverage looks below a class only for the field that it doesn't write; subclasses' fields and nulls count as before."""
    kept, own = [], K.written
    monkeypatch.setattr(K, "written", lambda df: kept.append(own(df)) or kept[-1])
    up = spark.createDataFrame([("a", "a", 0), ("b", "b", 0), ("c", "c", 0), ("b", "a", 1), ("c", "b", 1), ("c", "a", 2), ("d", "d", 0)], "child string, ancestor string, depth long")
    fields = spark.createDataFrame([("s", "a", "f"), ("s", "c", "g"), ("s", "x", "f"), ("t", "b", "f")], "source string, cls string, field string")
    declared = [("s", "o", "a", "f"), ("s", "o", "a", "g"), ("s", "o", "a", "h"), ("s", "o", "d", "f"), ("s", "o", "x", "f"), ("s", "o", "x", "g"), ("t", "o", "c", "f"), ("t", "o", "a", "f"), ("s", "o", None, "f"), ("s", "o", "a", "h")]
    got = K.coverage(fields, spark.createDataFrame(declared, "source string, stock string, cls string, field string"), up).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [("s", "o", "a", "h", False), ("s", "o", "d", "f", True), ("s", "o", "x", "g", False), ("t", "o", "c", "f", True), ("s", "o", None, "f", True)]))
    assert kept and kept[0].filter("source = 's' AND cls = 'a' AND field = 'f'").isEmpty()
