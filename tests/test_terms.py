import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import terms as T


def values(spark, inputs, f):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


CLEAN = {
    "<http://x/y>": "http://x/y",
    '"abc"': "abc",
    '"12"^^<http://www.w3.org/2001/XMLSchema#integer>': "12",
    '"1.5"^^xsd:decimal': "1.5",
    '"hi"@en': "hi",
    r'"a\tb\nc \"q\""': 'a b c "q"',
    "": "",
    "_:b0": "_:b0",
    "bare": "bare",
    r'"back\\slash"': "back\\slash",
    r'"\\t"': "\\t",
    '"' + chr(92) + 'u00e9"': "u00e9",
    '  "pad "  ': "pad",
    '"open': '"open',
    None: "",
}


def test_clean_term(spark):
    assert values(spark, list(CLEAN), T.clean_term) == list(CLEAN.values())


def plain_clean(v):
    """The ledger's rules by a loop; a literal ends at its last quote, whatever quotes are inside."""
    v = v.strip(" \t\n\r\f\x0b")
    if v.startswith("<") and v.endswith(">"):
        return v[1:-1]
    m = re.fullmatch(r'(?s)"(.*)"(?:\^\^<[^>]*>|\^\^[A-Za-z][\w.-]*:[\w.-]+|@[A-Za-z0-9-]+)?', v, re.A)
    if not m:
        return v
    out, i, s = "", 0, m[1]
    while i < len(s):
        if s[i] == "\\" and i + 1 < len(s):
            i += 1
            out += " " if s[i] in "tnr" else s[i]
        else:
            out += " " if s[i] in "\t\n\r" else s[i]
        i += 1
    return out.strip(" \t\n\r\f\x0b")


def test_clean_term_on_random_terms(spark):
    r = random.Random(1)
    inputs = []
    for _ in range(1500):
        body = "".join(r.choice(['a', '\\\\', '\\"', '\\t', '\\n', '\\x', " ", "\t", "é", "^", "@", ":", "<", ">"]) for _ in range(r.randrange(0, 9)))
        inputs.append(r.choice(['"%s"', '"%s"@en', '"%s"^^<t>', '"%s"^^xsd:int', "<%s>", "%s", '"%s', "_:%s"]) % body)
    assert values(spark, inputs, T.clean_term) == [plain_clean(x) for x in inputs]


@pytest.mark.parametrize(
    "spec,given,want",
    [
        ("iri_localname,replace:_:\\:", "http://purl.obolibrary.org/obo/GO_0008150", "GO:0008150"),
        ("prefix:HGNC:", "11998", "HGNC:11998"),
        ("prefix:HGNC:", "HGNC:11998", "HGNC:11998"),
        (r"regex:^(\d{4})", "2017-08-10", "2017"),
        ("split:,", "A, B ,C,,", ["A", "B", "C"]),
        ("split:,,lower", "A, B", ["a", "b"]),
        ("strip_prefix:KW-", "KW-0001", "0001"),
        ("strip_prefix:KW-,int", "KW-0001", "0001"),
        ("int", "x-12y3", "-12"),
        ("upper", "aé", "AÉ"),
        ("", "same", "same"),
        ("iri_localname", "http://a/b#c/", "c"),
    ],
)
def test_transforms(spark, spec, given, want):
    run, listed = T.compile_transform(spec)
    assert values(spark, [given], run) == [want] and listed == isinstance(want, list)


def test_unknown_names():
    with pytest.raises(ValueError):
        T.compile_transform("nope")
    with pytest.raises(ValueError):
        T.compile_filter("nope:1")


def test_to_ascii(spark):
    cases = {"ERα-regulated": "ERalpha-regulated", "TNF-α/β": "TNF-alpha/beta", "café": "cafe", "ﬁsh": "fish", "“q” ‘s’ –": "\"q\" 's' -", "中": "?", "plain": "plain", "Å½": "A?", "①": "1"}
    assert values(spark, list(cases), T.to_ascii) == list(cases.values())


def test_constraint_path(spark):
    cases = {"organism.name=[Organism]": "organism.name", "score >= 0.5": "score", "a.b IS NOT NULL": "a.b", "x NOT IN (1, 2)": "x", "n != null": "n"}
    assert values(spark, list(cases), T.constraint_path) == list(cases.values())


def test_types(spark):
    ints = {"1": True, " +5 ": True, "1.5": False, "NR": False, "": False, "-0": True}
    assert values(spark, list(ints), lambda c: T.fits_type(c, "int")) == list(ints.values())
    floats = {"1": True, "1.5": True, ".5": True, "1e-3": True, "1d": False, "nan": True, "x": False}
    assert values(spark, list(floats), lambda c: T.fits_type(c, "java.lang.Double")) == list(floats.values())
    assert values(spark, ["12", "1.5", "true", "x"], T.guess_type) == ["java.lang.Integer", "java.lang.Double", "java.lang.Boolean", "java.lang.String"]


def test_names(spark):
    assert values(spark, ["primaryIdentifier"], T.snake) == ["primary_identifier"]
    assert values(spark, ["Ab-C 1"], T.flat) == ["abc1"]
    assert values(spark, ["a-b c", "1x"], T.variable_name) == ["a_b_c", "_1x"]
    assert values(spark, ["a|b\nc", "x" * 200], T.markdown_cell) == ["a\\|b c", "x" * 159 + "…"]
    assert values(spark, ["<http://a>", "ex:S", '"lit"', "some text", "_:b"], T.looks_literal) == [False, False, True, True, False]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab,\\ :", max_size=6), max_size=4))
def test_split_steps_never_loses_plain_steps(parts):
    steps = T.split_steps(",".join(p.replace("\\", "").replace(",", "") for p in parts))
    assert steps == [p.replace("\\", "").replace(",", "").strip() for p in parts if p.replace("\\", "").replace(",", "").strip()]


def test_literals_with_raw_quotes_and_controls(spark):
    cases = {'"a "b" c"@en': 'a "b" c', '"x"y"^^<t>': 'x"y', '"a\\\\n\\n\\"b"': 'a\\n "b', '"p\x01q"': "p\x01q", '"': '"', '""': "", '"open': '"open', '"n"^^xsd:int': "n", " <i> ": "i"}
    from tessera.functions.terms import clean_term, fits_type

    df = spark.createDataFrame(list(cases.items()), "t string, want string")
    assert [tuple(r) for r in df.filter(clean_term(F.col("t")) != F.col("want")).collect()] == []
    numbers = spark.createDataFrame([("INF", True), ("-Infinity", True), ("NaN", True), ("1e5", True), ("nano", False)], "t string, want boolean")
    assert numbers.filter(fits_type(F.col("t"), "java.lang.Double") != F.col("want")).count() == 0
