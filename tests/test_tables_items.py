from pyspark.sql import Observation
from pyspark.sql import functions as F

from tessera.operators import items as I
from tessera.operators.tables import ColumnSpec, clean_table


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_table_of_the_fixture(spark):
    raw = spark.createDataFrame([('"1"', '"a, b"', "<http://x/GO_1>"), ('"1"', '"a, b"', "<http://x/GO_1>"), ('"2"', "", "_:b1"), ("", '"lost"', "")], "id string, syn string, go string")
    specs = [ColumnSpec("id", "id", required=True), ColumnSpec("go", "go", "iri_localname", "regex:^http"), ColumnSpec("taxon", value="9606")]
    seen = Observation()
    assert rows(clean_table(raw, specs, observation=seen)) == [("1", "GO_1", "9606"), ("2", "", "9606")]
    assert seen.get == {"rows_in": 4, "filtered": 0}


def test_filter_sees_the_value_before_its_transform(spark):
    raw = spark.createDataFrame([("<http://x/A>",), ("_:b",), ("<http://www.w3.org/2002/07/owl#Thing>",), ("<http://x/B>",)], "v string")
    spec = lambda required: [ColumnSpec("k", value="c"), ColumnSpec("v", "v", "iri_localname", "regex:^http://x", required=required)]
    assert rows(clean_table(raw, spec(True))) == [("c", "A"), ("c", "B")]
    assert rows(clean_table(raw, [*spec(False), ColumnSpec("w", "v")], distinct=False))[:1] == [("c", "", "_:b")]


def test_missing_variables_and_splits(spark):
    raw = spark.createDataFrame([("x", "1;2", "a;b"), ("y", "", "a")], "id string, n string, m string")
    specs = [ColumnSpec("id", "id"), ColumnSpec("n", "n", "split:;"), ColumnSpec("m", "m", "split:;")]
    assert rows(clean_table(raw, specs)) == [("x", "1", "a"), ("x", "1", "b"), ("x", "2", "a"), ("x", "2", "b"), ("y", "", "a")]
    assert clean_table(raw, [*specs, ColumnSpec("q", "absent", required=True)]).count() == 0
    assert clean_table(raw.filter("id = 'z'"), specs).count() == 0


def test_identity(spark):
    df = spark.createDataFrame([("p1", "s1", "d"), ("", "s1", "d2"), (None, "", "d3"), ("", "", "")], "a string, b string, d string")
    i = I.identity("Gene", ["a", "b"], {"a": F.col("a"), "b": F.col("b"), "d": F.col("d")})
    got = [tuple(r.i) if r.i else None for r in df.select(i.alias("i")).collect()]
    assert got == [("Gene", "a", "p1"), ("Gene", "b", "s1"), ("Gene", "*", "d=d3"), None]


def test_ambiguity(spark):
    data = [(1, "E1", "protein-coding"), (2, "E1", "ncRNA"), (3, "E2", "ncRNA"), (4, "E2", "ncRNA"), (5, "E3", "x"), (6, "", "x"), (7, None, "x")]
    df = spark.createDataFrame([(*d, "9606") for d in data], "id int, ens string, kind string, org string")
    got = {r.id: r.ens for r in I.resolve_ambiguity(df, "ens", ["org"], F.col("kind") == "protein-coding").collect()}
    assert got == {1: "E1", 2: "", 3: "", 4: "", 5: "E3", 6: "", 7: None}


def test_objects_of_wide_rows(spark):
    df = spark.createDataFrame([("1", "A", "x", 0), ("1", "", "y", 1), ("2", "B", "", 2)], "id string, sym string, alias string, n int")
    got = I.split_objects(df, {"Gene": {"id": "id", "symbol": "sym"}, "Synonym": {"value": "alias"}}, {"Gene": ["id"], "Synonym": ["value"]}, F.col("n"))
    objects = got.groupBy("item", "field").agg(F.min_by("value", "ord").alias("value"))
    assert sorted((r["item"].cls, r["item"].key_value, r.field, r.value) for r in objects.collect()) == [("Gene", "1", "id", "1"), ("Gene", "1", "symbol", "A"), ("Gene", "2", "id", "2"), ("Gene", "2", "symbol", "B"), ("Synonym", "x", "value", "x"), ("Synonym", "y", "value", "y")]


def test_numbers_are_dense(spark):
    df = spark.range(1000).withColumn("k", F.xxhash64("id")).repartition(7)
    got = sorted((r.k, r.item_no) for r in I.numbered(df, [F.col("k")]).collect())
    assert [n for _, n in got] == list(range(1, 1001))


def test_numbers_of_more_rows_than_the_sampler_takes(spark):
    own = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        df = spark.range(400_000).withColumn("k", F.xxhash64("id"))
        n = I.numbered(df, [F.col("k")])
        assert tuple(n.agg(F.min("item_no"), F.max("item_no"), F.count_distinct("item_no")).first()) == (1, 400_000, 400_000)
        assert n.join(n.select((F.col("item_no") + 1).alias("item_no"), F.col("k").alias("before")), "item_no").filter("before >= k").isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", own)
