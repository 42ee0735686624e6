from pyspark.sql import functions as F

from tessera.llm.mixing import mix


def test_tables_rake_as_far_as_the_driver(spark):
    # A sparse table of which 25 rounds leave the weights off by 4e-6.
    words = {("s0", "en"): 1, ("s0", "de"): 2, ("s1", "de"): 3}
    df = spark.createDataFrame([(i, "w " * n, s, x) for i, ((s, x), n) in enumerate(words.items())], "doc_id long, text string, source string, lang string")
    targets = {"source": {"s0": 0.5, "s1": 0.5}, "lang": {"en": 0.4, "de": 0.6}}
    one, two = ({(r.source, r.lang): r.weight for r in mix(df, F.lit("t"), 0.5, targets, driver_cells=n).collect()} for n in (1000, 0))
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-8 for k in one)
