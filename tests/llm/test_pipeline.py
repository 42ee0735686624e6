import re

import corpus_pipeline as cp
from test_jaccard import brute
from test_packing import check

from tessera.llm.queries import op8_toxicity, table

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns, rows = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in op8_toxicity(spark, SF).collect() if r.predicted}
    want = {i: t for i, t in rows.items() if i not in toxic}
    one = cp.reject_toxic(spark, docs, SF).cache()
    assert one.columns == columns and {r.doc_id: r.text for r in one.collect()} == want

    first = {}
    for i in sorted(want):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", want[i] or ""), i)
    want = {i: want[i] for i in first.values()}
    two = cp.drop_copies(spark, one, SF).cache()
    assert two.columns == columns and {r.doc_id: r.text for r in two.collect()} == want

    kept = {int(c) for i, n, c in brute(list(want.items()), 5, 80) if n} | {int(i) for i, n, _ in brute(list(want.items()), 5, 80) if not n}
    want = {i: want[i] for i in kept}
    three = cp.drop_near_copies(spark, two, SF).cache()
    assert three.columns == columns and {r.doc_id: r.text for r in three.collect()} == want

    four = cp.mix_sources(spark, three, SF).cache()
    sampled = {r.doc_id: r.text for r in four.collect()}
    assert four.columns == columns and sampled.items() <= want.items() and 0 < len(sampled) < len(want)
    check(cp.pack_windows(spark, four, SF).collect(), list(sampled.items()))


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c", "en", "s"), (1, "a b c", "en", "s"), (2, "a  b c", "en", "s"), (None, "x y", "en", "s"), (None, "x y", "en", "s"), (3, None, None, None), (4, "", "en", "s")]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, lang string, source string, norm int")
    got = sorted((str(r.doc_id), r.text) for r in cp.drop_copies(spark, docs, SF).collect())
    assert got == [("1", "a b c"), ("3", None), ("None", "x y")]
    near = cp.drop_near_copies(spark, docs.filter("doc_id > 1"), SF)
    assert sorted(r.doc_id for r in near.collect()) == [2, 3, 4]
    assert cp.mix_sources(spark, docs.filter("norm = 0"), SF).count() == 0
