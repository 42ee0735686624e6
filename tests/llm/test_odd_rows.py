"""Odd rows in every stage of the pipeline, and in operators whose own tests lack them."""

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from tessera.llm import queries as Q
from tessera.llm.packing import pack
from tessera.llm.pii import personal_data
from tessera.llm.urls import judge_urls

SF = "/root/testdata/sf0.001"
#: Names that operators use for columns of their own, and one with a dot.
CLASHES = ["norm", "row_id", "row_key", "key", "deal", "half", "sha", "s", "rule", "verdict", "found", "score", "features", "tokens", "row", "sampled", "draw", "a.b"]
SCHEMA = "doc_id long, text string, lang string, source string"


def odd(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHES)))


@pytest.mark.parametrize("name,stage", cp.STAGES)
def test_stage_of_an_empty_table(spark, name, stage):
    out = stage(spark, odd(spark, [(1, "x", "en", "s")]).filter("doc_id > 1"), SF)
    assert out.count() == 0
    assert name == "packing" or out.columns == ["doc_id", "text", "lang", "source", *CLASHES]


@pytest.mark.parametrize("name,stage", cp.STAGES[:-1])
def test_stage_keeps_columns_texts_and_nulls(spark, name, stage):
    long = " ".join(f"word{i % 977}x{i}" for i in range(300_000))
    rows = [(1, long, "en", "s"), (None, "plain words of one text", None, None), (3, None, "de", "t"), (4, "", "de", "t"), (None, "quite other words in this", "en", None)]
    out = stage(spark, odd(spark, rows), SF)
    assert out.columns == ["doc_id", "text", "lang", "source", *CLASHES]
    got = {(r.doc_id, r.text, r.lang, r.source) for r in out.collect()}
    if name == "mixing":  # samples
        assert got <= set(rows)
    elif name == "exact dedup":
        assert got == set(rows) - {(4, "", "de", "t")}  # null is empty, and 3 comes first
    else:
        assert got == set(rows)
    assert all(r["a.b"] == CLASHES.index("a.b") for r in out.collect())


def test_packing_of_odd_rows(spark):
    rows = [(1, "one two " * 40_000, "en", "s"), (1, "one two", "en", "s"), (None, None, None, None), (None, "", "en", "s"), (2, "one two", "en", "s")]
    for pieces in (cp.pack_windows(spark, odd(spark, rows), SF).collect(), pack(odd(spark, rows), Q.tokenizer_path()).collect()):
        whole = [r for r in pieces if r.start == 0]
        assert sorted(str(r.doc_id) for r in whole) == ["1", "1", "2", "None", "None"]
        assert sorted(r.doc_tokens for r in whole if r.doc_id is None) == [1, 1]
        assert sum(r.length for r in pieces) == sum(r.doc_tokens for r in whole)


def test_urls_with_null_and_repeated_ids(spark):
    rows = [(None, "http://a.example.com/en/7x"), (None, "http://b.org/es/1"), (1, None), (1, None), (2, ""), (3, "no scheme"), (4, "http://x.net/" + "y" * 100_000)]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 AS s", "2 AS verdict", "3 AS score")
    got = judge_urls(df, Q.URL_RULES).collect()
    assert sorted(str(r.page_id) for r in got) == sorted(str(i) for i, _ in rows) and {r.verdict for r in got} <= {"allow", "block"}
    assert {r.rule: r.verdict for r in got if r.page_id is None} == {"example.com/en/7": "allow", "org/es/": "block"}
    assert len({r.verdict for r in got if r.page_id in (1, 2)}) == 1
    assert judge_urls(df.filter("page_id = 9"), Q.URL_RULES).count() == 0


def test_personal_data_with_null_and_repeated_ids(spark):
    rows = [(None, "write to a.b@c.org"), (None, "write to a.b@c.org"), (1, None), (1, ""), (2, "é +49 170 1234567"), (3, "x " * 150_000 + "10.0.0.1")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS base", "2 AS loose", "3 AS pattern")
    got = [(r.doc_id, [tuple(x) for x in r.base]) for r in personal_data(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(None, [(0, 9, 18)]), (None, [(0, 9, 18)]), (1, []), (1, []), (2, [(3, 2, 17)]), (3, [(1, 300_000, 300_008)])]))
    assert personal_data(df.filter("doc_id = 9")).count() == 0


@pytest.mark.parametrize("query,method,threshold", [(Q.op3_quality, "quality", 0.7), (Q.op8_toxicity, "toxicity", 0.5)])
def test_a_score_at_the_threshold_counts(spark, monkeypatch, query, method, threshold):
    ids = [r.doc_id for r in Q.table(spark, SF, "documents").select("doc_id").limit(3).collect()]
    below = threshold - 1e-12
    stub = lambda *a, **k: spark.createDataFrame([(ids[0], threshold), (ids[1], below), (None, 1.0)], "doc_id long, score double")
    monkeypatch.setattr(Q, method, stub)
    assert {r.doc_id: (r.predicted, r.held_out in (True, False)) for r in query(spark, SF).collect()} == {ids[0]: (1, True), ids[1]: (0, True), None: (1, True)}
