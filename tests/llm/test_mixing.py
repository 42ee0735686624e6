import numpy as np
import pytest
from oracle import assert_same
from pyspark.sql import functions as F

from tessera.llm.mixing import mix, mix_sql, probabilities, rake
from tessera.llm.queries import op9_mixing


def test_rake_meets_the_marginals():
    r = np.random.default_rng(0)
    codes = [a.ravel() for a in np.indices((5, 4, 3))]
    mass = r.random(60) * 1000
    targets = [x / x.sum() for x in (r.random(5), r.random(4), r.random(3))]
    w = rake(mass, codes, targets)
    for code, t in zip(codes, targets):
        assert np.allclose(np.bincount(code, w), t, atol=1e-8)


def test_probabilities_spend_the_budget():
    r = np.random.default_rng(1)
    for _ in range(200):
        mass, w = r.random(20) * 100 * (r.random(20) > 0.1), r.random(20) ** 4
        budget = r.random() * mass.sum()
        p = probabilities(mass, w, budget)
        assert (p <= 1).all() and (p >= 0).all()
        assert np.isclose((p * mass).sum(), budget)
    assert (probabilities(np.array([5.0, 1.0]), np.array([0.5, 0.5]), 6.0) == 1).all()


def test_query(spark):
    assert_same(spark, op9_mixing, mix_sql(), "/root/testdata/sf0.001")


@pytest.mark.parametrize("driver_cells", [1000, 0])
def test_given_targets_and_odd_rows(spark, driver_cells):
    rows = [(i, "w " * (1 + i % 5), f"s{i % 3}", "en" if i % 2 else None, 5) for i in range(900)] + [(None, None, None, None, 1), (901, "", "s9", "xx", 1), (902, "w " * 50_000, "s1", "en", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, tokens int")
    targets = {"source": {"s0": 0.5, "s1": 0.3, "s2": 0.2, "zz": 3.0}, "lang": {"en": 0.5, "(none)": 0.5}}
    got = mix(df, F.lit("t"), 0.3, targets, driver_cells=driver_cells).collect()
    assert len(got) == len(rows)
    share = {}
    for r in {(r.source, r.lang): r for r in got}.values():
        share[r.source] = share.get(r.source, 0) + r.weight
    assert abs(share["s0"] - 0.5) < 1e-6 and abs(share["s2"] - 0.2) < 1e-6
    assert abs(sum(r.tokens * r.probability for r in got) - 0.3 * sum(r.tokens for r in got)) < 1e-3
    assert not any(r.sampled for r in got if r.source == "s9")
    assert got[0].row.doc_id is not None


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string, lang string")
    assert mix(df, F.lit("t")).count() == 0
