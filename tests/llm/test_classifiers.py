import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.queries import op3_quality, op8_toxicity, table
from tessera.llm.quality import dual_coordinate_descent, platt, quality
from tessera.llm.toxicity import FactorisationMachine, toxicity


def held_out(spark, query, label, modulus, rest):
    """(accuracy, recall of 1, recall of 0) on rows whose labels weren't learnt."""
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r[label] for r in table(spark, sf, "labels").collect()}
    rows = query(spark, sf).collect()
    assert len(rows) == table(spark, sf, "documents").count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    y, p = np.array(held).T
    return (y == p).mean(), p[y == 1].mean(), 1 - p[y == 0].mean()


def test_quality_on_held_out_rows(spark):
    accuracy, keeps, drops = held_out(spark, op3_quality, "quality", 4, 2)
    assert accuracy > 0.98 and keeps > 0.99 and drops > 0.9


def test_toxicity_on_held_out_rows(spark):
    accuracy, catches, clean = held_out(spark, op8_toxicity, "toxic", 5, 0)
    assert accuracy > 0.97 and catches > 0.85 and clean > 0.99


@pytest.mark.parametrize("method,label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows(spark, method, label):
    docs = spark.createDataFrame([(1, None, 3), (2, "", 1), (3, "x " * 100_000, 1), (4, "plain words", 0), (4, "plain words", 0), (None, "no id", 2), (5, "$$$ !!!", 1)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(3, 1), (4, 0), (5, None), (None, 1), (99, 1), (4, 0)], f"doc_id long, {label} int")
    got = method(docs, labels, F.lit(True)).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in method(docs, labels.filter("doc_id < 0"), F.lit(True)).collect()} == {0.5}
    assert method(docs.filter("score = 9"), labels, F.lit(True)).count() == 0


def test_pairs_are_learnt():
    """The label is the exclusive or of two terms, which no additive weights can tell."""
    r = np.random.default_rng(0)
    on = r.random((3000, 2)) < 0.5
    y = (on[:, 0] ^ on[:, 1]).astype(int)
    at = np.concatenate([[0], np.cumsum(on.sum(axis=1))])
    model = FactorisationMachine(2)
    model.fit(y, at, np.nonzero(on)[1], epochs=60)
    assert ((model.margins(at, np.nonzero(on)[1]) > 0) == y).mean() > 0.97


def test_hinge_model_separates():
    r = np.random.default_rng(1)
    on = r.random((600, 12)) < 0.4
    y = (on[:, 0] & ~on[:, 1]).astype(int)
    at = np.concatenate([[0], np.cumsum(on.sum(axis=1))])
    place = np.nonzero(on)[1]
    w = dual_coordinate_descent(y, at, place, np.ones(len(place)), 12, cost=5.0, epochs=200)
    margin = on @ w[:-1] + w[-1]
    assert ((margin > 0) == y).mean() > 0.98
    a, b = platt(margin, y)
    assert a > 0 and (((a * margin + b) > 0) == y).mean() > 0.97
