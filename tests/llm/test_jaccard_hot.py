import random

import pytest
from test_jaccard import brute, made

from tessera.llm import jaccard


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("percent", [70, 90])
def test_hot_keys_lose_no_link(spark, monkeypatch, percent):
    monkeypatch.setattr(jaccard, "HOT_MEMBERS", 3)
    monkeypatch.setattr(jaccard, "COUNTERS", 64)
    rows = made(11, 160)
    got = jaccard.jaccard_components(frame(spark, rows), words=2, percent=percent)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got.collect()) == brute(rows, 2, percent)


def test_texts_that_share_one_half_form_few_pairs(spark, monkeypatch):
    """5,000 texts with one common half and different others; among them 300 pairs that link."""
    r = random.Random(5)
    shared = " ".join(f"s{i}" for i in range(40))
    rows = []
    for k in range(4_700):
        own = [f"w{r.randrange(10**9)}" for _ in range(40)]
        rows.append((len(rows), shared + " " + " ".join(own)))
        if k < 300:
            rows.append((len(rows), shared + " " + " ".join(own[:-1] + ["z"])))
    pairs, real = [], jaccard.by_rarest

    def counted(*a):
        df = real(*a)
        pairs.append(df.count())
        return df

    monkeypatch.setattr(jaccard, "by_rarest", counted)
    monkeypatch.setattr(jaccard, "HOT_MEMBERS", 500)
    out = jaccard.jaccard_components(frame(spark, rows)).collect()
    assert {x.doc_id: x.component_id for x in out} == {i: i - i % 2 if i < 600 else i for i, _ in rows}
    assert len(pairs) == 1 and pairs[0] <= len(rows)
