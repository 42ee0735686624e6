import random
import re

import pytest
from oracle import assert_same

from tessera.llm.components import connected_components
from tessera.llm.common import Scratch
from tessera.llm.jaccard import allocate, jaccard_components
from tessera.llm.queries import OP4_SQL, op4_ngram_jaccard


def sets_of(text, k):
    t = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute(rows, k, percent):
    """(id, size, component) of each row by all pairs."""
    sets, up = [sets_of(t, k) for _, t in rows], list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                c = len(sets[i] & sets[j])
                if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                    up[root(i)] = root(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[root(i)] = min(ids.get(root(i), doc), doc)
    return sorted((str(doc), len(sets[i]), str(ids.get(root(i)))) for i, (doc, _) in enumerate(rows))


def made(seed, n=260):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(n):
        if texts and r.random() < 0.6:
            w = r.choice(texts).split()
            for _ in range(r.randrange(0, 1 + len(w) // 12)):
                if w:
                    w[r.randrange(len(w))] = r.choice(words)
            if r.random() < 0.4:
                w = w[: r.randrange(max(1, len(w) - 6), len(w) + 1)]
            texts.append(" ".join(w))
        else:
            texts.append(" ".join(r.choices(words, k=r.choice([1, 2, 3, 5, 9, 12, 20, 40, 150]))))
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("k,percent,deletions", [(3, 90, "cost"), (2, 70, "all")])
def test_against_all_pairs(spark, k, percent, deletions):
    rows = made(percent + len(deletions))
    rows += [(None, "a b c d"), (None, rows[5][1]), (500, None), (501, ""), (502, " \t"), (7, "x y"), (7, "X  Y"), (503, "É a b"), (504, "é a b"), (505, "long " * 40_000), (506, "long " * 39_999)]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n int, node int").repartition(3)
    got = jaccard_components(df, k, percent, deletions=deletions).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows, k, percent)


def test_hot_group_and_first(spark):
    r = random.Random(4)
    base = [f"t{i}" for i in range(200)]
    rows = [(i, " ".join(w if r.random() > 0.004 else "z" + str(i) for w in base)) for i in range(300)]
    rows += [(1000 + i, " ".join(r.choices(base, k=60))) for i in range(300)]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert sorted((str(x.doc_id), x.n_shingles, str(x.component_id)) for x in got) == brute(rows, 3, 90)
    assert sorted(x.doc_id for x in got if x.first) == sorted({x.component_id for x in got})


def test_large_sets(spark):
    r = random.Random(6)
    base = [f"u{i}" for i in range(3000)]
    rows = [(i, " ".join(w if r.random() > 0.01 else f"z{r.random()}" for w in base)) for i in range(12)]
    rows += [(100 + i, " ".join(f"v{i}_{j}" for j in range(2500))) for i in range(8)]
    rows += [(200, " ".join(base[:1499])), (201, " ".join(base[:1580])), (202, " ".join(base[:1700]))]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert sorted((str(x.doc_id), x.n_shingles, str(x.component_id)) for x in got) == brute(rows, 3, 90)


def test_empty(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_allocation_covers_the_difference():
    for percent in (70, 80, 90):
        for band in range(30):
            for how in ("cost", "none", "all"):
                from tessera.llm.jaccard import BOUNDS

                m, d = allocate(band, percent, 1e6, how)
                differ = (int(BOUNDS[band + 1]) - 1) * (100 - percent) // percent
                assert m - d + 2 * d >= differ + 1 and 0 <= d <= m


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 99), (99, 101), (7, 7), (200, 201), (201, 200)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect())
    assert got == {**{i: 1 for i in range(1, 61)}, 99: 99, 100: 99, 101: 99, 200: 200, 201: 200}


def test_query(spark):
    assert_same(spark, op4_ngram_jaccard, OP4_SQL, "/root/testdata/sf0.001")
