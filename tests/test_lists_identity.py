import itertools
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tessera.operators import enrich as N
from tessera.operators import identity as D
from tessera.operators import search as S


def tail(k, n, m, d):
    """Exact chance of k or more of m marked among d of n objects."""
    return float(Fraction(sum(math.comb(m, i) * math.comb(n - m, d - i) for i in range(max(k, 0), min(m, d) + 1)), math.comb(n, d)))


def test_hypergeometric_tail(spark):
    rng = random.Random(1)
    cases = [(0, 10, 3, 4), (3, 10, 3, 4), (4, 10, 9, 4), (1, 1, 1, 1), (5, 10, 5, 10), (2, 20_000, 50, 1_000), (40, 8_000, 400, 800), (75, 8_000, 400, 800), (15, 8_000, 400, 800)]
    for _ in range(150):
        n = rng.randrange(1, 300)
        m, d = rng.randrange(0, n + 1), rng.randrange(0, n + 1)
        cases.append((rng.randrange(0, min(m, d) + 1), n, m, d))
    df = spark.createDataFrame(cases, "k long, n long, m long, d long")
    for r in df.withColumn("p", N.hypergeometric_tail(F.col("k"), F.col("n"), F.col("m"), F.col("d"))).collect():
        want = tail(r.k, r.n, r.m, r.d)
        assert r.p == pytest.approx(want, rel=1e-7, abs=1e-12), r


def corrected(ps, how):
    order = sorted(range(len(ps)), key=lambda i: ps[i])
    out, n, best = [0.0] * len(ps), len(ps), 1.0 if how == "benjamini-hochberg" else 0.0
    if how == "benjamini-hochberg":
        for rank in range(n, 0, -1):
            best = min(best, ps[order[rank - 1]] * n / rank)
            out[order[rank - 1]] = best
    else:
        for rank in range(1, n + 1):
            best = max(best, ps[order[rank - 1]] * (n - rank + 1))
            out[order[rank - 1]] = min(1.0, best)
    return out


@pytest.mark.parametrize("how", ["benjamini-hochberg", "holm", "bonferroni", "none"])
def test_corrections(spark, how):
    rng = random.Random(2)
    ps = [rng.choice([0.0, 1e-9, 0.01, 0.04, 0.04, 0.5, 1.0, rng.random()]) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(ps)), "id long, p double").repartition(6)
    got = {r.id: r.adjusted for r in N.adjusted(df, "p", ["id"], how).collect()}
    want = {"none": ps, "bonferroni": [min(1.0, p * 500) for p in ps]}.get(how) or corrected(ps, how)
    assert len(got) == 500 and all(got[i] == pytest.approx(w, abs=1e-12) for i, w in enumerate(want))


def test_corrections_of_nulls_and_none(spark):
    df = spark.createDataFrame([(1, 0.02), (2, None), (3, 0.04)], "id long, p double")
    assert {r.id: r.adjusted for r in N.adjusted(df, "p", ["id"]).collect()} == {1: 0.04, 2: None, 3: 0.04}
    assert N.adjusted(df.limit(0), "p", ["id"], "holm").count() == 0
    with pytest.raises(ValueError, match="Holm-Bonferroni"):
        N.adjusted(df, "p", ["id"], "Holm-Bonferroni")


def test_enrichment_counts_objects_once(spark):
    """Repeated links and list entries, links of strangers and null targets don't count, so successes never exceed the population."""
    members = spark.createDataFrame([(i,) for i in range(20)] + [(3,), (None,)], "id long")
    links = spark.createDataFrame([(i, "t") for i in range(10)] * 3 + [(i, "u") for i in range(100)] + [(1, None), (None, "t")], "src long, dst string")
    listed = spark.createDataFrame([(i,) for i in range(5)] * 2 + [(77,)], "id long")
    got = {r.target: r for r in N.enrichment(members, links, listed, "none").collect()}
    assert (got["t"].overlap, got["t"].total, got["t"].expected, got["u"].overlap, got["u"].total, got["u"].p) == (5, 10, 2.5, 5, 20, 1.0)
    assert got["t"].p == pytest.approx(tail(5, 20, 10, 5))
    assert N.enrichment(members, links, listed.limit(0)).count() == 0


def test_distribution(spark):
    values = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "b"), (4, None), (None, "a"), (3, "b")], "id long, category string")
    got = {r.category: (r.actual, r.expected) for r in N.distribution(values, spark.createDataFrame([(1,), (1,), (4,)], "id long")).collect()}
    assert got == {"a": (1, pytest.approx(2 / 3)), "b": (1, pytest.approx(2 / 3))}


def test_labels(spark):
    known = lambda *p: spark.createDataFrame(list(p), "label string, id long")
    tiers = [("symbol", known(("ABC", 5), ("abc", 4), ("Dup", 9), ("Dup", 8))), ("old symbol", known(("abc", 1), ("gone", 2)))]
    asked = spark.createDataFrame([("abc",), (" ABC ",), ("dup",), ("GONE",), ("nobody",), ("",), (None,), ("abc",)], "label string")
    first = {r.label: (r.id, r.tier, r.n_ids) for r in N.resolve_labels(asked, tiers).collect()}
    assert first == {"abc": (4, "symbol", 1), " ABC ": (4, "symbol", 2), "dup": (8, "symbol", 2), "GONE": (2, "old symbol", 1), "nobody": (None, None, 0)}
    every = sorted((r.label, r.id) for r in N.resolve_labels(asked, tiers, every=True).filter("id IS NOT NULL").collect())
    assert every == [(" ABC ", 4), (" ABC ", 5), ("GONE", 2), ("abc", 4), ("dup", 8), ("dup", 9)]


def classes(pairs):
    least = {}
    find = lambda x: x if least.setdefault(x, x) == x else find(least[x])
    for a, b in pairs:
        a, b = find(a), find(b)
        least[max(a, b)] = min(a, b)
    return {x: find(x) for x in least}


@pytest.mark.parametrize("shape", ["random", "chain", "star", "none"])
def test_equivalence_classes(spark, shape):
    rng = random.Random(3)
    pairs = {"random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)], "chain": [(i, i + 1) for i in range(90)], "star": [(5, i) for i in range(300)], "none": []}[shape]
    got = {r.node: r.least for r in D.equivalence_classes(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = classes(pairs)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: want[x] for x in linked}


def loaded(spark, rows, **more):
    df = spark.createDataFrame(rows, "row_id long, source string, id string, acc string, taxon string, name string")
    return D.load(df, {"primary": ["id"], "accession": ["acc", "taxon"]}, ["name"], {"a": 0}, **more)


def test_load_merges_over_any_key_and_keeps_provenance(spark):
    rows = [(1, "a", "x", None, None, "one"), (2, "b", "x", "P1", "9", "uno"), (3, "c", None, "P1", "9", ""), (4, "c", None, "P1", "10", "other"), (5, "b", "", "", "", "alone"), (6, "d", None, "P2", None, "half a key"), (7, "b", None, "P2", None, None)]
    got = loaded(spark, rows)
    assert {r.row_id: r.obj for r in got.members.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 7}
    objects = {r.obj: (r.name, r.name_source, r.name_conflict, r.n_rows) for r in got.objects.collect()}
    assert objects[1] == ("one", "a", False, 3) and objects[7] == (None, None, False, 1)
    assert sorted(map(tuple, got.provenance.filter("obj = 1").collect())) == [(1, "name", "a", "one"), (1, "name", "b", "uno")]
    assert got.violations.count() == 0


def test_load_refuses_sources_whole_and_reports_conflicts(spark):
    rows = [(1, "a", "x", None, None, "one"), (2, "bad", "y", None, None, "p"), (3, "bad", "y", None, None, "q"), (4, "bad", "x", None, None, "r"), (5, "b", "z", None, None, "s"), (6, "c", "z", None, None, "t")]
    got = loaded(spark, rows)
    assert sorted(r.row_id for r in got.members.collect()) == [1, 5, 6]
    assert sorted(map(tuple, got.violations.collect())) == [("conflict", "b", "5.name", 1), ("duplicate key", "bad", 'primary=["y"]', 2)]
    assert {r.source for r in got.provenance.collect()} == {"a", "b", "c"}


def test_load_of_a_value_that_a_third_of_rows_share(spark):
    """Each source has the hot key once, so it is no duplicate; a row a link, no pairs."""
    rows = [(i, f"s{i}", "hot" if i % 3 == 0 else f"k{i}", None, None, f"n{i}") for i in range(900)]
    got = loaded(spark, rows)
    sizes = [r.n_rows for r in got.objects.orderBy(F.desc("n_rows")).limit(2).collect()]
    assert sizes == [300, 1] and got.violations.filter("rule = 'conflict'").count() == 1


def test_load_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(240):
        rows.append((i, f"s{i}", rng.choice([None, f"x{rng.randrange(60)}"]), rng.choice([None, f"p{rng.randrange(30)}"]), str(rng.randrange(3)), f"n{rng.randrange(3)}"))
    by = {}
    for r in rows:
        for k in ([("id", r[2])] if r[2] else []) + ([("acc", r[3], r[4])] if r[3] else []):
            by.setdefault(k, []).append(r[0])
    want = classes([(i, i) for i in range(240)] + [p for ids in by.values() for p in itertools.pairwise(ids)])
    got = loaded(spark, rows)
    assert {r.row_id: r.obj for r in got.members.collect()} == want


def test_edge_index_deals_out_documents_before_their_grams(spark, monkeypatch):
    """One file's documents are several tasks' grams; rows that repeat an id, and null ids, are each found once."""
    monkeypatch.setattr(S, "TASK_CHARS", 1 << 10)
    docs = spark.range(400).selectExpr("'D' AS kind", "CASE WHEN id % 50 = 0 THEN NULL ELSE cast(id % 300 AS string) END AS id", "concat('Winter ab WINTER', id % 7, ' ', id) AS text").coalesce(1)
    index = S.edge_index(docs)
    assert index.rdd.getNumPartitions() > 4
    want = {(t[:n], "D", r.id) for r in docs.collect() for t in r.text.lower().split() if len(t) > 2 for n in range(3, min(10, len(t)) + 1)}
    got = [tuple(r) for r in index.select("gram", "kind", "id").collect()]
    assert len(got) == len(want) and set(got) == want
    assert S.edge_index(docs.filter("id < 0")).count() == 0
