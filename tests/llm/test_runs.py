import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tessera.llm.queries import op12_periodic_runs
from tessera.llm.runs import collapsed, periodic_runs, runs_of, z_values

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    """Every period, every stretch of words that equal those one period on."""
    found = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - p:
            s = i
            while i < len(w) - p and w[i] == w[i + p]:
                i += 1
            if i > s and i - s + p >= max(12, 2 * p):
                found.setdefault((s, i + p), p)
            i = max(i, s + 1)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def kept(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(words) if i not in gone)


@pytest.mark.parametrize("kinds", [1, 2, 3, 30])
def test_against_brute_force(kinds):
    rng = random.Random(kinds)
    for _ in range(400):
        n = rng.choice([0, 5, 11, 12, 13, 24, 40, 90])
        w = [rng.randrange(kinds) for _ in range(n)]
        if n > 12 and rng.random() < 0.5:
            a, p = rng.randrange(n), 1 + rng.randrange(8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = runs_of(np.array(w, np.int64))
        assert runs == brute(w)
        assert collapsed([str(x) for x in w], runs) == kept([str(x) for x in w], runs)


def test_z_values():
    rng = random.Random(4)
    for _ in range(200):
        w = np.array([rng.randrange(2) for _ in range(rng.randrange(2, 40))])
        mid = rng.randrange(1, len(w))
        for j, z in enumerate(z_values(w, mid)):
            want = 0
            while max(j, mid) + want < len(w) and w[j + want] == w[mid + want]:
                want += 1
            assert z == want


def test_fibonacci_words_hold_many_runs():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    assert runs_of(np.array(b)) == brute(b)
    assert len(brute(b)) > 50


def test_long_texts_take_no_square_time():
    """One word 30,000 times, a period of 5 as long, and 300,000 words without a run."""
    assert runs_of(np.zeros(30_000, np.int64)) == [(0, 30_000, 1)]
    assert runs_of(np.tile(np.arange(5), 6_000)) == [(0, 30_000, 5)]
    assert runs_of(np.arange(300_000) * 7919 % 300_007) == []


def test_rows(spark):
    again = "go on and on " * 5
    rows = [(1, again, "x", 7), (None, again, "x", 7), (1, again, "x", 7), (2, None, "x", 7), (3, "", "x", 7), (4, " \t\n", None, 7), (5, "a" * 300_000, "x", 7), (6, "é x " * 12, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed int").repartition(3)
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(df).collect())
    want = []
    for i, text, *_ in rows:
        words = WORD.findall(text or "")
        want.append((str(i), len(words), brute(words), kept(words, brute(words))))
    assert got == sorted(want)
    assert periodic_runs(df.filter("doc_id = 77")).count() == 0
    named = df.select(df.doc_id.alias("runs"), "text")
    assert periodic_runs(named, "runs").count() == len(rows)


def test_query(spark):
    """The whole table of the smallest size, its documents edited in Python."""
    got = {r.doc_id: r for r in op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        w = WORD.findall(d.text or "")
        n, h = len(w), zlib.crc32(str(d.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        if len(w) > 3_000:
            continue  # too slow for brute force: the fuzzed tests cover long texts
        runs, r = brute(w), got[d.doc_id]
        some += len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept(w, runs).encode()).hexdigest()
    assert some > 10
