import hashlib
import re

import regex

from tessera.llm.fingerprints import fingerprints
from tessera.llm.queries import op2_fingerprints, table


def edited_of(rows):
    """edited text and next row of each (id, text) with distinct ids."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (doc, text) in enumerate(order):
        nxt = order[(i + 1) % len(order)]
        half = len(text) // 2
        out[doc] = (text[: len(text) - half] + nxt[1][:half], nxt[0])
    return out


def lexicon_of(texts, low=0.001, high=0.1):
    df = {}
    for t in texts:
        for w in set(regex.findall(r"[\p{L}\p{N}]+", t.lower())):
            df[w] = df.get(w, 0) + 1
    n = len(texts)
    return {w for w, c in df.items() if max(2.0, low * n) <= c <= max(2.0, high * n)}


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text or "") for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    edits, lexicon = edited_of(rows), lexicon_of([t for _, t in rows])
    got = {r.doc_id: r for r in op2_fingerprints(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    known = lambda t: frozenset(w for w in regex.findall(r"[\p{L}\p{N}]+", t.lower()) if w in lexicon)
    first = {}
    for doc, text in rows:
        r, (edited, nxt) = got[doc], edits[doc]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = (x.split("-") for x in (r.fingerprint, r.edited_fingerprint, got[nxt].fingerprint))
        for near, other in ((r.near_edited, b), (r.near_next, c)):
            either = [x == y for x, y in zip(a, other) if not x == y == "0"]
            assert near == sum(either) / len(either)
        for t, f in ((text, a), (edited, b)):
            if k := known(t):  # the first hash stands for the set of lexicon terms
                assert first.setdefault(k, f[0]) == f[0]
    assert len(set(first.values())) == len(first)


def test_near_copies_and_odd_rows(spark):
    base = [f"term{i}" for i in range(60)]
    rows = [(i, " ".join(base[(i * 7) % 60 :] + base[: (i * 7) % 60])) for i in range(30)]
    rows += [(100, None), (101, ""), (102, "?! ."), (103, "?! ."), (104, "X" * 150_000), (105, "once unique alone"), (105, "another twin"), (None, "no id"), (106, "😀é" * 9)]
    df = spark.createDataFrame([(i, t, "k", 3) for i, t in rows], "doc_id long, text string, key string, half int")
    got = fingerprints(df, high=0.99).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.fingerprint.split("-")) == 20
    assert len({by[i][0].fingerprint for i in range(30)}) == 1  # word order doesn't matter
    assert by[102][0].fingerprint == by[103][0].fingerprint != by[100][0].fingerprint == by[101][0].fingerprint
    assert by[5][0].near_next == 1.0
    assert by[106][0].n_chars == 18
    # One word of sixty more or fewer: lexicons without it agree.
    pair = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(base[1:])), (3, " ".join(base))], "doc_id long, text string")
    near = {r.doc_id: r.near_next for r in fingerprints(pair, high=1.0, low=0.5).collect()}
    assert 0 < near[2] < 1
    single = fingerprints(spark.createDataFrame([(1, "ab c")], "doc_id long, text string")).first()
    assert single.near_next == 1.0 and single.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert fingerprints(df.filter("half = 0")).count() == 0
    assert re.fullmatch(r"[0-9a-f]{64}", single.edited_sha256)
