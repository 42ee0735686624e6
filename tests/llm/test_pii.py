import hashlib
import random
import re

import numpy as np

from tessera.llm.pii import KINDS, estimate, personal_data
from tessera.llm.queries import op10_pii, table

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, m):
    d = re.sub(r"[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 13 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    return kind != "phone" or 9 <= len(d) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k in KINDS for m in re.finditer(PLAIN[k], text or "") if passes(k, m.group())]


def check(row, text):
    base = brute(text)
    joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
    assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
    assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(b[0] == k for b in base) for k in KINDS]
    every = [s.split(":") for s in row.spans.split(",")] if row.spans else []
    every = [(k, int(s), int(e)) for k, s, e in every]
    assert set(base) <= set(every) and every == sorted(every, key=lambda x: (KINDS.index(x[0]), x[1]))


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in table(spark, "/root/testdata/sf0.001", "documents").collect()}
    got = op10_pii(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(texts)
    for r in got:
        check(r, texts[r.doc_id])


def odd_texts():
    r = random.Random(3)
    alphabet = ["a", "b@", "@", ".", "1", "12", "255", "4111 1111 1111 1111", "+1", "+44 ", " ", "-", "(", ")", "_", "%", "é", "😀", "x@y.z", "10.0.0.1", "4539578763621486", "\n", "c.d"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(1, 40))) for _ in range(400)]
    return texts + [None, "", "1" * 60_000, "a" * 60_000, "1 " * 30_000, "a.b@" * 5000, "+1" + " " * 30_000, "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "0000001.2.3.4", "999999999999.1.1.1", "a@" + "b." * 20_000 + "c"]


def test_base_spans_of_odd_texts(spark, tmp_path):
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] * 2, "doc_id long, text string, base int")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = op10_pii(spark, str(tmp_path)).collect()
    assert len(got) == 2 * len(texts)
    for r in got:
        check(r, texts[r.doc_id])


def test_method_adds_spans(spark):
    plain = [f"please mail jo{i}.b@site{i}.com or call +1 (415) 555-0{i:03d} card 4111 1111 1111 1111 thanks" for i in range(150)]
    odd = ["write to jane (at) corp (dot) com now", "pay with card 4111.1111.1111.1111 today", "call phone (415) 555-0199 now"]
    got = personal_data(spark.createDataFrame(list(enumerate(plain + odd)), "doc_id long, text string")).collect()
    added = {r.doc_id: {KINDS[s.kind] for s in r.spans if s not in r.base} for r in got}
    assert added[150] == {"email"} and added[151] == {"card"} and added[152] == {"phone"}
    assert not any(added[i] for i in range(150))


def test_estimate_tells_good_labelers():
    r = np.random.default_rng(0)
    y = r.random(20_000) < 0.4
    right = np.array([0.9, 0.95, 0.55, 0.8, 0.6])
    v = np.where(r.random((20_000, 5)) < right, y[:, None], ~y[:, None]) * 2
    patterns, at, n = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    p = estimate(np.zeros(len(patterns), int), patterns, n.astype(float))
    assert ((p[at.ravel()] > 0.5) == y).mean() > 0.95


def test_empty(spark):
    assert personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0
