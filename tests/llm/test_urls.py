import math
from collections import Counter, defaultdict
from functools import reduce

import pytest

from tessera.llm.common import Scratch
from tessera.llm.queries import URL_RULES, op5_url_filter, table
from tessera.llm.urls import ALPHABET, END, ORDER, START, judge_urls, url_scores


def brute_scores(strings, order=ORDER, alphabet=ALPHABET):
    """The scores by plain Python, for tests."""
    counts = {v: defaultdict(Counter) for v in ("allow", "block")}
    for s, verdict, learn in strings:
        if learn:
            t = START * order + s + END
            for i in range(order, len(t)):
                for k in range(order + 1):
                    counts[verdict][k, t[i - k : i]][t[i]] += 1

    def p(verdict, t, i):
        def one(low, k):
            seen = counts[verdict].get((k, t[i - k : i]))
            return (seen[t[i]] + len(seen) * low) / (sum(seen.values()) + len(seen)) if seen else low

        return reduce(one, range(order + 1), 1 / alphabet)

    out = {}
    for s, _, _ in strings:
        t = START * order + s + END
        out[s] = sum(math.log(p("allow", t, i)) - math.log(p("block", t, i)) for i in range(order, len(t))) / (len(s) + 1)
    return out


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [i for i, c in enumerate(rest) if c in "/?#"]
    host = rest[: ends[0]] if ends else rest
    tail = rest[len(host) :]
    cut = [i for i, c in enumerate(tail) if c in "?#"]
    return host.translate({i: i + 32 for i in range(65, 91)}), tail[: cut[0]] if cut else tail


def rule_of(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def test_scores_against_brute_force(spark):
    rows = [(f"h{i % 7}.example.{'com' if i % 3 else 'org'}/{i * i % 97}", ["allow", "block", None][i % 3], i % 3 != 2 and i % 5 != 0) for i in range(200)] + [("", None, False), ("é/" * 300, None, False)]
    got = {r.s: r.score for r in url_scores(spark.createDataFrame(rows, "s string, verdict string, learn boolean"), Scratch(spark)).collect()}
    want = brute_scores(rows)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9) for s in want)


def test_query(spark):
    got = {r.page_id: r for r in op5_url_filter(spark, "/root/testdata/sf0.01").collect()}
    pages = table(spark, "/root/testdata/sf0.01", "pages").collect()
    assert len(got) == len(pages)
    for p in pages:
        r = got[p.page_id]
        assert (r.host, r.path) == parts(p.url)
        rule, verdict = rule_of(r.host, r.path)
        assert r.rule == rule and r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)


@pytest.mark.parametrize("url", [None, "", "no scheme", "HTTP://A.ExAmple.COM/en/7?x=/de/", "x://com/en/1", "x://scom/en/", "a://b://c/d", "http://EXAMPLE.net/de/8#?", "://", "http://example.net?q", "x://org/es/" + "y" * 50_000])
def test_parts_and_rules(spark, url):
    df = spark.createDataFrame([(1, url, "z"), (1, url, "z")], "page_id long, url string, host string")
    for r in judge_urls(df, URL_RULES, order=2).collect():
        assert (r.host, r.path) == parts(url)
        rule, verdict = rule_of(r.host, r.path)
        assert r.rule == rule and r.verdict == (verdict or "allow")


def test_empty(spark):
    assert judge_urls(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0
