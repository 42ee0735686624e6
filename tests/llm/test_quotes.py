import random

import regex

from tessera.llm.quotes import link_quotes
from tessera.llm.queries import op7_quote_linking, table

LOW = -(2**63)


def parse(text):
    out = []
    for line in regex.split(r"\r\n|\n|\r", text or ""):
        marks = regex.match(r"(?:[ \t]*>)*", line).group()
        level = marks.count(">")
        body = regex.sub(r"^[ \t]", "", line[len(marks) :]) if level else line
        plain = regex.sub(r"[^\p{L}\p{N}]+", " ", body.lower()).strip()
        out.append((level, body, plain if len(plain.split(" ")) >= 3 else None))
    return out


def brute(rows):
    """rows: (conv, turn, text) with distinct (conv, turn) -> parent, by_quote, root, depth, position, clean."""
    msgs = sorted((LOW if c is None else c, LOW if t is None else t, parse(x)) for c, t, x in rows)
    own, parent, quoted = {}, {}, {}
    for c, t, lines in msgs:
        for level, _, key in lines:
            if key and level == 0:
                own.setdefault(key, []).append((c, t))
    for i, (c, t, lines) in enumerate(msgs):
        votes = {}
        for key in {k for level, _, k in lines if k and level == 1}:
            near = [h for h in own.get(key, []) if h[0] == c][:1]
            far = own.get(key, [])[:1]
            if near and near[0] < (c, t):
                votes.setdefault(near[0], []).append(1)
            elif far and far[0][0] < c:
                votes.setdefault(far[0], []).append(0)
        before = msgs[i - 1][:2] if i and msgs[i - 1][0] == c else None
        best = min(((-len(v), -max(v), h) for h, v in votes.items()), default=None)
        parent[c, t] = best[2] if best else before
        quoted[c, t] = bool(best)
    out, threads = {}, {}
    for c, t, lines in msgs:
        node, depth = (c, t), 0
        while parent[node]:
            node, depth = parent[node], depth + 1
        threads.setdefault(node, []).append((depth, c, t))
        out[c, t] = [parent[c, t], quoted[c, t], node, depth, "\n".join(b for level, b, _ in lines if level == 0)]
    for group in threads.values():
        for i, (_, c, t) in enumerate(sorted(group)):
            out[c, t].append(i)
    return out


def same(got, rows):
    want = brute(rows)
    value = lambda x: LOW if x is None else x
    assert len(got) == len(rows)
    for r in got:
        parent, by_quote, root, depth, clean, position = want[value(r.conv_id), value(r.turn)]
        assert (r.by_quote, r.depth, r.position, r.clean) == (by_quote, depth, position, clean)
        assert (value(r.thread_conv), value(r.thread_turn)) == root
        assert parent is None and r.parent_turn is None or (value(r.parent_conv), value(r.parent_turn)) == parent


def test_against_brute_force(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    rows, lines = [], []
    for i in range(250):
        own = [" ".join(r.choices(words, k=r.randrange(1, 7))) for _ in range(r.randrange(1, 4))]
        quote = [r.choice(["> ", ">", "  > ", ">> ", "> > "]) + r.choice([str.upper, str])(x) for x in r.sample(lines, min(len(lines), r.randrange(0, 4)))]
        rows.append((i // 6 if i < 200 else 99, i, r.choice(["\n", "\r\n"]).join(quote + own)))
        lines += own
    rows += [(None, None, "> w1 w2 w3"), (None, 3, None), (77, None, ""), (78, 0, "> " * 20_000 + "deep deep deep"), (79, 0, "word " * 60_000)]
    df = spark.createDataFrame([(c, t, "user", x, 0, "k") for c, t, x in rows], "conv_id long, turn long, role string, text string, depth int, root string").repartition(5)
    same(link_quotes(df).collect(), rows)


def test_repeated_rows_and_hot_conversation(spark):
    rows = [(1, i, f"line number {i} here") for i in range(600)]
    same(link_quotes(spark.createDataFrame([(c, t, "u", x) for c, t, x in rows], "conv_id long, turn long, role string, text string").repartition(6)).collect(), rows)
    twice = link_quotes(spark.createDataFrame([(1, 1, "u", "> a b c")] * 3, "conv_id long, turn long, role string, text string")).collect()
    assert sorted((r.depth, r.position) for r in twice) == [(0, 0), (1, 1), (2, 2)]


def test_empty(spark):
    assert link_quotes(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_query(spark):
    rows = [(r.conv_id, r.turn, r.text) for r in table(spark, "/root/testdata/sf0.001", "conversations").collect()]
    assert op7_quote_linking(spark, "/root/testdata/sf0.001").count() == len(rows)
