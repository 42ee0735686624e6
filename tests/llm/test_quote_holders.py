import random

import pytest
from test_quotes import parse

from tessera.llm.quotes import _most_lines, link_quotes

COLUMNS = "conv_id long, turn long, role string, text string"


def parents(spark, rows):
    df = spark.createDataFrame([(c, t, "u", x) for c, t, x in rows], COLUMNS).repartition(3)
    return {(r.conv_id, r.turn): (r.parent_conv, r.parent_turn) if r.by_quote else None for r in link_quotes(df, every_holder=True).collect()}


def brute(rows):
    """The earlier message with most of the quoted level-1 lines, by comparing with every one."""
    msgs = sorted((c, t, parse(x)) for c, t, x in rows)
    own = [((c, t), {k for level, _, k in lines if k and level == 0}) for c, t, lines in msgs]
    out = {}
    for c, t, lines in msgs:
        asked = {k for level, _, k in lines if k and level == 1}
        votes = [(-len(asked & keys), h[0] != c, h) for h, keys in own if h < (c, t) and asked & keys]
        out[c, t] = min(votes)[2] if votes else None
    return out


def test_the_message_that_holds_both_lines(spark):
    a, b, c = "line a of it", "line b of it", "line c of it"
    rows = [(1, 0, f"{a}\n{b}"), (1, 1, f"{a}\n{c}"), (1, 2, f"> {a}\n> {c}\nyes")]
    assert parents(spark, rows)[1, 2] == (1, 1)


@pytest.mark.parametrize("common", [0, 2, 50])
def test_every_holder_against_brute_force(spark, common, monkeypatch):
    monkeypatch.setattr("tessera.llm.quotes._most_lines", lambda *a: _most_lines(*a, common=common))
    r = random.Random(common)
    stock = [f"stock line {i}" for i in range(12)] + ["everybody writes this"] * 10
    rows = []
    for i in range(160):
        own = r.sample(stock, r.randrange(1, 5))
        quoted = [f"> {x}" for x in r.sample(stock, r.randrange(0, 5))]
        rows.append((i // 8, i, "\n".join(quoted + own)))
    assert parents(spark, rows) == brute(rows)


def test_levels_short_lines_scripts_and_line_breaks(spark):
    rows = [
        (1, 0, "the first message of all"),
        (1, 1, "no quote in this one"),
        (1, 2, "something else in between"),
        (1, 3, "> no quote in this one\n>> the first message of all\nboth named"),
        (1, 4, ">> the first message of all\nonly deeper"),
        (2, 0, "yes please"),
        (2, 1, "👍"),
        (2, 2, "other words here now"),
        (2, 3, "> yes please\nfine"),
        (2, 4, "> 👍\nfine"),
        (3, 0, "yes please"),
        (3, 1, "今天天气很好"),
        (4, 0, "> 今天天气很好\n"),
        (4, 1, "> yes please"),
        (5, 0, "a long passage that one mailer keeps in a line\n\nand one more"),
        (6, 0, "keeps in a line"),
        (6, 1, "> a long passage that\n> one mailer\n> keeps in a line\nso it is"),
    ]
    got = parents(spark, rows)
    assert {k: v for k, v in got.items() if v} == {
        (1, 1): (1, 0), (1, 3): (1, 1), (1, 4): (1, 0), (2, 3): (2, 0), (2, 4): (2, 1), (4, 0): (3, 1), (6, 1): (5, 0),
    }


def test_common_lines_cost_profiles_not_pairs(spark, monkeypatch):
    """400 messages hold the same 20 lines and 1,140 quote a different three of them each: tables grow with messages, not with 456,000 pairs."""
    from itertools import combinations

    from tessera.llm.common import Scratch

    stock = [f"boilerplate line {i} of all" for i in range(20)]
    rows = [(i, 0, "\n".join(stock)) for i in range(400)]
    rows += [(1_000 + i, 0, "\n".join(f"> {x}" for x in c) + f"\nmy own words {i}") for i, c in enumerate(combinations(stock, 3))]
    sizes = {}
    save = Scratch.save

    def counted(self, df, name, partition_by=None):
        out = save(self, df, name, partition_by)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(Scratch, "save", counted)
    got = parents(spark, rows)
    assert {got[1_000 + i, 0] for i in range(1_140)} == {(0, 0)}
    text_lines = 400 * 20 + 1_140 * 4
    assert max(sizes.values()) <= 2 * text_lines, {k: v for k, v in sizes.items() if v > text_lines}
    assert sizes["scored"] == 1_140 and sizes["set_near"] <= 1_140
