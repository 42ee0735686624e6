"""Personal data: fixed base spans, and more spans by weak supervision.

Candidates are the base spans and looser spans of each kind (obfuscated addresses, card numbers
with other separators, phone numbers without a country code). Five labelers vote on each, for,
against or not at all: its format, its checksum or range, a gazetteer of beginnings and ends,
the words around it, its length. Expectation-maximisation over the counts of all vote
patterns estimates the labelers' reliabilities, and a logistic span classifier is trained on
the resulting probabilities. Candidates that it accepts are added; base spans stay.

DataFrame functions only. What the driver sees is counts by pattern, of which there is a fixed number.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, text_of

KINDS = ("email", "ip", "card", "phone")
# Possessive and anchored to the start of a run, the base patterns match what the plain ones match,
# in linear time: \G is where the match before ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser spans; those that overlap a base span of any kind are dropped.
LOOSE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20./_-]?[0-9]{4}){2}[\x20./_-]?[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9+.])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20./-])[0-9]{3,4}[\x20./-][0-9]{3,4}(?![0-9])",
}
#: What a text must contain to hold a span of the kind.
HINTS = {"email": r"@|[(\[]at[)\]]", "ip": r"[0-9][.\[(]", "card": r"[0-9][0-9\x20-]", "phone": r"[0-9][\x20./)-]"}
# The labelers' word lists, by kind.
CONTEXT_FOR = {"email": r"mail|contact|write|address|from:|to:", "ip": r"\bip\b|server|host|addr|ping|login", "card": r"card|visa|master|amex|credit|debit|payment|pay\b", "phone": r"phone|tel\b|call|fax|mobile|cell|whatsapp|sms"}
CONTEXT_AGAINST = {"email": r"example only|e\.g\.", "ip": r"version|release|section|v\.", "card": r"isbn|order|serial|invoice|token|id\b|ref", "phone": r"isbn|version|order|serial|ref|page|invoice"}
GAZETTEER = {"email": r"(?:com|org|net|edu|gov|io|de|fr|es|uk|eu|info)$", "ip": r"^(?:10|127|172|192|[1-9][0-9]?|1[0-9][0-9]|2[01][0-9]|22[0-3])[^0-9]", "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)", "phone": r"^\(?(?:0[1-9]|[2-9][0-9]{2}|[1-9][0-9])"}
STRICT = {"email": r"^[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$", "ip": r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$", "card": r"^(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){2,3}(?:[\x20-][0-9]{1,3})?)$", "phone": r"^(?:\+[0-9]{1,3}[\x20.-]?)?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}$"}
#: What the labelers' votes weigh before the first round, by labeler.
FIRST_WEIGHTS = (1.0, 2.5, 0.5, 1.0, 0.5)
LABELERS = len(FIRST_WEIGHTS)
AROUND = 32


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)
    place = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))

    def add(total: Column, i: Column) -> Column:
        d = F.substr(back, i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.when(F.length(digits) > 0, F.aggregate(place, F.lit(0), add) % 10 == 0).otherwise(F.lit(False))


def byte_parts(c: Column) -> Column:
    """Whether all dotted parts are numbers up to 255; leading zeros don't count."""
    def small(p: Column) -> Column:
        q = F.regexp_replace(p, r"^0+", "")
        return (F.length(q) < 3) | ((F.length(q) == 3) & (q <= "255"))

    return F.forall(F.split(c, r"[^0-9]+"), small)


def _valid(kind: str) -> Callable[[Column], Column]:
    """The check that a base span of the kind passes."""

    def check(span: Column) -> Column:
        digits = _digits(span["match"])
        if kind == "email":
            return F.lit(True)
        if kind == "ip":
            return byte_parts(span["match"])
        if kind == "card":
            return F.when((F.length(digits) >= 13) & (F.length(digits) <= 19), luhn(digits)).otherwise(F.lit(False))
        return (F.length(digits) >= 9) & (F.length(digits) <= 15)

    return check


def spans_of(matches: str, pieces: str) -> Column:
    """Array of (start, end, match, before, after) from the matches of a pattern and the pieces between them."""
    empty = F.expr("cast(array() AS array<struct<start:int,end:int,match:string,before:string,after:string>>)")
    size = F.size(matches)

    def add(acc: Column, i: Column) -> Column:
        piece, match, rest = F.get(pieces, i), F.get(matches, i), F.get(pieces, i + 1)
        start = acc["at"] + F.length(piece)
        end = start + F.length(match)
        span = F.struct(start.alias("start"), end.alias("end"), match.alias("match"), F.call_function("right", piece, F.lit(AROUND)).alias("before"), F.call_function("left", rest, F.lit(AROUND)).alias("after"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    return F.when(size > 0, F.aggregate(F.sequence(F.lit(0), size - 1), start, add, lambda acc: acc["spans"])).otherwise(empty)


def with_spans(df: DataFrame, patterns: dict[str, str], prefix: str, text: str = "text") -> DataFrame:
    """``df`` with a column of located matches for each kind."""
    none = F.expr("cast(array() AS array<string>)")
    for kind in KINDS:
        hint = F.col(text).rlike(HINTS[kind] if prefix == "loose_" or kind in ("ip", "card") else {"email": "@", "phone": r"\+[0-9]"}[kind])
        df = df.withColumn("m__", F.when(hint, F.regexp_extract_all(text, F.lit(patterns[kind]), F.lit(0))).otherwise(none))
        df = df.withColumn("p__", F.when(F.size("m__") > 0, F.split(text, patterns[kind], -1)).otherwise(none))
        df = df.withColumn(prefix + kind, spans_of("m__", "p__")).drop("m__", "p__")
    return df


def votes(kind: str, s: Column) -> list[Column]:
    """The labelers' votes on a span: 2 for, 0 against, 1 none."""
    digits = _digits(s["match"])
    n = F.length(digits)
    near = F.lower(F.concat(s["before"], F.lit(" ... "), s["after"]))
    yes, no, abstain = F.lit(2), F.lit(0), F.lit(1)
    checks = {"email": abstain, "ip": F.when(byte_parts(s["match"]), yes).otherwise(no), "card": F.when(luhn(digits), yes).otherwise(no), "phone": abstain}
    lengths = {"email": F.when(F.length(s["match"]) <= 60, yes).otherwise(no), "ip": F.when(n <= 12, yes).otherwise(no), "card": F.when(n.isin(13, 15, 16, 19), yes).otherwise(no), "phone": F.when((n >= 9) & (n <= 13), yes).otherwise(no)}
    return [
        F.when(s["match"].rlike(STRICT[kind]), yes).otherwise(abstain),
        checks[kind],
        F.when(F.lower(s["match"]).rlike(GAZETTEER[kind]), yes).otherwise(no),
        F.when(near.rlike(CONTEXT_FOR[kind]), yes).when(near.rlike(CONTEXT_AGAINST[kind]), no).otherwise(abstain),
        lengths[kind],
    ]


def _shape(s: Column) -> list[Column]:
    """Further features of a span for the classifier, each 0 or 1."""
    return [
        (s["before"].rlike(r"[\p{L}\p{N}_]$")).cast("int"),
        (s["after"].rlike(r"^[\p{L}\p{N}_]")).cast("int"),
        s["match"].rlike(r"[\x20]").cast("int"),
        s["match"].rlike(r"[/_\[(]").cast("int"),
    ]


def pattern_of(kind: str, s: Column) -> Column:
    """A span's kind, votes and shape as one number below 4 * 3^5 * 2^4."""
    out = F.lit(KINDS.index(kind))
    for v in votes(kind, s):
        out = out * 3 + v
    for v in _shape(s):
        out = out * 2 + v
    return out


def unpack(patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind, votes, shape) of pattern numbers."""
    shape = (patterns[:, None] >> np.arange(3, -1, -1)) & 1
    rest = patterns >> 4
    v = rest[:, None] // 3 ** np.arange(LABELERS - 1, -1, -1) % 3
    return rest // 3**LABELERS, v, shape


def estimate(kind: np.ndarray, v: np.ndarray, n: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Probability that a span of each pattern is personal data, by EM over labelers' reliabilities for each kind."""
    p = 1 / (1 + np.exp(-((v - 1) @ np.array(FIRST_WEIGHTS))))
    for k in np.unique(kind):
        at = np.flatnonzero(kind == k)
        for _ in range(rounds):
            share = (n[at] * p[at]).sum() / n[at].sum()
            log_odds = np.full(len(at), np.log((share + 1e-3) / (1 - share + 1e-3)))
            for j in range(LABELERS):
                one = np.bincount(v[at, j], n[at] * p[at], 3) + 1.0
                two = np.bincount(v[at, j], n[at] * (1 - p[at]), 3) + 1.0
                log_odds += (np.log(one / one.sum()) - np.log(two / two.sum()))[v[at, j]]
            new = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
            done = np.abs(new - p[at]).max() < 1e-6
            p[at] = new
            if done:
                break
    return p


def design(patterns: np.ndarray) -> np.ndarray:
    """0/1 features of pattern numbers: kind, vote of each labeler by kind, shape, constant."""
    kind, v, shape = unpack(patterns)
    cols = [np.ones(len(patterns))] + [(kind == k) * 1.0 for k in range(len(KINDS))]
    cols += [((kind == k) & (v[:, j] == x)) * 1.0 for k, j, x in product(range(len(KINDS)), range(LABELERS), (0, 2))]
    return np.column_stack([*cols, *shape.T])


def train(patterns: np.ndarray, target: np.ndarray, n: np.ndarray, l2: float = 1e-3) -> np.ndarray:
    """Weights of the logistic span classifier on soft targets, by Newton's method."""
    x = design(patterns)
    w, weight = np.zeros(x.shape[1]), n / n.sum()
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - target)) + l2 * w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + l2 * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-7:
            break
    return w


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row: doc_id, base and spans (arrays of kind, start, end), by kind as in KINDS, then start.

    Positions count code points, the end is exclusive. Base spans: leftmost matches of each
    kind's pattern that don't overlap; those failing the kind's check are dropped. ``spans`` has them and
    the looser candidates that the trained classifier accepts and that overlap no base span. Null text is
    empty and has no spans. Repeated rows are read each; ids are passed on, null or repeated; other columns are ignored. Without
    candidates nothing is added; an empty table gives an empty result.
    """
    scratch = Scratch(df.sparkSession)
    docs = df.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    both = with_spans(with_spans(docs, BASE, "base_"), LOOSE, "loose_")
    for kind in KINDS:
        both = both.withColumn(f"base_{kind}", F.filter(f"base_{kind}", _valid(kind)))
    coded = lambda spans, kind: F.transform(spans, lambda s: F.struct(F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), pattern_of(kind, s).alias("pattern")))
    both = both.select("doc_id", F.concat(*(coded(F.col(f"base_{k}"), k) for k in KINDS)).alias("base"), F.concat(*(coded(F.col(f"loose_{k}"), k) for k in KINDS)).alias("loose"))
    free = F.filter("loose", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    found = scratch.save(both.select("doc_id", "base", free.alias("loose")), "found")
    counts = found.select(F.explode(F.concat("base", "loose")).alias("s")).groupBy("s.pattern").agg(F.count("*").alias("n")).orderBy("pattern").toArrow()
    accepted: list[int] = []
    if counts.num_rows:
        patterns, n = counts["pattern"].to_numpy().astype(np.int64), counts["n"].to_numpy().astype(float)
        kind, v, _ = unpack(patterns)
        w = train(patterns, estimate(kind, v, n), n)
        accepted = [int(x) for x, m in zip(patterns, design(patterns) @ w, strict=True) if m >= 0]
    passes = F.array(*map(F.lit, accepted)) if accepted else F.expr("cast(array() AS array<int>)")
    plain = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    added = F.filter("loose", lambda c: F.array_contains(passes, c["pattern"]))
    return found.select("doc_id", F.array_sort(F.transform("base", plain)).alias("base"), F.array_sort(F.transform(F.concat("base", added), plain)).alias("spans"))


def span_text(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def kind_count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
