"""URL filter: rules, and for the rest the ratio of two character language models.

One model is learnt from URLs that rules allow, the other from those that rules block. Both are
variable-order Markov models: the probability of a character after each shorter and longer
context, blended by Witten-Bell smoothing. A URL's score is the difference of its
log-likelihoods over its length; the threshold is the one that best separates rule-decided
URLs that the models did not learn from. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ascii_lower, text_of

#: Longest context in characters, and size of the alphabet that unseen characters share.
ORDER, ALPHABET = 4, 256
START, END = "\x02", "\x03"
#: Tables of scores up to this many rows (about 30 bytes each) are broadcast.
BROADCAST_ROWS = 200_000
#: Bins of a score between -BIN_RANGE and BIN_RANGE when the threshold is set.
BINS, BIN_RANGE = 2000, 10.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty where it is null or has no ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.coalesce(ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def deciding_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest fitting rule, nulls if none; of equally long ones the first."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    name = verdict = None
    for kind, h, p in ordered:
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    null = F.lit(None).cast("string")
    return (name, verdict) if ordered else (null, null)


def _grams(strings: DataFrame, order: int) -> Column:
    """Windows of order + 1 characters, one ending at each character and at the end mark."""
    padded = F.concat(F.lit(START * order), F.col("s"), F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length("s") + 1), lambda i: F.substr(padded, i, F.lit(order + 1)))


def url_scores(strings: DataFrame, scratch: Scratch, order: int = ORDER, alphabet: int = ALPHABET) -> DataFrame:
    """(s, score) for each distinct s of ``strings`` (s, verdict or null, learn: boolean).

    score: (log P(s | allowed) - log P(s | blocked)) / (length + 1); an empty model is uniform.
    """
    windows = strings.select("s", "verdict", "learn", F.explode(_grams(strings, order)).alias("g"))
    counted = windows.groupBy("g").agg(F.count(F.when(F.col("learn") & (F.col("verdict") == "allow"), 1)).alias("a"), F.count(F.when(F.col("learn") & (F.col("verdict") == "block"), 1)).alias("b"))
    full = scratch.save(counted, "windows")
    # n-grams of every length 1 to order + 1: suffixes of the full windows.
    suffixes = F.explode(F.transform(F.sequence(F.lit(0), F.lit(order)), lambda k: F.struct(k.alias("k"), F.substr(F.col("g"), F.lit(order + 1) - k, k + 1).alias("gram"))))
    grams = full.filter("a + b > 0").select("a", "b", suffixes.alias("x")).groupBy("x.k", "x.gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    grams = scratch.save(grams, "grams")
    contexts = grams.groupBy("k", F.expr("left(gram, k)").alias("context")).agg(F.sum("a").alias("na"), F.sum("b").alias("nb"), F.count(F.when(F.col("a") > 0, 1)).alias("ta"), F.count(F.when(F.col("b") > 0, 1)).alias("tb"))
    contexts = scratch.save(contexts, "contexts")
    looked = full.select("g", suffixes.alias("x")).select("g", "x.k", "x.gram", F.expr("left(x.gram, x.k)").alias("context"))
    looked = looked.join(grams, ["k", "gram"], "left").join(contexts, ["k", "context"], "left")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in ("a", "b", "na", "nb", "ta", "tb")]
    levels = looked.select("g", "k", *zero).groupBy("g").agg(F.array_sort(F.collect_list(F.struct("k", "a", "b", "na", "nb", "ta", "tb"))).alias("levels"))

    def blended(n: str, total: str, kinds: str) -> Column:
        step = lambda p, x: F.when(x[total] > 0, (x[n] + x[kinds] * p) / (x[total] + x[kinds])).otherwise(p)
        return F.aggregate("levels", F.lit(1.0 / alphabet), step)

    ratio = levels.select("g", (F.log(blended("a", "na", "ta")) - F.log(blended("b", "nb", "tb"))).alias("ratio"))
    ratio = scratch.save(ratio, "ratios")
    ratio = F.broadcast(ratio) if ratio.count() <= BROADCAST_ROWS else ratio
    return windows.select("s", "g").join(ratio, "g").groupBy("s").agg((F.sum("ratio") / F.count("*")).alias("score"))


def best_threshold(scored: DataFrame) -> float:
    """The threshold on score that maximises the mean share of right verdicts of both kinds; 0 without both kinds.

    ``scored``: score, verdict. Counts by bin are collected, a bounded number of rows.
    """
    place = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("score") + BIN_RANGE) * (BINS / (2 * BIN_RANGE))).cast("int")))
    rows = scored.groupBy(place.alias("bin")).agg(F.count(F.when(F.col("verdict") == "allow", 1)).alias("a"), F.count(F.when(F.col("verdict") == "block", 1)).alias("b")).collect()
    allowed, blocked = sum(r.a for r in rows), sum(r.b for r in rows)
    if not allowed or not blocked:
        return 0.0
    by = {r.bin: (r.a, r.b) for r in rows}
    found, a_below, b_below = [], 0, 0
    for k in range(BINS + 1):
        found.append(((allowed - a_below) / allowed + b_below / blocked, k))
        a, b = by.get(k, (0, 0))
        a_below, b_below = a_below + a, b_below + b
    top = max(x for x, _ in found)
    ties = [k for x, k in found if x == top]
    return (ties[0] + ties[-1]) / 2 * (2 * BIN_RANGE / BINS) - BIN_RANGE  # the middle of the best stretch


def judge_urls(df: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", order: int = ORDER) -> DataFrame:
    """One row for each row of ``df``: page_id, host, path, rule, verdict, score.

    ``rules``: (allow or block, host, path prefix). A rule fits its host and all subdomains where
    the path starts with its path; the longest wins. Other URLs get the models' verdict: allow
    where the score is at least the threshold; they learn and score the whole URL as it is written. A URL without :// (or null) has an
    empty host and path, and is judged like any other, by all of its text. Four fifths of the rule-decided URLs, by
    hash, teach the models, the rest set the threshold; without both kinds it is 0, and without any
    every score is 0, so allow. Repeated rows are judged each; ids are passed on, null or repeated. A score equal to the threshold
    allows. Other columns are ignored; an empty table gives an empty result.
    """
    scratch = Scratch(df.sparkSession)
    host, path = host_and_path(text_of(url_col))
    parts = df.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), text_of(url_col).alias("s"))
    rule, verdict = deciding_rule(F.col("host"), F.col("path"), rules)
    parts = parts.select("*", rule.alias("rule"), verdict.alias("by_rule"), F.col("s"))
    once = parts.groupBy("s").agg(F.min("by_rule").alias("verdict"))  # equal URLs have one verdict by rules
    learn = F.col("verdict").isNotNull() & (F.pmod(F.crc32(F.col("s").cast("binary")), F.lit(5)) != 0)
    strings = scratch.save(once.withColumn("learn", learn), "strings")
    scores = scratch.save(url_scores(strings, scratch, order), "scores")
    threshold = best_threshold(strings.filter("verdict IS NOT NULL AND NOT learn").join(scores, "s"))
    judged = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return parts.join(scores, "s").select("page_id", "host", "path", "rule", F.coalesce("by_rule", judged).alias("verdict"), "score")
