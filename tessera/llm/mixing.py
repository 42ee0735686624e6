"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). The cells' token mass is raked until its
shares along each dimension are the targets. A document of a cell is then sampled with the
probability that brings the cell to its weight within a token budget: min(1, c * weight / mass), with
c such that the expected tokens are the budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, text_of, words_of

#: Cells up to this many (about 100 bytes each) are raked on the driver and broadcast; above it, as tables.
DRIVER_CELLS = 100_000
TOLERANCE, ROUNDS = 1e-10, 200
NONE = "(none)"
DIMS = ("source", "lang", "topic")
#: Target shares are mass ** power where no targets are given: 1 keeps a dimension, 0 levels it.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}


def shares(mass: dict[str, float], power: float) -> dict[str, float]:
    raised = {k: m**power if m > 0 else 0.0 for k, m in mass.items()}
    total = sum(raised.values())
    return {k: x / total if total else 0.0 for k, x in raised.items()}


def rake(mass: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray]) -> np.ndarray:
    """Weights (sum 1) of cells after raking ``mass`` to the target shares of each dimension."""
    w = mass / max(mass.sum(), 1e-300)
    for _ in range(ROUNDS):
        worst = 0.0
        for code, target in zip(codes, targets, strict=True):
            total = np.bincount(code, w, len(target))
            scale = np.divide(target, total, out=np.zeros(len(target)), where=total > 0)
            worst = max(worst, np.abs(total - target)[total > 0].max(initial=0.0))
            w = w * scale[code]
        if worst < TOLERANCE:
            break
    return w / max(w.sum(), 1e-300)


def probabilities(mass: np.ndarray, w: np.ndarray, budget: float) -> np.ndarray:
    """min(1, c * w / mass) of each cell, with c such that the expected mass is ``budget`` (or all there is)."""
    w = np.where(mass > 0, w, 0.0)
    ratio = np.divide(w, mass, out=np.zeros(len(w)), where=mass > 0)
    order = np.argsort(-ratio, kind="stable")
    m, v, r = mass[order], w[order], ratio[order]
    before = np.concatenate([[0.0], np.cumsum(m)[:-1]])
    left = np.cumsum(v[::-1])[::-1]
    c = np.divide(np.maximum(budget - before, 0.0), left, out=np.full(len(v), np.inf), where=left > 0)
    fits = np.flatnonzero(c * r <= 1)
    scale = c[fits[0]] if len(fits) else np.inf
    with np.errstate(invalid="ignore"):
        p = np.minimum(1.0, np.nan_to_num(scale * ratio, nan=0.0, posinf=1.0))
    return p


def unit(c: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of the MD5 of an id's text."""
    return F.conv(F.substring(F.md5(F.coalesce(c.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _raked_on_driver(cells: DataFrame, targets: dict[str, dict[str, float]], powers: dict[str, float], fraction: float) -> DataFrame:
    t = cells.orderBy(*DIMS).toArrow()
    mass = t["mass"].to_numpy().astype(float)
    codes, goals = [], []
    for d in DIMS:
        names, code = np.unique(np.array(t[d].to_pylist(), object), return_inverse=True) if t.num_rows else (np.array([]), np.zeros(0, int))
        total = dict(zip(names, np.bincount(code, mass, len(names)), strict=True))
        goal = targets.get(d) or shares(total, powers[d])
        of = np.array([goal.get(n, 0.0) if total[n] > 0 else 0.0 for n in names])
        codes.append(code)
        goals.append(of / of.sum() if of.sum() else of)
    w = rake(mass, codes, goals)
    p = probabilities(mass, w, fraction * mass.sum())
    rows = [(*(t[d][i].as_py() for d in DIMS), float(w[i]), float(p[i])) for i in range(t.num_rows)]
    return cells.sparkSession.createDataFrame(rows, "source string, lang string, topic string, weight double, probability double")


def _raked_as_tables(cells: DataFrame, targets: dict[str, dict[str, float]], powers: dict[str, float], fraction: float, scratch: Scratch) -> DataFrame:
    """The same without collecting cells: joins on a dimension's totals, a table and the worst marginal written each round."""
    spark = cells.sparkSession
    goals = {}
    for d in DIMS:
        own = cells.groupBy(d).agg(F.sum("mass").alias("m")).filter("m > 0")
        if d in targets:
            given = spark.createDataFrame([(k, float(x)) for k, x in targets[d].items()], f"{d} string, g double")
            own = own.join(given, d, "left").select(d, F.coalesce("g", F.lit(0.0)).alias("g"))
        else:
            own = own.select(d, F.pow(F.col("m").cast("double"), F.lit(powers[d])).alias("g"))
        total = own.agg(F.sum("g")).first()[0] or 1.0
        goals[d] = scratch.save(own.select(d, (F.col("g") / total).alias("g")), f"goal_{d}")
    total = cells.agg(F.sum("mass")).first()[0] or 1
    w = cells.withColumn("weight", F.col("mass") / F.lit(float(total)))
    for k in range(ROUNDS):
        w = w.withColumn("gap", F.lit(0.0))
        for d in DIMS:
            scale = w.groupBy(d).agg(F.sum("weight").alias("s")).join(goals[d], d).filter("s > 0").select(d, (F.col("g") / F.col("s")).alias("scale"), F.abs(F.col("s") - F.col("g")).alias("off"))
            w = w.join(scale, d, "left").withColumn("weight", F.col("weight") * F.coalesce("scale", F.lit(0.0))).withColumn("gap", F.greatest("gap", "off")).drop("scale", "off")
        w = scratch.save(w, f"raked{k}")
        if k:
            scratch.drop(f"raked{k - 1}")
        if (w.agg(F.max("gap")).first()[0] or 0.0) < TOLERANCE:
            break
    w = w.drop("gap")
    whole = w.agg(F.sum("weight")).first()[0] or 1.0
    w = w.withColumn("weight", F.col("weight") / whole)
    budget, c, capped = fraction * total, None, -1
    while True:  # cells at probability 1 leave the rest of the budget to the others
        full = F.lit(False) if c is None else F.col("weight") * c >= F.col("mass")
        n, m, v = w.agg(F.count(F.when(full, 1)), F.sum(F.when(full, F.col("mass")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if n == capped:
            break
        capped, c = n, (max(budget - (m or 0), 0.0) / v if v and v > 1e-300 else 1e300)
    p = F.when(F.col("mass") > 0, F.least(F.lit(1.0), F.col("weight") * c / F.col("mass"))).otherwise(0.0)
    return w.select(*DIMS, "weight", p.alias("probability"))


def mix(df: DataFrame, topic: Column, fraction: float = 0.5, targets: dict[str, dict[str, float]] | None = None, powers: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text", driver_cells: int = DRIVER_CELLS) -> DataFrame:
    """All columns of ``df`` in a struct ``row``, with source, lang, topic, tokens, weight, probability, sampled.

    Tokens are words between ASCII white space. ``topic`` is an expression over ``df``. ``targets`` gives shares by
    dimension and value (values without one get 0, those that don't occur count for nothing);
    a dimension without targets gets mass ** power. Null values are a value of their own, "(none)". Where
    targets contradict each other, the last dimension raked holds. Documents without tokens
    weigh nothing; of a cell without mass none is sampled. The choice is by a hash of the id, so a rerun makes
    it again and repeated ids share it. An empty table gives an empty result.
    """
    targets, powers = targets or {}, POWERS | (powers or {})
    name = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    docs = df.select(F.struct("*").alias("row"), name(F.col("source")).alias("source"), name(F.col("lang")).alias("lang"), name(topic).alias("topic"), F.size(words_of(text_of(text_col))).cast("long").alias("tokens"), F.col(id_col).alias("id__"))
    scratch = Scratch(df.sparkSession)
    cells = scratch.save(docs.groupBy(*DIMS).agg(F.sum("tokens").alias("mass")), "cells")
    if cells.count() <= driver_cells:
        weights = F.broadcast(_raked_on_driver(cells, targets, powers, fraction))
    else:
        weights = _raked_as_tables(cells, targets, powers, fraction, scratch)
    out = docs.join(weights, list(DIMS), "left")
    return out.select("row", *DIMS, "tokens", F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("probability", F.lit(0.0)).alias("probability"), (unit(F.col("id__")) < F.coalesce("probability", F.lit(0.0))).alias("sampled"))


def rule_topic(text: Column) -> Column:
    """Topic of a text by what it contains: licence, contact, table, or prose."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.contains(t, F.lit("License")), "licence").when(F.contains(t, F.lit("@")) | F.contains(t, F.lit("+1 (")), "contact").when(F.contains(t, F.lit(" | ")), "table").otherwise("prose")


def mix_sql(fraction: float = 0.5, rounds: int = 60) -> str:
    """DuckDB's SQL for doc_id, tokens, probability and sampled of ``documents``: raking as unrolled steps."""
    steps = [f"""
d AS MATERIALIZED (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang,
  CASE WHEN contains(coalesce(text, ''), 'License') THEN 'licence' WHEN contains(coalesce(text, ''), '@') OR contains(coalesce(text, ''), '+1 (') THEN 'contact' WHEN contains(coalesce(text, ''), ' | ') THEN 'table' ELSE 'prose' END AS topic,
  len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS tokens FROM documents),
c AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS mass FROM d GROUP BY ALL)"""]
    for k in DIMS:
        steps.append(f"g_{k} AS MATERIALIZED (SELECT {k}, pow(sum(mass), {POWERS[k]}) / sum(pow(sum(mass), {POWERS[k]})) OVER () AS g FROM c GROUP BY {k} HAVING sum(mass) > 0)")
    steps.append("r0 AS MATERIALIZED (SELECT c.*, g_source.g AS g_source, g_lang.g AS g_lang, g_topic.g AS g_topic, mass / sum(mass) OVER () AS w FROM c JOIN g_source USING (source) JOIN g_lang USING (lang) JOIN g_topic USING (topic))")
    n = 0
    for _ in range(rounds):
        for k in DIMS:
            steps.append(f"r{n + 1} AS MATERIALIZED (SELECT * REPLACE (w * g_{k} / sum(w) OVER (PARTITION BY {k}) AS w) FROM r{n})")
            n += 1
    steps.append(f"o AS MATERIALIZED (SELECT *, w / mass AS r, sum(mass) OVER (ORDER BY w / mass DESC, source, lang, topic) - mass AS before, sum(w) OVER (ORDER BY w / mass DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, {fraction} * sum(mass) OVER () AS budget FROM r{n} WHERE mass > 0)")
    steps.append("s AS (SELECT max(greatest(budget - before, 0) / rest) FILTER (WHERE before = (SELECT min(before) FROM o WHERE greatest(budget - before, 0) / rest * r <= 1)) AS c FROM o)")
    steps.append("p AS (SELECT source, lang, topic, least(1.0, s.c * r) AS probability FROM o, s)")
    return f"WITH {', '.join(steps)} SELECT doc_id, tokens, round(coalesce(probability, 0), 6) AS probability, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 < coalesce(probability, 0) AS sampled FROM d LEFT JOIN p USING (source, lang, topic)"
