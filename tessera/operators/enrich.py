"""Object lists: resolution of identifiers, enrichment of linked values with corrected p-values, distribution over categories."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.written import written

CORRECTIONS = ("none", "bonferroni", "holm", "benjamini-hochberg")
#: Below it log-factorials are a table, from it on Stirling's series, which is exact to a double's last digits there.
_STIRLING = 32
#: Terms of a tail that are summed: so many standard deviations and so many more; what follows is under 1e-16 of the sum.
_DEVIATIONS, _MORE = 40, 80


def log_factorial(n: Column) -> Column:
    """ln n! of a whole number."""
    x = F.greatest(n, F.lit(_STIRLING)).cast("double")
    series = (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5.0)))
    small = F.array(*(F.lit(math.lgamma(i + 1)) for i in range(_STIRLING)))
    return F.when(n < _STIRLING, F.get(small, n.cast("int"))).otherwise(series)


def log_choose(n: Column, k: Column) -> Column:
    return log_factorial(n) - log_factorial(k) - log_factorial(n - k)


def hypergeometric_tail(k: Column, population: Column, successes: Column, draws: Column) -> Column:
    """The chance of ``k`` successes or more among ``draws`` objects drawn from ``population`` without putting back.

    Above the mean it is summed upwards from k, else 1 less what is summed downwards from k - 1, so terms fall
    from the first on and each is a ratio of the one before: no term underflows before the sum does.
    """
    n, m, d = (c.cast("double") for c in (population, successes, draws))
    mean = d * m / n
    spread = F.ceil(F.sqrt(mean * (1 - m / n)) * _DEVIATIONS).cast("long") + _MORE
    most, least = F.least(successes, draws), F.greatest(F.lit(0), draws + successes - population)
    first = lambda i: F.exp(log_choose(successes, i) + log_choose(population - successes, draws - i) - log_choose(population, draws))
    start = lambda: F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))
    step = lambda s, ratio: F.struct((s["term"] * ratio).alias("term"), (s["sum"] + s["term"] * ratio).alias("sum"))
    up = F.aggregate(F.when(k < most, F.sequence(k + 1, F.least(most, k + spread))).otherwise(F.array().cast("array<bigint>")), start(), lambda s, i: step(s, (m - i + 1) * (d - i + 1) / (i * (n - m - d + i))), lambda s: s["sum"])
    below = k - 1
    down = F.aggregate(F.when(below > least, F.sequence(below, F.greatest(least + 1, below - spread), F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>")), start(), lambda s, i: step(s, i * (n - m - d + i) / ((m - i + 1) * (d - i + 1))), lambda s: s["sum"])
    tail = F.when(k <= least, 1.0).when(k > most, 0.0).when(k > mean, first(k) * up).otherwise(1 - first(below) * down)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail))


def adjusted(rows: DataFrame, p: str, ties: list[str], correction: str = "benjamini-hochberg", name: str = "adjusted") -> DataFrame:
    """``rows`` with the p-value corrected for their number; an unknown correction is an error.

    Ranks by p come from range partitions, which are written once; the running minimum or maximum goes on within a
    partition, and one number for each of the others is added to it. Equal p-values get equal results; ``ties`` tell
    them apart for the ranks. Rows without p-value don't count and stay without.
    """
    if correction not in CORRECTIONS:
        raise ValueError(f"unknown correction {correction!r}, known: {', '.join(CORRECTIONS)}")
    if correction == "none":
        return rows.withColumn(name, F.col(p))
    if correction == "bonferroni":
        tests = rows.agg(F.count(p)).first()[0]
        return rows.withColumn(name, F.least(F.lit(1.0), F.col(p) * tests))
    order = [F.col(p), *(F.col(t) for t in ties)]
    placed = rows.filter(F.col(p).isNotNull()).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(placed.withColumn("part__", F.spark_partition_id()).withColumn("pos__", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    sizes = {r.part__: r.n for r in placed.groupBy("part__").agg(F.count("*").alias("n")).collect()}
    tests, begins, at = sum(sizes.values()), {}, 0
    for part in sorted(sizes):
        begins[part], at = at, at + sizes[part]
    side = lambda numbers, column, kind: F.broadcast(rows.sparkSession.createDataFrame(sorted(numbers.items()), f"part__ int, {column} {kind}"))
    ranked = placed.join(side(begins, "begin__", "long"), "part__").withColumn("rank__", F.col("begin__") + F.col("pos__") + 1)
    falls = correction == "benjamini-hochberg"
    scaled = F.col(p) * tests / F.col("rank__") if falls else F.col(p) * (tests - F.col("rank__") + 1)
    pick = F.min if falls else F.max
    ranked = ranked.withColumn("scaled__", scaled)
    own = {r.part__: r.v for r in ranked.groupBy("part__").agg(pick("scaled__").alias("v")).collect()}
    beyond, so_far = {}, math.inf if falls else 0.0
    for part in sorted(own, reverse=falls):
        beyond[part] = so_far
        so_far = min(so_far, own[part]) if falls else max(so_far, own[part])
    within = Window.partitionBy("part__").orderBy(F.desc("pos__") if falls else F.col("pos__")).rowsBetween(Window.unboundedPreceding, 0)
    best = (F.least if falls else F.greatest)(pick("scaled__").over(within), F.col("beyond__"))
    out = ranked.join(side(beyond, "beyond__", "double"), "part__").withColumn(name, F.least(F.lit(1.0), best))
    return out.select(*rows.columns, name).union(rows.filter(F.col(p).isNull()).withColumn(name, F.lit(None).cast("double")))


def enrichment(members: DataFrame, links: DataFrame, listed: DataFrame, correction: str = "benjamini-hochberg") -> DataFrame:
    """(target, overlap, total, expected, p, adjusted) of each target that a listed object links to.

    ``members``: (id) all objects, ``links``: (src, dst), ``listed``: (id) the list. ``overlap`` of the list's objects and ``total`` of
    all link to the target, ``expected`` would by chance; ``p`` is the chance of so many or more (hypergeometric), ``adjusted``
    corrects it for the number of targets found. Objects and links count once, however often they are given, and only
    objects among the members count, so no target has more links than there are objects.
    """
    if correction not in CORRECTIONS:
        raise ValueError(f"unknown correction {correction!r}, known: {', '.join(CORRECTIONS)}")
    everyone = members.select(F.col("id").alias("src")).filter("src IS NOT NULL").distinct()
    own = listed.select(F.col("id").alias("src")).distinct().join(everyone, "src", "left_semi")
    n, k = everyone.count(), own.count()
    pairs = links.select("src", "dst").filter("dst IS NOT NULL").distinct().join(everyone, "src", "left_semi")
    marked = pairs.join(own.withColumn("own__", F.lit(1)), "src", "left")
    counts = marked.groupBy(F.col("dst").alias("target")).agg(F.count("own__").alias("overlap"), F.count("*").alias("total")).filter("overlap > 0")
    size, drawn = F.lit(n).cast("long"), F.lit(k).cast("long")
    counts = counts.withColumn("expected", F.col("total") * F.lit(float(k)) / F.lit(float(max(n, 1)))).withColumn("p", hypergeometric_tail(F.col("overlap"), size, F.col("total"), drawn))
    return adjusted(counts, "p", ["target"], correction)


def distribution(values: DataFrame, listed: DataFrame) -> DataFrame:
    """(category, actual, expected): the list's objects in each category, and how many a random list as long would have.

    ``values``: (id, category); an object may be in several categories and counts in each. Objects without a category
    count in none, and don't count for the size of the list or of all.
    """
    pairs = values.select("id", "category").filter("id IS NOT NULL AND category IS NOT NULL").distinct()
    own = listed.select("id").distinct().withColumn("own__", F.lit(1))
    marked = pairs.join(own, "id", "left")
    size = marked.groupBy("id").agg(F.max("own__").alias("own__")).agg(F.count("*").alias("all"), F.count("own__").alias("own")).first()
    share = size["own"] / max(size["all"], 1)
    return marked.groupBy("category").agg(F.count("own__").alias("actual"), (F.count("*") * share).alias("expected"))


def resolve_labels(labels: DataFrame, tiers: list[tuple[str, DataFrame]], every: bool = False) -> DataFrame:
    """(label, id, tier, n_ids): what each label stands for, by the first tier that knows it.

    ``labels``: (label). ``tiers``: names with (label, id), such as symbols, then synonyms, then old symbols. Labels match whatever
    their case and the white space around them, but an exact match of the same tier comes first. With ``every`` all ids of
    that tier are rows, else the smallest, and ``n_ids`` tells how many there were. Labels that no tier knows stay, with null id and
    tier. Nothing is gathered by label: a label that very many ids share costs an aggregate.
    """
    plain = lambda c: F.lower(F.trim(c))
    asked = labels.select("label").filter("trim(label) <> ''").distinct().withColumn("plain__", plain(F.col("label")))
    known = [df.select(plain(F.col("label")).alias("plain__"), F.col("label").alias("as__"), F.col("id"), F.lit(i).alias("no__"), F.lit(name).alias("tier")) for i, (name, df) in enumerate(tiers)]
    hits = asked.join(reduce(DataFrame.unionByName, known).filter("id IS NOT NULL"), "plain__").withColumn("rank__", F.col("no__") * 2 + F.when(F.col("as__") == F.col("label"), 0).otherwise(1))
    hits = hits.groupBy("label", "id").agg(F.min(F.struct("rank__", "tier")).alias("r"))
    best = hits.groupBy("label").agg(F.min("r.rank__").alias("best__"))
    first = hits.join(best, "label").filter("r.rank__ = best__")
    counts = first.groupBy("label").agg(F.min("id").alias("id"), F.min("r.tier").alias("tier"), F.count("*").alias("n_ids"))
    if every:
        counts = first.select("label", "id", F.col("r.tier").alias("tier")).join(counts.select("label", "n_ids"), "label")
    return asked.select("label").join(counts, "label", "left").select("label", "id", "tier", F.coalesce("n_ids", F.lit(0)).cast("long").alias("n_ids"))
