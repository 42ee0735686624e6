"""Queries of object lists, labels and of loads by several keys, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .model import table
from .operators import enrich as N
from .operators import identity as D
from .queries import query

_TAILS = """
WITH e AS (SELECT l_partkey AS target, count(DISTINCT l_orderkey) FILTER (o_orderstatus = 'P') AS overlap, count(DISTINCT l_orderkey) AS total FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
n AS (SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'P') AS d FROM orders),
s AS (SELECT target, overlap, total, n, d, total * (d / n) AS expected FROM e, n WHERE overlap > 0),
p AS (SELECT target, overlap, total, expected, (SELECT sum(exp(lgamma(total + 1) - lgamma(i + 1) - lgamma(total - i + 1) + lgamma(n - total + 1) - lgamma(d - i + 1) - lgamma(n - total - d + i + 1) - lgamma(n + 1) + lgamma(d + 1) + lgamma(n - d + 1)))
  FROM range(overlap, least(total, d) + 1) r(i) WHERE n - total - d + i >= 0) AS p FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY p, target) AS rk, count(*) OVER () AS m FROM p)
"""


@query(_TAILS + "SELECT target, overlap, total, round(expected, 6) AS expected, round(p, 8) AS p, round(least(1, min(p * m / rk) OVER (ORDER BY rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 8) AS adjusted FROM r")
def list_enrichment(spark, d):
    return _enriched(spark, d, "benjamini-hochberg")


@query(_TAILS + "SELECT target, overlap, total, round(expected, 6) AS expected, round(p, 8) AS p, round(least(1, max(p * (m - rk + 1)) OVER (ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 8) AS adjusted FROM r")
def list_enrichment_holm(spark, d):
    return _enriched(spark, d, "holm")


def _enriched(spark, d, correction):
    o = table(spark, d, "orders")
    links = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"))
    found = N.enrichment(o.select(F.col("o_orderkey").alias("id")), links, o.filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id")), correction)
    return found.select("target", "overlap", "total", F.round("expected", 6).alias("expected"), F.round("p", 8).alias("p"), F.round("adjusted", 8).alias("adjusted"))


@query("SELECT n_name AS category, count(*) FILTER (c_acctbal > 5000) AS actual, round(count(*) * (SELECT count(*) FILTER (c_acctbal > 5000) / count(*) FROM customer), 6) AS expected FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def list_distribution(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    values = c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("c_custkey").alias("id"), F.col("n_name").alias("category"))
    found = N.distribution(values, c.filter("c_acctbal > 5000").select(F.col("c_custkey").alias("id")))
    return found.select("category", "actual", F.round("expected", 6).alias("expected"))


_LABELS = """
WITH asked AS (SELECT DISTINCT upper(p_name) AS label FROM part UNION SELECT 'none ' || s_suppkey FROM supplier UNION SELECT c_name FROM customer),
known AS (SELECT 0 AS tier_no, 'symbol' AS tier, p_name AS label, p_partkey AS id FROM part WHERE p_size > 25 UNION ALL SELECT 1, 'synonym', p_name, p_partkey FROM part UNION ALL SELECT 1, 'synonym', c_name, c_custkey FROM customer),
hits AS (SELECT a.label, id, min(tier_no * 2 + CASE WHEN k.label = a.label THEN 0 ELSE 1 END) AS rk, min(tier) AS tier FROM asked a JOIN known k ON lower(trim(k.label)) = lower(trim(a.label)) GROUP BY a.label, id, tier_no),
best AS (SELECT label, min(rk) AS rk FROM hits GROUP BY 1),
f AS (SELECT h.* FROM hits h JOIN best b ON h.label = b.label AND h.rk = b.rk)
"""


def _resolved(spark, d, every):
    part, name = table(spark, d, "part"), lambda df, c, i: df.select(F.col(c).alias("label"), F.col(i).cast("long").alias("id"))
    asked = part.select(F.upper("p_name").alias("label")).union(table(spark, d, "supplier").select(F.concat(F.lit("none "), F.col("s_suppkey").cast("string")))).union(table(spark, d, "customer").select("c_name"))
    synonyms = name(part, "p_name", "p_partkey").union(name(table(spark, d, "customer"), "c_name", "c_custkey"))
    return N.resolve_labels(asked, [("symbol", name(part.filter("p_size > 25"), "p_name", "p_partkey")), ("synonym", synonyms)], every)


@query(_LABELS + "SELECT a.label, min(id) AS id, min(tier) AS tier, count(id) AS n_ids FROM asked a LEFT JOIN f ON a.label = f.label GROUP BY 1")
def labels_first(spark, d):
    return _resolved(spark, d, False)


@query(_LABELS + "SELECT a.label, id, tier, CASE WHEN id IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY a.label) END AS n_ids FROM asked a LEFT JOIN f ON a.label = f.label")
def labels_every(spark, d):
    return _resolved(spark, d, True)


@query("SELECT DISTINCT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_name IN (SELECT min(p_name) FROM part GROUP BY p_brand))")
def scan_by_labels(spark, d):
    """A source read for the ids of labels only: labels are resolved, their ids restrict the scan by a semi-join."""
    part = table(spark, d, "part")
    asked = part.groupBy("p_brand").agg(F.min("p_name").alias("label")).select("label")
    ids = N.resolve_labels(asked, [("symbol", part.select(F.col("p_name").alias("label"), F.col("p_partkey").alias("id")))], every=True).select(F.col("id").alias("l_partkey"))
    return table(spark, d, "lineitem").join(ids.distinct(), "l_partkey", "left_semi").select("l_orderkey", "l_partkey", "l_suppkey").distinct()


#: Two keys: a number, and a code of three fields; sources: the register, orders that know customers by number, branches by code only.
KEYS = {"number": ["number"], "code": ["code", "area"]}


def source_rows(spark, d):
    """Customers of four sources; branches know neighbours in pairs, so that objects are chained over both keys; the archive has a code twice."""
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    e = lambda df, source, number, code, area, name, no: df.select(F.expr(f"4 * cast({no} AS long) + {no_of[source]}").alias("row_id"), F.lit(source).alias("source"), F.expr(number).alias("number"), F.expr(code).alias("code"), F.expr(area).alias("area"), F.expr(name).alias("name"))
    no_of = {"register": 0, "orders": 1, "branch": 2, "archive": 3}
    register = e(c, "register", "cast(c_custkey AS string)", "CASE WHEN c_custkey % 3 <> 0 THEN concat('k', c_custkey div 2) END", "cast(c_custkey % 2 AS string)", "CASE WHEN c_custkey % 2 = 0 THEN c_name END", "c_custkey")
    ordered = e(o.select("o_custkey").distinct(), "orders", "cast(o_custkey AS string)", "concat('k', o_custkey div 2 + 1)", "'0'", "concat('buyer ', o_custkey)", "o_custkey").filter("cast(number AS long) % 5 = 0")
    branch = e(c.filter("c_custkey % 4 = 0"), "branch", "NULL", "concat('k', c_custkey div 2)", "'0'", "concat('branch ', c_custkey)", "c_custkey")
    archive = e(c.filter("c_custkey < 40"), "archive", "NULL", "concat('k', c_custkey div 2)", "'1'", "'archived'", "c_custkey")
    return register.unionByName(ordered).unionByName(branch).unionByName(archive)


_ROWS = """
WITH RECURSIVE r AS (SELECT 4 * c_custkey AS row_id, 'register' AS source, c_custkey::VARCHAR AS number, CASE WHEN c_custkey % 3 <> 0 THEN 'k' || (c_custkey // 2) END AS code, (c_custkey % 2)::VARCHAR AS area, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS name FROM customer
  UNION ALL SELECT DISTINCT 4 * o_custkey + 1, 'orders', o_custkey::VARCHAR, 'k' || (o_custkey // 2 + 1), '0', 'buyer ' || o_custkey FROM orders WHERE o_custkey % 5 = 0
  UNION ALL SELECT 4 * c_custkey + 2, 'branch', NULL, 'k' || (c_custkey // 2), '0', 'branch ' || c_custkey FROM customer WHERE c_custkey % 4 = 0),
k AS (SELECT row_id, 'n' || number AS v FROM r WHERE number IS NOT NULL UNION SELECT row_id, 'c' || code || '|' || area FROM r WHERE code IS NOT NULL),
w AS (SELECT row_id, row_id AS other FROM r UNION SELECT w.row_id, b.row_id FROM w JOIN k a ON a.row_id = w.other JOIN k b ON a.v = b.v),
o AS MATERIALIZED (SELECT row_id, min(other) AS obj FROM w GROUP BY 1),
p AS MATERIALIZED (SELECT obj, r.*, CASE source WHEN 'register' THEN 0 ELSE 1 END AS rk FROM r JOIN o ON r.row_id = o.row_id),
g AS (SELECT obj, count(*) AS n_rows, arg_min(name, (rk, row_id)) FILTER (name IS NOT NULL) AS name, arg_min(source, (rk, row_id)) FILTER (name IS NOT NULL) AS name_source, min(rk) FILTER (name IS NOT NULL) AS rk FROM p GROUP BY 1),
m AS (SELECT g.*, (SELECT count(DISTINCT name) FROM p WHERE p.obj = g.obj AND p.rk = g.rk) > 1 AS name_conflict FROM g)
"""


def _load(spark, d):
    return D.load(source_rows(spark, d), KEYS, ["name"], {"register": 0})


@query(_ROWS + "SELECT obj, name, name_source, name_conflict, n_rows FROM m")
def merged_objects(spark, d):
    return _load(spark, d).objects


@query(_ROWS + "SELECT 'conflict' AS rule, name_source AS source, obj || '.name' AS subject, 1::BIGINT AS n FROM m WHERE name_conflict UNION ALL SELECT 'duplicate key', 'archive', 'code=[\"k' || (c_custkey // 2) || '\",\"1\"]', count(*) FROM customer WHERE c_custkey < 40 GROUP BY c_custkey // 2 HAVING count(*) > 1")
def load_violations(spark, d):
    return _load(spark, d).violations


@query(_ROWS + "SELECT DISTINCT obj, 'name' AS field, source, name AS value FROM p WHERE name IS NOT NULL")
def field_provenance(spark, d):
    return _load(spark, d).provenance
