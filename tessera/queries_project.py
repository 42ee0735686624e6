"""Queries over a project whose model, columns, items and sources are derived from the given tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .model import table
from .operators import checks as K
from .queries import QUERIES, SQL, query

_E = F.expr


def project(spark, d) -> K.Project:
    """Classes from parts, a tree of threes, with three fields each; columns from line items, items from orders, sources from suppliers."""
    part, line, orders, supplier = (table(spark, d, t) for t in ("part", "lineitem", "orders", "supplier"))
    k = part.select(F.col("p_partkey").alias("k"))
    cls = _E("concat('C', k)")
    f = k.select("k", F.explode(F.array(*(F.lit(i) for i in range(3)))).alias("i"))
    link = _E("(k + i) % 3 <> 0")
    return K.Project(
        spark,
        classes=k.select(cls.alias("cls"), _E("k % 4 = 0").alias("core")),
        extends=k.filter("k >= 3").select(cls.alias("cls"), _E("concat('C', k div 3)").alias("parent")),
        fields=f.select(
            cls.alias("cls"),
            _E("concat('f', (k + i) % 6)").alias("field"),
            _E("CASE (k + i) % 3 WHEN 0 THEN 'attribute' WHEN 1 THEN 'reference' ELSE 'collection' END").alias("kind"),
            F.when(link, _E("concat('C', 1 + (k * 7 + i) % 100)")).otherwise("java.lang.String").alias("type"),
            F.when(link & _E("(k + i) % 4 = 0"), _E("concat('f', (k * 5 + i) % 6)")).otherwise("").alias("reverse"),
            F.col("i").cast("long").alias("ord"),
            _E("k % 4 = 0").alias("core"),
        ),
        keys=k.filter("k % 10 = 1").select(cls.alias("cls")),
        draft_keys=k.filter("k % 10 = 2").select(cls.alias("cls")),
        additions=k.filter("k % 7 = 0").select(cls.alias("cls"), _E("concat('f', k % 6)").alias("field")).union(k.filter("k % 50 = 0").select(_E("concat('N', k)"), F.lit("g"))),
        columns=line.select(
            _E("concat('s', l_suppkey % 3)").alias("source"),
            _E("concat('t', l_orderkey % 20)").alias("table"),
            _E("concat('c', l_orderkey, '_', l_linenumber)").alias("column"),
            _E("CASE l_quantity WHEN 50 THEN concat('X', l_linenumber) WHEN 49 THEN concat('N', l_partkey) ELSE concat('C', l_partkey) END").alias("cls"),
            _E("concat('f', l_linenumber % 6)").alias("field"),
            F.when(F.col("l_returnflag") == "R", _E("concat('C', 1 + l_suppkey % 100, '.f', l_linenumber % 6)")).otherwise("").alias("via"),
            F.when(F.col("l_linestatus") == "F", "literal").otherwise("const").alias("kind"),
            (F.col("l_returnflag") == "A").alias("required"),
            _E("l_linenumber = 1").alias("root"),
            _E("concat('S', l_partkey % 50)").alias("subject"),
            _E("concat('p', l_suppkey % 10)").alias("predicate"),
            _E("l_linenumber % 2 = 0").alias("discriminated"),
        ),
        items=orders.select(_E("concat('s', o_orderkey % 3)").alias("source"), F.col("o_orderkey").cast("string").alias("id"), _E("concat('C', 2 * o_custkey)").alias("cls")),
        links=line.select(_E("concat('s', l_suppkey % 3)").alias("source"), F.col("l_partkey").cast("string").alias("src"), F.col("l_orderkey").cast("string").alias("dst")),
        order=supplier.select(_E("concat('k', s_suppkey)").alias("source"), _E("s_suppkey * 37 % 101").alias("position")),
        replaces=supplier.select(_E("concat('k', s_suppkey)").alias("source"), _E("concat('k', s_suppkey * 3 % 150)").alias("stock")).union(supplier.select(_E("concat('s', s_suppkey % 3)"), _E("concat('d', s_suppkey % 5)")).distinct()),
        alongside=supplier.select(_E("concat('k', s_suppkey)").alias("source"), _E("concat('k', s_suppkey * 7 % 150)").alias("stock")).union(supplier.filter("s_suppkey % 9 = 0").select(_E("concat('k', s_suppkey)"), _E("concat('k', s_suppkey * 3 % 150)"))),
        declared=k.select(_E("concat('d', k % 5)").alias("stock"), cls.alias("cls"), _E("concat('f', k % 6)").alias("field")),
        accepted=k.filter("k % 9 < 2").select(_E("concat('s', k % 3)").alias("source"), _E("CASE k % 9 WHEN 0 THEN concat('C', k) ELSE concat('C', k, '.f', k % 6) END").alias("entry")),
    )


PROJECT_SQL = """
WITH RECURSIVE classes AS (SELECT 'C' || p_partkey AS cls, p_partkey % 4 = 0 AS core FROM part),
extends AS (SELECT 'C' || p_partkey AS cls, 'C' || (p_partkey // 3) AS parent FROM part WHERE p_partkey >= 3),
fields AS (SELECT 'C' || k AS cls, 'f' || ((k + i) % 6) AS field, CASE (k + i) % 3 WHEN 0 THEN 'attribute' WHEN 1 THEN 'reference' ELSE 'collection' END AS kind,
  CASE WHEN (k + i) % 3 <> 0 THEN 'C' || (1 + (k * 7 + i) % 100) ELSE 'java.lang.String' END AS type,
  CASE WHEN (k + i) % 3 <> 0 AND (k + i) % 4 = 0 THEN 'f' || ((k * 5 + i) % 6) ELSE '' END AS reverse, i AS ord, k % 4 = 0 AS core FROM (SELECT p_partkey AS k FROM part), range(3) r(i)),
keys AS (SELECT 'C' || p_partkey AS cls FROM part WHERE p_partkey % 10 = 1),
draft_keys AS (SELECT 'C' || p_partkey AS cls FROM part WHERE p_partkey % 10 = 2),
additions AS (SELECT 'C' || p_partkey AS cls, 'f' || (p_partkey % 6) AS field FROM part WHERE p_partkey % 7 = 0 UNION ALL SELECT 'N' || p_partkey, 'g' FROM part WHERE p_partkey % 50 = 0),
columns AS (SELECT 's' || (l_suppkey % 3) AS source, 't' || (l_orderkey % 20) AS tab, CASE l_quantity WHEN 50 THEN 'X' || l_linenumber WHEN 49 THEN 'N' || l_partkey ELSE 'C' || l_partkey END AS cls,
  'f' || (l_linenumber % 6) AS field, CASE WHEN l_returnflag = 'R' THEN 'C' || (1 + l_suppkey % 100) ELSE '' END AS via_cls, CASE WHEN l_returnflag = 'R' THEN 'f' || (l_linenumber % 6) ELSE '' END AS via_field,
  CASE WHEN l_linestatus = 'F' THEN 'literal' ELSE 'const' END AS kind, l_returnflag = 'A' AS required, l_linenumber = 1 AS root, 'S' || (l_partkey % 50) AS subject, 'p' || (l_suppkey % 10) AS predicate, l_linenumber % 2 = 0 AS discriminated FROM lineitem),
items AS (SELECT 's' || (o_orderkey % 3) AS source, o_orderkey AS id, 'C' || (2 * o_custkey) AS cls FROM orders),
links AS (SELECT 's' || (l_suppkey % 3) AS source, l_orderkey AS dst FROM lineitem),
load AS (SELECT 'k' || s_suppkey AS source, s_suppkey * 37 % 101 AS position FROM supplier),
replaces AS (SELECT 'k' || s_suppkey AS source, 'k' || (s_suppkey * 3 % 150) AS stock FROM supplier UNION SELECT 's' || (s_suppkey % 3), 'd' || (s_suppkey % 5) FROM supplier),
alongside AS (SELECT 'k' || s_suppkey AS source, 'k' || (s_suppkey * 7 % 150) AS stock FROM supplier UNION SELECT 'k' || s_suppkey, 'k' || (s_suppkey * 3 % 150) FROM supplier WHERE s_suppkey % 9 = 0),
declared AS (SELECT 'd' || (p_partkey % 5) AS stock, 'C' || p_partkey AS cls, 'f' || (p_partkey % 6) AS field FROM part),
accepted AS (SELECT DISTINCT 's' || (p_partkey % 3) AS source, CASE p_partkey % 9 WHEN 0 THEN 'C' || p_partkey ELSE 'C' || p_partkey || '.f' || (p_partkey % 6) END AS entry FROM part WHERE p_partkey % 9 < 2),
up AS (SELECT cls AS child, cls AS ancestor, 0 AS depth FROM classes UNION ALL SELECT up.child, e.parent, depth + 1 FROM up JOIN extends e ON up.ancestor = e.cls),
known AS (SELECT * FROM (SELECT child AS cls, field, kind, type, reverse, core, ancestor AS declared_in, depth, ord, row_number() OVER (PARTITION BY child, field ORDER BY depth, ancestor, ord) AS rn FROM up JOIN fields ON ancestor = fields.cls) WHERE rn = 1)
"""
_WAYS = """,
roots AS (SELECT source, tab, min(cls) AS root_cls FROM columns WHERE root GROUP BY 1, 2),
bare AS (SELECT DISTINCT c.source, c.cls, root_cls FROM columns c JOIN roots r ON c.source = r.source AND c.tab = r.tab WHERE via_cls = '' AND c.cls <> root_cls),
ways AS (SELECT b.cls, b.root_cls, k.field, row_number() OVER (PARTITION BY b.cls, b.root_cls ORDER BY k.depth DESC, k.declared_in, k.ord, k.field) AS rn FROM (SELECT DISTINCT cls, root_cls FROM bare) b JOIN known k ON k.cls = b.root_cls AND k.kind <> 'attribute' JOIN up u ON u.child = b.cls AND u.ancestor = k.type),
used AS (SELECT source, via_cls AS cls, via_field AS field FROM columns WHERE via_cls <> '' UNION SELECT b.source, b.root_cls, w.field FROM bare b JOIN ways w ON b.cls = w.cls AND b.root_cls = w.root_cls WHERE w.rn = 1),
wr AS (SELECT source, cls, field FROM columns UNION SELECT * FROM used UNION SELECT source, type, reverse FROM used JOIN known USING (cls, field) WHERE reverse <> '')
"""
_GAPS = _WAYS + """,
lifted AS (SELECT source, ancestor AS cls, field FROM wr JOIN up ON wr.cls = up.child UNION SELECT * FROM wr),
gaps AS (SELECT DISTINCT r.source, r.stock, d.cls, d.field, (r.source, d.cls) NOT IN (SELECT source, cls FROM lifted) AS whole FROM replaces r JOIN declared d ON r.stock = d.stock WHERE (r.source, d.cls, d.field) NOT IN (SELECT source, cls, field FROM lifted)),
covered AS (SELECT g.*, coalesce(a.entry, b.entry) AS entry FROM gaps g LEFT JOIN accepted a ON a.source = g.source AND a.entry = g.cls LEFT JOIN accepted b ON b.source = g.source AND b.entry = g.cls || '.' || g.field)
"""
_VIA = """,
via AS (SELECT DISTINCT c.source, c.cls, via_cls || '.' || via_field AS via, k.kind AS via_kind, k.type AS via_type FROM columns c JOIN classes USING (cls) LEFT JOIN known k ON k.cls = via_cls AND k.field = via_field WHERE via_cls <> ''),
narrower AS (SELECT child, ancestor FROM up)
"""
_NOKEY = ", keyless AS (SELECT * FROM columns WHERE cls IN (SELECT cls FROM classes) AND cls NOT IN (SELECT child FROM up WHERE ancestor IN (SELECT cls FROM keys)))"
RULE_SQL = {
    "unknown_class": ("", "SELECT DISTINCT source, cls AS subject FROM columns WHERE cls NOT IN (SELECT cls FROM classes) AND cls NOT IN (SELECT cls FROM additions)"),
    "unknown_field": ("", "SELECT DISTINCT source, cls || '.' || field AS subject FROM columns WHERE cls IN (SELECT cls FROM classes UNION SELECT cls FROM additions) AND (cls, field) NOT IN (SELECT cls, field FROM known) AND (cls, field) NOT IN (SELECT cls, field FROM additions)"),
    "not_attribute": ("", "SELECT DISTINCT source, c.cls || '.' || c.field || ' ' || k.kind AS subject FROM columns c JOIN known k ON c.cls = k.cls AND c.field = k.field WHERE k.kind <> 'attribute'"),
    "via_unknown": (_VIA, "SELECT DISTINCT source, via AS subject FROM via WHERE via_kind IS NULL"),
    "via_attribute": (_VIA, "SELECT DISTINCT source, via AS subject FROM via WHERE via_kind = 'attribute'"),
    "via_range": (_VIA, "SELECT DISTINCT source, via || ' ' || cls AS subject FROM via WHERE via_kind <> 'attribute' AND (cls, via_type) NOT IN (SELECT child, ancestor FROM narrower) AND (via_type, cls) NOT IN (SELECT child, ancestor FROM narrower)"),
    "via_widens": (_VIA, "SELECT DISTINCT source, via || ' ' || cls AS subject FROM via WHERE via_kind <> 'attribute' AND cls <> via_type AND (cls, via_type) IN (SELECT child, ancestor FROM narrower)"),
    "draft_key": (_NOKEY, "SELECT DISTINCT source, cls AS subject FROM keyless WHERE required AND cls IN (SELECT cls FROM draft_keys)"),
    "no_key": (_NOKEY, "SELECT DISTINCT source, cls AS subject FROM keyless WHERE cls NOT IN (SELECT cls FROM draft_keys)"),
    "collision": ("", "SELECT source, concat_ws(' ', tab, cls || '.' || field, CASE WHEN via_cls = '' THEN '' ELSE via_cls || '.' || via_field END) AS subject FROM columns WHERE kind <> 'const' GROUP BY source, tab, cls, field, via_cls, via_field HAVING count(*) > 1"),
    "cross_product": ("", "SELECT source, tab || ' ' || subject || ' ' || predicate AS subject FROM columns WHERE kind IN ('literal', 'iri') AND NOT discriminated GROUP BY source, tab, columns.subject, predicate HAVING count(*) > 1"),
    "unknown_item_class": ("", "SELECT DISTINCT source, cls AS subject FROM items WHERE cls NOT IN (SELECT cls FROM classes) AND cls NOT IN (SELECT cls FROM additions)"),
    "dangling_reference": ("", "SELECT source, count(*)::VARCHAR AS subject FROM links WHERE (source, dst) NOT IN (SELECT source, id FROM items) GROUP BY 1"),
    "replaces_and_alongside": ("", "SELECT source, stock AS subject FROM alongside WHERE (source, stock) IN (SELECT source, stock FROM replaces)"),
    "alongside_absent": ("", "SELECT source, stock AS subject FROM alongside WHERE (source, stock) NOT IN (SELECT source, stock FROM replaces) AND stock NOT IN (SELECT source FROM load)"),
    "load_order": ("", "SELECT a.source, a.stock AS subject FROM alongside a JOIN load s ON s.source = a.source JOIN load t ON t.source = a.stock WHERE t.position > s.position AND (a.source, a.stock) NOT IN (SELECT source, stock FROM replaces)"),
    "still_active": ("", "SELECT source, stock AS subject FROM replaces WHERE stock IN (SELECT source FROM load)"),
    "coverage_gap": (_GAPS, "SELECT DISTINCT source, concat_ws(' ', stock, cls || '.' || field, CASE WHEN whole THEN '(class)' END) AS subject FROM covered WHERE entry IS NULL"),
    "accepted_gap": (_GAPS, "SELECT DISTINCT source, stock || ' ' || cls || '.' || field AS subject FROM covered WHERE entry IS NOT NULL"),
    "unused_acceptance": (_GAPS, "SELECT DISTINCT source, entry AS subject FROM accepted WHERE (source, entry) NOT IN (SELECT source, entry FROM covered WHERE entry IS NOT NULL)"),
    "unresolved_reverse": (", there AS (SELECT cls, field FROM additions UNION SELECT cls, field FROM fields WHERE core), lifted AS (SELECT child AS cls, field FROM up JOIN there ON ancestor = there.cls UNION SELECT * FROM there)", "SELECT DISTINCT '' AS source, f.cls || '.' || f.field || ' ' || f.type || '.' || f.reverse AS subject FROM fields f JOIN additions a ON f.cls = a.cls AND f.field = a.field WHERE f.reverse <> '' AND (f.type, f.reverse) NOT IN (SELECT cls, field FROM lifted)"),
}


def _rule_query(name: str) -> None:
    more, sql = RULE_SQL[name]
    key = "check_column_collision" if name == "collision" else f"check_{name}"  # check_collision is a query of its own
    QUERIES[key] = lambda spark, d: K.findings(project(spark, d), [name])
    SQL[key] = f"{PROJECT_SQL}{more}SELECT '{name}' AS rule, '{K.RULES[name][0]}' AS severity, source, subject FROM ({sql})"


for _name in RULE_SQL:
    _rule_query(_name)


@query(PROJECT_SQL + _WAYS + "SELECT source, cls, field FROM wr")
def written_fields(spark, d):
    return project(spark, d).written_fields


_CARRY = """,
wr AS (SELECT DISTINCT 'C' || l_partkey AS cls, 'f' || (l_linenumber % 6) AS field FROM lineitem WHERE l_returnflag = 'R'),
live AS (SELECT cls, field FROM known WHERE substr(cls, 2)::INT % 5 <> 0),
need AS (SELECT k.cls, k.field, k.kind, k.type, k.reverse FROM wr JOIN known k ON wr.cls = k.cls AND wr.field = k.field JOIN classes c ON c.cls = k.cls WHERE NOT (c.core AND k.core AND (k.cls, k.field) IN (SELECT cls, field FROM live))),
ends AS (SELECT n.type AS cls, n.reverse AS field, coalesce(k.kind, CASE n.kind WHEN 'reference' THEN 'collection' ELSE 'reference' END) AS kind, n.cls AS type, n.field AS reverse,
  row_number() OVER (PARTITION BY n.type, n.reverse ORDER BY n.cls, n.field) AS rn FROM need n JOIN classes c ON c.cls = n.type LEFT JOIN known k ON k.cls = n.type AND k.field = n.reverse WHERE n.kind <> 'attribute' AND n.reverse <> '' AND (n.type, n.reverse) NOT IN (SELECT cls, field FROM wr)),
own_ends AS (SELECT cls, field, kind, type, reverse FROM ends WHERE rn = 1 AND (cls, field) NOT IN (SELECT cls, field FROM need)),
carried AS (SELECT cls FROM (SELECT cls FROM need UNION SELECT n.type FROM need n JOIN classes c ON c.cls = n.type WHERE NOT c.core AND n.kind <> 'attribute' UNION SELECT cls FROM own_ends) UNION SELECT e.parent FROM carried JOIN extends e ON carried.cls = e.cls JOIN classes c ON c.cls = e.parent WHERE NOT c.core)
"""


def _carried(spark, d):
    p = project(spark, d)
    written = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(_E("concat('C', l_partkey)").alias("cls"), _E("concat('f', l_linenumber % 6)").alias("field")).distinct()
    live = p.known.filter("cast(substr(cls, 2) AS int) % 5 <> 0").select("cls", "field")
    return K.carried_definitions(p, written, live)


@query(PROJECT_SQL + _CARRY + "SELECT DISTINCT carried.cls, coalesce(parent, '') AS parents FROM carried LEFT JOIN extends e ON e.cls = carried.cls")
def carried_classes(spark, d):
    return _carried(spark, d)[0]


@query(PROJECT_SQL + _CARRY + "SELECT * FROM need UNION ALL SELECT * FROM own_ends")
def carried_members(spark, d):
    return _carried(spark, d)[1]


@query(PROJECT_SQL + _WAYS + ", refs AS (SELECT source, cls, field FROM used JOIN known USING (cls, field) WHERE kind = 'reference' UNION SELECT u.source, k.type, k.reverse FROM used u JOIN known k ON u.cls = k.cls AND u.field = k.field JOIN known b ON b.cls = k.type AND b.field = k.reverse WHERE b.kind = 'reference') SELECT source, cls, field FROM columns UNION SELECT * FROM refs")
def competing_fields(spark, d):
    return K.competing_fields(project(spark, d))


@query(PROJECT_SQL + _WAYS + ", l AS (SELECT DISTINCT source, cls, via_cls, via_field, '' AS implied FROM columns WHERE via_cls <> '' UNION SELECT b.source, b.cls, b.root_cls, w.field, ', implied' FROM bare b JOIN ways w ON b.cls = w.cls AND b.root_cls = w.root_cls WHERE w.rn = 1) SELECT DISTINCT source, via_cls || '.' || via_field || ' -> ' || l.cls || CASE WHEN coalesce(reverse, '') <> '' THEN ' (reverse ' || type || '.' || reverse || ')' ELSE '' END || implied AS line FROM l LEFT JOIN known k ON k.cls = via_cls AND k.field = via_field")
def links_report(spark, d):
    return K.links_report(project(spark, d))
