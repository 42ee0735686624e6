"""The registered queries of the engine, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import terms as T
from .model import catalog, mine, table, triples
from .operators import integrate as G
from .operators import items as I
from .operators import search as S
from .operators.tables import ColumnSpec, RunStatistics, clean_table
from .plans import patterns as P
from .plans.catalog import closure, inherited_fields
from .plans.pathquery import Constraint, PathQuery, Template
from .plans.written import new_folder, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- terms -----------------------------------------------------------------------------------------


@query(r"SELECT doc_id, regexp_replace(regexp_replace(text, '[\t\r\n]', ' ', 'g'), '^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$', '', 'g') AS value FROM documents")
def term_clean(spark, d):
    wire = T.wire_literal(F.col("text"), "@en")
    return table(spark, d, "documents").select("doc_id", T.clean_term(wire).alias("value"))


@query("SELECT o_orderkey, o_orderkey::VARCHAR AS value, 'literal' AS kind, 'http://www.w3.org/2001/XMLSchema#integer' AS datatype FROM orders")
def term_typed(spark, d):
    wire = T.wire_literal(F.col("o_orderkey").cast("string"), "^^<http://www.w3.org/2001/XMLSchema#integer>")
    t = T.term_struct(wire)
    return table(spark, d, "orders").select("o_orderkey", t["value"].alias("value"), t["kind"].alias("kind"), t["datatype"].alias("datatype"))


@query("SELECT page_id, regexp_extract(regexp_replace(url, '/+$', ''), '[^/#]*$') AS name FROM pages")
def iri_localname(spark, d):
    return table(spark, d, "pages").select("page_id", T.iri_localname(T.clean_term(F.concat(F.lit("<"), "url", F.lit(">")))).alias("name"))


def transformed(spark, d, name, key, column, spec):
    run, listed = T.compile_transform(spec)
    out = table(spark, d, name).select(key, run(F.col(column)).alias("value"))
    return out.withColumn("value", F.explode("value")) if listed else out


@query("SELECT c_custkey, CASE WHEN c_name = '' OR starts_with(c_name, 'cust:') THEN c_name ELSE 'cust:' || c_name END AS value FROM customer")
def tf_prefix(spark, d):
    return transformed(spark, d, "customer", "c_custkey", "c_name", "prefix:cust:")


@query("SELECT p_partkey, CASE WHEN starts_with(p_brand, 'Brand#') THEN substr(p_brand, 7) ELSE p_brand END AS value FROM part")
def tf_strip_prefix(spark, d):
    return transformed(spark, d, "part", "p_partkey", "p_brand", "strip_prefix:Brand#")


@query("SELECT o_orderkey, replace(o_orderpriority, '-', ':') AS value FROM orders")
def tf_replace(spark, d):
    return transformed(spark, d, "orders", "o_orderkey", "o_orderpriority", r"replace:-:\:")


@query("SELECT page_id, regexp_extract(url, 'https?://([^/]+)', 1) AS value FROM pages")
def tf_regex(spark, d):
    return transformed(spark, d, "pages", "page_id", "url", "regex:https?://([^/]+)")


@query("SELECT c_custkey, regexp_extract(c_name, '-?[0-9]+') AS value FROM customer")
def tf_int(spark, d):
    return transformed(spark, d, "customer", "c_custkey", "c_name", "int")


@query("SELECT p_partkey, lower(p_type) AS value FROM part UNION ALL SELECT p_partkey, upper(p_name) FROM part")
def tf_case(spark, d):
    return transformed(spark, d, "part", "p_partkey", "p_type", "lower").union(transformed(spark, d, "part", "p_partkey", "p_name", "upper"))


@query("SELECT p_partkey, w AS value FROM (SELECT p_partkey, trim(unnest(string_split(p_name, ' '))) AS w FROM part) WHERE w <> ''")
def tf_split_explode(spark, d):
    return transformed(spark, d, "part", "p_partkey", "p_name", "replace: :;,split:;")


@query("SELECT page_id, 'x:' || upper(replace(regexp_extract(regexp_replace(url, '/+$', ''), '[^/#]*$'), '?', ':')) AS value FROM pages WHERE regexp_extract(regexp_replace(url, '/+$', ''), '[^/#]*$') <> '' UNION ALL SELECT page_id, '' FROM pages WHERE regexp_extract(regexp_replace(url, '/+$', ''), '[^/#]*$') = ''")
def tf_chain(spark, d):
    return transformed(spark, d, "pages", "page_id", "url", r"iri_localname,replace:?:\:,upper,prefix:x:")


@query(None)  # DuckDB has no fold of ligatures, typographic punctuation or Greek letters
def ascii_fold(spark, d):
    return table(spark, d, "documents").select("doc_id", T.to_ascii(F.col("text")).alias("value"))


@query("SELECT c_custkey, 'http://ex.org/c#' || c_custkey AS iri, c_custkey::VARCHAR AS local, 'http://ex.org/c#' || c_custkey AS same FROM customer")
def curie_expand(spark, d):
    curie = F.concat(F.lit("ex:"), F.col("c_custkey").cast("string"))
    iri = T.expand_curie(curie, {"ex": "http://ex.org/c#"})
    return table(spark, d, "customer").select("c_custkey", iri.alias("iri"), T.local_name(iri).alias("local"), T.same_iri(F.replace(iri, F.lit("http:"), F.lit("https:"))).alias("same"))


@query("SELECT event_id, CASE WHEN regexp_matches(raw, '^\\s*[+-]?[0-9]+\\s*$') THEN raw END AS as_int, CASE WHEN regexp_matches(raw, '^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$') THEN raw END AS as_double, CASE WHEN regexp_matches(raw, '^-?[0-9]+$') THEN 'java.lang.Integer' ELSE 'java.lang.String' END AS guessed FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'NR' WHEN event_id % 3 = 1 THEN user_id::VARCHAR ELSE user_id || 'x' END AS raw FROM events)")
def type_guard(spark, d):
    user, n = F.col("user_id").cast("string"), F.col("event_id") % 3
    raw = table(spark, d, "events").select("event_id", F.when(n == 0, "NR").when(n == 1, user).otherwise(F.concat(user, F.lit("x"))).alias("raw"))
    return raw.select("event_id", F.when(T.fits_type(F.col("raw"), "int"), F.col("raw")).alias("as_int"), F.when(T.fits_type(F.col("raw"), "double"), F.col("raw")).alias("as_double"), T.guess_type(F.col("raw")).alias("guessed"))


@query("SELECT doc_id, '\"' || replace(replace(replace(replace(replace(replace(replace(source || '<&>' || text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(10), '&#10;'), chr(9), '&#9;'), chr(13), '&#13;') || '\"' AS quoted FROM documents")
def xml_quote(spark, d):
    return table(spark, d, "documents").select("doc_id", T.xml_quoted(F.concat("source", F.lit("<&>"), "text")).alias("quoted"))


@query("SELECT o_orderkey, 'Order.' || lower(o_orderstatus) AS path FROM orders")
def constraint_paths(spark, d):
    text = F.concat(F.lit("Order."), F.lower("o_orderstatus"), F.get(F.array(F.lit(" = x"), F.lit(" >= 0.5"), F.lit(" IS NOT NULL"), F.lit(" NOT IN (a, b)"), F.lit("!=y")), (F.col("o_orderkey") % 5).cast("int")))
    return table(spark, d, "orders").select("o_orderkey", T.constraint_path(text).alias("path"))


# --- cleaned tables ------------------------------------------------------------------------------


def raw_lines(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(*(T.wire_literal(F.col(c).cast("string")).alias(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")))


@query("SELECT l_orderkey::VARCHAR AS c_order, l_returnflag AS flag FROM lineitem WHERE l_returnflag = 'R'")
def filter_required(spark, d):
    return clean_table(raw_lines(spark, d), [ColumnSpec("c_order", "l_orderkey"), ColumnSpec("flag", "l_returnflag", filter="equals:R", required=True)], distinct=False)


@query("SELECT l_orderkey::VARCHAR AS c_order, CASE WHEN regexp_matches(l_returnflag, '^[AR]') THEN lower(l_returnflag) ELSE '' END AS flag FROM lineitem")
def filter_blank(spark, d):
    return clean_table(raw_lines(spark, d), [ColumnSpec("c_order", "l_orderkey"), ColumnSpec("flag", "l_returnflag", "lower", "regex:^[AR]")], distinct=False)


@query("SELECT l_returnflag AS flag, '9606' AS taxon FROM lineitem WHERE l_returnflag = 'A'")
def drop_empty(spark, d):
    return clean_table(raw_lines(spark, d), [ColumnSpec("flag", "l_returnflag", filter="equals:A"), ColumnSpec("taxon", value="9606")], distinct=False)


@query("SELECT o, f FROM (SELECT CASE WHEN l_orderkey % 2 = 0 THEN l_orderkey::VARCHAR ELSE '' END AS o, l_returnflag AS f FROM lineitem) WHERE o <> ''")
def drop_nokey(spark, d):
    raw = raw_lines(spark, d).withColumn("l_orderkey", F.when(F.regexp_extract("l_orderkey", "([0-9]+)", 1).cast("long") % 2 == 0, F.col("l_orderkey")).otherwise(""))
    return clean_table(raw, [ColumnSpec("o", "l_orderkey", required=True), ColumnSpec("f", "l_returnflag")], distinct=False)


@query("SELECT DISTINCT l_orderkey::VARCHAR AS o, l_linenumber::VARCHAR AS n, CASE WHEN l_returnflag IN ('A', 'R') THEN lower(l_returnflag) ELSE '' END AS flag, '9606' AS taxon, '' AS absent FROM lineitem WHERE l_linestatus = 'O'")
def clean_table_full(spark, d):
    specs = [ColumnSpec("o", "l_orderkey", required=True), ColumnSpec("n", "l_linenumber", "int"), ColumnSpec("flag", "l_returnflag", "lower", "regex:^[AR]$"), ColumnSpec("s", "l_linestatus", filter="equals:O", required=True), ColumnSpec("taxon", value="9606"), ColumnSpec("absent", "nowhere")]
    return clean_table(raw_lines(spark, d), specs, distinct=False).drop("s").distinct()


@query("SELECT DISTINCT p_partkey::VARCHAR AS part, w AS word, t AS kind FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, p_type FROM part), LATERAL (SELECT unnest(string_split(p_type, ' ')) AS t) WHERE w <> '' AND t <> ''")
def explode_cartesian(spark, d):
    return clean_table(table(spark, d, "part"), [ColumnSpec("part", "p_partkey", required=True), ColumnSpec("word", "p_name", "replace: :;,split:;"), ColumnSpec("kind", "p_type", "replace: :;,split:;")], decode=False)


@query("WITH r AS (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN '' ELSE l_orderkey::VARCHAR END AS o FROM lineitem), k AS (SELECT o, CASE WHEN l_returnflag = 'R' THEN 'r' ELSE '' END AS flag, l_linenumber % 2 AS half FROM r WHERE l_linestatus = 'O') SELECT 'rows_in' AS figure, count(*) AS n FROM r UNION ALL SELECT 'filtered', count(*) FROM r WHERE l_linestatus <> 'O' UNION ALL SELECT 'empty', 0 UNION ALL SELECT 'no_key', count(*) FROM k WHERE o = '' UNION ALL SELECT 'rows_out', count(*) FROM (SELECT DISTINCT o, flag FROM k WHERE o <> '') UNION ALL SELECT 'missing', 1")
def run_statistics(spark, d):
    """The figures of a cleaning run, of which one plan gathers all."""
    raw = raw_lines(spark, d).withColumn("l_orderkey", F.when(F.regexp_extract("l_orderkey", "([0-9]+)", 1).cast("long") % 3 == 0, F.lit('""')).otherwise(F.col("l_orderkey")))
    seen = RunStatistics()
    specs = [ColumnSpec("o", "l_orderkey", required=True), ColumnSpec("flag", "l_returnflag", "lower", "equals:R"), ColumnSpec("s", "l_linestatus", filter="equals:O", required=True), ColumnSpec("none", "nowhere")]
    clean_table(raw, specs, statistics=seen).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(sorted(seen.counts.items()), "figure string, n long")


# --- graph patterns ------------------------------------------------------------------------------


@query("SELECT 'customer:' || c_custkey AS c, c_name AS name, c_mktsegment AS segment FROM customer")
def bgp_star(spark, d):
    node = P.Node("c", (P.Leaf("name", "name"), P.Leaf("segment", "segment")), types=("Customer",))
    return P.Compiler(triples(spark, d, "customer"), {"name", "segment"}).run(P.Pattern(node, ["c", "name", "segment"]))


@query("SELECT DISTINCT 'order:' || o_orderkey AS o, c_name AS customer, n_name AS nation, r_name AS region FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def bgp_path(spark, d):
    region = P.Node("r", (P.Leaf("name", "region"),))
    nation = P.Node("n", (P.Leaf("name", "nation"),), (P.Branch("in_region", region),))
    customer = P.Node("c", (P.Leaf("name", "customer"),), (P.Branch("in_nation", nation),))
    order = P.Node("o", (), (P.Branch("of_customer", customer),), ("Order",))
    return P.Compiler(triples(spark, d, "orders", "customer", "nation", "region")).run(P.Pattern(order, ["o", "customer", "nation", "region"]))


@query("SELECT DISTINCT 'document:' || d.doc_id AS doc, lang, quality::VARCHAR AS quality, toxic::VARCHAR AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE lang IS NOT NULL")
def bgp_optional(spark, d):
    node = P.Node("doc", (P.Leaf("lang", "lang"), P.Leaf("quality", "quality", True), P.Leaf("toxic", "toxic", True)), types=("Document",))
    return P.Compiler(triples(spark, d, "documents", "labels")).run(P.Pattern(node, ["doc", "lang", "quality", "toxic"]))


@query("SELECT DISTINCT 'customer:' || c_custkey AS c, c_name AS name, 'order:' || o_orderkey AS o, o_orderstatus AS status FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority LIKE '%URGENT'")
def bgp_nested_optional(spark, d):
    order = P.Node("o", (P.Leaf("status", "status"), P.Leaf("priority", "priority", ends_with=("URGENT",))), types=("Order",))
    t = triples(spark, d, "customer", "orders").backward("of_customer", "orders")
    node = P.Node("c", (P.Leaf("name", "name"),), (P.Branch("orders", order, True),), ("Customer",))
    return P.Compiler(t, {"status", "priority"}).run(P.Pattern(node, ["c", "name", "o", "status"]))


@query("SELECT 'customer:' || c_custkey AS c, c_mktsegment AS segment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def bgp_values(spark, d):
    node = P.Node("c", (P.Leaf("segment", "segment", values=("BUILDING", "MACHINERY")),))
    return P.Compiler(triples(spark, d, "customer")).run(P.Pattern(node, ["c", "segment"]))


@query("SELECT 'part:' || p_partkey AS p, p_brand AS brand FROM part WHERE p_brand LIKE '%3' OR p_brand LIKE '%12'")
def bgp_strends(spark, d):
    node = P.Node("p", (P.Leaf("brand", "brand", ends_with=("3", "12")),))
    return P.Compiler(triples(spark, d, "part")).run(P.Pattern(node, ["p", "brand"]))


@query("SELECT n_name AS nation, c_name AS customer, NULL::VARCHAR AS supplier FROM nation JOIN customer ON c_nationkey = n_nationkey UNION SELECT n_name, NULL, s_name FROM nation JOIN supplier ON s_nationkey = n_nationkey")
def bgp_union_types(spark, d):
    t = triples(spark, d, "customer", "supplier", "nation")
    party = lambda var, kind: P.Compiler(t).run(P.Pattern(P.Node("x", (P.Leaf("name", var),), (P.Branch("in_nation", P.Node("n", (P.Leaf("name", "nation"),))),), (kind,)), ["nation", var]))
    return party("customer", "Customer").unionByName(party("supplier", "Supplier"), allowMissingColumns=True).select("nation", "customer", "supplier")


@query("SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)")
def distinct_count(spark, d):
    return P.count_distinct(table(spark, d, "lineitem").select("l_orderkey", "l_partkey"))


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def page_scan(spark, d):
    return P.page(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), [F.col("o_orderkey")], 50, 100)


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')")
def key_batch_scan(spark, d):
    keys = table(spark, d, "part").filter("p_type = 'PROMO'").select("p_partkey")
    return P.key_batches(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", keys)


@query("SELECT 'orders' AS branch, c_name AS customer, 'order:' || o_orderkey AS value FROM customer JOIN orders ON o_custkey = c_custkey UNION ALL SELECT 'nation', c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def satellite_tables(spark, d):
    t = triples(spark, d, "customer", "orders", "nation").backward("of_customer", "orders")
    root = P.Node("c", (P.Leaf("name", "customer"),), (P.Branch("orders", P.Node("o"), True), P.Branch("in_nation", P.Node("n", (P.Leaf("name", "nation"),)), True)), ("Customer",))
    parts = P.satellites(P.Pattern(root, ["c", "customer", "o", "nation"]))
    run = P.Compiler(t).run
    return run(parts["o"]).select(F.lit("orders").alias("branch"), "customer", F.col("o").alias("value")).union(run(parts["n"]).select(F.lit("nation"), "customer", "nation"))


# --- objects -------------------------------------------------------------------------------------

LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity")


def line_rows(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *LINE_ORDER, F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag")).alias("flag"), F.col("l_linestatus").alias("status"))


@query("SELECT l_orderkey, l_linenumber, arg_min(l_returnflag, row(l_shipdate, l_partkey, l_suppkey, l_quantity)) FILTER (l_returnflag <> 'N') AS flag, arg_min(l_linestatus, row(l_shipdate, l_partkey, l_suppkey, l_quantity)) AS status FROM lineitem GROUP BY 1, 2")
def item_merge_first(spark, d):
    return I.merge_first(line_rows(spark, d), ["l_orderkey", "l_linenumber"], ["flag", "status"], F.struct(*LINE_ORDER))


@query("SELECT l_orderkey, l_linenumber, greatest(count(DISTINCT l_returnflag) FILTER (l_returnflag <> 'N') - 1, 0) AS flag_conflicts FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_returnflag) FILTER (l_returnflag <> 'N') > 1")
def item_conflicts(spark, d):
    return I.merge_first(line_rows(spark, d), ["l_orderkey", "l_linenumber"], ["flag"], F.struct(*LINE_ORDER), conflicts=True).filter("flag_conflicts > 0").select("l_orderkey", "l_linenumber", "flag_conflicts")


@query("SELECT l_orderkey, l_linenumber, arg_max(l_suppkey, row(l_shipdate, l_partkey, l_suppkey, l_quantity)) AS l_suppkey FROM lineitem GROUP BY 1, 2")
def item_ref_last(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *LINE_ORDER)
    return I.merge_last(rows, ["l_orderkey", "l_linenumber"], ["l_suppkey"], F.struct(*LINE_ORDER))


@query("SELECT o_custkey, len(list(o_orderkey)) AS n, list_aggregate(list_sort(list(o_orderkey)), 'string_agg', ',') AS orders FROM orders GROUP BY 1")
def item_collection(spark, d):
    out = I.merge_collection(table(spark, d, "orders"), ["o_custkey"], "o_orderkey")
    return out.select("o_custkey", F.size("o_orderkey").cast("long").alias("n"), F.array_join(F.transform("o_orderkey", lambda x: x.cast("string")), ",").alias("orders"))


@query("SELECT l_suppkey, string_agg(l_returnflag, ',' ORDER BY first) AS flags FROM (SELECT l_suppkey, l_returnflag, min(row(l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity)) AS first FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def item_collection_ordered(spark, d):
    out = I.merge_collection(table(spark, d, "lineitem"), ["l_suppkey"], "l_returnflag", F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"))
    return out.select("l_suppkey", F.array_join("l_returnflag", ",").alias("flags"))


@query("SELECT DISTINCT o_orderkey::VARCHAR AS src, 'customer' AS field, 'c' || o_custkey AS dst FROM orders UNION SELECT DISTINCT 'c' || o_custkey, 'orders', o_orderkey::VARCHAR FROM orders")
def reverse_links(spark, d):
    edges = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("o_custkey"))
    return I.both_ways(edges, "o_orderkey", "o_custkey", "customer", "orders")


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'primaryIdentifier' WHEN p_partkey % 3 = 1 THEN 'secondaryIdentifier' ELSE '*' END AS key_field, CASE WHEN p_partkey % 3 = 0 THEN p_partkey::VARCHAR WHEN p_partkey % 3 = 1 THEN p_name ELSE 'brand=' || p_brand || '|type=' || p_type END AS key_value FROM part")
def key_fallback(spark, d):
    n = F.col("p_partkey") % 3
    values = {"primaryIdentifier": F.when(n == 0, F.col("p_partkey").cast("string")), "secondaryIdentifier": F.when(n == 1, F.col("p_name")), "type": F.when(n == 2, F.col("p_type")), "brand": F.when(n == 2, F.col("p_brand"))}
    item = I.identity("Part", ["primaryIdentifier", "secondaryIdentifier"], values)
    return table(spark, d, "part").select("p_partkey", item["key_field"].alias("key_field"), item["key_value"].alias("key_value"))


@query("SELECT p_partkey, CASE WHEN n = 1 OR (promo = 1 AND p_type = 'PROMO') THEN p_name ELSE '' END AS p_name FROM (SELECT *, count(*) OVER w AS n, count(*) FILTER (p_type = 'PROMO') OVER w AS promo FROM part WINDOW w AS (PARTITION BY p_name, p_brand))")
def key_ambiguity(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return I.resolve_ambiguity(parts, "p_name", ["p_brand"], F.col("p_type") == "PROMO").select("p_partkey", "p_name")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS item_no FROM orders")
def item_ids(spark, d):
    return I.numbered(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_orderkey", "item_no")


@query("SELECT 'Part' AS cls, p_partkey AS id, 'TPC data' AS data_set, 'TPC' AS data_source FROM part UNION ALL SELECT 'DataSet', 0, NULL, NULL")
def provenance(spark, d):
    items = table(spark, d, "part").select(F.lit("Part").alias("cls"), F.col("p_partkey").alias("id")).union(spark.createDataFrame([("DataSet", 0)], "cls string, id long"))
    return I.with_provenance(items, "TPC data", "TPC")


@query("SELECT n, '<item id=\"0_' || n || '\" class=\"Nation\"><attribute name=\"name\" value=\"' || n_name || '\"/><reference name=\"region\" ref_id=\"0_' || (100 + n_regionkey) || '\"/></item>' AS line FROM (SELECT *, n_nationkey + 1 AS n FROM nation) UNION ALL SELECT 100 + r_regionkey, '<item id=\"0_' || (100 + r_regionkey) || '\" class=\"Region\"><attribute name=\"name\" value=\"' || r_name || '\"/>' || coalesce((SELECT '<collection name=\"nations\">' || string_agg('<reference ref_id=\"0_' || (n_nationkey + 1) || '\"/>', '' ORDER BY n_nationkey) || '</collection>' FROM nation WHERE n_regionkey = r_regionkey), '') || '</item>' FROM region")
def items_document(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    no, rno = (F.col("n_nationkey") + 1).cast("long"), (F.col("r_regionkey") + 100).cast("long")
    items = n.select(no.alias("no"), F.lit("Nation").alias("cls"), F.create_map(F.lit("name"), "n_name").alias("attrs")).union(r.select(rno, F.lit("Region"), F.create_map(F.lit("name"), "r_name")))
    up = (F.col("n_regionkey") + 100).cast("long")
    links = n.select(no.alias("src_no"), F.lit("region").alias("field"), up.alias("dst_no"), F.lit(False).alias("many")).union(n.select(up, F.lit("nations"), no, F.lit(True))).union(n.select(no, F.lit("ghost"), F.lit(999999).cast("long"), F.lit(False)))
    return I.items_xml(items, links).select(F.col("no").alias("n"), "line")


# --- integration ---------------------------------------------------------------------------------


@query("SELECT c_custkey AS k, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_name END, stub) AS name, CASE WHEN c_custkey % 2 = 0 THEN 'crm' WHEN stub IS NOT NULL THEN 'orders' END AS name_source FROM customer LEFT JOIN (SELECT o_custkey, 'stub ' || o_custkey AS stub FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def multi_source_priority(spark, d):
    crm = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("name"), F.lit("crm").alias("src"))
    stub = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.concat(F.lit("stub "), F.col("o_custkey").cast("string")).alias("name"), F.lit("orders").alias("src")).distinct()
    return G.by_priority(crm.union(stub), ["k"], ["name"], "src", {"crm": 0, "orders": 1}, F.col("name")).select("k", "name", "name_source")


@query("SELECT o_custkey AS k, count(DISTINCT o_orderstatus) > 1 AS status_conflict, min(o_orderstatus) AS status FROM orders GROUP BY 1")
def source_conflicts(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("status"), F.lit("*").alias("src"))
    return G.by_priority(rows, ["k"], ["status"], "src", {"other": 0}, F.col("status")).select("k", "status_conflict", "status")


@query("SELECT DISTINCT o_custkey AS src, l_partkey AS dst FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def derived_links(spark, d):
    first = table(spark, d, "orders").select(F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst"))
    second = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"))
    return G.derived_links(first, second)


@query("WITH RECURSIVE e AS (SELECT 'n' || n_nationkey AS c, 'r' || n_regionkey AS p FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier UNION ALL SELECT 'r' || r_regionkey, 'world' FROM region), w AS (SELECT c, c AS a, 0 AS depth FROM (SELECT c FROM e UNION SELECT p FROM e) UNION ALL SELECT w.c, e.p, depth + 1 FROM w JOIN e ON w.a = e.c) SELECT c AS child, a AS ancestor, min(depth)::BIGINT AS depth FROM w GROUP BY 1, 2")
def hierarchy_closure(spark, d):
    e = lambda df, p, c, q, u: df.select(F.concat(F.lit(p), F.col(c).cast("string")).alias("c"), F.concat(F.lit(q), F.col(u).cast("string")).alias("p"))
    edges = e(table(spark, d, "nation"), "n", "n_nationkey", "r", "n_regionkey").union(e(table(spark, d, "supplier"), "s", "s_suppkey", "n", "s_nationkey")).union(table(spark, d, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")), F.lit("world")))
    return closure(edges, "c", "p")


@query("SELECT * FROM (VALUES ('Customer', 'id', 'Party'), ('Customer', 'name', 'Party'), ('Customer', 'balance', 'Party'), ('Customer', 'nation', 'Party'), ('Customer', 'segment', 'Customer'), ('Customer', 'orders', 'Customer'), ('Customer', 'parts', 'Customer'), ('Supplier', 'id', 'Party'), ('Supplier', 'name', 'Party'), ('Supplier', 'balance', 'Party'), ('Supplier', 'nation', 'Party'), ('Supplier', 'lines', 'Supplier')) t(cls, field, declared_in)")
def fields_inherited(spark, d):
    return inherited_fields(catalog().tables(spark)).filter(F.col("cls").isin("Customer", "Supplier")).select("cls", "field", "declared_in")


def merge_inputs(spark, d):
    part, key = table(spark, d, "part"), F.col("p_partkey")
    row = lambda df, field: df.select(key.alias("k"), field.alias("im_field"), F.lit("sure").alias("status"))
    base = row(part.filter(key % 5 != 4), F.col("p_brand"))
    fresh = row(part.filter(key % 5 != 3), F.when(key % 5 == 2, F.lower("p_brand")).otherwise(F.col("p_brand")))
    disk = row(part.filter(key % 5 != 4), F.when(key % 7 == 0, F.concat("p_brand", F.lit("!"))).otherwise(F.col("p_brand")))
    return fresh, disk, base


@query("SELECT k, CASE WHEN m = 3 THEN b || '!' WHEN m <> 4 AND e THEN b || '!' WHEN m = 2 THEN lower(b) ELSE b END AS im_field, CASE WHEN m = 3 THEN 'drop' WHEN m <> 4 AND e THEN 'human' ELSE 'sure' END AS status, CASE WHEN m = 3 THEN 'stale' WHEN m <> 4 AND e THEN 'edited' ELSE 'fresh' END AS origin FROM (SELECT p_partkey AS k, p_brand AS b, p_partkey % 5 AS m, p_partkey % 7 = 0 AS e FROM part) WHERE m <> 3 OR e")
def three_way_merge(spark, d):
    return G.three_way_merge(*merge_inputs(spark, d), ["k"], ["im_field", "status"])


@query("SELECT p_partkey AS k, 'drop' AS status FROM part WHERE p_partkey % 5 = 3 AND p_partkey % 7 = 0")
def stale_rows(spark, d):
    return G.three_way_merge(*merge_inputs(spark, d), ["k"], ["im_field", "status"]).filter("origin = 'stale'").select("k", "status")


@query("SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'Promo' WHEN p_size > 25 THEN 'Big' WHEN p_brand LIKE '%3' THEN 'Three' END AS target, CASE WHEN p_type = 'PROMO' THEN 'source rule' WHEN p_size > 25 THEN 'term' WHEN p_brand LIKE '%3' THEN 'generic' ELSE 'todo' END AS tier FROM part")
def rule_cascade(spark, d):
    part = table(spark, d, "part")
    tier = lambda cond, target: part.filter(cond).select("p_partkey", F.lit(target).alias("target"))
    return G.cascade(part, ["p_partkey"], [("source rule", tier("p_type = 'PROMO'", "Promo")), ("term", tier("p_size > 25", "Big")), ("generic", tier("p_brand LIKE '%3'", "Three"))], "target")


@query("SELECT 'l' || l_orderkey AS src, l_partkey AS dst FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 10 <> 0)")
def check_dangling(spark, d):
    links = table(spark, d, "lineitem").select(F.concat(F.lit("l"), F.col("l_orderkey").cast("string")).alias("src"), F.col("l_partkey").alias("dst"))
    return G.dangling(links, table(spark, d, "part").filter("p_partkey % 10 <> 0").select(F.col("p_partkey").alias("id"))).select("src", "dst")


def column_rows(spark, d):
    p = table(spark, d, "part")
    return p.select(F.col("p_brand").alias("table"), F.col("p_type").alias("im_class"), F.lit("").alias("via"), F.col("p_name").alias("im_field"), F.col("p_partkey").cast("string").alias("column"), F.col("p_name").alias("predicate"), F.col("p_type").alias("subject"))


@query("SELECT p_brand AS \"table\", p_type AS im_class, p_name AS im_field, count(*) AS n, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey::VARCHAR) AS columns FROM part GROUP BY 1, 2, 3 HAVING count(*) > 1")
def check_collision(spark, d):
    return G.collisions(column_rows(spark, d)).select("table", "im_class", "im_field", "n", "columns")


@query("SELECT p_brand AS \"table\", p_type AS subject, p_name AS predicate, count(*) AS n FROM part GROUP BY 1, 2, 3 HAVING count(*) > 1")
def check_crossproduct(spark, d):
    return G.cross_products(column_rows(spark, d))


@query("SELECT DISTINCT p_type AS cls, p_brand AS field FROM part WHERE (p_type, p_brand) NOT IN (SELECT p_type, p_brand FROM part WHERE p_size > 40) AND p_brand <> 'Brand#1'")
def check_coverage(spark, d):
    p = table(spark, d, "part").select(F.col("p_type").alias("cls"), F.col("p_brand").alias("field"), "p_size")
    return G.coverage_gaps(p, p.filter("p_size > 40").select("cls", "field").distinct(), p.filter("field = 'Brand#1'").select("cls", "field").distinct())


@query("SELECT 'dangling' AS rule, 'hard' AS severity, n_nationkey || '.' || n_regionkey AS subject FROM nation WHERE n_regionkey > 2 UNION ALL SELECT 'empty', 'soft', r_regionkey::VARCHAR FROM region WHERE r_regionkey NOT IN (SELECT n_regionkey FROM nation WHERE n_regionkey > 0)")
def check_all(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    bad = G.dangling(n.select(F.col("n_nationkey").alias("src"), F.col("n_regionkey").alias("dst")), r.filter("r_regionkey <= 2").select(F.col("r_regionkey").alias("id"))).select("src", "dst")
    empty = r.select("r_regionkey").join(n.filter("n_regionkey > 0").select(F.col("n_regionkey").alias("r_regionkey")), "r_regionkey", "left_anti")
    return G.violations(dangling=("hard", bad), empty=("soft", empty))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)")
def scope_taxon(spark, d):
    keys = table(spark, d, "customer").filter("c_nationkey = 3").select("c_custkey")
    return G.in_scope(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", keys).select("o_orderkey", "o_custkey")


@query("SELECT l_orderkey, l_partkey FROM lineitem WHERE l_partkey IN (1, 5, 7, 11, 13)")
def scope_list(spark, d):
    keys = spark.createDataFrame([(x,) for x in (1, 5, 7, 11, 13)], "k long")
    return G.in_scope(table(spark, d, "lineitem").select("l_orderkey", "l_partkey"), "l_partkey", keys).select("l_orderkey", "l_partkey")


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)")
def scope_cited(spark, d):
    cited = table(spark, d, "labels").filter("quality = 0").select("doc_id")
    return G.in_scope(table(spark, d, "documents").select("doc_id", "source"), "doc_id", cited).select("doc_id", "source")


@query("SELECT p_name, min(p_partkey) AS p_partkey FROM part GROUP BY 1")
def first_per_label(spark, d):
    return I.first_per(table(spark, d, "part").select("p_name", "p_partkey"), ["p_name"], [F.col("p_partkey")])


@query("SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS position FROM part")
def column_positions(spark, d):
    return I.rank_in(table(spark, d, "part").select("p_brand", "p_partkey"), ["p_brand"], [F.col("p_partkey")], "r").select("p_brand", "p_partkey", (F.col("r") - 1).alias("position"))


@query("SELECT o_orderpriority AS priority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1")
def status_counts(spark, d):
    return G.status_counts(table(spark, d, "orders").withColumnRenamed("o_orderpriority", "priority"), "priority", "o_orderstatus", ["F", "O", "P"])


@query("SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey <> b.s_suppkey")
def cluster_pairs(spark, d):
    s = table(spark, d, "supplier")
    return s.select("s_nationkey", F.col("s_suppkey").alias("a")).join(s.select("s_nationkey", F.col("s_suppkey").alias("b")), "s_nationkey").filter("a <> b").select("a", "b")


@query("SELECT p_brand AS field, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS writers FROM part GROUP BY 1")
def writers_per_field(spark, d):
    return I.merge_collection(table(spark, d, "part"), ["p_brand"], "p_type").select(F.col("p_brand").alias("field"), F.array_join("p_type", ",").alias("writers"))


# --- path queries ---------------------------------------------------------------------------------


@query("SELECT DISTINCT p_name AS name, p_brand AS brand FROM part WHERE p_brand = 'Brand#2' ORDER BY 1")
def pathq_attr(spark, d):
    return mine(spark, d).run(PathQuery(["Part.name", "Part.brand"], [Constraint("Part.brand", "=", "Brand#2")], [("Part.name", "asc")]), ["name", "brand"])


@query("SELECT DISTINCT c_name AS name, n_name AS nation, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'")
def pathq_ref(spark, d):
    return mine(spark, d).run(PathQuery(["Customer.name", "Customer.nation.name", "Customer.nation.region.name"], [Constraint("Customer.nation.region.name", "=", "ASIA")]), ["name", "nation", "region"])


@query("SELECT DISTINCT c_name AS name, o_orderkey AS o, l_quantity AS quantity FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE c_mktsegment = 'BUILDING'")
def pathq_coll(spark, d):
    return mine(spark, d).run(PathQuery(["Customer.name", "Customer.orders.id", "Customer.orders.lines.quantity"], [Constraint("Customer.segment", "=", "BUILDING")]), ["name", "o", "quantity"])


@query("SELECT DISTINCT o_orderkey AS o, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'F'")
def pathq_neq(spark, d):
    return mine(spark, d).run(PathQuery(["Order.id", "Order.status"], [Constraint("Order.status", "!=", "F")]), ["o", "status"])


@query("SELECT DISTINCT p_partkey AS p, p_size AS size FROM part WHERE p_brand IN ('Brand#1', 'Brand#3') AND p_name LIKE '%a%' AND p_name NOT LIKE 'z%' AND p_size >= 10 AND p_size < 40 AND p_type NOT IN ('PROMO') AND p_retailprice IS NOT NULL")
def pathq_in_like_cmp(spark, d):
    c = [Constraint("Part.brand", "IN", ["Brand#1", "Brand#3"]), Constraint("Part.name", "LIKE", "*a*"), Constraint("Part.name", "NOT LIKE", "z*"), Constraint("Part.size", ">=", 10), Constraint("Part.size", "<", 40), Constraint("Part.type", "NOT IN", ["PROMO"]), Constraint("Part.price", "IS NOT NULL")]
    return mine(spark, d).run(PathQuery(["Part.id", "Part.size"], c), ["p", "size"])


TEMPLATES = {
    "template_hierarchy": Template("Nation to its region", PathQuery(["Nation.name", "Nation.region.name"], [Constraint("Nation.region.name", "=", "EUROPE")], [("Nation.name", "asc")])),
    "template_identifiers": Template("Identifiers of a customer", PathQuery(["Customer.id", "Customer.name", "Customer.nation.name"], [Constraint("Customer.segment", "=", "BUILDING")], [("Customer.id", "asc")])),
    "template_suppliers": Template("Suppliers of a brand", PathQuery(["Part.brand", "Part.lines.supplier.name"], [Constraint("Part.brand", "=", "Brand#1")])),
    "template_order_parts": Template("Parts of urgent orders", PathQuery(["Order.priority", "Order.lines.part.name"], [Constraint("Order.priority", "=", "1-URGENT")])),
    "template_part_customers": Template("Customers that ordered a part", PathQuery(["LineItem.part.name", "LineItem.order.customer.name", "LineItem.flag"], [Constraint("LineItem.part.type", "=", "PROMO")])),
    "template_documents": Template("Documents and their labels", PathQuery(["Document.id", "Document.lang", "Document.labels.quality"], [Constraint("Document.lang", "=", "en")], [("Document.id", "asc")])),
}
TEMPLATE_SQL = {
    "template_hierarchy": ("ASIA", "SELECT DISTINCT n_name AS a, r_name AS b FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'"),
    "template_identifiers": ("MACHINERY", "SELECT DISTINCT c_custkey AS a, c_name AS b, n_name AS c FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment = 'MACHINERY'"),
    "template_suppliers": ("Brand#3", "SELECT DISTINCT p_brand AS a, s_name AS b FROM part JOIN lineitem ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey WHERE p_brand = 'Brand#3'"),
    "template_order_parts": ("5-LOW", "SELECT DISTINCT o_orderpriority AS a, p_name AS b FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE o_orderpriority = '5-LOW'"),
    "template_part_customers": ("PROMO", "SELECT DISTINCT p_name AS a, c_name AS b, l_returnflag AS c FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE p_type = 'PROMO'"),
    "template_documents": ("de", "SELECT DISTINCT d.doc_id AS a, lang AS b, quality AS c FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE lang = 'de'"),
}


def _template(name: str) -> None:
    value, sql = TEMPLATE_SQL[name]

    def run(spark, d):
        q = TEMPLATES[name].with_values(value)
        return mine(spark, d).run(q, list("abc")[: len(q.view)])

    QUERIES[name], SQL[name] = run, sql


for _name in TEMPLATES:
    _template(_name)


# --- search ---------------------------------------------------------------------------------------


def corpus(spark, d):
    return S.search_docs(table(spark, d, "part"), "Part", "p_partkey", ["p_name", "p_brand"]).union(S.search_docs(table(spark, d, "customer"), "Customer", "c_custkey", ["c_name", "c_mktsegment"]))


CORPUS_SQL = "WITH c AS (SELECT 'Part' AS kind, p_partkey::VARCHAR AS id, p_name || ' ' || p_brand AS text FROM part UNION ALL SELECT 'Customer', c_custkey::VARCHAR, c_name || ' ' || c_mktsegment FROM customer), t AS (SELECT DISTINCT kind, id, unnest(string_split_regex(lower(text), '[ \\t\\n\\r]+')) AS t FROM c)"


@query(CORPUS_SQL + " SELECT kind, id, count(DISTINCT q)::BIGINT AS score FROM t JOIN (VALUES ('sma'), ('brand#1')) x(q) ON starts_with(t, q) AND length(t) >= 3 AND length(q) BETWEEN 3 AND 10 GROUP BY 1, 2 HAVING count(DISTINCT q) = 2")
def search_prefix(spark, d):
    return S.search(S.edge_index(corpus(spark, d)), "SMA Brand#1")


@query(CORPUS_SQL + " SELECT DISTINCT substr(t, 1, n::INT) AS gram, kind, id FROM t, range(3, 11) r(n) WHERE length(t) >= 3 AND n <= length(t)")
def search_index(spark, d):
    return S.edge_index(corpus(spark, d))


@query("SELECT DISTINCT 'Part' AS kind, 'p_name' AS field, p_name AS value FROM part WHERE lower(p_name) LIKE 's%' UNION SELECT 'Supplier', 's_name', s_name FROM supplier WHERE lower(s_name) LIKE 's%'")
def autocomplete(spark, d):
    docs = S.autocomplete_docs({"Part": (table(spark, d, "part"), ["p_name", "p_brand"]), "Supplier": (table(spark, d, "supplier"), ["s_name"])})
    return S.autocomplete(docs, "S")


@query("SELECT 'Part' AS kind, count(*) AS n FROM part UNION ALL SELECT 'Customer', count(*) FROM customer")
def facets(spark, d):
    return S.facets(corpus(spark, d))


@query("SELECT 'Part' AS kind, 'p_name' AS field, p_name AS value, count(*) AS n FROM part GROUP BY p_name ORDER BY n DESC, value LIMIT 10")
def summary_topk(spark, d):
    return S.summary(table(spark, d, "part"), "Part", "p_name", 10)


def stored_index(spark, d):
    """Parts and customers as stored, then every seventh customer's text changed and every eleventh deleted."""
    index = S.StoredIndex(spark, new_folder(spark), buckets=32)
    index.change(corpus(spark, d))
    c = table(spark, d, "customer")
    changed, gone = c.filter("c_custkey % 7 = 0 AND c_custkey % 11 <> 0"), c.filter("c_custkey % 7 = 0 OR c_custkey % 11 = 0")
    again = S.search_docs(changed.withColumn("vip", F.concat(F.lit("vip"), F.col("c_nationkey").cast("string"))), "Customer", "c_custkey", ["c_name", "vip"])
    index.change(again, gone.select(F.lit("Customer").alias("kind"), F.col("c_custkey").cast("string").alias("id")))
    return index


STORED_SQL = "WITH c AS (SELECT 'Part' AS kind, p_partkey::VARCHAR AS id, p_name || ' ' || p_brand AS text FROM part UNION ALL SELECT 'Customer', c_custkey::VARCHAR, c_name || ' ' || CASE WHEN c_custkey % 7 = 0 THEN 'vip' || c_nationkey ELSE c_mktsegment END FROM customer WHERE c_custkey % 11 <> 0), t AS (SELECT DISTINCT kind, id, unnest(string_split_regex(lower(text), '[ \\t\\n\\r]+')) AS t FROM c), h AS (SELECT query, kind, id, q, max(length(q) / length(t)) AS share FROM t JOIN (VALUES ('SMA Brand#1', 'sma', 2), ('SMA Brand#1', 'brand#1', 2), ('Customer#0000000 VIP', 'customer#0000000', 2), ('Customer#0000000 VIP', 'vip', 2)) x(query, q, words) ON starts_with(t, q) GROUP BY ALL), s AS (SELECT query, kind, id, round(sum(share), 6) AS score FROM h GROUP BY ALL HAVING count(*) = 2)"


@query(STORED_SQL + " SELECT * FROM s")
def search_stored(spark, d):
    index = stored_index(spark, d)
    found = [index.hits(q).select(F.lit(q).alias("query"), "kind", "id", "score") for q in ("SMA Brand#1", "Customer#0000000 VIP")]
    return found[0].union(found[1])


@query(STORED_SQL + " SELECT kind, id, score FROM s WHERE query = 'Customer#0000000 VIP' ORDER BY score DESC, kind, id LIMIT 25")
def search_top(spark, d):
    return stored_index(spark, d).search("Customer#0000000 VIP", 25)


@query("SELECT 'Customer' AS kind, c_custkey::VARCHAR AS id FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') UNION ALL SELECT 'Part', p_partkey::VARCHAR FROM part WHERE p_partkey % 3 = 0")
def index_sync(spark, d):
    live = table(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.lit("Customer").alias("kind"), F.col("o_custkey").cast("string").alias("id"))
    parts = table(spark, d, "part").filter("p_partkey % 3 <> 0").select(F.lit("Part").alias("kind"), F.col("p_partkey").cast("string").alias("id"))
    return S.out_of_sync(stored_index(spark, d).documents(), live.union(parts).distinct())


# --- the whole way --------------------------------------------------------------------------------


@query("SELECT DISTINCT p_name AS name, p_brand AS brand FROM part WHERE p_brand = 'Brand#2'")
def part_to_pathquery(spark, d):
    """Flagship: parts as wire terms, cleaned, merged into objects, linked to their brands, asked by path."""
    wire = table(spark, d, "part").select(*(T.wire_literal(F.col(c).cast("string")).alias(c) for c in ("p_partkey", "p_name", "p_brand")))
    clean = written(clean_table(wire, [ColumnSpec("id", "p_partkey", required=True), ColumnSpec("name", "p_name"), ColumnSpec("brand", "p_brand")]))
    items = I.split_objects(clean, {"Part": {"id": "id", "name": "name"}, "Brand": {"name": "brand"}}, {"Part": ["id"], "Brand": ["name"]}, F.col("id"))
    objects = items.groupBy("item", "field").agg(F.min_by("value", "ord").alias("value"))
    parts = objects.filter("item.cls = 'Part' AND field = 'name'").select(F.col("item.key_value").alias("id"), F.col("value").alias("name"))
    brands = objects.filter("item.cls = 'Brand' AND field = 'name' AND value = 'Brand#2'").select(F.col("item.key_value").alias("brand"))
    return clean.select("id", "brand").join(brands, "brand").join(parts, "id").select("name", "brand").distinct()


from . import queries_lists, queries_project  # noqa: E402, F401  they register themselves
