"""The object model over the star schema, its tables, and triples made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans.catalog import ATTRIBUTE, COLLECTION, REFERENCE, Catalog, ClassDef, Field
from .plans.pathquery import Link, Mine
from .plans.patterns import Triples, TripleTable


def _cls(name: str, attributes: str, references: dict[str, str] | None = None, collections: dict[str, str] | None = None, extends: list[str] | None = None, keys: list[list[str]] | None = None, types: dict[str, str] | None = None) -> ClassDef:
    fields = {a: Field(a, ATTRIBUTE, (types or {}).get(a, "java.lang.String")) for a in attributes.split()}
    for kind, links in ((REFERENCE, references or {}), (COLLECTION, collections or {})):
        for f, target in links.items():
            of, _, reverse = target.partition("/")
            fields[f] = Field(f, kind, of, reverse)
    return ClassDef(name, extends or [], fields, keys or [])


def catalog() -> Catalog:
    return Catalog(
        [
            _cls("Region", "id name", {}, {"nations": "Nation/region"}, keys=[["id"]]),
            _cls("Nation", "id name", {"region": "Region/nations"}, {"parties": "Party/nation"}, keys=[["id"]]),
            _cls("Party", "id name balance", {"nation": "Nation/parties"}, keys=[["id"]], types={"balance": "java.lang.Double"}),
            _cls("Customer", "segment", {}, {"orders": "Order/customer", "parts": "Part"}, ["Party"]),
            _cls("Supplier", "", {}, {"lines": "LineItem/supplier"}, ["Party"]),
            _cls("Part", "id name brand type size price", {}, {"lines": "LineItem/part"}, keys=[["id"]], types={"size": "java.lang.Integer", "price": "java.lang.Double"}),
            _cls("Order", "id status total priority", {"customer": "Customer/orders"}, {"lines": "LineItem/order"}, keys=[["id"]], types={"total": "java.lang.Double"}),
            _cls("LineItem", "number quantity flag", {"order": "Order/lines", "part": "Part/lines", "supplier": "Supplier/lines"}, types={"quantity": "java.lang.Double"}),
            _cls("Document", "id lang source chars", {}, {"labels": "Label/document"}, keys=[["id"]], types={"chars": "java.lang.Integer"}),
            _cls("Label", "quality toxic", {"document": "Document/labels"}, types={"quality": "java.lang.Integer", "toxic": "java.lang.Integer"}),
        ]
    )


COLUMNS = {
    ("Region", "id"): "r_regionkey", ("Region", "name"): "r_name", ("Nation", "id"): "n_nationkey", ("Nation", "name"): "n_name",
    ("Customer", "id"): "c_custkey", ("Customer", "name"): "c_name", ("Customer", "balance"): "c_acctbal", ("Customer", "segment"): "c_mktsegment",
    ("Supplier", "id"): "s_suppkey", ("Supplier", "name"): "s_name", ("Supplier", "balance"): "s_acctbal",
    ("Part", "id"): "p_partkey", ("Part", "name"): "p_name", ("Part", "brand"): "p_brand", ("Part", "type"): "p_type", ("Part", "size"): "p_size", ("Part", "price"): "p_retailprice",
    ("Order", "id"): "o_orderkey", ("Order", "status"): "o_orderstatus", ("Order", "total"): "o_totalprice", ("Order", "priority"): "o_orderpriority",
    ("LineItem", "number"): "l_linenumber", ("LineItem", "quantity"): "l_quantity", ("LineItem", "flag"): "l_returnflag",
    ("Document", "id"): "doc_id", ("Document", "lang"): "lang", ("Document", "source"): "source", ("Document", "chars"): "n_chars", ("Label", "quality"): "quality", ("Label", "toxic"): "toxic",
}
LINKS = {
    ("Nation", "region"): Link((("n_regionkey", "r_regionkey"),)),
    ("Region", "nations"): Link((("r_regionkey", "n_regionkey"),)),
    ("Customer", "nation"): Link((("c_nationkey", "n_nationkey"),)),
    ("Supplier", "nation"): Link((("s_nationkey", "n_nationkey"),)),
    ("Customer", "orders"): Link((("c_custkey", "o_custkey"),)),
    ("Order", "customer"): Link((("o_custkey", "c_custkey"),)),
    ("Order", "lines"): Link((("o_orderkey", "l_orderkey"),)),
    ("LineItem", "order"): Link((("l_orderkey", "o_orderkey"),)),
    ("LineItem", "part"): Link((("l_partkey", "p_partkey"),)),
    ("LineItem", "supplier"): Link((("l_suppkey", "s_suppkey"),)),
    ("Part", "lines"): Link((("p_partkey", "l_partkey"),)),
    ("Supplier", "lines"): Link((("s_suppkey", "l_suppkey"),)),
    ("Document", "labels"): Link((("doc_id", "doc_id"),)),
    ("Label", "document"): Link((("doc_id", "doc_id"),)),
}
TABLES = {"Region": "region", "Nation": "nation", "Customer": "customer", "Supplier": "supplier", "Part": "part", "Order": "orders", "LineItem": "lineitem", "Document": "documents", "Label": "labels"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mine(spark: SparkSession, sf_dir: str) -> Mine:
    return Mine(catalog(), {c: table(spark, sf_dir, t) for c, t in TABLES.items()}, COLUMNS, LINKS)


def triples(spark: SparkSession, sf_dir: str, *names: str) -> Triples:
    """Triples of some of customer, supplier, nation, region, orders, documents, labels, part."""
    t = lambda n: table(spark, sf_dir, n)
    link = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    made = {
        "customer": lambda: TripleTable(t("customer").withColumn("nation", link("nation:", "c_nationkey")), "c_custkey", "customer:", {"c_name": "name", "c_mktsegment": "segment", "c_acctbal": "balance", "nation": "in_nation"}, ("Customer",)),
        "supplier": lambda: TripleTable(t("supplier").withColumn("nation", link("nation:", "s_nationkey")), "s_suppkey", "supplier:", {"s_name": "name", "s_acctbal": "balance", "nation": "in_nation"}, ("Supplier",)),
        "nation": lambda: TripleTable(t("nation").withColumn("region", link("region:", "n_regionkey")), "n_nationkey", "nation:", {"n_name": "name", "region": "in_region"}, ("Nation",)),
        "region": lambda: TripleTable(t("region"), "r_regionkey", "region:", {"r_name": "name"}, ("Region",)),
        "orders": lambda: TripleTable(t("orders").withColumn("customer", link("customer:", "o_custkey")), "o_orderkey", "order:", {"o_orderstatus": "status", "o_orderpriority": "priority", "customer": "of_customer"}, ("Order",)),
        "part": lambda: TripleTable(t("part"), "p_partkey", "part:", {"p_name": "name", "p_brand": "brand", "p_type": "ptype", "p_size": "size"}, ("Part",)),
        "documents": lambda: TripleTable(t("documents"), "doc_id", "document:", {"lang": "lang", "source": "source", "n_chars": "chars"}, ("Document",)),
        "labels": lambda: TripleTable(t("labels"), "doc_id", "document:", {"quality": "quality", "toxic": "toxic"}),
    }
    return Triples(tuple(made[n]() for n in names))
