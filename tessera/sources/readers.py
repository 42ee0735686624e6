"""Readers: wire TSV, query results in JSON and CSV, exchange tables with a metadata block, XML items, id lists."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.terms import clean_term


def header_name(cell: str) -> str:
    """A variable's name without ?, quotes or both, whichever comes first."""
    name = cell.strip().lstrip("?").strip()
    if len(name) > 1 and name[0] == name[-1] and name[0] in "'\"":
        name = name[1:-1].strip()
    return name.lstrip("?")


def _below_header(spark: SparkSession, path: str, columns: int) -> DataFrame:
    """Cells c0, c1, ... of a tab-separated file: its first line is left out by place, quotes are data, missing cells are empty."""
    schema = ", ".join(f"c{i} string" for i in range(columns))
    cells = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").option("mode", "PERMISSIVE").csv(path)
    return cells.na.fill("")


def read_wire_tsv(spark: SparkSession, path: str, clean: bool = True) -> DataFrame:
    """A result table: tab-separated wire terms below a header; CR, LF and CRLF end lines, blank lines are skipped.

    Short rows are padded with empty values. Quotes are data. Only the first line of a file is a header, whatever
    rows below it look like.
    """
    head = spark.read.text(path).filter(F.trim("value") != "").first()
    if head is None:
        return spark.createDataFrame([], T.StructType([]))
    names = [header_name(c) for c in head.value.split("\t")]
    body = _below_header(spark, path, len(names))
    return body.select(*((clean_term(F.col(f"c{i}")) if clean else F.col(f"c{i}")).alias(n) for i, n in enumerate(names)))


RESULT_CELL = "struct<type:string,value:string,datatype:string,`xml:lang`:string>"


def read_result_json(spark: SparkSession, path: str) -> DataFrame:
    """A result document {head: {vars}, results: {bindings}} as wire terms; unbound is empty."""
    raw = spark.read.text(path, wholetext=True)
    names = json.loads(raw.select(F.get_json_object("value", "$.head.vars").alias("v")).first().v or "[]")
    row = f"struct<{','.join(f'`{n}`:{RESULT_CELL}' for n in names)}>"
    parsed = raw.select(F.from_json("value", f"struct<results:struct<bindings:array<{row}>>>").alias("d")).select(F.explode("d.results.bindings").alias("b"))

    def term(n: str):
        c = F.col(f"b.`{n}`")
        value = c["value"]
        for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
            value = F.replace(value, F.lit(a), F.lit(b))
        tail = F.when(c["xml:lang"].isNotNull(), F.concat(F.lit("@"), c["xml:lang"])).when(c["datatype"].isNotNull(), F.concat(F.lit("^^<"), c["datatype"], F.lit(">"))).otherwise("")
        return F.when(c.isNull(), "").when(c["type"] == "uri", F.concat(F.lit("<"), c["value"], F.lit(">"))).when(c["type"] == "bnode", F.concat(F.lit("_:"), c["value"])).otherwise(F.concat(F.lit('"'), value, F.lit('"'), tail))

    return parsed.select(*(term(n).alias(n) for n in names))


def read_result_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV result as wire terms: values that begin with http stay bare, others are quoted."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return df.select(*(F.when(F.col(c).isNull() | (F.col(c) == ""), "").when(F.col(c).startswith("http"), F.col(c)).otherwise(quoted(F.col(c))).alias(c) for c in df.columns))


def sniff(body: str, asked: str = "") -> str:
    """json, tsv or csv, by how a body looks."""
    start = body.lstrip()[:1]
    if start == "{":
        return "json"
    first = body.split("\n", 1)[0]
    return "tsv" if "\t" in first or asked == "tsv" else "csv" if "," in first else asked or "tsv"


def read_exchange(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, str]]:
    """A table below a block of # key: value lines at the top of a file, and the block. Below the header # is data."""
    lines = spark.read.text(path)
    most, above, head = 64, [], None
    while head is None:  # the block is as long as it is: look further until its end
        top = [r.value for r in lines.limit(most).collect()]
        at = next((i for i, x in enumerate(top) if x.strip() and not x.startswith("#")), None)
        if at is not None:
            above, head = top[:at], top[at]
        elif len(top) < most:
            above, head = top, ""
        most *= 8
    meta = {}
    for line in above:
        if line.startswith("#"):
            k, _, v = line.lstrip("# ").partition(":")
            meta[k.strip()] = v.strip().strip('"')
    names = head.split("\t") if head else []
    cells = F.split("value", "\t", -1)
    # The first partition has the top of the file, and its rows are numbered from 0.
    body = lines.withColumn("at", F.monotonically_increasing_id()).filter((F.col("at") > len(above)) & (F.col("value") != ""))
    return body.select(*(F.coalesce(F.get(cells, F.lit(i)), F.lit("")).alias(n.removeprefix("ext_")) for i, n in enumerate(names))), meta


def cited_ids(spark: SparkSession, paths: list[str], attribute: str = "pubMedId") -> DataFrame:
    """(id) of an attribute in items documents, distinct, in numeric order."""
    pattern = rf'name="{re.escape(attribute)}" value="([0-9]+)"'
    lines = spark.read.option("ignoreMissingFiles", "true").text(paths)
    return lines.select(F.explode(F.regexp_extract_all("value", F.lit(pattern), F.lit(1))).alias("id")).distinct().orderBy(F.col("id").cast("long"))


_REFERENCES = "array<struct<_name:string,_ref_id:string>>"
_COLLECTIONS = "array<struct<_name:string,reference:array<struct<_ref_id:string>>>>"
ITEM = f"_id string, _class string, attribute array<struct<_name:string,_value:string>>, reference {_REFERENCES}, collection {_COLLECTIONS}"


def _items(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", "item").schema(ITEM).load(path)


def read_items_xml(spark: SparkSession, path: str) -> DataFrame:
    """(id, cls, attrs) of items documents."""
    attributes = F.coalesce("attribute", F.array().cast("array<struct<_name:string,_value:string>>"))
    return _items(spark, path).select(F.col("_id").alias("id"), F.col("_class").alias("cls"), F.map_from_entries(F.transform(attributes, lambda a: F.struct(a["_name"], a["_value"]))).alias("attrs"))


def read_item_links(spark: SparkSession, path: str) -> DataFrame:
    """(src, field, dst, many) of the references and collections of items documents."""
    one = F.transform(F.coalesce("reference", F.array().cast(_REFERENCES)), lambda r: F.struct(r["_name"].alias("field"), r["_ref_id"].alias("dst"), F.lit(False).alias("many")))
    several = F.transform(F.coalesce("collection", F.array().cast(_COLLECTIONS)), lambda c: F.transform(c["reference"], lambda r: F.struct(c["_name"].alias("field"), r["_ref_id"].alias("dst"), F.lit(True).alias("many"))))
    return _items(spark, path).select(F.col("_id").alias("src"), F.explode(F.concat(one, F.flatten(several))).alias("l")).select("src", "l.*")


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """(value) of a list file: tokens between white space, # begins a comment."""
    bare = F.regexp_replace("value", "#.*$", "")
    return spark.read.text(path).select(F.explode(F.split(bare, r"\s+")).alias("value")).filter("value <> ''")


def distinct_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, md5) of files, byte-identical ones once."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.md5("content").alias("md5"))
    return files.groupBy("md5").agg(F.min("path").alias("path"))


def model_files(spark: SparkSession, folder: str, allow: list[str] | None = None) -> DataFrame:
    """(path, kind) of a folder's model files, of byte-identical ones the first path: kind is core, additions or keys.

    core.xml and genomic_additions.xml always count; other additions and key files only where their path has one of the ``allow``
    tokens (all without a list) and isn't below a test folder. Core files come first, then paths in order, as a model is loaded.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{xml,properties}").load(folder)
    path = F.col("path")
    kind = F.when(path.rlike(r"/(core|genomic_additions)\.xml$"), "core").when(path.rlike(r"_additions\.xml$"), "additions").when(path.rlike(r"_keys\.properties$"), "keys")
    asked = F.lit(True) if allow is None else reduce(lambda a, b: a | b, (path.contains(t) for t in allow), F.lit(False))
    found = files.select("path", kind.alias("kind"), F.md5("content").alias("md5")).filter(F.col("kind").isNotNull() & ((F.col("kind") == "core") | (asked & ~path.contains("/test/"))))
    return found.groupBy("md5", "kind").agg(F.min("path").alias("path")).orderBy(F.col("kind") != "core", "path").select("path", "kind")


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated table with a header, its values as they are; a file that isn't there is a table without columns or rows."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], T.StructType([]))
    return spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path).na.fill("")


def verify_manifest(spark: SparkSession, folder: str, manifest: str) -> DataFrame:
    """(file, problem) where a folder and its list of MD5 sums differ: missing, unlisted or changed."""
    have = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    have = have.select(F.regexp_extract("path", r".*/(data/.*)$", 1).alias("file"), F.md5("content").alias("sum")).filter("file <> ''")
    want = spark.read.text(manifest).select(F.regexp_extract("value", r"^([0-9a-f]{32})\s+\*?(.*)$", 2).alias("file"), F.substring("value", 1, 32).alias("listed")).filter("file <> ''")
    both = want.join(have, "file", "full_outer")
    problem = F.when(F.col("sum").isNull(), "missing").when(F.col("listed").isNull(), "unlisted").when(F.col("sum") != F.col("listed"), "changed")
    return both.select("file", problem.alias("problem")).filter("problem IS NOT NULL")
