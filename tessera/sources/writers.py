"""Writers: tables as TSV, exchange tables with a metadata block, items documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.terms import to_ascii


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated without quotes; nulls are empty, tabs and line ends in values become spaces."""
    flat = df.select(*(F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"[\t\r\n]", " ").alias(c) for c in df.columns))
    flat.write.mode("overwrite").csv(path, sep="\t", header=True, quote="", escape="\\", emptyValue="")


def mapping_exchange(rows: DataFrame) -> DataFrame:
    """Mapping rows with predicate, justification and confidence derived from their status."""
    predicate = F.when(F.col("status").isin("sure", "human"), "skos:exactMatch").when(F.col("status") == "guess", "skos:closeMatch").when(F.col("status") == "link", "skos:relatedMatch").otherwise("")
    reason = F.when(F.col("status") == "human", "semapv:ManualMappingCuration").when(F.col("status") == "guess", "semapv:LexicalMatching").otherwise("semapv:MappingReview")
    sure = F.when(F.col("status").isin("sure", "human"), "1.0").when(F.col("status") == "guess", "0.5").otherwise("")
    return rows.withColumns({"predicate_id": predicate, "mapping_justification": reason, "confidence": sure})


def exchange_lines(rows: DataFrame, meta: dict[str, str]) -> DataFrame:
    """Lines of an exchange file: the metadata block, the header, the rows, with their order."""
    spark = rows.sparkSession
    head = [(i, f"# {k}: {v}") for i, (k, v) in enumerate(meta.items())] + [(len(meta), "\t".join(rows.columns))]
    body = rows.select(F.lit(len(head)).alias("no"), F.concat_ws("\t", *(F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"[\t\r\n]", " ") for c in rows.columns)).alias("line"))
    return spark.createDataFrame(head, "no int, line string").unionByName(body)


def write_items(items: DataFrame, links: DataFrame, path: str) -> None:
    """Items documents below ``path``: each part file is one with its root, and holds a range of the items' numbers in order.

    ``items`` (no: long, cls, attrs: map), ``links`` (src_no, field, dst_no, many: boolean). Values are written in ASCII, links to items
    that don't exist are left out, a reference keeps its largest target, a collection all of its targets. Ids are unique over
    all parts, and links may lead to items of other parts.
    """
    label = lambda c: F.concat(F.lit("0_"), c.cast("string"))
    live = links.join(items.select(F.col("no").alias("dst_no")), "dst_no", "left_semi")
    ends = live.groupBy(F.col("src_no").alias("no"), "field", "many").agg(F.sort_array(F.collect_set("dst_no")).alias("dst"))
    targets = F.transform(F.when(F.col("many"), F.col("dst")).otherwise(F.slice("dst", -1, 1)), lambda d: F.struct(label(d).alias("_ref_id")))
    ends = ends.select("no", "many", F.struct(F.col("field").alias("_name"), targets.alias("reference")).alias("x")).groupBy("no").agg(
        F.sort_array(F.collect_list(F.when(~F.col("many"), F.struct(F.col("x._name").alias("_name"), F.col("x.reference")[0]["_ref_id"].alias("_ref_id"))))).alias("reference"),
        F.sort_array(F.collect_list(F.when(F.col("many"), F.col("x")))).alias("collection"),
    )
    attributes = F.transform(F.array_sort(F.map_entries("attrs")), lambda e: F.struct(e["key"].alias("_name"), to_ascii(e["value"]).alias("_value")))
    rows = items.join(ends, "no", "left").select("no", label(F.col("no")).alias("_id"), F.col("cls").alias("_class"), attributes.alias("attribute"), "reference", "collection")
    rows.repartitionByRange("no").sortWithinPartitions("no").drop("no").write.mode("overwrite").format("xml").option("rootTag", "items").option("rowTag", "item").option("declaration", "").save(path)
