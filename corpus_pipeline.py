"""The corpus pipeline: toxicity, exact duplicates, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept, row by
row: ids may be null or repeat. All but the last return the columns of ``documents``, whatever they are
called beside doc_id, text, lang and source; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_ROWS, Scratch, free_name, scratch_scope
from tessera.llm.exact_dedup import exact_duplicates
from tessera.llm.jaccard import jaccard_components
from tessera.llm.mixing import mix, rule_topic
from tessera.llm.packing import pack
from tessera.llm.queries import fold, table, tokenizer_path
from tessera.llm.toxicity import toxicity


def _by_id(docs: DataFrame) -> bool:
    """Whether doc_id tells the rows apart: none is null and none repeats. Only ids are shuffled."""
    odd = docs.select(F.col("doc_id").cast("long").alias("id")).groupBy("id").agg(F.count("*").alias("n")).filter("n > 1 OR id IS NULL")
    return odd.isEmpty()


def _keyed(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, str]:
    """``docs`` with a number for each row, and the name of that column.

    It is the doc_id where that tells all rows apart. Where it doesn't, the rows are numbered and written once, so that every
    reader sees the same numbers.
    """
    key = free_name(docs, "row_key")
    if _by_id(docs):
        return docs.withColumn(key, F.col("doc_id").cast("long")), key
    return scratch.save(docs.withColumn(key, F.monotonically_increasing_id()), "keyed"), key


def _without(keyed: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """The rows of ``keyed`` whose key isn't in ``dropped`` (key), a written table, without the key."""
    side = F.broadcast(dropped) if dropped.count() <= BROADCAST_ROWS else dropped
    return keyed.join(side, key, "left_anti").drop(key)


def _losers(keyed: DataFrame, key: str, others: DataFrame) -> DataFrame:
    """Keys of all rows of the groups but the one with the smallest doc_id (null last, then key).

    ``others``: (key, head), each row but a group's head, which is a row of the group, with that head.
    """
    scratch = Scratch(keyed.sparkSession)
    others = scratch.save(others, "others")
    rows = others.union(others.select(F.col("head").alias(key), "head").distinct())
    rows = scratch.save(keyed.select(key, "doc_id").join(rows, key), "rows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id"), F.col(key).alias("key"))
    best = rows.groupBy("head").agg(F.min(order).alias("x")).select(F.col("x.key").alias(key))
    return rows.select(key).join(best, key, "left_anti")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is under 0.5; labels of the fold that queries hold out are not learnt.

    Each row is scored by its own whole text, null as the empty one, so rows that repeat an id stay or go each for itself.
    """
    scratch = Scratch(spark)
    keyed, key = _keyed(docs, scratch)
    with scratch_scope():
        scored = toxicity(keyed, table(spark, sf_dir, "labels"), fold(5) != 0, key_col=key)
        dropped = scratch.save(scored.filter("score >= 0.5").select(key), "dropped")
    return _without(keyed, key, dropped)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row with the smallest doc_id; null ids come last, null texts are empty ones."""
    scratch = Scratch(spark)
    keyed, key = _keyed(docs, scratch)
    with scratch_scope():
        found = exact_duplicates(keyed, id_col=key).filter("NOT kept")
        dropped = scratch.save(_losers(keyed, key, found.select(F.col("doc_id").alias(key), F.col("keep_id").alias("head"))), "dropped")
    return _without(keyed, key, dropped)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five-word shingles, similarity 0.8 or more) one row with the smallest doc_id.

    Null ids come last. Texts without words are no copies.
    """
    scratch = Scratch(spark)
    keyed, key = _keyed(docs, scratch)
    with scratch_scope():
        found = jaccard_components(keyed, words=5, percent=80, id_col=key).filter("doc_id <> component_id")
        dropped = scratch.save(_losers(keyed, key, found.select(F.col("doc_id").alias(key), F.col("component_id").alias("head"))), "dropped")
    return _without(keyed, key, dropped)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that raking to the source, language and topic targets samples.

    Null sources and languages are values of their own. Texts without words weigh nothing, whether they are sampled depends on
    their cell. Rows with a null or repeated id are drawn each for itself, so equal rows may differ.
    """
    scratch = Scratch(spark)
    if _by_id(docs):
        drawn, draw = docs, "doc_id"
    else:
        keyed, key = _keyed(docs, scratch)
        draw, again = free_name(keyed, "draw"), free_name(keyed, "again")
        repeated = scratch.save(keyed.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id", F.lit(True).alias(again)), "repeated")
        side = F.broadcast(repeated) if repeated.count() <= BROADCAST_ROWS else repeated
        text = F.col("doc_id").cast("string")
        own = F.concat_ws(" ", text, F.lit("row"), F.col(key).cast("string"))
        drawn = keyed.join(side, "doc_id", "left").withColumn(draw, F.when(text.isNull() | F.col(again), own).otherwise(text))
    return mix(drawn, rule_topic(F.col("text")), id_col=draw).filter("sampled").select(*(F.col("row")[c].alias(c) for c in docs.columns))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 1024 ids, of every row: null texts are empty, ids null or repeated are passed on."""
    return pack(docs, tokenizer_path()).drop("ids")


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: The classifier's fit can't be expressed in SQL; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs, scratch, before = table(spark, sf_dir, "documents"), Scratch(spark), None
    for name, stage in STAGES[:-1]:
        with scratch_scope():
            docs = scratch.save(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        if before:
            scratch.drop(before)
        before = name.replace(" ", "_")
    return STAGES[-1][1](spark, docs, sf_dir)
