"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_of, words_of
from .exact_dedup import exact_duplicates
from .fingerprints import fingerprints
from .jaccard import jaccard_components
from .mixing import mix, mix_sql, rule_topic
from .neighbours import near_vectors
from .packing import pack
from .pii import KINDS, kind_count, personal_data, span_text
from .quality import quality
from .quotes import link_quotes
from .runs import periodic_runs
from .toxicity import toxicity
from .urls import judge_urls
from .whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def fold(modulus: int):
    """crc32 of doc_id as text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold(4) != 2)
    return scored.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), words=3, percent=90).drop("first")


#: Verdict, host and path prefix of each URL rule.
URL_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES).drop("score")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


def op7_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = link_quotes(table(spark, sf_dir, "conversations"), every_holder=True)
    return linked.withColumn("clean_sha256", F.sha2("clean", 256)).drop("clean")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold(5) != 0)
    return scored.select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), rule_topic(F.col("text")))
    return mixed.select("row.doc_id", "tokens", F.round("probability", 6).alias("probability"), "sampled")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(kind_count("base", k).alias(f"n_{k}") for k in KINDS), F.sha2(span_text("base"), 256).alias("base_sha256"), span_text("spans").alias("spans"))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document by the hash of its id repeats, from some word on, a stretch of its own words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.select("doc_id", text_of("text").alias("text"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words_of(text_of("text"))).alias("w"))
    n = F.size("w").cast("long")
    docs = docs.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    repeated = F.transform(F.sequence("a", n - 1), lambda i: F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    edited = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), repeated), " ")
    return docs.select("doc_id", F.when(F.col("a").isNotNull(), edited).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted(table(spark, sf_dir, "documents")))
    found = found.withColumn("best", F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    length, period = -F.col("best.less"), F.col("best.period")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
"""


OP4_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
x AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM x a JOIN x b ON a.sh = b.sh AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM c WHERE 100 * c >= 90 * (na + nb - c)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT DISTINCT a AS doc_id, a AS other FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a),
m AS (SELECT doc_id, min(other) AS least FROM r GROUP BY 1)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(least, s.doc_id) AS component_id FROM s LEFT JOIN m ON s.doc_id = m.doc_id
"""

OP11_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT DISTINCT a, a AS other FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.other = l.a),
m AS (SELECT a, min(other) AS least FROM r GROUP BY 1),
n AS (SELECT a, count(*) AS n FROM l GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least, vec_id) AS component_id, coalesce(least, vec_id) = vec_id AS kept, 1.0::DOUBLE AS audit_recall
FROM embeddings e LEFT JOIN m ON e.vec_id = m.a LEFT JOIN n ON e.vec_id = n.a
"""

_QUERIES = [op1_exact_dedup, op2_fingerprints, op3_quality, op4_ngram_jaccard, op5_url_filter, op6_packing, op7_quote_linking, op8_toxicity, op9_mixing, op10_pii, op11_embedding_near_dedup, op12_periodic_runs, op13_whitening]


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1_SQL, "op4_ngram_jaccard": OP4_SQL, "op9_mixing": mix_sql(), "op11_embedding_near_dedup": OP11_SQL}
