"""Prefix keyword search, autocomplete and facets over an inverted index of edge n-grams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.written import Pointer

SHORTEST, LONGEST = 3, 10
#: Characters of text whose grams one task of ``edge_index`` holds; 11 of them make at most 8 grams.
TASK_CHARS = 1 << 21


def search_docs(df: DataFrame, kind: str, id_col: str, fields: list[str]) -> DataFrame:
    """(kind, id, text) of a table's searchable fields."""
    return df.select(F.lit(kind).alias("kind"), F.col(id_col).cast("string").alias("id"), F.concat_ws(" ", *fields).alias("text"))


def tokens(text: Column) -> Column:
    """Distinct lower-cased tokens between white space."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[ \t\n\r\f\x0B]+"), lambda t: t != ""))


def edge_index(docs: DataFrame) -> DataFrame:
    """(gram, kind, id): the first 3 to 10 characters of each token; shorter tokens are not found.

    Documents are dealt out by id before their grams are made, some thirty for each, so a task's grams are those of about TASK_CHARS
    characters, however large the files are, and grams aren't shuffled.
    """
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    docs = docs.repartition(chars // TASK_CHARS + 1, "id")  # not by kind: where that is constant, grams would be shuffled again
    words = docs.select("kind", "id", F.explode(tokens(F.col("text"))).alias("t")).filter(F.length("t") >= SHORTEST)
    lengths = F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.length("t")))
    return words.select("kind", "id", F.explode(F.transform(lengths, lambda n: F.substr("t", F.lit(1), n))).alias("gram")).distinct()


def search(index: DataFrame, query: str) -> DataFrame:
    """(kind, id, score) of documents with every token of ``query`` as a gram; score counts tokens found."""
    words = sorted(set(query.lower().split()))
    hits = index.filter(F.col("gram").isin(*words) if words else F.lit(False)).groupBy("kind", "id").agg(F.count_distinct("gram").alias("score"))
    return hits.filter(F.col("score") == len(words))


def autocomplete_docs(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(kind, field, value) of the configured fields of each class, distinct and non-empty."""
    parts = [df.select(F.lit(kind).alias("kind"), F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields))).alias("d")).select("kind", "d.*") for kind, (df, fields) in tables.items()]
    return reduce(DataFrame.unionByName, parts).filter("value <> ''").distinct()


def autocomplete(docs: DataFrame, start: str) -> DataFrame:
    """Values that begin with ``start``, whatever the case."""
    return docs.filter(F.lower("value").startswith(start.lower()))


def facets(docs: DataFrame) -> DataFrame:
    """Documents of each kind."""
    return docs.groupBy("kind").agg(F.count("*").alias("n"))


def summary(df: DataFrame, kind: str, field: str, most: int = 200) -> DataFrame:
    """The most frequent values of a field, at most ``most``."""
    return df.groupBy(F.col(field).cast("string").alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(most).select(F.lit(kind).alias("kind"), F.lit(field).alias("field"), "value", "n")


def out_of_sync(index: DataFrame, live: DataFrame) -> DataFrame:
    """(kind, id) that the index has and the objects don't."""
    return index.select("kind", "id").distinct().join(live.select("kind", "id").distinct(), ["kind", "id"], "left_anti")


def index_rows(docs: DataFrame) -> DataFrame:
    """(gram, rest, size, kind, id): grams as ``edge_index`` has them, the token's length, and beside its longest gram the rest of the token.

    So words longer than a gram find their tokens too, by their first LONGEST characters and then by the rest.
    """
    words = docs.select("kind", "id", F.explode(tokens(F.col("text"))).alias("t")).filter(F.length("t") >= SHORTEST)
    lengths = F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.length("t")))
    grams = words.select("kind", "id", "t", F.explode(lengths).alias("n"))
    rest = F.when(F.col("n") == LONGEST, F.substr("t", F.lit(LONGEST + 1))).otherwise("")
    return grams.select(F.substr("t", F.lit(1), F.col("n")).alias("gram"), rest.alias("rest"), F.length("t").alias("size"), "kind", "id")


class StoredIndex:
    """An inverted index as tables below ``path``, bucketed by gram, with generations of additions and deletions.

    A search reads the buckets of its words' grams only. ``change`` adds a generation: documents deleted in it are hidden in those
    before, documents added in it are seen (an update is both). A pointer file names the generations that count, so a
    search sees a change whole or not at all; ``compact`` writes what is seen as one generation.
    """

    ROWS = "gram string, rest string, size int, kind string, id string, generation int, bucket int"
    GONE = "kind string, id string, generation int"

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256):
        self.spark, self.path = spark, path.rstrip("/")
        self._file = Pointer(spark, f"{self.path}/current.json")
        self.state = self._file.read() or {"first": 0, "next": 0, "buckets": buckets}

    def _bucket(self, gram: Column) -> Column:
        return F.pmod(F.xxhash64(gram), F.lit(self.state["buckets"])).cast("int")

    def _seen(self, df: DataFrame) -> DataFrame:
        return df.filter(F.col("generation").between(self.state["first"], self.state["next"] - 1))

    def _write(self, rows: DataFrame, generation: int) -> None:
        rows = rows.withColumn("bucket", self._bucket(F.col("gram")))
        # A gram that very many documents share would be one task: buckets are dealt out over four by document.
        rows = rows.repartition(F.col("bucket"), F.pmod(F.xxhash64("id"), F.lit(4)))
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/rows/generation={generation}")

    def change(self, added: DataFrame | None = None, deleted: DataFrame | None = None) -> None:
        """Add documents (kind, id, text) and delete (kind, id), as one change."""
        at = self.state["next"]
        empty = self.spark.createDataFrame([], "kind string, id string, text string")
        self._write(index_rows(added if added is not None else empty), at)
        gone = (deleted if deleted is not None else empty).select(F.col("kind").cast("string").alias("kind"), F.col("id").cast("string").alias("id")).distinct()
        gone.write.mode("overwrite").parquet(f"{self.path}/gone/generation={at}")
        self._point({**self.state, "next": at + 1})

    def _point(self, state: dict) -> None:
        self._file.replace(state)
        self.state = state

    def _live(self, rows: DataFrame) -> DataFrame:
        if self.state["next"] - self.state["first"] < 2:
            return rows
        gone = self._seen(self.spark.read.schema(self.GONE).parquet(f"{self.path}/gone")).groupBy("kind", "id").agg(F.max("generation").alias("gone"))
        return rows.join(gone, ["kind", "id"], "left").filter("gone IS NULL OR generation >= gone").drop("gone")

    def _rows(self) -> DataFrame:
        if self.state["next"] == self.state["first"]:
            return self.spark.createDataFrame([], self.ROWS)
        return self._seen(self.spark.read.schema(self.ROWS).parquet(f"{self.path}/rows"))

    def documents(self) -> DataFrame:
        """(kind, id) that a search can find."""
        return self._live(self._rows().select("kind", "id", "generation").distinct()).select("kind", "id").distinct()

    def hits(self, query: str) -> DataFrame:
        """(kind, id, score) of documents that have for every word of ``query`` a token beginning with it.

        Each word adds the share that it makes of the shortest such token, so whole words count 1. Words shorter than a gram find
        nothing.
        """
        words = sorted(set(query.lower().split()))
        if not words:
            return self._rows().select("kind", "id", F.lit(0.0).alias("score")).limit(0)
        rows, found = self._rows(), None
        for i, w in enumerate(words):
            gram = F.lit(w[:LONGEST])
            own = rows.filter((F.col("bucket") == self._bucket(gram)) & (F.col("gram") == gram) & F.col("rest").startswith(w[LONGEST:]))
            own = own.select("kind", "id", "generation", F.lit(i).alias("word"), (F.lit(float(len(w))) / F.col("size")).alias("share"))
            found = own if found is None else found.union(own)
        best = self._live(found).groupBy("kind", "id", "word").agg(F.max("share").alias("share"))
        return best.groupBy("kind", "id").agg(F.count("*").alias("n"), F.round(F.sum("share"), 6).alias("score")).filter(F.col("n") == len(words)).drop("n")

    def search(self, query: str, most: int = 10) -> DataFrame:
        """The ``most`` best hits, by falling score, then kind and id."""
        return self.hits(query).orderBy(F.desc("score"), "kind", "id").limit(most)

    def compact(self) -> None:
        """Write what is seen as one generation. Folders of those before stay for searches that began before."""
        at = self.state["next"]
        self._write(self._live(self._rows()).select("gram", "rest", "size", "kind", "id"), at)
        self.spark.createDataFrame([], "kind string, id string").write.mode("overwrite").parquet(f"{self.path}/gone/generation={at}")
        self._point({**self.state, "first": at, "next": at + 1})
