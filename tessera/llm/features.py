"""Hashed features of texts, for the linear and factorised classifiers.

A feature is a 64-bit hash. A batch of texts is split by Arrow, and whatever depends on a word
alone is computed once for each distinct word of the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean

#: Bytes of text whose features a worker holds at a time.
BATCH_BYTES = 1_500_000

#: texts -> (document of each feature, feature), each pair once, ordered by document.
Extractor = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def slices(b: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most BATCH_BYTES of text in ``column``, one row at least."""
    size = np.cumsum(pc.binary_length(b.column(column)).to_numpy(zero_copy_only=False))
    at = 0
    while at < b.num_rows:
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + BATCH_BYTES, "right")))
        yield b.slice(at, end - at)
        at = end


def tokens(texts: pa.Array, pattern: str) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(document of each token, token's place in the vocabulary, vocabulary) of texts split at ``pattern``."""
    parts = pc.split_pattern_regex(texts, pattern)
    at = parts.offsets.to_numpy()
    coded = parts.flatten().dictionary_encode()
    doc = np.repeat(np.arange(len(texts)), np.diff(at))
    code, vocabulary = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    empty = pc.equal(vocabulary, "").to_numpy(zero_copy_only=False)
    if empty.any():
        keep = ~empty[code]
        doc, code = doc[keep], code[keep]
    return doc, code, vocabulary


def hashes(words: pa.Array, salt: str) -> np.ndarray:
    """A 64-bit hash of each string; ``salt`` has 16 characters."""
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False), hash_key=salt, categorize=False).astype(np.uint64)


def once(doc: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (document, feature) pair once, ordered by document."""
    order = np.lexsort((feature, doc))
    doc, feature = doc[order], feature[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (feature[1:] != feature[:-1])
    return doc[new], feature[new]


def gather(df: DataFrame, extract: Extractor, keep: list[str], known: np.ndarray | None = None) -> DataFrame:
    """``keep`` columns (cast to long) and ``features``: the sorted distinct features of the column text.

    With ``known``, a sorted array of features, only those, by their place in it.
    """
    schema = pa.schema([*((c, pa.int64()) for c in keep), ("features", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, len(keep)):
                doc, feature = extract(b.column(len(keep)))
                if known is not None:
                    doc, feature = places(doc, feature, known)
                ends = np.cumsum(np.bincount(doc, minlength=b.num_rows))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(feature.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], lists], schema=schema)

    return df.select(*(F.col(c).cast("long").alias(c) for c in keep), "text").mapInArrow(lean(run), ", ".join([*(f"{c} long" for c in keep), "features array<long>"]))


def places(doc: np.ndarray, feature: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose feature is in ``known``, by its place there."""
    if not len(known):
        return doc[:0], np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, feature), len(known) - 1)
    hit = known[at] == feature
    return doc[hit], at[hit].astype(np.int64)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: object, most: int) -> DataFrame:
    """(text, y) of labelled training rows: all, or a sample by hash of about ``most`` of them.

    ``docs``: doc_id, text. ``train``: a condition over doc_id. Documents with labels of both
    kinds or none are left out.
    """
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & train).groupBy("doc_id").agg(F.min(label).alias("lo"), F.max(label).alias("hi")).filter("lo = hi").select("doc_id", F.col("lo").cast("long").alias("y"))
    n = marks.count()
    if n > most:
        marks = marks.filter(F.expr(f"pmod(xxhash64(doc_id, 'sample'), 1000000) < {int(1e6 * most / n)}"))
    side = F.broadcast(marks) if min(n, most) <= 500_000 else marks
    return docs.join(side, "doc_id").select("y", "text")


def associated(sample: DataFrame, extract: Extractor, most: int, least_docs: int = 3) -> tuple[np.ndarray, int, int]:
    """The ``most`` features with the largest chi-square against y, sorted; rows and positive rows of the sample."""
    rows, positive = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not rows:
        return np.zeros(0, np.uint64), 0, 0
    counts = gather(sample, extract, ["y"]).select("y", F.explode("features").alias("f")).groupBy("f").agg(F.count("*").alias("n"), F.sum("y").alias("p")).filter(f"n >= {least_docs}")
    n, p, a, b = F.col("n"), F.col("p"), F.lit(float(rows)), F.lit(float(positive))
    gap = p * a - n * b
    chi = gap * gap / F.greatest(n * (a - n) * b * (a - b), F.lit(1e-9))
    top = counts.select("f", chi.alias("chi")).orderBy(F.desc("chi"), "f").limit(most).select("f").toArrow()
    return np.sort(top["f"].to_numpy().view(np.uint64)), rows, positive


def fetch(sample: DataFrame, extract: Extractor, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(labels, offsets, feature places) of the sample on the driver; its size is bounded by the sample's."""
    t = gather(sample, extract, ["y"], known).toArrow().combine_chunks()
    if not t.num_rows:
        return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64)
    lists = t["features"].combine_chunks() if t["features"].num_chunks != 1 else t["features"].chunk(0)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    y = t["y"].to_numpy()
    sizes = np.diff(lists.offsets.to_numpy())
    # One order, whatever order the rows came in.
    at = np.concatenate([[0], np.cumsum(sizes)])
    weight = np.concatenate([np.zeros(1), np.cumsum((flat + 1.0) ** 1.5)])
    order = np.lexsort((weight[at[1:]] - weight[at[:-1]], sizes, y))
    take = np.concatenate([np.arange(at[i], at[i + 1]) for i in order]) if len(flat) else np.zeros(0, np.int64)
    return y[order], np.concatenate([[0], np.cumsum(sizes[order])]), flat[take]
