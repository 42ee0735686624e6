"""Exact duplicates by a Golomb-coded exchange of fingerprints.

1. Every partition hashes its normalised texts, sorts the distinct hashes of each
   owner (a range of the hash space) and sends them as Golomb-Rice coded gaps.
2. An owner decodes what its senders sent and answers each with a bitmap: which of
   the sent hashes came from another sender too.
3. Rows whose hash is marked, or that repeat within their own partition, are
   suspects. Only their texts are shuffled, grouped by all their bytes.

A hash goes out once from each sender, however often it occurs there, and the byte
check aggregates before its shuffle, so a text that a third of all rows share costs
one row for each task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANK, Scratch, join_unique, lean, shuffle_partitions, text_of

#: Rows a sender gathers before it sends a set of blocks.
SENDER_ROWS = 200_000
#: A row's number is its sender's with so many bits more: a sender has SENDER_ROWS and one batch at most.
ROW_BITS = 20
#: A filter list up to this many hashes (8 bytes each) is broadcast; above it the join shuffles.
BROADCAST_HASHES = 1_000_000


def normalise(name: str):
    """Each run of ASCII white space becomes one space; null is empty."""
    return F.regexp_replace(text_of(name), f"{BLANK}+", " ")


def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted distinct uint64 values as Golomb-Rice coded gaps.

    Layout: count (8 bytes), remainder width k (1), length of the unary part in bits (8),
    unary quotients, k-bit remainders. The divisor is a power of two near the mean gap times ln 2.
    """
    values = np.asarray(values, dtype=np.uint64)
    if not len(values):
        return np.zeros(17, np.uint8).tobytes()
    gaps = np.diff(values, prepend=np.uint64(0))
    mean = float(values[-1]) / len(values)
    k = max(0, int(np.floor(np.log2(max(mean * 0.6931, 1.0)))))
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1)
    unary = np.zeros(int(ends[-1]), np.uint8)
    unary[ends - 1] = 1
    rest = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    head = np.array([len(values), len(unary)], np.int64)
    return head[:1].tobytes() + bytes([k]) + head[1:].tobytes() + np.packbits(unary).tobytes() + np.packbits(rest).tobytes()


def golomb_decode(data: bytes) -> np.ndarray:
    """The inverse of golomb_encode."""
    n, k, bits = int(np.frombuffer(data, np.int64, 1)[0]), data[8], int(np.frombuffer(data, np.int64, 1, 9)[0])
    if not n:
        return np.zeros(0, np.uint64)
    size = (bits + 7) // 8
    unary = np.unpackbits(np.frombuffer(data, np.uint8, size, 17))[:bits]
    quotients = np.diff(np.flatnonzero(unary), prepend=-1).astype(np.uint64) - np.uint64(1)
    gaps = quotients << np.uint64(k)
    if k:
        rest = np.unpackbits(np.frombuffer(data, np.uint8, offset=17 + size))[: n * k].reshape(n, k).astype(np.uint64)
        gaps |= (rest << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def _owner_of(hashes: np.ndarray, owners: int) -> np.ndarray:
    """Owner of each uint64 hash: equal ranges of the top 32 bits."""
    return ((hashes >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int32)


def _sender(owners: int):
    """mapInArrow body: rows with their place in what was sent (kind 0) and the blocks sent (kind 1)."""
    schema = pa.schema([("kind", pa.int32()), ("row_id", pa.int64()), ("doc_id", pa.int64()), ("sha", pa.string()), ("h", pa.int64()), ("sender", pa.int64()), ("owner", pa.int32()), ("slot", pa.int32()), ("twice", pa.bool_()), ("payload", pa.binary())])

    def emit(batches: list[pa.RecordBatch], sender: int) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(batches).combine_chunks()
        h = t["h"].to_numpy().view(np.uint64)
        distinct, back, counts = np.unique(h, return_inverse=True, return_counts=True)
        owner = _owner_of(distinct, owners)
        ids, starts = np.unique(owner, return_index=True)
        slot = np.arange(len(distinct)) - starts[np.searchsorted(ids, owner)]
        n = len(h)
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), pa.array((sender << ROW_BITS) + np.arange(n)), *(t[c].combine_chunks() if t[c].num_chunks != 1 else t[c].chunk(0) for c in ("doc_id", "sha", "h")), pa.array(np.full(n, sender)), pa.array(owner[back]), pa.array(slot[back].astype(np.int32)), pa.array(counts[back] > 1), pa.nulls(n, pa.binary())], schema=schema)
        blocks = [golomb_encode(x) for x in np.split(distinct, starts[1:])]
        m = len(blocks)
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(m, np.int32)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.string()), pa.nulls(m, pa.int64()), pa.array(np.full(m, sender)), pa.array(ids.astype(np.int32)), pa.nulls(m, pa.int32()), pa.nulls(m, pa.bool_()), pa.array(blocks, pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, sender = [], 0, TaskContext.get().partitionId() << 20
        for b in batches:
            if b.num_rows:
                held.append(b)
                rows += b.num_rows
            if rows >= SENDER_ROWS:
                yield from emit(held, sender)
                held, rows, sender = [], 0, sender + 1
        if held:
            yield from emit(held, sender)

    return run


def _answer(blocks: pd.DataFrame) -> pd.DataFrame:
    """An owner's answer: for each sender 64-bit words, bit i set if its i-th hash came from another sender too."""
    sent = [golomb_decode(x) for x in blocks["payload"]]
    every = np.sort(np.concatenate(sent))
    shared = np.unique(every[1:][every[1:] == every[:-1]])
    words = []
    for x in sent:
        marks = np.isin(x, shared, assume_unique=True)
        marks = np.pad(marks, (0, -len(marks) % 64))
        words.append(np.packbits(marks, bitorder="little").view(np.int64))
    return pd.DataFrame({"sender": blocks["sender"], "owner": blocks["owner"], "marks": words})


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owners: int | None = None) -> DataFrame:
    """One row for each row of ``df``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised bytes are. Null text counts as empty, and all
    empty texts form a group. Of a group the smallest id stays; null ids come last. Of rows
    that repeat both id and text exactly one is kept: rows are numbered as they are written, so every
    reader sees the same numbers, however Spark divides the files. ``owners``: ranges of the hash space;
    by default four for each shuffle partition, so an owner's share shrinks as the cluster
    grows. Other columns are ignored. An empty table gives an empty result.
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    owners = owners or max(16, 4 * shuffle_partitions(spark))
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), normalise(text_col).alias("norm"))
    hashed = texts.select("doc_id", F.sha2("norm", 256).alias("sha"), F.xxhash64("norm").alias("h"))
    sent = scratch.save(hashed.mapInArrow(lean(_sender(owners)), "kind int, row_id long, doc_id long, sha string, h long, sender long, owner int, slot int, twice boolean, payload binary"), "sent", "kind")
    rows = sent.filter("kind = 0").drop("kind", "payload")
    blocks = sent.filter("kind = 1").select("sender", "owner", "payload")
    answers = scratch.save(blocks.groupBy("owner").applyInPandas(_answer, "sender long, owner int, marks array<long>"), "answers")
    marked = rows.join(answers, ["sender", "owner"])
    suspect = F.col("twice") | (F.expr("shiftrightunsigned(marks[cast(slot div 64 as int)], slot % 64) & 1") == 1)
    suspects = scratch.save(marked.filter(suspect).groupBy("h").agg(F.count("*").alias("n")).select("h"), "suspects")
    # The byte check. The list of suspect hashes is broadcast only while it is short.
    side = F.broadcast(suspects) if suspects.count() <= BROADCAST_HASHES else suspects
    checked = texts.withColumn("h", F.xxhash64("norm")).join(side, "h", "left_semi")
    groups = checked.groupBy("norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1")
    groups = scratch.save(groups.select(F.sha2("norm", 256).alias("sha"), "keep_id", "group_size"), "groups")
    out = join_unique(rows.select("doc_id", "sha", "row_id"), groups, "sha", scratch)
    out = out.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        "sha",
        "row_id",
    )
    # Ids that repeat: of the rows with the group's id the first one written is kept.
    first = out.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("group_size") > 1)).groupBy("sha").agg(F.min("row_id").alias("first_row"))
    out = join_unique(out, scratch.save(first, "first"), "sha", scratch)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & ((F.col("group_size") == 1) | (F.col("row_id") == F.col("first_row")))
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"))
