"""Document fingerprints: I-Match over several randomised lexicons.

The lexicon is the terms whose document frequency lies in a band, so whose inverse document
frequency does. A text's distinct terms in the lexicon are sorted and hashed, once with
the whole lexicon and once with each of several random parts of it. Large parts agree only for
near copies, thin parts also where much of a text was edited. Two fingerprints are alike by
the share of agreeing hashes among the parts that have a term of either text. DataFrame functions only.

As a term of the band occurs in at least LOW of the documents, the lexicon has at most
(distinct terms of a mean document) / LOW terms, however many documents there are. It goes to the
tasks as a Bloom filter of SLOTS bits and PROBES probes: of the terms outside the band a share of
(1 - exp(-PROBES * terms / SLOTS)) ** PROBES counts as inside, the same ones in every text; with 150,000
terms, those of a mean document of 150 distinct ones, 1 in 3,500, and with none lost that is inside.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, text_of

#: Band of document frequencies, as shares of the documents; terms of a single document never count.
LOW, HIGH = 0.001, 0.1
SLOTS, PROBES = 1 << 22, 4
#: Bits of a character of the filter, which is kept as ASCII.
CHAR_BITS = 7
#: Shares of the lexicon that the hashes of a fingerprint keep; the first is of the whole lexicon.
SHARES = ((1, 1), *((2, 3),) * 5, *((1, 8),) * 6, *((1, 32),) * 8)
NULL_ID = -(2**63)


def terms(text: Column) -> Column:
    """Hashes of the distinct terms of a text: runs of letters and digits, lower-cased."""
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]++"))
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def band_counts(docs: DataFrame, low: float, high: float) -> DataFrame:
    """(term) of the lexicon of ``docs`` (text)."""
    n = docs.count()
    counts = docs.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return counts.filter((F.col("df") >= max(2.0, low * n)) & (F.col("df") <= max(2.0, high * n))).select("term")


def _slot(t: Column, probe: int, slots: int) -> Column:
    """Slot of a term's hash: the probes step through the slots by an odd number that depends on the hash."""
    step = F.shiftrightunsigned(t, 31).bitwiseOR(F.lit(1))
    return F.pmod(t.bitwiseAND(F.lit(0x7FFFFFFF)) + step * probe if probe else t.bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(slots))


def bit_map(lexicon: DataFrame, slots: int, probes: int = PROBES) -> bytes:
    """slots / CHAR_BITS characters, bit i % CHAR_BITS of character i / CHAR_BITS set if a term has slot i.

    Its size is fixed, so the driver can hold it.
    """
    slot = F.explode(F.array(*(_slot(F.col("term"), k, slots) for k in range(probes))))
    chars = lexicon.select(slot.alias("slot")).groupBy(F.floor(F.col("slot") / CHAR_BITS).cast("int").alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1, cast(slot % {CHAR_BITS} as int))")).alias("bits")).toArrow()
    out = np.zeros(slots // CHAR_BITS + 1, np.uint8)
    out[chars["at"].to_numpy()] = chars["bits"].to_numpy()
    return out.tobytes()


def _in_lexicon(bits: bytes, slots: int, probes: int = PROBES):
    every = F.lit(bits)

    def inside(t: Column) -> Column:
        found = F.lit(True)
        for k in range(probes):
            slot = _slot(t, k, slots)
            char = F.ascii(F.substring(every, F.floor(slot / CHAR_BITS).cast("int") + 1, F.lit(1)).cast("string"))
            found = found & (F.call_function("getbit", char, (slot % CHAR_BITS).cast("int")) == 1)
        return found

    return inside


def _parts(shares: tuple[tuple[int, int], ...]) -> tuple[int, list[tuple[int, int, int, int]]]:
    """How many 64-bit hashes of a term say which parts it is in, and of each part the hash, its bits there (shift, mask) and
    the number that these stay below: a share of a power of two takes just its bits, any other ten."""
    out, word, used = [], 0, 0
    for share, of in shares:
        bits = of.bit_length() - 1 if of & (of - 1) == 0 else 10
        if used + bits > 64:
            word, used = word + 1, 0
        out.append((word, used, (1 << bits) - 1, share if of == 1 << bits else round(share * (1 << bits) / of)))
        used += bits
    return word + 1, out


def with_fingerprint(df: DataFrame, text: str, out: str, bits: bytes, slots: int, shares: tuple[tuple[int, int], ...]) -> DataFrame:
    """``df`` with ``out``, an array of hashes, null for a part without a term of the text.

    The first is never null: without a term of the lexicon it is of all terms, without terms of the text.
    """
    every = f"{out}_every"
    known = f"{out}_known"
    words, parts = _parts(shares[1:])
    df = df.withColumn(every, F.array_sort(terms(F.col(text))))
    marked = lambda t: F.struct(t.alias("t"), *(F.xxhash64(t, F.lit(k)).alias(f"h{k}") for k in range(words)))
    df = df.withColumn(known, F.transform(F.filter(every, _in_lexicon(bits, slots)), marked))
    rest = F.when(F.size(every) > 0, F.xxhash64(F.lit("terms"), F.col(every))).otherwise(F.xxhash64(F.lit("text"), F.col(text)))

    def kept(word: int, shift: int, mask: int, below: int) -> Column:
        return F.filter(known, lambda x: F.shiftrightunsigned(x[f"h{word}"], shift).bitwiseAND(F.lit(mask)) < below)

    hashes = [F.xxhash64(kept(*p)) for p in parts]
    none = F.xxhash64(F.expr(f"cast(array() AS array<struct<t:bigint,{','.join(f'h{k}:bigint' for k in range(words))}>>)"))
    return df.withColumn(out, F.array(F.when(F.size(known) > 0, F.xxhash64(known)).otherwise(rest), *(F.nullif(h, none) for h in hashes))).drop(every, known)


def likeness(a: Column, b: Column) -> Column:
    """Share of hashes that agree, among those that either fingerprint has."""
    points = F.zip_with(a, b, lambda x, y: F.when(x == y, 1).when(x.isNotNull() | y.isNotNull(), 0))
    return F.size(F.filter(points, lambda p: p == 1)) / F.size(F.filter(points, lambda p: p.isNotNull()))


def as_text(a: Column) -> Column:
    """Hashes in hexadecimal, 0 for null, joined by hyphens."""
    return F.array_join(F.transform(a, lambda x: F.coalesce(F.lpad(F.lower(F.hex(x)), 16, "0"), F.lit("0"))), "-")


def ring(keys: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, half, next_key) for ``keys`` (key: long, distinct; half): the next smaller key; after the smallest the largest.

    Keys are range-partitioned, so no task orders them all; only each partition's largest key is collected.
    """
    placed = scratch.save(keys.repartitionByRange(F.desc("key")).withColumn("part", F.spark_partition_id()), "placed")
    tops = sorted((r.part, r.top) for r in placed.groupBy("part").agg(F.max("key").alias("top")).collect())
    follow = [(p, tops[(i + 1) % len(tops)][1]) for i, (p, _) in enumerate(tops)]
    after = keys.sparkSession.createDataFrame(follow, "part int, after long")
    linked = placed.withColumn("lead", F.lead("key").over(Window.partitionBy("part").orderBy(F.desc("key"))))
    return linked.join(F.broadcast(after), "part").select("key", "half", F.coalesce("lead", "after").alias("next_key"))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: float = LOW, high: float = HIGH, slots: int = SLOTS, shares: tuple[tuple[int, int], ...] = SHARES) -> DataFrame:
    """One row for each row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last floor(n / 2) code points replaced by the first as
    many (or all) of the next document's, by descending id; after the last comes the first. A
    null id counts as the smallest (-2^63, which is read as null), null text as empty. Rows that repeat an id share their next
    document; where that id repeats, it is the row whose text has the smallest SHA-256. Equal texts have
    equal fingerprints. Other columns are ignored. An empty table gives an empty result.
    """
    scratch = Scratch(df.sparkSession)
    # The text is shuffled once: both joins below read one exchange of (key, text), so no other column may be in it.
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("key"), text_of(text_col).alias("text"))
    bits = bit_map(band_counts(docs, low, high), slots)
    keys = scratch.save(docs.groupBy("key").agg(F.max(F.floor(F.length("text") / 2)).cast("int").alias("half"), F.count("*").alias("n")), "keys")
    chain = scratch.save(ring(keys.select("key", "half"), scratch), "chain")
    repeated = keys.agg(F.max("n")).first()[0]
    single = docs.select("key", "text")
    if repeated and repeated > 1:
        single = single.groupBy("key").agg(F.min_by("text", F.sha2("text", 256)).alias("text"))
    heads = single.select(F.col("key").alias("next_key"), "text").join(chain, "next_key").select("key", F.expr("left(text, half)").alias("head"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = docs.join(heads, "key").select("key", "text", n.cast("long").alias("n_chars"), F.concat(F.substr("text", F.lit(1), n - half), F.substr("head", F.lit(1), half)).alias("edited"))
    marked = with_fingerprint(with_fingerprint(edited, "text", "own", bits, slots, shares), "edited", "other", bits, slots, shares)
    marked = scratch.save(marked.select("key", "n_chars", F.sha2("text", 256).alias("sha"), F.sha2("edited", 256).alias("edited_sha256"), "own", "other"), "marked")
    nexts = marked.select(F.col("key").alias("next_key"), "own", "sha")
    if repeated and repeated > 1:
        nexts = nexts.groupBy("next_key").agg(F.min_by("own", "sha").alias("own"))
    nexts = nexts.join(chain, "next_key").select("key", F.col("own").alias("next_own"))
    out = marked.join(nexts, "key")
    doc_id = F.when(F.col("key") != NULL_ID, F.col("key")).alias("doc_id")
    return out.select(doc_id, "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"))
