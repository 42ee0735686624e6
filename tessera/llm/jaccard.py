"""Similarity join of shingle sets by a partition of the universe (exact).

For two sets with Jaccard similarity >= t, the smaller of x items, at most
D = floor(x (1 - t) / t) items are in one set only. Sizes fall into bands; a band's scheme hashes
the universe into segments. Some segments are looked up as they are (worth 1), others with
their one-deletion neighbourhood as well (worth 2). Where the values add up to D + 1, two similar
sets must agree in one segment: as wholes, or up to one item (pigeonhole). For each
band a cost model over the counts of all documents picks how many segments have neighbourhoods.

A segment's key is the sum of its items' mixed hashes, so each deletion costs one
subtraction. Sets are compared as classes of equal sets. Within a key, members are first
compared with its smallest member, and components are formed; then only pairs whose
components still differ. A group of thousands of near copies thus costs a few
comparisons for each member, and no link between components is lost. Segments that hold nothing are
no keys, for some more segments (see allocate). Where a key has many
members of different components (texts that share one half), and among LARGE sets, of which any two may
share a segment of few items and whose parity maps rule out little, two that link also share one of their rarest
items, as many as may be missing from the other and one more: only members that do are paired.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch, ascii_lower, join_unique, lean, text_of, words_of
from .components import connected_components

#: Members up to which all pairs of a key are looked at; the members of larger keys are paired by their rarest items.
HOT_MEMBERS = 500
#: Counters of items, by hash, that say which items are rare (8 bytes each).
COUNTERS = 1 << 20
#: Words of 64 bits of a set's parity map. It rules out pairs of sets up to about 2,000 items.
MAP_WORDS = 16
#: Sets with more items than LARGE have a second, wider map, used for pairs of such sets only.
LARGE, WIDE_WORDS = 1_500, 128
#: Cost of ruling out a pair of sets by size and parity map, in signatures sent.
PAIR_COST = 0.1
#: Keys that a task combines at a time.
COMBINE_KEYS = 500_000
BAND_RATIO = 1.25
#: Items that a worker signs at a time.
SIGN_ITEMS = 100_000
NULL_ID = -(2**63)
MAP = tuple(f"b{k}" for k in range(MAP_WORDS))


def _bounds() -> np.ndarray:
    """Lower size of each band."""
    out = [1]
    while out[-1] < 2**31:
        out.append(max(out[-1] + 1, math.ceil(out[-1] * BAND_RATIO)))
    return np.array(out, np.int64)


BOUNDS = _bounds()


def differing(band: int, percent: int) -> int:
    """Items that one of two similar sets of a band may have beyond the other, both counted together: D."""
    most = int(BOUNDS[band + 1] - 1) if band + 1 < len(BOUNDS) else int(BOUNDS[band])
    return most * (100 - percent) // percent


def allocate(band: int, percent: int, sets: float, deletions: str = "cost") -> tuple[int, int]:
    """(segments, how many of them have neighbourhoods) of a band that ``sets`` sets use.

    The segments' values add up to D + 1 and a slack. A set whose segments without content are worth no more than the
    slack needs no keys of such segments (see _signer). More slack costs more keys and saves the pairs that share only
    emptiness. ``deletions``: "cost" for the cheapest, "none" or "all" to force one end.
    """
    differ = differing(band, percent)
    slacks = np.unique(np.concatenate([np.arange(12), np.geomspace(12, 12 + differ / 4, 20).astype(np.int64)]))
    with_d = np.unique(np.concatenate([[0], np.geomspace(1, max(1, (differ + 1) // 2), 200).astype(np.int64)]))[: (differ + 1) // 2 + 1]
    if deletions == "none" or not differ:
        with_d = with_d[:1]
    elif deletions == "all":
        with_d = with_d[-1:]
    slack, with_d = (x.ravel() for x in np.meshgrid(slacks, with_d))
    segments = differ + 1 + slack - with_d
    size = float(BOUNDS[band]) * (1 + BAND_RATIO) / 2
    mean = size / segments
    lone = np.exp(-mean)
    rows = (segments - with_d) + with_d * (2 + mean)
    chance = (segments - with_d) * lone**2 + with_d * (lone * (1 + mean)) ** 2
    # Share of sets with more worth of segments without content than the slack, by a normal tail.
    hollow = (segments - with_d) * lone + 2 * with_d * lone * (1 + mean)
    spread = np.sqrt(hollow + 2 * with_d * lone * (1 + mean)) + 1e-9
    loud = np.array([math.erfc(z / math.sqrt(2)) / 2 for z in (slack + 0.5 - hollow) / spread])
    best = int(np.argmin(sets * rows + PAIR_COST * sets**2 / 2 * chance * loud**2))
    return int(segments[best]), int(with_d[best])


def with_shingles(df: DataFrame, text_col: str, words: int, keep: list[Column]) -> DataFrame:
    """``keep`` columns and ``items``: the distinct shingles of ``text_col`` as 64-bit hashes."""
    w = df.select(*keep, words_of(ascii_lower(text_of(text_col))).alias("w__"))
    names = [c for c in w.columns if c != "w__"]
    at = ", ".join(f"w__[i + {k}]" for k in range(words))
    items = F.expr(f"CASE WHEN size(w__) = 0 THEN cast(array() AS array<bigint>) WHEN size(w__) < {words} THEN array(xxhash64(w__)) ELSE array_distinct(transform(sequence(0, size(w__) - {words}), i -> xxhash64({at}))) END")
    return w.select(*names, items.alias("items"))


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of each list of a flat uint64 array, modulo 2^64."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[at[1:]] - total[at[:-1]]


def _identity(items: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mixed items, and two independent 64-bit hashes of each list as a set."""
    t = _mix(items)
    return t, _sums(t, at), _sums(_mix(t ^ np.uint64(0x5851F42D4C957F2D)), at)


def _lists(b: pa.RecordBatch, column: int, most: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with at most ``most`` list items, one row at least: rows, items, offsets."""
    offsets = b.column(column).offsets.to_numpy()
    at = 0
    while at < b.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        part = b.slice(at, end - at)
        values = part.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        yield part, values, offsets[at : end + 1].astype(np.int64) - int(offsets[at])
        at = end


def _as_lists(doc: np.ndarray, values: np.ndarray, docs: int) -> pa.ListArray:
    order = np.argsort(doc, kind="stable")
    ends = np.cumsum(np.bincount(doc, minlength=docs))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values[order].view(np.int64)))


def _signer(percent: int, segments: np.ndarray, with_d: np.ndarray, slack: np.ndarray):
    """mapInArrow body: (doc_id, items) -> doc_id, n, set identity, parity map, keys, keys of deletions.

    Two similar sets agree in segments worth D + 1 + slack - D at least. Segments without content, empty ones and ones of a
    single item that a deletion empties, agree with all others of the kind. Where those of one of the two sets are worth no more than
    the slack, they agree in another segment too. So only sets with more send keys without content, and two of them still meet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b, items, at in _lists(whole, 1, SIGN_ITEMS):
                docs, n = b.num_rows, np.diff(at)
                doc = np.repeat(np.arange(docs), n)
                t, h1, h2 = _identity(items, at)
                place = _mix(items ^ np.uint64(0xD6E8FEB86659FD93))
                del items
                bits = np.zeros(docs * MAP_WORDS, np.uint64)
                np.bitwise_xor.at(bits, doc * MAP_WORDS + (place >> np.uint64(60)).astype(np.int64), np.uint64(1) << ((place >> np.uint64(54)) & np.uint64(63)))
                bits = bits.reshape(docs, MAP_WORDS).T
                rank = np.cumsum(n > LARGE) - 1
                big = n[doc] > LARGE
                wide = np.zeros(int((n > LARGE).sum()) * WIDE_WORDS, np.uint64)
                np.bitwise_xor.at(wide, rank[doc[big]] * WIDE_WORDS + (place[big] >> np.uint64(57)).astype(np.int64), np.uint64(1) << ((place[big] >> np.uint64(51)) & np.uint64(63)))
                wide_at = np.concatenate([[0], np.cumsum(np.where(n > LARGE, WIDE_WORDS, 0))]).astype(np.int32)
                high = np.searchsorted(BOUNDS, n, "right") - 1
                low = np.searchsorted(BOUNDS, -(-n * percent // 100), "right") - 1
                keys, key_doc, gone, gone_doc = [], [], [], []
                for k in range(int((high - low).max(initial=0)) + 1):
                    band = np.where((n > 0) & (low + k <= high), low + k, -1)
                    m = np.where(band >= 0, segments[band], 0)
                    base = np.concatenate([[0], np.cumsum(m)])
                    in_use = m[doc] > 0
                    d, x = doc[in_use], t[in_use]
                    seg = ((place[in_use] & np.uint64(0xFFFFFFFF)) * m[d].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
                    cell = base[d] + seg
                    sums = np.zeros(base[-1], np.uint64)
                    np.add.at(sums, cell, x)
                    cell_doc = np.repeat(np.arange(docs), m)
                    place_in = np.arange(base[-1]) - base[cell_doc]
                    salt = _mix((place_in + (band[cell_doc] << 40)).astype(np.uint64))
                    held = np.bincount(cell, minlength=base[-1])
                    deep = place_in < with_d[band[cell_doc]]
                    # A set is loud if its segments without content (that agree with any other such) may be all that agree with a similar one.
                    hollow = np.bincount(cell_doc, np.where(deep, 2 * (held <= 1), held == 0), docs)
                    loud = hollow >= np.where(band >= 0, slack[band] + 1, 0)
                    take = (held > 0) | loud[cell_doc]
                    keys.append(_mix(sums ^ salt)[take])
                    key_doc.append(cell_doc[take])
                    drop = (seg < with_d[band[d]]) & ((held[cell] > 1) | loud[d])
                    gone.append(_mix((sums[cell[drop]] - x[drop]) ^ salt[cell[drop]]))
                    gone_doc.append(d[drop])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), *(pa.array(np.ascontiguousarray(x).view(np.int64)) for x in bits), pa.ListArray.from_arrays(pa.array(wide_at), pa.array(wide.view(np.int64))), _as_lists(np.concatenate(key_doc), np.concatenate(keys), docs), _as_lists(np.concatenate(gone_doc), np.concatenate(gone), docs)],
                    names=["doc_id", "n", "h1", "h2", *MAP, "wide", "keys", "gone"],
                )

    return run


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body: (node, keys, gone) -> deal, node, whole, key, center.

    A key that one node of this task has goes out as it is: dealt by the key, without key and center. Of a key that
    several nodes here have, only the smallest node, its local center, goes out that way; all of them
    stay beside it as (key, center), dealt by key and node. However many nodes share a key, other tasks get one row of each task.
    """

    def emit(node: np.ndarray, key: np.ndarray, whole: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((node, key))
        node, key, whole = node[order], key[order], whole[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        start = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        many = np.diff(np.append(start, len(key)))[group] > 1
        center = node[start][group]
        deal = np.concatenate([key[new], _mix(key[many].view(np.uint64) ^ _mix(node[many].view(np.uint64))).view(np.int64)])
        none = int(new.sum())
        mask = np.concatenate([np.ones(none, bool), np.zeros(int(many.sum()), bool)])
        pad = np.zeros(none, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(deal), pa.array(np.concatenate([node[new], node[many]])), pa.array(np.concatenate([whole[new], whole[many]])), pa.array(np.concatenate([pad, key[many]]), mask=mask), pa.array(np.concatenate([pad, center[many]]), mask=mask)],
            names=["deal", "node", "whole", "key", "center"],
        )

    held, n = [], 0
    for b in batches:
        for column, whole in ((1, True), (2, False)):
            lists = b.column(column)
            keys = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            held.append((np.repeat(b.column(0).to_numpy(), np.diff(lists.offsets.to_numpy())), keys, np.full(len(keys), whole)))
            n += len(keys)
        if n >= COMBINE_KEYS:
            yield from _chunks(emit(*map(np.concatenate, zip(*held, strict=True))))
            held, n = [], 0
    if n:
        yield from _chunks(emit(*map(np.concatenate, zip(*held, strict=True))))


def _chunks(b: pa.RecordBatch, rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, b.num_rows, rows):
        yield b.slice(at, rows)


def _identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body: items -> n, h1, h2, items."""
    for whole in batches:
        for b, items, at in _lists(whole, 0, SIGN_ITEMS):
            _, h1, h2 = _identity(items, at)
            yield pa.RecordBatch.from_arrays([pa.array(np.diff(at)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), b.column(0)], names=["n", "h1", "h2", "items"])


def jaccard_components(df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", deletions: str = "cost") -> DataFrame:
    """One row for each row of ``df``: doc_id, n_shingles, component_id, first.

    Two rows link when 100 * |intersection| >= percent * |union| of their sets of distinct
    ``words``-word shingles (words: runs of other than ASCII white space, A-Z lower-cased; a text
    with fewer words is one shingle). component_id is the smallest doc_id that links reach.
    Texts without words (null, empty, blank) link with nothing: their component is their own id.
    Rows with a repeated id are rows of their own, and link if alike; null ids lose against others, and a
    component of null ids only has a null component_id. ``first`` is true for one row of each
    component, of the smallest id. Shingles are compared as 64-bit hashes and equal sets found by 128-bit ones.
    Other columns are ignored. An empty table gives an empty result.
    """
    scratch = Scratch(df.sparkSession)
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    blanks = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1
    counts = docs.groupBy(F.floor(F.log(blanks.cast("double")) / math.log(BAND_RATIO)).cast("int").alias("k")).count().collect()
    sizes = np.zeros(len(BOUNDS))
    for k, n in counts:
        sizes[np.clip(np.searchsorted(BOUNDS, BAND_RATIO**k, "right") - 1, 0, len(BOUNDS) - 1)] += n
    used = sizes + np.append(sizes[1:], 0) / 2
    schemes = [allocate(b, percent, used[b], deletions) for b in range(len(BOUNDS) - 1)]
    segments, with_d = (np.array(x, np.int64) for x in zip(*schemes, strict=True))
    slack = segments + with_d - 1 - np.array([differing(b, percent) for b in range(len(BOUNDS) - 1)], np.int64)
    signed = with_shingles(docs, "text", words, [F.col("doc_id")]).mapInArrow(lean(_signer(percent, segments, with_d, slack)), "doc_id long, n long, h1 long, h2 long, " + ", ".join(f"{c} long" for c in MAP) + ", wide array<long>, keys array<long>, gone array<long>")
    sets = scratch.save(signed.withColumn("row_id", F.monotonically_increasing_id()), "sets")

    classes = scratch.save(sets.filter("n > 0").groupBy("n", "h1", "h2").agg(F.min("row_id").alias("node"), F.min("doc_id").alias("min_doc")), "classes")
    nodes = sets.join(classes.select(F.col("node").alias("row_id")), "row_id", "left_semi")
    meta = scratch.save(nodes.select(F.col("row_id").alias("node"), "n", "h1", "h2", F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), *MAP, "wide"), "meta")
    dealt = nodes.select("row_id", "keys", "gone").mapInArrow(lean(_postings), "deal long, node long, whole boolean, key long, center long")
    same = Window.partitionBy("deal")
    met = dealt.select("*", F.min("node").over(same).alias("low"), F.max("node").over(same).alias("high")).filter("key IS NOT NULL OR low < high")
    shared = scratch.save(met.select(F.coalesce("key", "deal").alias("key"), "whole", "node", F.coalesce("center", "low").alias("center")), "shared")
    rows = scratch.save(sets.select("row_id", "doc_id", "n", "h1", "h2"), "rows")
    scratch.drop("sets")
    scratch.release()

    def items_of(members: DataFrame, name: str) -> DataFrame:
        """(node, items) of ``members`` (node), from their texts."""
        known = scratch.save(meta.join(members, "node").select("node", "n", "h1", "h2", "doc_id"), f"{name}known")
        side = F.broadcast if known.count() <= BROADCAST_ROWS else lambda df: df  # else the same joins shuffle
        ids = known.select(F.col("doc_id").alias("id_key")).distinct()
        texts = docs.withColumn("id_key", F.coalesce("doc_id", F.lit(NULL_ID))).join(side(ids), "id_key", "left_semi")
        found = with_shingles(texts, "text", words, []).mapInArrow(lean(_identify), "n long, h1 long, h2 long, items array<long>")
        # A repeated id may bring a node's items twice, and so a link twice, which changes nothing.
        items = scratch.save(found.join(side(known), ["n", "h1", "h2"]).select("node", "items"), f"{name}items")
        scratch.drop(f"{name}known")
        return items

    def compared(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) of nodes that link."""
        first = scratch.save(plausible(with_meta(pairs, meta), percent).select("a", "b", "n_a", "n_b").distinct(), f"{name}first")
        both_large = (F.col("n_a") > LARGE) & (F.col("n_b") > LARGE)
        wide = first.filter(both_large)
        for side in ("a", "b"):
            wide = wide.join(meta.filter(F.col("n") > LARGE).select(F.col("node").alias(side), F.col("wide").alias(f"wide_{side}")), side)
        differ = F.aggregate(F.zip_with("wide_a", "wide_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
        wide = wide.filter(differ * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent))
        pairs = scratch.save(first.filter(~both_large).select("a", "b").union(wide.select("a", "b")), f"{name}pairs")
        short = pairs.count() <= BROADCAST_ROWS
        side = F.broadcast if short else lambda df: df
        items = items_of(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), name)
        of_a = items.select(F.col("node").alias("a"), F.col("items").alias("of_a")).join(side(pairs), "a")
        of_b = items.select(F.col("node").alias("b"), F.col("items").alias("of_b")).join(side(pairs.select("b").distinct()), "b", "left_semi")
        both = of_a.join(of_b, "b")
        common = both.select("a", "b", (F.size("of_a") + F.size("of_b")).alias("total"), F.size(F.array_intersect("of_a", "of_b")).alias("common"))
        links = scratch.save(common.filter(F.col("common") * (100 + percent) >= F.col("total") * percent).select("a", "b"), f"{name}links")
        scratch.drop(f"{name}first", f"{name}pairs", f"{name}items")
        scratch.release()
        return links

    # First each node with the center that it shares most keys with, then with its other centers.
    stars = scratch.save(shared.filter("node <> center").groupBy("node", "center").count(), "stars")
    best = stars.groupBy("node").agg(F.max(F.struct("count", (-F.col("center")).alias("c"))).alias("x")).select(F.col("node").alias("a"), (-F.col("x.c")).alias("b"))
    links = compared(best, "best")
    comps = scratch.save(connected_components(links, scratch, "best_cc"), "best_comps")

    def comp_of(rows: DataFrame, node: str, out: str) -> DataFrame:
        c = comps.select(F.col("node").alias(node), F.col("comp").alias(out))
        return rows.join(c, node, "left").withColumn(out, F.coalesce(out, F.col(node)))

    def merge(more: DataFrame, name: str) -> DataFrame:
        ends = comp_of(comp_of(more, "a", "ca"), "b", "cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).filter("a <> b")
        over = comps.select(F.col("node").alias("a"), F.col("comp").alias("b")).filter("a <> b")
        return scratch.save(connected_components(over.union(ends), scratch, f"{name}_cc"), f"{name}_comps")

    others = comp_of(comp_of(stars.select(F.col("node").alias("a"), F.col("center").alias("b")), "a", "ca"), "b", "cb").filter("ca <> cb").select("a", "b")
    comps = merge(compared(others, "star"), "star")
    # Then, within keys that still hold several components, each pair of which the components differ.
    placed = comp_of(shared, "node", "comp")
    mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
    left = scratch.save(placed.join(mixed, "key").join(meta.drop("h1", "h2", "doc_id", "wide"), "node"), "left")
    counted = left.groupBy("key").count()
    hot_keys = scratch.save(counted.filter(F.col("count") > HOT_MEMBERS).select("key"), "hot_keys")
    few = left.join(F.broadcast(hot_keys) if hot_keys.count() <= BROADCAST_ROWS else hot_keys, "key", "left_anti")
    a = few.select("key", *(F.col(c).alias(f"{c}_a") for c in ("node", "whole", "comp", "n", *MAP)))
    b = few.select("key", *(F.col(c).alias(f"{c}_b") for c in ("node", "whole", "comp", "n", *MAP)))
    rest = plausible(a.join(b, "key").filter(f"node_a < node_b AND comp_a <> comp_b AND (whole_a OR whole_b) AND NOT (n_a > {LARGE} AND n_b > {LARGE})"), percent)
    rest = rest.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    members = left.join(hot_keys, "key", "left_semi").union(left.filter(F.col("n") > LARGE)).select("node", "comp", "n", *MAP).distinct()
    members = scratch.save(members, "members")
    if not members.isEmpty():
        rest = rest.union(by_rarest(members, items_of(members.select("node"), "hot"), percent, scratch))
    comps = merge(compared(rest.distinct(), "rest"), "rest")

    # The result of each class, then of each row of it.
    of_class = scratch.save(comp_of(classes, "node", "comp"), "of_class")
    least = scratch.save(of_class.groupBy("comp").agg(F.min("min_doc").alias("component_id")), "least")
    of_class = scratch.save(join_unique(of_class, least, "comp", scratch).select("node", "comp", "component_id"), "of_node")
    set_of = F.struct("n", "h1", "h2").alias("set")
    by_set = scratch.save(classes.select("node", set_of).join(of_class, "node").drop("node"), "by_set")
    out = join_unique(rows.select("row_id", "doc_id", "n", set_of), by_set, "set")
    own = F.col("n") == 0
    out = scratch.save(out.select("row_id", "doc_id", "n", F.when(own, F.col("row_id")).otherwise(F.col("comp")).alias("comp"), F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")), "out")
    first = scratch.save(out.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("comp").agg(F.min("row_id").alias("first_row")), "first")
    scratch.drop("shared", "left", "stars", "rare", "by_rarest", "classes", "meta", "rows", "members", "hotitems", "hot_keys", "of_class", "of_node", "by_set", "least")
    return join_unique(out, first, "comp", scratch).select("doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("row_id") == F.col("first_row")).alias("first"))


def _rarest(percent: int, holders: np.ndarray):
    """mapInArrow body: (node, items) -> node, item, after: the first items of a set in the order of ``holders``, then of the hashes.

    ``after`` is the number of the set's items from this one on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b, items, at in _lists(whole, 1, SIGN_ITEMS):
                n = np.diff(at)
                row = np.repeat(np.arange(b.num_rows), n)
                order = np.lexsort((items, holders[(items % np.uint64(len(holders))).astype(np.int64)], row))
                place = np.arange(len(items)) - np.repeat(at[:-1], n)
                take = place <= (n - (n * percent + 99) // 100)[row]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row[take])), pa.array(items[order][take].view(np.int64)), pa.array((n[row] - place)[take])], names=["node", "item", "after"])

    return run


def by_rarest(members: DataFrame, items: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of ``members`` (node, comp, n, parity map) of different components that share one of their rarest items.

    ``items``: (node, items). Two sets that link miss at most n - ceil(n * percent / 100) of the n items of either. So of each,
    in one order of all items, the first that many and one more hold a common item, whatever the order. It goes by how many
    members have an item, counted in COUNTERS hashed counters: what all share comes last, and what few share forms few pairs.
    Of the first item that two linking sets have in common, all others come after it in both, and they have
    percent / (100 + percent) of the two sizes together, so ``after`` is no less in either. The join compares parity maps as well: a pair that they rule out is never a row. For the smaller set alone that is twice this share
    of its own size: only items with as much after them lead, and sets that share less than a link needs don't meet in what they share.
    """
    counter = F.col("item").bitwiseAND(F.lit(COUNTERS - 1)).cast("int")  # COUNTERS is a power of two
    counts = items.select(F.explode("items").alias("item")).groupBy(counter.alias("counter")).agg(F.count("*").alias("n")).toArrow()
    holders = np.zeros(COUNTERS, np.int64)
    holders[counts["counter"].to_numpy()] = counts["n"].to_numpy()
    rare = items.mapInArrow(lean(_rarest(percent, holders)), "node long, item long, after long").distinct()
    leads = F.col("after") * (100 + percent) >= F.col("n") * (2 * percent)
    rare = scratch.save(rare.join(members, "node").withColumn("leads", leads), "rare")
    split = rare.groupBy("item").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("leads").alias("led")).filter("lo < hi AND led").select("item")
    rare = rare.join(split, "item")
    a = rare.filter("leads").select("item", *(F.col(c).alias(f"{c}_a") for c in ("node", "comp", "n", "after", *MAP)))
    b = rare.select("item", *(F.col(c).alias(f"{c}_b") for c in ("node", "comp", "n", "after", *MAP)))
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("node_a") < F.col("node_b")))
    enough = F.least("after_a", "after_b") * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    met = plausible(a.join(b, "item").filter(ordered & (F.col("comp_a") != F.col("comp_b")) & enough), percent)
    return scratch.save(met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct(), "by_rarest")


def with_meta(pairs: DataFrame, meta: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(meta.select(F.col("node").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("n", *MAP))), side)
    return pairs


def plausible(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and parity maps allow a link: each bit that differs is an item of one set only."""
    size = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    bits = sum((F.bit_count(F.col(f"b{k}_a").bitwiseXOR(F.col(f"b{k}_b"))) for k in range(MAP_WORDS)), F.lit(0))
    return pairs.filter(size & (bits * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)))
