"""Near duplicates among embeddings: NN-descent with folded balls, audited, its threshold edges verified in double precision.

1. Equal vectors become one node with a weight. Windows over a few random orders (sign codes of random directions) give
   each node its first list of neighbours.
2. A round of NN-descent lets the neighbours of each node, in both directions, meet: pairs of them that are nearer than
   what their lists hold enter the lists, if one of them is new there.
3. A list holds LIST neighbours, and beyond them all that can be links. Where it is full of neighbours so near that any
   two of them must be links, the enlarged lists of all these nodes would be the same: they are folded into one ball, whose
   member table is that list, once. Balls stay in the graph as their leaders, with a radius, and fold again. So a group of
   copies that a third of all rows belong to costs a row for each member, not for each pair.
4. Rounds end when they find hardly any new link. Pairs of leaders that the radii decide are links of all members at
   once; the others are compared member by member, in blocks. An audit compares a sample of nodes with all: below the
   recall asked for, lists double, further orders are added and the descent goes on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, join_unique, lean
from .components import connected_components

#: Neighbours of a list beside those that can be links.
LIST = 10
#: Random orders, the sign bits that they sort by, and the rows of a window.
ORDERS, BITS, WINDOW = 3, 32, 48
#: New and old neighbours of each direction that meet at a node in one round; the others wait for the next.
MEET = 10
#: A round that adds at most this share of the links is the last; there are two at least.
FEW = 0.001
#: Nodes that the audit compares with all others, and the share of their links that must have been found.
AUDIT_ROWS, RECALL = 1_000, 0.99
#: What single-precision cosines of the search may be off by; links are decided in double precision.
SLACK = 1e-5
#: Members of a block of the exact comparison, and vectors that are broadcast at once.
BLOCK, WIDE_ROWS, WIDE_SHARE = 256, 5_000, 1e-4
#: Pairs a task gathers before it reduces them to the lists' best.
GATHER = 500_000


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The flat values of a list column and where each row's begin (one more at the end)."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False), offsets


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the rows of each vector length."""
    values, offsets = _vectors(column)
    lengths = np.diff(offsets)
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield rows, values[offsets[rows][:, None] + np.arange(d)]


def _coder(order: int):
    """mapInArrow body: (node, block, x, r) with the sign code of the given random order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[int, np.ndarray] = {}
        for b in batches:
            code = np.zeros(b.num_rows, np.int64)
            for rows, x in _by_length(b.column(2)):
                d = x.shape[1]
                if d not in directions:
                    directions[d] = np.random.default_rng([11, order, d]).standard_normal((d, BITS)).astype(np.float32)
                code[rows] = (x @ directions[d] > 0) @ (1 << np.arange(BITS, dtype=np.int64))[::-1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(code)], names=[*b.schema.names, "code"])

    return run


_EDGE = pa.schema([("src", pa.int64()), ("dst", pa.int64()), ("sim", pa.float32()), ("link", pa.bool_())])
_EDGE_SQL = "src long, dst long, sim float, link boolean"


def _best(src: np.ndarray, dst: np.ndarray, sim: np.ndarray, link: np.ndarray, size: int) -> pa.RecordBatch:
    """Of each src the ``size`` nearest dst and its links, each once."""
    order = np.lexsort((dst, -sim, src))
    src, dst, sim, link = src[order], dst[order], sim[order], link[order]
    once = np.ones(len(src), bool)
    once[1:] = (src[1:] != src[:-1]) | (dst[1:] != dst[:-1])
    src, dst, sim, link = src[once], dst[once], sim[once], link[once]
    starts = np.flatnonzero(np.r_[True, src[1:] != src[:-1]]) if len(src) else np.zeros(0, np.int64)
    rank = np.arange(len(src)) - np.repeat(starts, np.diff(np.r_[starts, len(src)]))
    keep = (rank < size) | link
    return pa.RecordBatch.from_arrays([pa.array(src[keep]), pa.array(dst[keep]), pa.array(sim[keep], pa.float32()), pa.array(link[keep])], schema=_EDGE)


def _windows(size: int, window: int, angle: float):
    """mapInArrow body over rows in a random order: the nearest neighbours of each within its window and block."""

    def edges(nodes: np.ndarray, blocks: np.ndarray, values: np.ndarray, offsets: np.ndarray, r: np.ndarray) -> Iterator[tuple]:
        starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
        for s, e in zip(starts, np.r_[starts[1:], len(nodes)]):
            if e - s < 2:
                continue
            x = values[offsets[s] : offsets[e]].reshape(e - s, -1)
            sims = x @ x.T
            np.fill_diagonal(sims, -np.inf)
            top = np.argpartition(-sims, min(size, e - s - 1) - 1, axis=1)[:, : min(size, e - s - 1)]
            i = np.repeat(np.arange(e - s), top.shape[1])
            j = top.ravel()
            sim = sims[i, j]
            yield nodes[s + i], nodes[s + j], sim, sim >= np.cos(np.minimum(np.pi, angle + r[s + i] + r[s + j])) - SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            t = pa.Table.from_batches([b] if held is None else [held, b]).combine_chunks()
            whole = t.num_rows - t.num_rows % window
            for at in range(0, whole, window):
                yield from made(t.slice(at, window))
            rest = t.slice(whole).combine_chunks()
            held = rest.to_batches()[0] if rest.num_rows else None
        if held is not None:
            yield from made(pa.Table.from_batches([held]))

    def made(t: pa.Table) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(t.to_batches()).combine_chunks()
        x = pa.concat_arrays([pa.array([], t["x"].type), *t["x"].chunks])
        values, offsets = _vectors(x)
        found = list(edges(t["node"].to_numpy(), t["block"].to_numpy(), values, offsets, t["r"].to_numpy()))
        if found:
            yield _best(*(np.concatenate(c) for c in zip(*found)), size)

    return run


def _meeting(size: int, angle: float):
    """mapInArrow body over (v, u, fresh, x, r, low), sorted by v: the pairs of a node's neighbours that improve a list."""

    def pairs(u: np.ndarray, fresh: np.ndarray, x: np.ndarray, r: np.ndarray, low: np.ndarray) -> list[tuple]:
        order = np.lexsort((~fresh, u))
        first = order[np.r_[True, u[order][1:] != u[order][:-1]]]
        u, fresh, x, r, low = u[first], fresh[first], x[first], r[first], low[first]
        i, j = np.triu_indices(len(u), 1)
        new = fresh[i] | fresh[j]
        i, j = i[new], j[new]
        sim = (x @ x.T)[i, j]
        link = sim >= (np.cos(np.minimum(np.pi, angle + r[i] + r[j])) if r.any() else math.cos(angle)) - SLACK
        there, back = (sim > low[i]) | link, (sim > low[j]) | link
        return [(u[i[there]], u[j[there]], sim[there], link[there]), (u[j[back]], u[i[back]], sim[back], link[back])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found, n = None, [], 0
        for b in _with_end(batches):
            t = pa.Table.from_batches([x for x in (held, b) if x is not None]).combine_chunks() if (held is not None or b is not None) else None
            if t is None or not t.num_rows:
                continue
            v = t["v"].to_numpy()
            starts = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
            last = len(v) if b is None else starts[-1]
            u, fresh, r, low = (t[c].to_numpy() for c in ("u", "fresh", "r", "low"))
            values, offsets = _vectors(pa.concat_arrays([pa.array([], t["x"].type), *t["x"].chunks]))
            for s, e in zip(starts, np.r_[starts[1:], len(v)]):
                if e > last:
                    break
                if e - s > 1 and fresh[s:e].any():
                    own = pairs(u[s:e], fresh[s:e], values[offsets[s] : offsets[e]].reshape(e - s, -1), r[s:e], low[s:e])
                    found += own
                    n += sum(len(p[0]) for p in own)
                if n >= GATHER:
                    yield _best(*(np.concatenate(c) for c in zip(*found)), size)
                    found, n = [], 0
            rest = pa.Table.from_batches(t.slice(last).to_batches()).combine_chunks() if last < len(v) else None
            held = rest.to_batches()[0] if rest is not None else None
        if found:
            yield _best(*(np.concatenate(c) for c in zip(*found)), size)

    return run


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from (b for b in batches if b.num_rows)
    yield None


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


class _Descent:
    """The neighbour graph: points (node, block, x, r), edges (src, dst, sim, link, fresh, place), members (node, lead)."""

    def __init__(self, nodes: DataFrame, angle: float, scratch: Scratch):
        self.nodes, self.angle, self.scratch = nodes, angle, scratch
        self.size, self.meet, self.window, self.orders, self.step = LIST, MEET, WINDOW, 0, 0
        # Members of a ball are within half the angle of its leader, so any two of them are links.
        self.reach = math.cos(angle / 2 - 1e-6)
        self.points = self.save(nodes.select("node", "block", F.transform("x", lambda v: v.cast("float")).alias("x"), F.lit(0.0).alias("r")), "points")
        self.members = self.save(nodes.select("node", F.col("node").alias("lead")), "members")
        self.edges = None

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.step += 1
        return self.scratch.save(df, f"{name}{self.step}")

    def lists(self, edges: DataFrame, name: str = "edges") -> DataFrame:
        """Each src's nearest ``size`` neighbours and all that can be links; an edge that is old anywhere is old."""
        once = edges.groupBy("src", "dst").agg(F.max("sim").alias("sim"), F.max("link").alias("link"), F.min("fresh").alias("fresh"))
        placed = once.withColumn("place", F.row_number().over(Window.partitionBy("src").orderBy(F.desc("sim"), "dst")))
        return self.save(placed.filter((F.col("place") <= self.size) | F.col("link")), name)

    def widen(self) -> None:
        """Add the neighbours of some more random orders."""
        found = []
        for order in range(self.orders, self.orders + ORDERS):
            coded = self.points.mapInArrow(lean(_coder(order)), "node long, block string, x array<float>, r double, code long")
            placed = coded.withColumn("tie", F.xxhash64("node", F.lit(order))).repartitionByRange("block", "code", "tie").sortWithinPartitions("block", "code", "tie")
            found.append(placed.select("node", "block", "x", "r").mapInArrow(lean(_windows(self.size, self.window, self.angle)), _EDGE_SQL).withColumn("fresh", F.lit(True)))
        self.orders += ORDERS
        for other in found[1:]:
            found[0] = found[0].union(other)
        if self.edges is not None:
            found[0] = found[0].union(self.edges.select("src", "dst", "sim", "link", "fresh"))
        self.edges = self.lists(found[0])

    def longer(self) -> None:
        """Double the lists, what meets at a node, and the windows."""
        self.size, self.meet, self.window = 2 * self.size, 2 * self.meet, 2 * self.window

    def links(self) -> int:
        return self.edges.filter("link").count()

    def descend(self) -> None:
        """One round: neighbours of neighbours meet."""
        chance = lambda c: F.xxhash64(c, F.lit(self.step))
        turn = F.row_number().over(Window.partitionBy("src", "fresh").orderBy(chance("dst"), "dst"))
        ranked = self.edges.withColumn("turn", turn)
        ahead = ranked.filter(F.col("turn") <= self.meet).select(F.col("src").alias("v"), F.col("dst").alias("u"), "fresh")
        behind = self.edges.select(F.col("dst").alias("v"), F.col("src").alias("u"), "fresh")
        behind = behind.withColumn("turn", F.row_number().over(Window.partitionBy("v", "fresh").orderBy(chance("u"), "u"))).filter(F.col("turn") <= self.meet).drop("turn")
        meet = ahead.union(behind)
        meet = meet.join(meet.filter("fresh").select("v").distinct(), "v", "left_semi")
        low = self.edges.filter(F.col("place") == self.size).select(F.col("src").alias("node"), F.col("sim").alias("low"))
        side = self.points.join(low, "node", "left").select(F.col("node").alias("u"), "x", "r", F.coalesce("low", F.lit(-2.0).cast("float")).alias("low"))
        rows = meet.join(side, "u").select("v", "u", "fresh", "x", "r", "low").repartition("v").sortWithinPartitions("v")
        found = rows.mapInArrow(lean(_meeting(self.size, self.angle)), _EDGE_SQL).withColumn("fresh", F.lit(True))
        kept = ranked.select("src", "dst", "sim", "link", (F.col("fresh") & (F.col("turn") > self.meet)).alias("fresh"))
        self.edges = self.lists(kept.union(found))
        self.scratch.release()

    def fold(self) -> None:
        """Fold saturated lists into balls, again and again while that takes more than a few."""
        while True:
            tight = self.edges.filter(F.col("sim") >= self.reach).select("src", "dst")
            full = self.save(tight.groupBy("src").count().filter(F.col("count") >= LIST).select(F.col("src").alias("node")), "full")
            n = full.count()
            if not n or self._fold_once(tight, full) <= n * 0.01:
                return
            self.scratch.release()

    def _fold_once(self, tight: DataFrame, full: DataFrame) -> int:
        rank = lambda c: F.xxhash64(c, F.lit(self.step))
        both = tight.union(tight.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        near = both.groupBy("src").agg(F.min(F.struct(rank("dst").alias("rank"), F.col("dst").alias("dst"))).alias("m"))
        up = F.when(F.col("m.rank") < rank("src"), F.col("m.dst")).otherwise(F.col("src"))
        parents = self.save(near.select(F.col("src").alias("node"), up.alias("up")).join(full, "node", "left_semi"), "parents")
        for _ in range(2):
            above = parents.select(F.col("node").alias("up"), F.col("up").alias("next"))
            parents = self.save(join_unique(parents, above, "up").select("node", F.coalesce("next", "up").alias("up")), "parents")
        wish = parents.filter("node <> up")
        wish = self.save(wish.join(wish.select(F.col("node").alias("up")), "up", "left_anti").select(F.col("node").alias("lead"), "up"), "wish")
        # A ball moves only if all its members are within reach of the new leader.
        moved = self.save(join_unique(self.members, wish, "lead").filter("up IS NOT NULL"), "moved")
        heads = self.save(self.nodes.join(wish.select(F.col("up").alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias("up"), F.col("x").alias("y")), "heads")
        placed = join_unique(moved.join(self.nodes.select("node", "x"), "node"), heads, "up", most=WIDE_ROWS, share=WIDE_SHARE)
        judged = placed.withColumn("cos", _dot("x", "y")).groupBy("lead", "up").agg(F.min("cos").alias("cos"))
        taken = self.save(judged.filter(F.col("cos") >= self.reach), "taken")
        n = taken.count()
        if not n:
            return 0
        goes = taken.select("lead", "up")
        self.members = self.save(join_unique(self.members, goes, "lead").select("node", F.coalesce("up", "lead").alias("lead")), "members")
        wide = taken.groupBy(F.col("up").alias("node")).agg(F.acos(F.least(F.min("cos"), F.lit(1.0))).alias("wider"))
        left = self.points.join(taken.select(F.col("lead").alias("node")), "node", "left_anti")
        self.points = self.save(left.join(wide, "node", "left").select("node", "block", "x", F.greatest("r", F.coalesce("wider", F.lit(0.0))).alias("r")), "points")
        to = lambda c, new: goes.select(F.col("lead").alias(c), F.col("up").alias(new))
        edges = self.edges.join(to("src", "s"), "src", "left").join(to("dst", "d"), "dst", "left")
        pairs = edges.filter("s IS NOT NULL OR d IS NOT NULL").select(F.coalesce("s", "src").alias("src"), F.coalesce("d", "dst").alias("dst")).filter("src <> dst")
        pairs = pairs.union(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
        x = self.points.select("node", "x")
        pairs = pairs.join(x.select(F.col("node").alias("src"), "x"), "src").join(x.select(F.col("node").alias("dst"), F.col("x").alias("y")), "dst")
        again = pairs.select("src", "dst", _dot("x", "y").cast("float").alias("sim"), F.lit(True).alias("fresh"))
        edges = edges.filter("s IS NULL AND d IS NULL").select("src", "dst", "sim", "fresh").union(again)
        ball = self.points.filter("r > 0").select("node", "r")
        edges = edges.join(ball.select(F.col("node").alias("src"), F.col("r").alias("rs")), "src", "left").join(ball.select(F.col("node").alias("dst"), F.col("r").alias("rd")), "dst", "left")
        far = F.least(F.lit(math.pi), F.lit(self.angle) + F.coalesce("rs", F.lit(0.0)) + F.coalesce("rd", F.lit(0.0)))
        self.edges = self.lists(edges.select("src", "dst", "sim", (F.col("sim") >= F.cos(far) - SLACK).alias("link"), "fresh"))
        return n

    def refine(self) -> None:
        """Descend until a round finds hardly any new link."""
        self.fold()
        had, rounds = self.links(), 0
        while True:
            self.descend()
            self.fold()
            have, rounds = self.links(), rounds + 1
            if rounds >= 2 and have - had <= FEW * have:
                return
            had = have


def _block_links(cosine: float):
    """mapInArrow body over pairs of blocks (a, a_nodes, a_weights, a_x, b, ...): the members' links over the pair."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("node", pa.int64()), ("more", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, y = np.array(row["ax"]), np.array(row["bx"])
                hit = x @ y.T >= cosine
                rows = [(row["an"], hit @ np.array(row["bw"])), (row["bn"], np.array(row["aw"]) @ hit)]
                node, more = np.concatenate([n for n, _ in rows]), np.concatenate([m for _, m in rows]).astype(np.int64)
                some = more > 0
                k = int(some.sum())
                if k:
                    yield pa.RecordBatch.from_arrays([pa.array([row["a"]] * k, pa.int64()), pa.array([row["b"]] * k, pa.int64()), pa.array(node[some].astype(np.int64)), pa.array(more[some])], schema=schema)

    return run


def _linked(graph: _Descent, cosine: float) -> tuple[DataFrame, DataFrame]:
    """Links of each node (node, n_links) and its component (node, comp: a node of it), from the graph's edges."""
    scratch, angle, nodes = graph.scratch, graph.angle, graph.nodes
    pairs = graph.edges.filter("link").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
    x, r = nodes.select("node", "x"), graph.points.select("node", "r")
    pairs = pairs.join(x.select(F.col("node").alias("a"), "x"), "a").join(x.select(F.col("node").alias("b"), F.col("x").alias("y")), "b")
    pairs = pairs.join(r.select(F.col("node").alias("a"), F.col("r").alias("ra")), "a").join(r.select(F.col("node").alias("b"), F.col("r").alias("rb")), "b")
    pairs = graph.save(pairs.select("a", "b", "ra", "rb", _dot("x", "y").alias("cos")), "pairs")
    between, wide = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("cos")))), F.col("ra") + F.col("rb")
    alone = wide == 0
    sure = F.when(alone, F.col("cos") >= cosine).otherwise(between + wide <= angle - 1e-9)
    open_ = ~alone & ~sure & (between - wide <= angle + 1e-9)
    weights = graph.members.join(nodes.select("node", "weight"), "node")
    weights = graph.save(weights, "weights")
    mass = graph.save(weights.groupBy("lead").agg(F.sum("weight").alias("mass"), F.count("*").alias("size")), "mass")
    linked = pairs.filter(sure).select("a", "b")
    ends = linked.select(F.col("a").alias("lead"), F.col("b").alias("other")).union(linked.select("b", "a"))
    gained = ends.join(mass.select(F.col("lead").alias("other"), "mass"), "other").groupBy("lead").agg(F.sum("mass").alias("gained"))
    leads = graph.save(mass.join(gained, "lead", "left").select("lead", (F.col("mass") - 1 + F.coalesce("gained", F.lit(0))).alias("base")), "leads")
    undecided = graph.save(pairs.filter(open_).select("a", "b"), "undecided")
    base = join_unique(weights.select("node", "lead"), leads, "lead")
    if undecided.isEmpty():
        counts = base.select("node", F.col("base").alias("n_links"))
    else:
        ball = undecided.select(F.col("a").alias("lead")).union(undecided.select("b")).distinct()
        parts = mass.join(ball, "lead", "left_semi").select("lead", F.ceil(F.col("size") / BLOCK).cast("long").alias("parts"))
        parts = graph.save(parts, "parts")
        held = join_unique(weights, parts, "lead").filter("parts IS NOT NULL").join(x, "node")
        held = held.groupBy("lead", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part")).agg(F.collect_list(F.struct("node", "weight", "x")).alias("m"))
        held = graph.save(held.select("lead", "m.node", "m.weight", "m.x"), "blocks")
        side = lambda p: held.select(F.col("lead").alias(p), F.col("node").alias(f"{p}n"), F.col("weight").alias(f"{p}w"), F.col("x").alias(f"{p}x"))
        found = graph.save(undecided.join(side("a"), "a").join(side("b"), "b").mapInArrow(lean(_block_links(cosine)), "a long, b long, node long, more long"), "found")
        own = found.groupBy("node").agg(F.sum("more").alias("more"))
        counts = base.join(own, "node", "left").select("node", (F.col("base") + F.coalesce("more", F.lit(0))).alias("n_links"))
        linked = linked.union(found.select("a", "b").distinct())
    comps = graph.save(connected_components(linked, scratch, f"cc{graph.step}"), "comps")
    comp = join_unique(weights.select("node", F.col("lead").alias("node_")), comps.select(F.col("node").alias("node_"), "comp"), "node_").select("node", F.coalesce("comp", "node_").alias("comp"))
    return graph.save(counts, "counts"), graph.save(comp, "comp")


def _audit(nodes: DataFrame, counts: DataFrame, cosine: float) -> float:
    """The share found of the links of AUDIT_ROWS nodes, which are compared with all."""
    picked = nodes.orderBy(F.xxhash64("node", F.lit("audit")), "node").limit(AUDIT_ROWS)
    sample = picked.collect()
    blocks: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for block in {r["block"] for r in sample}:
        own = [r for r in sample if r["block"] == block]
        blocks[block] = (np.array([r["node"] for r in own]), np.array([r["x"] for r in own]))
    sent = nodes.sparkSession.sparkContext.broadcast(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        true: dict[str, np.ndarray] = {}
        for b in batches:
            names, weights = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy()
            for rows, x in _by_length(b.column(2)):
                for block in set(names[rows]) & set(sent.value):
                    at = names[rows] == block
                    hits = weights[rows][at] @ (x[at] @ sent.value[block][1].T >= cosine)
                    true[block] = true.get(block, 0) + hits
        for block, hits in true.items():
            yield pa.RecordBatch.from_arrays([pa.array(sent.value[block][0]), pa.array(hits.astype(np.int64))], names=["node", "true"])

    true = nodes.select("block", "weight", "x").mapInArrow(lean(run), "node long, true long").groupBy("node").agg((F.sum("true") - 1).alias("true"))
    both = counts.join(F.broadcast(true), "node").agg(F.sum(F.least("true", "n_links")).alias("found"), F.sum("true").alias("all")).first()
    return both["found"] / both["all"] if both["all"] else 1.0


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.93, recall: float = RECALL) -> DataFrame:
    """One row for each row of ``df``: vec_id, n_links, component_id, kept, audit_recall.

    Rows link when their labels are equal and not null, their vectors have the same length, and their cosine, in double
    precision, is at least ``cosine``. Vectors that are null, empty or zero, or hold null or non-finite entries, link with
    nothing. ``n_links`` counts the rows linked directly, rows that repeat included; component_id is the smallest id
    reachable. Ids may repeat or be null: each row counts for itself, null ids are never the smallest, and a component without
    ids has none. ``kept``: the id is the component's (both null count). ``audit_recall`` is the share found of the links of
    AUDIT_ROWS nodes that were compared with all; below ``recall`` the search goes on with longer lists, which end as whole
    ones. Other columns are ignored; an empty table gives an empty result.
    """
    scratch = Scratch(df.sparkSession)
    angle = math.acos(cosine)
    c = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), c.alias("c"))
    scale = F.array_max(F.transform("c", F.abs))
    fine = F.coalesce(F.col("label").isNotNull() & (F.size("c") > 0) & F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & (scale > 0), F.lit(False))
    rows = rows.withColumn("scale", F.when(fine, scale)).withColumn("c", F.transform("c", lambda v: v / F.col("scale")))
    rows = rows.withColumn("norm", F.sqrt(F.aggregate("c", F.lit(0.0), lambda s, v: s + v * v))).withColumn("x", F.transform("c", lambda v: v / F.col("norm")))
    key = F.when(F.col("scale").isNotNull(), F.concat_ws(".", F.hex(F.xxhash64(F.lit(1), "label", "x")), F.hex(F.xxhash64(F.lit(2), "label", "x"))))
    block = F.concat_ws("|", F.size("x").cast("string"), "label")
    rows = scratch.save(rows.select(F.monotonically_increasing_id().alias("row_id"), "vec_id", key.alias("key"), block.alias("block"), "x"), "rows")
    alike = rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("row_id").alias("row_id"), F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    nodes = scratch.save(rows.select("row_id", "block", "x").join(alike, "row_id").withColumnRenamed("row_id", "node"), "nodes")
    if nodes.isEmpty():
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"), F.lit(1.0).alias("audit_recall"))
    n_nodes = nodes.count()
    graph = _Descent(nodes.select("node", "block", "weight", "x"), angle, scratch)
    while True:
        graph.widen()
        graph.refine()
        counts, comp = _linked(graph, cosine)
        share = _audit(graph.nodes, counts, cosine)
        if share >= recall or graph.size >= n_nodes:
            break
        graph.longer()
    # Rows find their node by the vectors' hash; a vector that very many rows repeat is a hot key.
    least = comp.join(nodes.select("node", "least"), "node")
    smallest = scratch.save(least.groupBy("comp").agg(F.min("least").alias("component_id")), "smallest")
    of_node = join_unique(comp, smallest, "comp").join(counts, "node").join(nodes.select("node", "key"), "node")
    of_node = scratch.save(of_node.select("key", "n_links", "component_id"), "of_node")
    out = join_unique(rows.select("vec_id", "key"), of_node, "key")
    some = F.col("key").isNotNull()
    out = out.select("vec_id", F.when(some, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"), F.when(some, F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"), F.lit(share).alias("audit_recall"))
