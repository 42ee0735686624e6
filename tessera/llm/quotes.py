"""Quotation linking: reply trees from quoted passages, and messages without their quotes.

A line that begins with quote marks (>) belongs to a quote of that level. Every quoted line and
passage is normalised and hashed, and looked up among the hashed own lines and passages of all messages; the
message that holds most lines of a message's outermost quote that any holds is its parent. Messages without
such a parent reply to the turn before. Trees are ordered by depth, conversation and turn.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch, join_unique, text_of

#: Words that a line needs for its hash to say where it is from.
LEAST_WORDS = 3
#: Holders of a key up to which each is a candidate by itself.
COMMON = 50
ORDER_COLUMNS = ("root", "depth", "conv_id", "turn", "row_id")


def parsed_lines(text: Column) -> Column:
    """Array of (level, body, key) of a text's lines: quote depth, the line without marks, its normalised hash.

    key is null for lines with fewer than LEAST_WORDS words. Marks may have blanks between them.
    """
    lines = F.split(text, "\r\n|\n|\r")

    def parse(line: Column) -> Column:
        marks = F.regexp_extract(line, r"^(?:[ \t]*+>)*+", 0)
        level = F.length(F.regexp_replace(marks, r"[^>]", ""))
        body = F.when(level > 0, F.regexp_replace(F.substr(line, F.length(marks) + 1), r"^[ \t]", "")).otherwise(line)
        plain = F.trim(F.regexp_replace(F.lower(body), r"[^\p{L}\p{N}]++", " "))
        long = F.size(F.split(plain, " ")) >= LEAST_WORDS
        return F.struct(level.cast("int").alias("level"), body.alias("body"), F.when(long, F.xxhash64(plain)).alias("key"))

    return F.transform(lines, parse)


def _roots(parents: DataFrame, scratch: Scratch) -> DataFrame:
    """(head, root, depth) of a forest (head, parent or null, step: links from a head to its parent) by pointer doubling.

    ``root`` is a struct and so is each of the others but step. In every round only heads that haven't reached a root are joined,
    with what their pointers point at; log(depth) rounds.
    """
    at = scratch.save(parents.select("head", F.coalesce("parent", "head").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(F.col("step")).cast("long").alias("depth"), F.col("parent").isNull().alias("done")), "up0")
    step = 0
    while not at.filter("NOT done").isEmpty():
        over = at.select(F.col("head").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("done").alias("over"))
        step += 1
        moved = at.filter("NOT done").join(over, "up").select("head", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), F.col("over").alias("done"))
        new = scratch.save(at.filter("done").unionByName(moved), f"up{step}")
        scratch.drop(f"up{step - 1}")
        at = new
    return at.select("head", F.col("up").alias("root"), "depth")


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Running number of each row among its root's rows so far in this partition (rows come sorted), and the place where its run begins.

    ``starts`` marks the rows that begin a run; -1 stands for a run that began before this partition.
    """
    last, seen, run = None, 0, -1
    for b in batches:
        if not len(b):
            continue
        place = b.groupby("root", sort=False).cumcount()
        first = b["root"] == last
        if first.iloc[0]:
            place[first] += seen
        begun = place.where(b["starts"]).groupby(b["root"], sort=False).ffill()
        if first.iloc[0]:
            begun[first] = begun[first].fillna(run)
        begun = begun.fillna(-1).astype("int64")
        last, seen, run = b["root"].iloc[-1], int(place.iloc[-1]) + 1, int(begun.iloc[-1])
        yield b.assign(place=place.astype("int64"), begun=begun)


def positions(rows: DataFrame, scratch: Scratch, starts: Column | None = None, name: str = "counted") -> DataFrame:
    """``rows`` with position, the rank within root by ORDER_COLUMNS, from 0, and run, the position of the last row before or at
    it for which ``starts`` holds (null where there is none).

    Rows are range-partitioned, so one thread may span many tasks. Each counts its own rows; what precedes
    a thread that goes on from earlier partitions is added from one row per partition.
    """
    names = [*ORDER_COLUMNS]
    given = [c for c in rows.columns if c not in names]
    ranged = rows.select(*names, *given, (F.lit(False) if starts is None else F.coalesce(starts, F.lit(False))).alias("starts")).repartitionByRange(*names).sortWithinPartitions(*names)
    types = dict(ranged.dtypes)
    counted = ranged.mapInPandas(_places, ", ".join([*(f"{c} {types[c]}" for c in ranged.columns), "place long", "begun long"])).withColumn("part", F.spark_partition_id())
    counted = scratch.save(counted, name)
    order = F.struct(*names)
    ends = counted.groupBy("part").agg(F.min("root").alias("first"), F.max_by(F.struct("root", "place", "begun"), order).alias("last")).collect()  # a row for each partition
    before, carried, begun, previous = [], 0, -1, None
    for r in sorted(ends, key=lambda r: r.part):
        goes_on = previous == r["first"]
        before.append((r.part, r["first"], carried if goes_on else 0, begun if goes_on else -1))
        same = goes_on and r["first"] == r["last"].root
        begun = r["last"].begun + (carried if same else 0) if r["last"].begun >= 0 else begun if same else -1
        carried = (carried if same else 0) + r["last"].place + 1
        previous = r["last"].root
    side = F.broadcast(rows.sparkSession.createDataFrame(before, "part int, root long, before long, run_before long"))
    shift = F.coalesce("before", F.lit(0))
    run = F.when(F.col("begun") >= 0, F.col("begun") + shift).when(F.col("run_before") >= 0, F.col("run_before"))
    return counted.join(side, ["part", "root"], "left").select(*names, *given, (F.col("place") + shift).alias("position"), run.alias("run"))


def _first_holders(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """(row_id, source) by one candidate for each quoted line: its first holder in the conversation, else the first of all."""
    me = F.struct("conv_id", "turn", "row_id")
    own = lines.filter("l.level = 0").select(F.col("l.key").alias("key"), "conv_id", me.alias("holder"))
    in_conv = scratch.save(own.groupBy("key", "conv_id").agg(F.min("holder").alias("near")), "in_conv")
    of_all = scratch.save(in_conv.groupBy("key").agg(F.min("near").alias("far")), "of_all")
    quoted = lines.filter("l.level = 1").select(F.col("l.key").alias("key"), "conv_id", "row_id", me.alias("me")).distinct()
    found = quoted.join(in_conv, ["key", "conv_id"], "left").join(of_all, "key", "left")
    near = F.when(F.col("near") < F.col("me"), F.col("near"))
    far = F.when(F.col("far.conv_id") < F.col("conv_id"), F.col("far"))
    votes = found.select("row_id", F.coalesce(near, far).alias("source"), near.isNotNull().cast("int").alias("is_near")).filter("source IS NOT NULL").groupBy("row_id", "source").agg(F.count("*").alias("n"), F.max("is_near").alias("is_near"))
    return votes.groupBy("row_id").agg(F.min(F.struct((-F.col("n")).alias("n"), (-F.col("is_near")).alias("k"), F.col("source"))).alias("x")).select("row_id", "x.source")


def _short(df: DataFrame) -> DataFrame:
    """``df``, broadcast where it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _most_lines(asked: DataFrame, own: DataFrame, scratch: Scratch, common: int = COMMON) -> DataFrame:
    """(q, source, n) of each quote q with a holder: the earlier message that holds most of its lines, n of them.

    ``asked``: q, me, line, key, distinct; a line of a quote is held where one of its keys is. ``own``: key, holder,
    distinct. Of equal holders the first of the conversation of ``me`` comes first, then the first of all.
    Exact: holders of a key that at most ``common`` messages have are scored by all lines. Other holders can only have
    common keys; holders with the same common keys are one profile, of which only the first of all and of each conversation can
    win, and profiles are scored once for each distinct set of common (line, key) that quotes have. So what many messages
    repeat and many quote costs (distinct profiles) x (distinct sets) where these share a key, not holders x quotes.
    """
    asked = scratch.save(asked, "asked")
    own = scratch.save(own.join(_short(asked.select("key").distinct()), "key", "left_semi"), "own")
    held = scratch.save(own.groupBy("key").agg(F.count("*").alias("n_holders")), "held")
    asked = scratch.save(asked.join(_short(held), "key").withColumn("rare", F.col("n_holders") <= common), "asked_held")
    rare_own = own.join(_short(held.filter(F.col("n_holders") <= common).select("key")), "key", "left_semi")
    by_rare = asked.filter("rare").join(rare_own, "key").filter("holder < me").select("q", "me", "line", "holder")
    by_rare = scratch.save(by_rare.distinct(), "by_rare")
    also = by_rare.select("q", "me", "holder").distinct().join(asked.filter("NOT rare").select("q", "line", "key"), "q")
    also = also.join(own, ["key", "holder"], "left_semi").select("q", "me", "line", "holder")
    votes = by_rare.union(also).distinct().groupBy("q", "me", "holder").agg(F.count("*").alias("n"))
    # Sets of common keys. The line numbers of a set start anew, so that equal sets are one.
    sets = asked.filter("NOT rare").groupBy("q", "me", "line").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    sets = sets.groupBy("q", "me").agg(F.sort_array(F.collect_list("keys")).alias("lines"))
    sets = scratch.save(sets.select("q", "me", F.sha2(F.to_json("lines"), 256).alias("set"), "lines"), "sets")
    lines = sets.groupBy("set").agg(F.first("lines").alias("lines")).select("set", F.posexplode("lines").alias("line", "keys")).select("set", "line", F.explode("keys").alias("key"))
    lines = scratch.save(lines, "set_lines")
    shared = own.join(_short(held.filter(F.col("n_holders") > common).select("key")), "key", "left_semi")
    profiles = shared.groupBy("holder").agg(F.sort_array(F.collect_set("key")).alias("keys")).select("holder", F.sha2(F.to_json("keys"), 256).alias("profile"), "keys")
    profiles = scratch.save(profiles, "profiles")
    profile_keys = profiles.groupBy("profile").agg(F.first("keys").alias("keys")).select("profile", F.explode("keys").alias("key"))
    scored = scratch.save(profile_keys.join(_short(lines), "key").groupBy("set", "profile").agg(F.count_distinct("line").alias("n")), "scored")
    firsts = scratch.save(profiles.groupBy("profile", F.col("holder.conv_id").alias("conv_id")).agg(F.min("holder").alias("holder")), "firsts")
    quotes = sets.select("q", "me", "set", F.col("me.conv_id").alias("conv_id"))
    near = scored.join(quotes.select("set", "conv_id").distinct(), "set").join(firsts, ["profile", "conv_id"]).groupBy("set", "n", "conv_id").agg(F.min("holder").alias("holder"))
    near = scratch.save(near, "set_near")
    far = scratch.save(scored.join(firsts.groupBy("profile").agg(F.min("holder").alias("holder")), "profile").groupBy("set", "n").agg(F.min("holder").alias("holder")), "set_far")
    by_set = quotes.join(_short(near), ["set", "conv_id"]).select("q", "me", "holder", "n").union(quotes.join(_short(far), "set").select("q", "me", "holder", "n")).filter("holder < me")
    order = F.struct((-F.col("n")).alias("n"), (F.col("holder.conv_id") != F.col("me.conv_id")).alias("far"), F.col("holder"))
    best = votes.select("q", "me", "holder", "n").union(by_set).groupBy("q").agg(F.min(order).alias("x"))
    return scratch.save(best.select("q", F.col("x.holder").alias("source"), (-F.col("x.n")).alias("n")), "best")


def passages(lines: Column, conv: Column) -> Column:
    """Array of (level, keys, whole) of the passages of parsed lines: runs of lines of one level without blank lines.

    ``keys`` are of its lines, ``whole`` of all its words over line breaks. Characters of scripts without spaces are
    words. Keys of fewer than LEAST_WORDS words, and of lines of signs only, hold within the conversation.
    """

    def said(line: Column) -> Column:
        spaced = F.regexp_replace(F.lower(line["body"]), r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}])", " $1 ")
        plain = F.trim(F.regexp_replace(spaced, r"[^\p{L}\p{M}\p{N}]++", " "))
        return F.when(plain != "", plain).otherwise(F.trim(F.translate(line["body"], "\x01\x02\t", "   ")))

    def key(words: Column) -> Column:
        long = (F.size(F.split(words, " ")) >= LEAST_WORDS) & words.rlike(r"[\p{L}\p{N}]")
        return F.when(long, F.xxhash64(words)).otherwise(F.xxhash64(words, conv))

    def marked(line: Column) -> Column:
        words, level = said(line), line["level"].cast("string")
        return F.when(words != "", F.concat(level, F.lit("\x01"), words, F.lit("\x01"), level)).otherwise("")

    def passage(text: Column) -> Column:
        parts = F.split(text, "\x01")
        words = F.get(parts, F.lit(1))
        keys = F.transform(F.split(words, "\x02"), key)
        return F.struct(F.get(parts, F.lit(0)).cast("int").alias("level"), keys.alias("keys"), key(F.replace(words, F.lit("\x02"), F.lit(" "))).alias("whole"))

    text = F.regexp_replace(F.array_join(F.transform(lines, marked), "\n"), "\x01([0-9]+)\n\\1\x01", "\x02")
    return F.transform(F.filter(F.split(text, "\n"), lambda x: x != ""), passage)


def _every_holder(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(row_id, source) by all holders of the quoted passages of every level.

    A message's source is that of its outermost level that has one. Where a message names none itself, others
    may name it: the source of a deeper level of their quotes is the parent of the source of the level around it.
    """
    me = F.struct("conv_id", "turn", "row_id")
    found = scratch.save(rows.select("row_id", "conv_id", me.alias("me"), F.explode(passages(F.col("lines"), F.col("conv_id"))).alias("p")), "passages")
    quoted = found.filter("p.level > 0").select(F.struct("row_id", "p.level").alias("q"), "me", "p.whole", F.explode("p.keys").alias("line"))
    asked = quoted.select("q", "me", "line", F.explode(F.array("line", "whole")).alias("key")).distinct()
    own = found.filter("p.level = 0").select(F.explode(F.array_union("p.keys", F.array("p.whole"))).alias("key"), F.col("me").alias("holder")).distinct()
    best = _most_lines(asked, own, scratch)
    direct = scratch.save(best.groupBy("q.row_id").agg(F.min(F.struct("q.level", "source")).alias("x")).select("row_id", "x.source"), "direct")
    inner = F.lead("source").over(Window.partitionBy("q.row_id").orderBy("q.level"))
    named = best.select(F.col("source").alias("child"), inner.alias("source")).filter("source < child").groupBy("child", "source").agg(F.count("*").alias("n"))
    order = F.struct((-F.col("n")).alias("n"), (F.col("source.conv_id") != F.col("child.conv_id")).alias("far"), F.col("source"))
    named = named.groupBy(F.col("child.row_id").alias("row_id")).agg(F.min(order).alias("x")).select("row_id", "x.source")
    return direct.union(named.join(direct, "row_id", "left_anti"))


def link_quotes(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", every_holder: bool = False) -> DataFrame:
    """One row for each message: conv_id, turn, role, parent_conv, parent_turn, by_quote, thread_conv, thread_turn, depth, position, n_quoted, clean.

    The parent by quote is the message that holds most lines of the level-1 quotes, of equal ones the
    first in its own conversation, else the first by (conv_id, turn); only messages that come before by
    (conv_id, turn, first read) in the same conversation, or are of another, smaller conv_id, can be parents, so there
    are no cycles. With ``every_holder`` all messages that hold a line count, a line is also held where its passage is,
    whatever its line breaks, deeper levels count where outer ones have no holder, and short lines link within
    their conversation; without it only level 1 and lines of LEAST_WORDS words count, and a line that several hold counts
    for the first holder in the own conversation and, if there is none, for the first of all. Without such a parent a message
    replies to the row before it in its conversation; the first has none. ``clean`` is the text without
    quoted lines. Null text is empty; null conv_id or turn counts as the smallest; repeated rows are
    messages of their own. Other columns are ignored. An empty table gives an empty result.
    """
    scratch = Scratch(df.sparkSession)
    low = F.lit(-(2**63))
    base = df.select(F.coalesce(F.col(conv_col).cast("long"), low).alias("conv_id"), F.coalesce(F.col(turn_col).cast("long"), low).alias("turn"), F.col(role_col).alias("role"), parsed_lines(text_of(text_col)).alias("lines"))
    rows = scratch.save(base.withColumn("row_id", F.monotonically_increasing_id()), "rows")
    lines = rows.select("conv_id", "turn", "row_id", F.explode("lines").alias("l")).filter("l.key IS NOT NULL")
    best = _every_holder(rows, scratch) if every_holder else _first_holders(lines, scratch)
    # Messages that reply to the row before them form runs, found in the order of the rows: no task needs a whole conversation,
    # and only the heads of runs, a quote each or the first of a conversation, are linked to one another.
    said = join_unique(rows.select("row_id", "conv_id", "turn"), scratch.save(best.select("row_id", "source"), "best_of"), "row_id")
    ranked = positions(said.select(F.col("conv_id").alias("root"), F.lit(0).alias("depth"), "conv_id", "turn", "row_id", "source"), scratch, F.col("source").isNotNull(), "ranked_rows")
    message = F.struct("conv_id", "turn", "row_id")
    ranked = scratch.save(ranked.select("row_id", "conv_id", "turn", "source", F.col("position").alias("rank"), F.coalesce("run", F.lit(0)).alias("run")), "ranked")
    before = ranked.select("conv_id", (F.col("rank") + 1).alias("rank"), message.alias("previous"))
    linked = ranked.join(before, ["conv_id", "rank"], "left")
    place = F.struct("conv_id", F.col("run").alias("rank"))
    heads = ranked.filter("rank = run").select(F.struct("conv_id", "rank").alias("head"), message.alias("message"), F.col("source.row_id").alias("up_row"))
    above = ranked.select(F.col("row_id").alias("up_row"), place.alias("parent"), (F.col("rank") - F.col("run") + 1).alias("step"))
    linked_heads = scratch.save(heads.filter("up_row IS NOT NULL").join(above, "up_row").select("head", "parent", "step").unionByName(heads.filter("up_row IS NULL").select("head", F.lit(None).cast("struct<conv_id:bigint,rank:bigint>").alias("parent"), F.lit(0).cast("long").alias("step"))), "heads")
    named = heads.select(F.col("head").alias("root"), F.col("message").alias("thread"))
    trees = scratch.save(_roots(linked_heads, scratch), "roots")
    trees = scratch.save(join_unique(trees, scratch.save(named.join(trees.select("root").distinct(), "root"), "named"), "root").select(F.col("head").alias("run_head"), F.col("depth").alias("above"), "thread"), "trees")
    placed = join_unique(linked.withColumn("run_head", place), trees, "run_head", scratch)
    placed = scratch.save(placed.select("row_id", "conv_id", "turn", F.coalesce("source", "previous").alias("parent"), F.col("source").isNotNull().alias("by_quote"), F.col("thread.row_id").alias("root"), F.col("thread.conv_id").alias("thread_conv"), F.col("thread.turn").alias("thread_turn"), (F.col("above") + F.col("rank") - F.col("run")).alias("depth")), "placed")
    order = positions(placed, scratch, name="order").drop("conv_id", "turn", "run", "root")
    out = order.join(rows, "row_id")
    clean = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["body"]), "\n")
    given = lambda c: F.when(c != low, c)
    return out.select(
        given(F.col("conv_id")).alias("conv_id"),
        given(F.col("turn")).alias("turn"),
        "role",
        given(F.col("parent.conv_id")).alias("parent_conv"),
        given(F.col("parent.turn")).alias("parent_turn"),
        "by_quote",
        given(F.col("thread_conv")).alias("thread_conv"),
        given(F.col("thread_turn")).alias("thread_turn"),
        "depth",
        "position",
        F.size(F.filter("lines", lambda x: x["level"] > 0)).alias("n_quoted"),
        clean.alias("clean"),
    )
