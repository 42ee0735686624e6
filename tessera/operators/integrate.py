"""Integration of several sources: priorities, conflicts, derived links, three-way merge of mappings, scopes, checks."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EDITABLE_STATUS = ("drop", "link")
#: What the note of a kept row that the schema no longer has begins with.
STALE = "STALE: no longer in the schema"


def by_priority(rows: DataFrame, keys: list[str], fields: list[str], source: str, ranks: dict[str, dict[str, int]] | dict[str, int], order: Column) -> DataFrame:
    """One row per key: of each field the non-null value of the best-ranked source, ties by ``order``.

    ``ranks``: source -> rank for all fields, or field -> {source: rank}; sources without a rank share the last one.
    Beside each field come <field>_source, and <field>_conflict: whether the winning rank held different values (by the least
    and the greatest of their hashes, so nothing is gathered by key).
    """
    aggs = []
    for f in fields:
        table = ranks.get(f, ranks) if ranks and isinstance(next(iter(ranks.values())), dict) else ranks
        last = max(table.values(), default=0) + 1
        rank = reduce(lambda c, kv: F.when(F.col(source) == kv[0], kv[1]).otherwise(c), table.items(), F.lit(last))
        has = F.col(f).isNotNull() & (F.col(f).cast("string") != "")
        aggs.append(F.min_by(F.when(has, F.struct(F.col(f).alias("v"), F.col(source).alias("s"))), F.when(has, F.struct(rank.alias("r"), order.alias("o")))).alias(f"{f}__"))
        aggs.append(F.min(F.when(has, F.struct(rank.alias("r"), F.xxhash64(f).alias("h")))).alias(f"{f}__low"))
        aggs.append(F.max(F.when(has, F.struct((-rank).alias("r"), F.xxhash64(f).alias("h")))).alias(f"{f}__high"))
    out = rows.groupBy(*keys).agg(*aggs)
    cols = []
    for f in fields:
        differ = F.coalesce(F.col(f"{f}__low.h") != F.col(f"{f}__high.h"), F.lit(False))
        cols += [F.col(f"{f}__.v").alias(f), F.col(f"{f}__.s").alias(f"{f}_source"), differ.alias(f"{f}_conflict")]
    return out.select(*keys, *cols)


def derived_links(*hops: DataFrame) -> DataFrame:
    """(src, dst) of a chain of link tables (src, dst), each pair once."""
    out = hops[0].select("src", "dst")
    for h in hops[1:]:
        out = out.select("src", F.col("dst").alias("via")).join(h.select(F.col("src").alias("via"), "dst"), "via").select("src", "dst").distinct()
    return out.distinct()


def three_way_merge(fresh: DataFrame, disk: DataFrame, base: DataFrame | None, keys: list[str], cells: list[str], status: str = "status") -> DataFrame:
    """Fresh rows with the edits that ``disk`` has over ``base``, and edited rows that fresh no longer has.

    A cell that differs from the base was edited and is kept; a row with edits whose status wasn't
    becomes human (unless drop or link). Without a base, fresh stands for it. Rows gone from fresh stay if the base
    doesn't have them, if they were edited or if they are marked STALE already, as inert rows of status drop; a note, where
    there is one, gets that mark, so the next merge keeps them too. Columns: keys, cells, origin (fresh, edited, stale).
    """
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    side = lambda df, s: df.select(*keys, *(text(F.col(c)).alias(f"{s}_{c}") for c in cells), F.lit(True).alias(f"{s}__"))
    all3 = side(fresh, "f").join(side(disk, "d"), keys, "full_outer").join(side(base if base is not None else fresh, "b"), keys, "left")
    on = lambda s: F.coalesce(F.col(f"{s}__"), F.lit(False))
    before = {c: F.when(on("b"), F.col(f"b_{c}")).when(on("f"), F.col(f"f_{c}")).otherwise(F.lit("")) for c in cells}
    changed = {c: on("d") & (F.col(f"d_{c}") != before[c]) for c in cells}
    any_edit = reduce(lambda a, b: a | b, changed.values())
    stale_mark = F.col("d_note").startswith("STALE") if "note" in cells else F.lit(False)
    keep = on("f") | (on("d") & (~on("b") | any_edit | F.coalesce(stale_mark, F.lit(False))))
    out = {}
    for c in cells:
        kept = F.when(on("f") & changed[c], F.col(f"d_{c}")).when(on("f"), F.col(f"f_{c}")).otherwise(F.col(f"d_{c}"))
        if c == status:
            human = on("f") & any_edit & ~changed[c] & ~kept.isin(*EDITABLE_STATUS)
            kept = F.when(~on("f"), "drop").when(human, "human").otherwise(kept)
        elif c == "note":
            marked = F.concat_ws("; ", F.lit(STALE), F.when(kept != "", kept))
            kept = F.when(~on("f") & ~stale_mark, marked).otherwise(kept)
        out[c] = kept.alias(c)
    origin = F.when(~on("f"), "stale").when(any_edit, "edited").otherwise("fresh")
    return all3.filter(keep).select(*keys, *out.values(), origin.alias("origin"))


def cascade(rows: DataFrame, keys: list[str], candidates: list[tuple[str, DataFrame]], target: str, default: str = "todo") -> DataFrame:
    """Of the tiers' candidates (keys, target) the first tier's for each row; ``default`` without any.

    Within a tier the smallest target wins. Columns: keys, target, tier.
    """
    ranked = [df.select(*keys, F.struct(F.lit(i).alias("i"), F.col(target).alias("t"), F.lit(name).alias("tier")).alias("c")) for i, (name, df) in enumerate(candidates)]
    best = reduce(DataFrame.unionByName, ranked).groupBy(*keys).agg(F.min("c").alias("c"))
    return rows.select(*keys).join(best, keys, "left").select(*keys, F.col("c.t").alias(target), F.coalesce("c.tier", F.lit(default)).alias("tier"))


def in_scope(df: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """Rows whose value ``allowed`` (one column) has, as a semi-join."""
    return df.join(allowed.select(F.col(allowed.columns[0]).alias(column)).distinct(), column, "left_semi")


def restrict(rows: list[dict], cls: str, name: str, values: list[str], prefix: str = "", promote: bool = False) -> tuple[list[dict], str]:
    """Mapping rows with the queried column Class.field restricted to ``values``, and what was done; the input isn't changed.

    Only required columns are restricted, with ``promote`` optional ones too, which become required. Values are
    written as CURIEs where the column already holds some (or ``prefix`` is given), as endings of IRIs where it is cut to a
    local name, else as quoted literals. Beside such a column a constant of the field takes a single value, and goes where
    there are several. Without one nothing changes: "constant" if the field is only a constant, else "absent".
    """
    own = [i for i, r in enumerate(rows) if (r.get("im_class"), r.get("im_field")) == (cls, name)]
    constants = {i for i in own if rows[i].get("kind") == "const"}
    asked = {i for i in own if i not in constants and (promote or rows[i].get("required") == "yes")}
    if not asked:
        return [dict(r) for r in rows], "constant" if constants else "absent"

    def written_values(r: dict) -> str:
        curie = re.match(r"([A-Za-z][\w.-]*):[^/\s\"]", r.get("value") or "")
        if head := curie[1] if curie else prefix:
            return " ".join(f"{head}:{v}" for v in values)
        if r.get("transform") == "iri_localname":
            return " ".join(f'~"{v}"' for v in values)
        return " ".join(v if v.startswith('"') else f'"{v}"' for v in values)

    out = []
    for i, r in enumerate(rows):
        if i in asked:
            out.append({**r, "value": written_values(r), **({"required": "yes"} if promote else {})})
        elif i not in constants:
            out.append(dict(r))
        elif len(values) == 1:
            out.append({**r, "value": values[0]})
    return out, "restricted"


def taxon_scope(rows: list[dict], values: list[str], default: list[str]) -> tuple[list[dict] | None, str]:
    """``restrict`` on Organism.taxonId; unchanged for the default list and for sources without one.

    None (skip) where the taxon is only a constant, which can't be restricted and would be false of other taxa.
    """
    if list(values) == list(default):
        return rows, "default"
    scoped, done = restrict(rows, "Organism", "taxonId", list(values), prefix="taxid")
    if done == "constant":
        return None, "skipped"
    return (scoped, done) if done == "restricted" else (rows, done)


def gene_scope(rows: list[dict], cls: str, name: str, values: list[str]) -> tuple[list[dict] | None, str]:
    """``restrict`` on a source's gene field, optional ones too; None (skip) for a source that doesn't query one."""
    if not values:
        return rows, "default"
    scoped, done = restrict(rows, cls, name, list(values), promote=True)
    return (scoped, done) if done == "restricted" else (None, "skipped")


def merge_priorities(existing: dict[str, list[str]], writers: dict[str, list[str]], replaces: dict[str, str], supplements: dict[str, str | list[str]], overrides: dict[str, list[str]] | None = None) -> dict[str, list[str]]:
    """Priority lists by field.

    What replaces a stock source (``replaces``: new -> stock) stands in its slot, all that do one after the other. A supplement
    (-> stock, or several) comes after the last of its stock sources that are named and the supplements that are there already;
    where none is named they all go before * with it. Other writers go before *. Fields without a list get one only if several sources write them, or,
    ending in *, if a supplement does. ``overrides`` are lists that people set: they stand as they are, whatever was made.
    """
    heirs: dict[str, list[str]] = {}
    for new, old in replaces.items():
        heirs.setdefault(old, []).append(new)

    def slots_of(field: str) -> list[str]:
        names = list(dict.fromkeys(writers.get(field, [])))
        start = existing.get(field, ["*"] if any(n in supplements for n in names) else [])
        slots = list(dict.fromkeys(x for s in start for x in heirs.get(s, [s])))
        for n in (n for n in names if n not in slots):
            given, rest = supplements.get(n, []), slots.index("*") if "*" in slots else len(slots)
            stocks = [given] if isinstance(given, str) else list(given)
            named = [slots.index(x) for x in stocks if x in slots]
            if not named:
                slots[rest:rest] = [*stocks, n]
            else:
                after = max(named) + 1
                while after < len(slots) and slots[after] in supplements:
                    after += 1
                slots[after:after] = [n]
        return slots

    made = [f for f, names in writers.items() if f not in existing and (len(set(names)) > 1 or any(n in supplements for n in names))]
    return {f: slots_of(f) for f in [*existing, *made]} | (overrides or {})


def arranged(stock: list[str], replaces: dict[str, list[str]], alongside: dict[str, str]) -> list[str]:
    """Load order: a source stands where the first that it replaces stood, one alongside another right after it; the replaced go."""
    gone = {x for olds in replaces.values() for x in olds}
    out: list[str] = []
    for s in stock:
        out += [n for n, olds in replaces.items() if next((x for x in stock if x in olds), None) == s]
        if s not in gone:
            out.append(s)
            out += [n for n, beside in alongside.items() if beside == s]
    return out + [n for n in [*replaces, *alongside] if n not in out]


def dangling(links: DataFrame, objects: DataFrame) -> DataFrame:
    """Links (dst) whose target isn't among ``objects`` (id)."""
    return links.join(objects.select(F.col("id").alias("dst")), "dst", "left_anti")


def collisions(columns: DataFrame) -> DataFrame:
    """Groups of columns that write the same field of the same object: (table, im_class, via, im_field, n, columns)."""
    return columns.groupBy("table", "im_class", "via", "im_field").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("column")), ",").alias("columns")).filter("n > 1")


def cross_products(columns: DataFrame) -> DataFrame:
    """Groups of several columns of one predicate in one table, whose values multiply: (table, subject, predicate, n).

    Columns with a filter or a value are told apart by it and don't count.
    """
    plain = reduce(lambda a, b: a & b, (F.coalesce(F.col(c), F.lit("")) == "" for c in ("filter", "value") if c in columns.columns), F.lit(True))
    return columns.filter(plain).groupBy("table", "subject", "predicate").agg(F.count("*").alias("n")).filter("n > 1")


def coverage_gaps(declared: DataFrame, written: DataFrame, accepted: DataFrame) -> DataFrame:
    """(cls, field) that is declared, not written and not accepted as a gap."""
    return declared.select("cls", "field").distinct().join(written, ["cls", "field"], "left_anti").join(accepted, ["cls", "field"], "left_anti")


def violations(**checks: tuple[str, DataFrame]) -> DataFrame:
    """One DataFrame (rule, severity, subject) of all findings; each check gives its severity and a DataFrame."""
    parts = [df.select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), F.concat_ws(".", *df.columns).alias("subject")) for rule, (severity, df) in checks.items()]
    return reduce(DataFrame.unionByName, parts)


def status_counts(rows: DataFrame, by: str, status: str, known: list[str]) -> DataFrame:
    """Rows by status, a column for each known status."""
    return rows.groupBy(by).agg(*(F.count(F.when(F.col(status) == s, 1)).alias(s) for s in known))
