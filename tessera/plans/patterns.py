"""Graph patterns over triples, compiled to one DataFrame plan.

A pattern node is a subject with predicates; required ones are inner joins, optional ones
left joins that multiply rows by their values. Predicates that have one value for each subject can
be read together by a single aggregate over the triples instead of a join for each.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TYPE = "rdf:type"
#: Types that say nothing, so they are not looked up.
UNTYPED = {"rdfs:Resource", "owl:Thing"}


@dataclass(frozen=True)
class Leaf:
    """A predicate whose object is bound to ``var``."""

    predicate: str
    var: str
    optional: bool = False
    values: tuple[str, ...] = ()
    ends_with: tuple[str, ...] = ()


@dataclass(frozen=True)
class Branch:
    """A predicate that leads to another node; optional takes the whole sub-tree or nothing."""

    predicate: str
    node: Node
    optional: bool = False


@dataclass(frozen=True)
class Node:
    var: str
    leaves: tuple[Leaf, ...] = ()
    branches: tuple[Branch, ...] = ()
    types: tuple[str, ...] = ()


@dataclass
class Pattern:
    root: Node
    select: list[str] = field(default_factory=list)
    distinct: bool = True
    graph: str | None = None


def constraint(c: Column, values: tuple[str, ...], ends_with: tuple[str, ...]) -> Column | None:
    tests = ([c.isin(*values)] if values else []) + [c.endswith(e) for e in ends_with]
    return reduce(lambda a, b: a | b, tests) if tests else None


@dataclass(frozen=True)
class TripleTable:
    """A table whose columns are objects of predicates: subject IRIs are ``prefix`` and the subject column, null makes no triple."""

    df: DataFrame
    subject: str
    prefix: str
    predicates: dict[str, str]
    types: tuple[str, ...] = ()


@dataclass(frozen=True)
class Triples:
    """Triples (s, p, o) of tables and of edges (s, o) by predicate, of which ``of`` reads what the asked predicates need only.

    A predicate alone is a projection of two columns, so a pattern over tables becomes joins of their columns; several of
    one table are unpivoted in one pass.
    """

    tables: tuple[TripleTable, ...]
    edges: tuple[tuple[str, DataFrame], ...] = ()

    def of(self, *wanted: str) -> DataFrame:
        """The triples of some predicates, or of all."""
        parts = []
        for t in self.tables:
            s = F.concat(F.lit(t.prefix), F.col(t.subject).cast("string")).alias("s")
            pairs = [(p, F.col(c).cast("string")) for c, p in t.predicates.items() if not wanted or p in wanted]
            pairs += [(TYPE, F.lit(x)) for x in t.types if not wanted or TYPE in wanted]
            if len(pairs) == 1:
                parts.append(t.df.select(s, F.lit(pairs[0][0]).alias("p"), pairs[0][1].alias("o")).filter("o IS NOT NULL"))
            elif pairs:
                every = F.explode(F.array(*(F.struct(F.lit(p).alias("p"), o.alias("o")) for p, o in pairs)))
                parts.append(t.df.select(s, every.alias("x")).select("s", "x.p", "x.o").filter("o IS NOT NULL"))
        parts += [df.select("s", F.lit(p).alias("p"), "o") for p, df in self.edges if not wanted or p in wanted]
        if not parts:
            return self.of().filter(F.lit(False))
        return reduce(DataFrame.unionByName, parts)

    def backward(self, predicate: str, name: str) -> Triples:
        """These triples and ``predicate`` the other way round, called ``name``."""
        return Triples(self.tables, (*self.edges, (name, self.of(predicate).select(F.col("o").alias("s"), F.col("s").alias("o")))))


def required(node: Node) -> bool:
    """Whether a node asks for anything that must be there."""
    return bool(node.types) or any(not x.optional for x in (*node.leaves, *node.branches))


class Compiler:
    """Compiles patterns over ``triples`` (s, p, o[, g]: strings), a DataFrame or ``Triples`` of tables.

    ``single``: predicates with at most one value for each subject; those of a node are gathered in one aggregate.
    """

    def __init__(self, triples: DataFrame | Triples, single: set[str] = frozenset(), graph: str | None = None):
        named = graph and isinstance(triples, DataFrame) and "g" in triples.columns
        self.triples = triples.filter(F.col("g") == graph) if named else triples
        self.single = single

    def of(self, *predicates: str) -> DataFrame:
        """Triples of some predicates, or of all."""
        if isinstance(self.triples, Triples):
            return self.triples.of(*predicates)
        return self.triples.filter(F.col("p").isin(*predicates)) if predicates else self.triples

    def edge(self, predicate: str, s: str, o: str) -> DataFrame:
        return self.of(predicate).select(F.col("s").alias(s), F.col("o").alias(o))

    def _leaf(self, leaf: Leaf, s: str) -> DataFrame:
        out = self.edge(leaf.predicate, s, leaf.var)
        test = constraint(F.col(leaf.var), leaf.values, leaf.ends_with)
        return out if test is None else out.filter(test)

    def node(self, node: Node) -> DataFrame:
        """Bindings of a node and all below it."""
        star = [x for x in node.leaves if x.predicate in self.single]
        rest = [x for x in node.leaves if x.predicate not in self.single]
        parts: list[tuple[DataFrame, bool]] = []
        if star and (len(star) > 1 or not any(not x.optional for x in rest)):
            wanted = self.of(*(x.predicate for x in star))
            rows = wanted.groupBy(F.col("s").alias(node.var)).agg(*(F.max(F.when(F.col("p") == x.predicate, F.col("o"))).alias(x.var) for x in star))
            for x in star:
                test = constraint(F.col(x.var), x.values, x.ends_with)
                if test is not None and x.optional:
                    rows = rows.withColumn(x.var, F.when(test, F.col(x.var)))
                elif not x.optional:
                    rows = rows.filter(F.col(x.var).isNotNull() if test is None else test)
            parts.append((rows, all(x.optional for x in star)))
        else:
            rest = list(node.leaves)
        parts += [(self._leaf(x, node.var), x.optional) for x in rest]
        for b in node.branches:
            below = self.node(b.node)
            parts.append((self.edge(b.predicate, node.var, b.node.var).join(below, b.node.var), b.optional))
        types = [t for t in node.types if t not in UNTYPED]
        base = None
        if types:
            base = self.of(TYPE).filter(F.col("o").isin(*types)).select(F.col("s").alias(node.var)).distinct()
        for df, optional in sorted(parts, key=lambda x: x[1]):  # what is required first
            if base is None:
                base = df if not optional else self.of().select(F.col("s").alias(node.var)).distinct().join(df, node.var, "left")
            else:
                base = base.join(df, node.var, "left" if optional else "inner")
        return base if base is not None else self.of().select(F.col("s").alias(node.var)).distinct()

    def run(self, pattern: Pattern) -> DataFrame:
        out = self.node(pattern.root).select(*pattern.select)
        return out.distinct() if pattern.distinct else out


def satellites(pattern: Pattern) -> dict[str, Pattern]:
    """A pattern as one pattern for each of its root's optional branches and one for the rest.

    Branches of many values asked for together would multiply each other; apart, each has its own rows beside the root's required ones.
    """
    root = pattern.root
    keys = tuple(x for x in root.leaves if not x.optional)
    own = [root.var, *(x.var for x in keys)]
    main = Node(root.var, root.leaves, tuple(b for b in root.branches if not b.optional), root.types)
    out = {"main": Pattern(main, [c for c in pattern.select if c in _vars(main)], pattern.distinct)}
    for b in root.branches:
        if b.optional:
            node = Node(root.var, keys, (Branch(b.predicate, b.node, False),), root.types)
            picked = [c for c in pattern.select if c in _vars(b.node)]
            if picked:
                out[b.node.var] = Pattern(node, [*(c for c in own if c in pattern.select), *picked], pattern.distinct)
    return out


def _vars(node: Node) -> set[str]:
    return {node.var, *(x.var for x in node.leaves)}.union(*(_vars(b.node) for b in node.branches))


def to_sparql(pattern: Pattern, prefixes: dict[str, str] | None = None) -> str:
    """The pattern as SPARQL text."""
    lines = [f"PREFIX {k}: <{v}>" for k, v in (prefixes or {}).items()]
    lines.append(f"SELECT {'DISTINCT ' if pattern.distinct else ''}{' '.join('?' + v for v in pattern.select)}")
    if pattern.graph:
        lines.append(f"FROM <{pattern.graph}>")
    lines.append("WHERE {")

    def emit(node: Node, pad: str) -> None:
        for t in [t for t in node.types if t not in UNTYPED]:
            lines.append(f"{pad}?{node.var} a {t} .")
        for x in node.leaves:
            inner = f"?{node.var} {x.predicate} ?{x.var} ."
            if x.values:
                inner += " VALUES ?" + x.var + " { " + " ".join(f'"{v}"' for v in x.values) + " }"
            if x.ends_with:
                inner += " FILTER(" + " || ".join(f'STRENDS(STR(?{x.var}), "{e}")' for e in x.ends_with) + ")"
            lines.append(f"{pad}OPTIONAL {{ {inner} }}" if x.optional else pad + inner)
        for b in node.branches:
            lines.append(f"{pad}OPTIONAL {{" if b.optional else f"{pad}{{")
            lines.append(f"{pad}  ?{node.var} {b.predicate} ?{b.node.var} .")
            emit(b.node, pad + "  ")
            lines.append(pad + "}")

    emit(pattern.root, "  ")
    return "\n".join([*lines, "}"])


def count_distinct(df: DataFrame) -> DataFrame:
    """COUNT(*) over the distinct rows."""
    return df.distinct().agg(F.count("*").alias("n"))


def page(df: DataFrame, order: list[Column], size: int, offset: int = 0) -> DataFrame:
    """One page of ``df`` in ``order``."""
    return df.orderBy(*order).offset(offset).limit(size)


def key_batches(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``: what batches of VALUES lists give, as one semi-join."""
    return df.join(keys.select(F.col(keys.columns[0]).alias(key)).distinct(), key, "left_semi")
