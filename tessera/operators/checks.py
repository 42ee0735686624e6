"""The check of a project as rules over tables: what the model declares, what sources write, replace and load beside.

Each rule is a plan over the project's tables that gives (source, subject) of what breaks it; ``findings`` is their union
with rule and severity. Inheritance is a closure that the plans join, so a field that a class inherits counts as its own
and one that a subclass writes counts for every ancestor that declares it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, fields
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.catalog import ATTRIBUTE, Catalog, closure
from ..plans.resolve import MappingRow, query_rows, tables_of
from ..plans.written import written

#: Schemas of a project's tables; ``core`` tells what is there whatever sources are loaded, ``ord`` the order of declaration.
SCHEMAS = {
    "classes": "cls string, core boolean",
    "extends": "cls string, parent string",
    "fields": "cls string, field string, kind string, type string, reverse string, ord long, core boolean",
    "keys": "cls string",
    "draft_keys": "cls string",
    "additions": "cls string, field string",
    "columns": "source string, table string, column string, cls string, field string, via string, kind string, required boolean, root boolean, subject string, predicate string, discriminated boolean",
    "items": "source string, id string, cls string",
    "links": "source string, src string, dst string",
    "order": "source string, position long",
    "replaces": "source string, stock string",
    "alongside": "source string, stock string",
    "declared": "stock string, cls string, field string",
    "accepted": "source string, entry string",
}


def known_fields(up: DataFrame, declared: DataFrame) -> DataFrame:
    """(cls, field, kind, type, reverse, core, declared_in, depth, ord): own and inherited fields, the nearest declaration of each."""
    every = up.join(declared.withColumnRenamed("cls", "ancestor"), "ancestor")
    rest = F.struct("kind", "type", "reverse", "core", F.col("ancestor").alias("declared_in"), "depth", "ord")
    # Dealt out first: grouped where they are read, a task would sort the fields of a whole file of pairs.
    every = every.repartition("child", "field")
    return every.groupBy(F.col("child").alias("cls"), "field").agg(F.min_by(rest, F.struct("depth", "ancestor", "ord")).alias("f")).select("cls", "field", "f.*")


@dataclass
class Project:
    """A project's tables, as SCHEMAS has them; tables that aren't given are empty."""

    spark: SparkSession
    classes: DataFrame | None = None
    extends: DataFrame | None = None
    fields: DataFrame | None = None
    keys: DataFrame | None = None
    draft_keys: DataFrame | None = None
    additions: DataFrame | None = None
    columns: DataFrame | None = None
    items: DataFrame | None = None
    links: DataFrame | None = None
    order: DataFrame | None = None
    replaces: DataFrame | None = None
    alongside: DataFrame | None = None
    declared: DataFrame | None = None
    accepted: DataFrame | None = None

    def __post_init__(self) -> None:
        for f in fields(self):
            if f.name in SCHEMAS and getattr(self, f.name) is None:
                setattr(self, f.name, self.spark.createDataFrame([], SCHEMAS[f.name]))

    @classmethod
    def of(cls, spark: SparkSession, catalog: Catalog, core: Iterable[str] = (), **tables: DataFrame) -> Project:
        """The tables of a catalog; ``core``: classes whose own declaration and fields are always there."""
        core = set(core)
        make = lambda name, rows: spark.createDataFrame(rows, SCHEMAS[name])
        own = {
            "classes": make("classes", [(c, c in core) for c in catalog.classes]),
            "extends": make("extends", [(c.name, p) for c in catalog.classes.values() for p in c.extends]),
            "fields": make("fields", [(c.name, f.name, f.kind, f.type, f.reverse, i, c.name in core) for c in catalog.classes.values() for i, f in enumerate(c.fields.values())]),
            "keys": make("keys", [(c.name,) for c in catalog.classes.values() if c.keys]),
        }
        return cls(spark, **(own | tables))

    @cached_property
    def up(self) -> DataFrame:
        """(child, ancestor, depth), each class its own ancestor."""
        return closure(self.extends, "cls", "parent", self.classes.select("cls"))

    @cached_property
    def known(self) -> DataFrame:
        return written(known_fields(self.up, self.fields))

    def known_of(self, classes: DataFrame) -> DataFrame:
        """``known`` of the classes in ``classes`` (cls) only. What the joins depend on is written, so few classes are broadcast."""
        wanted = written(classes.distinct())
        return written(known_fields(written(self.up.join(wanted.withColumnRenamed("cls", "child"), "child", "left_semi")), self.fields))

    @cached_property
    def own_links(self) -> DataFrame:
        """(source, cls, via_cls, via_field) of columns with a ``via``."""
        return self.columns.filter(F.col("via") != "").select("source", "cls", F.substring_index("via", ".", 1).alias("via_cls"), F.expr("substr(via, instr(via, '.') + 1)").alias("via_field"))

    @cached_property
    def via_kinds(self) -> DataFrame:
        """(via_cls, via_field, via_kind, via_type): the fields of the classes that own links name."""
        known = self.known_of(self.own_links.select(F.col("via_cls").alias("cls")))
        return known.select(F.col("cls").alias("via_cls"), F.col("field").alias("via_field"), F.col("kind").alias("via_kind"), F.col("type").alias("via_type"))

    @cached_property
    def implied_links(self) -> DataFrame:
        """(source, cls, via_cls, via_field), distinct, of columns without a ``via`` that have a link all the same.

        It is the root's first reference or collection, fields of the farthest ancestor first, whose range is the column's class
        or one of its ancestors.
        """
        roots = written(self.columns.filter("root").groupBy("source", "table").agg(F.min("cls").alias("root_cls")))
        bare = self.columns.filter(F.col("via") == "").select("source", "table", "cls").join(roots, ["source", "table"]).filter("cls <> root_cls")
        reach = self.known_of(roots.select(F.col("root_cls").alias("cls"))).filter(F.col("kind") != ATTRIBUTE)
        first = Window.partitionBy("cls").orderBy(F.desc("depth"), "declared_in", "ord", "field")
        reach = written(reach.select(F.col("cls").alias("root_cls"), F.col("field").alias("via_field"), "type", F.row_number().over(first).alias("rank")))
        types = written(reach.select("type").distinct())
        ranges = self.up.select(F.col("child").alias("cls"), F.col("ancestor").alias("type")).join(types, "type", "left_semi")
        ways = bare.select("source", "cls", "root_cls").distinct().join(ranges, "cls").join(reach, ["root_cls", "type"])
        ways = ways.groupBy("source", "cls", "root_cls").agg(F.min("rank").alias("rank"))
        return written(ways.join(reach.select("root_cls", "rank", "via_field"), ["root_cls", "rank"]).select("source", "cls", F.col("root_cls").alias("via_cls"), "via_field"))

    @cached_property
    def links_used(self) -> DataFrame:
        """(source, cls, field) of the links that a source's columns use, own and implied."""
        every = self.own_links.select("source", "via_cls", "via_field").union(self.implied_links.select("source", "via_cls", "via_field"))
        return written(every.select("source", F.col("via_cls").alias("cls"), F.col("via_field").alias("field")).distinct())

    @cached_property
    def linked_fields(self) -> DataFrame:
        """(source, cls, field, field_kind, type, reverse) of ``links_used`` that the model has."""
        kinds = self.known_of(self.links_used.select("cls")).select("cls", "field", F.col("kind").alias("field_kind"), "type", "reverse")
        return written(self.links_used.join(kinds, ["cls", "field"]).select("source", "cls", "field", "field_kind", "type", "reverse"))

    @cached_property
    def written_fields(self) -> DataFrame:
        """(source, cls, field) that a source writes: columns, links, and the reverse ends of links."""
        direct = self.columns.filter("cls <> '' AND field <> ''").select("source", "cls", "field")
        back = self.linked_fields.filter("reverse <> ''").select("source", F.col("type").alias("cls"), F.col("reverse").alias("field"))
        return written(direct.union(self.links_used).union(back).distinct())


def project_columns(spark: SparkSession, sources: dict[str, tuple[list[MappingRow], str]]) -> DataFrame:
    """The ``columns`` table of sources: name -> (mapping rows, class of the root)."""
    out = []
    for source, (rows, root) in sources.items():
        for t in tables_of(rows):
            for r in query_rows(rows, t):
                told = bool(r.filter or r.value and r.kind != "const")
                out.append((source, t, r.column, r.im_class, r.im_field, r.via, r.kind, r.required == "yes", r.im_class == root and not r.via, r.subject, r.predicate, told))
    return spark.createDataFrame(out, SCHEMAS["columns"])


def competing_fields(project: Project) -> DataFrame:
    """(source, cls, field) that need a priority where several sources write them: attributes and single references.

    References count by explicit and implied links and by their reverse ends; collections don't, as sources add to them.
    """
    direct = project.columns.filter("cls <> '' AND field <> ''").select("source", "cls", "field")
    links = project.linked_fields
    ends = links.filter("reverse <> ''").select("source", F.col("type").alias("cls"), F.col("reverse").alias("field"))
    kinds = project.known_of(ends.select("cls")).select("cls", "field", F.col("kind").alias("field_kind"))
    back = ends.join(kinds, ["cls", "field"])
    single = links.select("source", "cls", "field", "field_kind").union(back.select("source", "cls", "field", "field_kind")).filter("field_kind = 'reference'")
    return direct.union(single.select("source", "cls", "field")).distinct()


def links_report(project: Project) -> DataFrame:
    """(source, line): each link that a source's columns write, with its reverse end, explicit or implied."""
    used = project.linked_fields.select(F.col("cls").alias("via_cls"), F.col("field").alias("via_field"), "type", "reverse").distinct()
    every = project.own_links.withColumn("own", F.lit(True)).unionByName(project.implied_links.withColumn("own", F.lit(False)))
    found = every.join(written(used), ["via_cls", "via_field"], "left")
    end = F.when(F.col("reverse") != "", F.concat(F.lit(" (reverse "), "type", F.lit("."), "reverse", F.lit(")")))
    line = F.concat(_link(), F.lit(" -> "), "cls", F.coalesce(end, F.lit("")), F.when(F.col("own"), "").otherwise(", implied"))
    return found.select("source", line.alias("line")).distinct()


def coverage(written_fields: DataFrame, declared: DataFrame, up: DataFrame) -> DataFrame:
    """(source, stock, cls, field, whole): what a source doesn't write of what the stock source that it replaces declares.

    ``declared``: (source, stock, cls, field). A field of a class is written where any subclass writes it; ``whole``: the
    source writes nothing of the class.
    """
    fields = written_fields.select("source", "cls", "field")
    below = up.select(F.col("ancestor").alias("cls"), F.col("child").alias("sub")).filter("cls <> sub")
    # Only for what a source doesn't write itself are subclasses asked, not each written field carried to all ancestors.
    left = written(declared.distinct().join(fields, ["source", "cls", "field"], "left_anti"))
    asked = left.select("source", "cls", "field").distinct().join(below, "cls")
    covered = asked.join(fields.withColumnRenamed("cls", "sub"), ["source", "sub", "field"], "left_semi").select("source", "cls", "field").distinct()
    gaps = written(left.join(covered, ["source", "cls", "field"], "left_anti"))
    classes = fields.select("source", "cls").distinct()
    asked = gaps.select("source", "cls").distinct()
    inside = asked.join(below, "cls").join(classes.withColumnRenamed("cls", "sub"), ["source", "sub"], "left_semi").select("source", "cls")
    some = asked.join(classes, ["source", "cls"], "left_semi").union(inside).distinct().withColumn("some", F.lit(True))
    return gaps.join(some, ["source", "cls"], "left").select("source", "stock", "cls", "field", F.col("some").isNull().alias("whole"))


def carried_definitions(project: Project, written_fields: DataFrame, live_fields: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Definitions that additions must carry: classes (cls, parents), fields (cls, field, kind, type, reverse).

    ``written_fields``: (cls, field). A written field of the model is carried, with its class, unless class and field are core
    and the live model (``live_fields``: cls, field, inherited ones too) has it. With a reference goes its range, unless core, and its
    reverse end with that end's class, unless a source writes it; an end that the model doesn't declare gets the opposite
    kind. With a class go its parents that aren't core: a fixpoint, each round follows the classes that the one before added.
    """
    core = project.classes.select("cls", F.col("core").alias("class_core"))
    want = written_fields.select("cls", "field").distinct().join(project.known, ["cls", "field"]).join(core, "cls")
    sure = F.col("class_core") & F.col("core")
    if live_fields is not None:
        want = want.join(live_fields.select("cls", "field", F.lit(True).alias("live")).distinct(), ["cls", "field"], "left")
        sure = sure & F.coalesce("live", F.lit(False))
    need = written(want.filter(~sure).select("cls", "field", "kind", "type", "reverse"))
    links = need.filter(F.col("kind") != ATTRIBUTE)
    ranges = links.join(core.select(F.col("cls").alias("type"), "class_core"), "type")
    ends = ranges.filter("reverse <> ''").select(F.col("type").alias("end"), F.col("reverse").alias("end_field"), F.col("cls").alias("back"), F.col("field").alias("back_field"), "kind")
    ends = ends.join(written_fields.select(F.col("cls").alias("end"), F.col("field").alias("end_field")).distinct(), ["end", "end_field"], "left_anti")
    model_kind = project.known.select(F.col("cls").alias("end"), F.col("field").alias("end_field"), F.col("kind").alias("end_kind"))
    opposite = F.when(F.col("kind") == "reference", "collection").otherwise("reference")
    ends = ends.join(model_kind, ["end", "end_field"], "left").withColumn("end_kind", F.coalesce("end_kind", opposite))
    ends = ends.groupBy("end", "end_field").agg(F.min(F.struct("back", "back_field", "end_kind")).alias("e"))
    ends = ends.select(F.col("end").alias("cls"), F.col("end_field").alias("field"), F.col("e.end_kind").alias("kind"), F.col("e.back").alias("type"), F.col("e.back_field").alias("reverse"))
    ends = written(ends.join(need.select("cls", "field"), ["cls", "field"], "left_anti"))
    found = written(need.select("cls").union(ranges.filter("NOT class_core").select("type")).union(ends.select("cls")).distinct())
    above = written(project.extends.join(core.select(F.col("cls").alias("parent"), "class_core"), "parent").filter("NOT class_core").select("cls", "parent"))
    known = found
    while not found.isEmpty():
        found = written(found.join(above, "cls").select(F.col("parent").alias("cls")).distinct().join(known, "cls", "left_anti"))
        known = known.union(found)
    parents = project.extends.groupBy("cls").agg(F.array_join(F.sort_array(F.collect_set("parent")), " ").alias("parents"))
    return known.join(parents, "cls", "left").select("cls", F.coalesce("parents", F.lit("")).alias("parents")), need.unionByName(ends)


# --- rules -----------------------------------------------------------------------------------------

Rule = Callable[[Project], DataFrame]
#: name -> (severity, plan); hard findings stop a project, soft ones are notes.
RULES: dict[str, tuple[str, Rule]] = {}


def rule(severity: str):
    def add(f: Rule) -> Rule:
        RULES[f.__name__] = (severity, f)
        return f

    return add


def _said(df: DataFrame, *subject: str | Column) -> DataFrame:
    return df.select("source", F.concat_ws(" ", *subject).alias("subject")).distinct()


def _typed(p: Project) -> DataFrame:
    """Columns of classes that the model has, with the field's declaration, if there is one."""
    own = p.columns.join(p.classes.select("cls"), "cls", "left_semi")
    return own.join(p.known.select("cls", "field", F.col("kind").alias("field_kind")), ["cls", "field"], "left")


def _member() -> Column:
    return F.concat_ws(".", "cls", "field")


@rule("hard")
def unknown_class(p: Project) -> DataFrame:
    """A column's class is neither in the model nor in the additions."""
    missing = p.columns.join(p.classes, "cls", "left_anti").join(p.additions, "cls", "left_anti")
    return _said(missing, "cls")


@rule("hard")
def unknown_field(p: Project) -> DataFrame:
    """A column's field is neither in the model, inherited ones included, nor in the additions."""
    own = p.columns.join(p.classes.select("cls").union(p.additions.select("cls")).distinct(), "cls", "left_semi")
    return _said(own.join(p.known, ["cls", "field"], "left_anti").join(p.additions, ["cls", "field"], "left_anti"), _member())


@rule("hard")
def not_attribute(p: Project) -> DataFrame:
    """A column writes a reference or collection; links come from ``via`` only."""
    return _said(_typed(p).filter(F.col("field_kind") != ATTRIBUTE), _member(), "field_kind")


def _via(p: Project) -> DataFrame:
    """Own links of columns, with what the model says of their field."""
    return p.own_links.join(p.via_kinds, ["via_cls", "via_field"], "left")


def _ranged(p: Project) -> DataFrame:
    """``_via`` of references and collections, and whether the column's class is narrower or wider than their range.

    Of the pairs of classes only those are shuffled that have a range of such a link.
    """
    own = _via(p).filter(F.col("via_kind") != ATTRIBUTE)
    types = written(p.via_kinds.filter(F.col("via_kind") != ATTRIBUTE).select("via_type").distinct())
    is_a = p.up.select(F.col("child").alias("cls"), F.col("ancestor").alias("via_type"), F.lit(True).alias("narrower")).join(types, "via_type", "left_semi")
    wider = p.up.select(F.col("ancestor").alias("cls"), F.col("child").alias("via_type"), F.lit(True).alias("wider")).join(types, "via_type", "left_semi")
    return own.join(is_a, ["cls", "via_type"], "left").join(wider, ["cls", "via_type"], "left")


def _of_model(p: Project, df: DataFrame) -> DataFrame:
    """Rows of ``df`` whose class the model has."""
    return df.join(p.classes.select("cls"), "cls", "left_semi")


def _link() -> Column:
    return F.concat_ws(".", "via_cls", "via_field")


@rule("hard")
def via_unknown(p: Project) -> DataFrame:
    """A link is no field of its class."""
    return _said(_of_model(p, _via(p).filter("via_kind IS NULL")), _link())


@rule("hard")
def via_attribute(p: Project) -> DataFrame:
    """A link is an attribute."""
    return _said(_of_model(p, _via(p).filter(F.col("via_kind") == ATTRIBUTE)), _link())


@rule("hard")
def via_range(p: Project) -> DataFrame:
    """A link's range is neither an ancestor nor a descendant of the column's class."""
    return _said(_of_model(p, _ranged(p).filter("narrower IS NULL AND wider IS NULL")), _link(), "cls")


@rule("soft")
def via_widens(p: Project) -> DataFrame:
    """A link's range is an ancestor of the column's class: perhaps not the link that was meant."""
    return _said(_of_model(p, _ranged(p).filter(F.col("narrower").isNotNull() & (F.col("via_type") != F.col("cls")))), _link(), "cls")


def _without_key(p: Project) -> DataFrame:
    """Columns of classes that neither declare nor inherit a key."""
    keyed = p.up.join(p.keys.select(F.col("cls").alias("ancestor")), "ancestor", "left_semi").select(F.col("child").alias("cls")).distinct()
    return p.columns.join(p.classes.select("cls"), "cls", "left_semi").join(keyed, "cls", "left_anti")


@rule("soft")
def draft_key(p: Project) -> DataFrame:
    """A root class has a drafted key only."""
    return _said(_without_key(p).filter("required").join(p.draft_keys, "cls", "left_semi"), "cls")


@rule("soft")
def no_key(p: Project) -> DataFrame:
    """A class has no key: its objects are stored without merging."""
    return _said(_without_key(p).join(p.draft_keys, "cls", "left_anti"), "cls")


@rule("hard")
def collision(p: Project) -> DataFrame:
    """Several columns of a table write the same field of the same object."""
    own = p.columns.filter("kind <> 'const' AND field <> ''")
    return _said(own.groupBy("source", "table", "cls", "via", "field").agg(F.count("*").alias("n")).filter("n > 1"), "table", _member(), "via")


@rule("hard")
def cross_product(p: Project) -> DataFrame:
    """One predicate of a subject is bound by several columns of a table that nothing tells apart."""
    own = p.columns.filter("kind IN ('literal', 'iri') AND predicate <> '-self-' AND NOT discriminated")
    return _said(own.groupBy("source", "table", "subject", "predicate").agg(F.count("*").alias("n")).filter("n > 1"), "table", "subject", "predicate")


@rule("hard")
def unknown_item_class(p: Project) -> DataFrame:
    """Items are of a class that neither the model nor the additions have."""
    return _said(p.items.select("source", "cls").distinct().join(p.classes, "cls", "left_anti").join(p.additions, "cls", "left_anti"), "cls")


@rule("hard")
def dangling_reference(p: Project) -> DataFrame:
    """Items refer to items that their document doesn't have; the number of such references."""
    lost = p.links.join(p.items.select("source", F.col("id").alias("dst")), ["source", "dst"], "left_anti")
    return _said(lost.groupBy("source").agg(F.count("*").alias("n")), F.col("n").cast("string"))


@rule("hard")
def replaces_and_alongside(p: Project) -> DataFrame:
    """A source both replaces a stock source and loads alongside it."""
    return _said(p.alongside.join(p.replaces, ["source", "stock"], "left_semi"), "stock")


@rule("soft")
def alongside_absent(p: Project) -> DataFrame:
    """The stock source that a source supplements isn't loaded."""
    there = p.order.select(F.col("source").alias("stock"))
    return _said(p.alongside.join(p.replaces, ["source", "stock"], "left_anti").join(there, "stock", "left_anti"), "stock")


@rule("hard")
def load_order(p: Project) -> DataFrame:
    """A source loads before the stock source that it supplements."""
    beside = p.alongside.join(p.replaces, ["source", "stock"], "left_anti").join(p.order, "source").withColumnRenamed("position", "own")
    return _said(beside.join(p.order.withColumnRenamed("source", "stock"), "stock").filter("position > own"), "stock")


@rule("soft")
def still_active(p: Project) -> DataFrame:
    """A replaced source is loaded all the same."""
    return _said(p.replaces.join(p.order.select(F.col("source").alias("stock")), "stock", "left_semi"), "stock")


def _gaps(p: Project) -> DataFrame:
    """Coverage gaps with the acceptance that covers them, of the class before of the field."""
    gaps = coverage(p.written_fields, p.replaces.join(p.declared, "stock").select("source", "stock", "cls", "field"), p.up)
    by_class = p.accepted.select("source", F.col("entry").alias("cls"), F.col("entry").alias("of_class")).distinct()
    by_field = p.accepted.select("source", F.col("entry").alias("member"), F.col("entry").alias("of_field")).distinct()
    gaps = gaps.withColumn("member", _member()).join(by_class, ["source", "cls"], "left").join(by_field, ["source", "member"], "left")
    return gaps.withColumn("entry", F.coalesce("of_class", "of_field"))


@rule("hard")
def coverage_gap(p: Project) -> DataFrame:
    """A field that a replaced source declares isn't written, and not accepted as a gap."""
    return _said(_gaps(p).filter("entry IS NULL"), "stock", "member", F.when(F.col("whole"), "(class)"))


@rule("soft")
def accepted_gap(p: Project) -> DataFrame:
    """A field that a replaced source declares isn't written, which is accepted."""
    return _said(_gaps(p).filter("entry IS NOT NULL"), "stock", "member")


@rule("soft")
def unused_acceptance(p: Project) -> DataFrame:
    """An acceptance that no gap needs."""
    return _said(p.accepted.join(_gaps(p).select("source", "entry").distinct(), ["source", "entry"], "left_anti"), "entry")


@rule("hard")
def unresolved_reverse(p: Project) -> DataFrame:
    """A reverse end that the additions name is neither in them nor core, own or inherited."""
    ends = p.additions.join(p.fields.select("cls", "field", "type", "reverse"), ["cls", "field"]).filter("reverse <> ''")
    there = p.additions.select("cls", "field").union(p.fields.filter("core").select("cls", "field")).distinct()
    lifted = p.up.join(there.withColumnRenamed("cls", "ancestor"), "ancestor").select(F.col("child").alias("type"), F.col("field").alias("reverse"))
    lifted = lifted.union(there.select(F.col("cls").alias("type"), F.col("field").alias("reverse"))).distinct()
    return _said(ends.join(lifted, ["type", "reverse"], "left_anti").withColumn("source", F.lit("")), _member(), F.concat_ws(".", "type", "reverse"))


def findings(project: Project, only: Iterable[str] = ()) -> DataFrame:
    """(rule, severity, source, subject) of all rules, or of those named; an unknown name is an error."""
    names = list(only) or list(RULES)
    if unknown := [n for n in names if n not in RULES]:
        raise ValueError(f"unknown rule {unknown[0]!r}")
    parts = [RULES[n][1](project).select(F.lit(n).alias("rule"), F.lit(RULES[n][0]).alias("severity"), "source", "subject") for n in names]
    return reduce(DataFrame.unionByName, parts)


def passes(found: DataFrame) -> bool:
    """Whether there are no hard findings."""
    return found.filter("severity = 'hard'").isEmpty()
