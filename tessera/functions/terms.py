"""RDF wire terms as Column expressions, and the registry of named transforms and filters.

A wire term is one string: ``<iri>``, ``"literal"``, ``"v"^^<type>``, ``"v"^^xsd:type``, ``"v"@lang``, ``_:b``
or a bare value. Everything here is a built-in expression, so it stays in generated code.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A quoted literal up to its last quote; quotes inside may stand without a backslash.
LITERAL = r'(?s)^"(.*)"(?:\^\^<[^>]*>|\^\^[A-Za-z][\w.-]*:[\w.-]+|@[A-Za-z0-9-]+)?$'
WHITE = " \t\n\r\f\x0b"


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(c, F.lit(WHITE))


def unescape(c: Column) -> Column:
    r"""Backslash escapes in one pass: \t \n \r become a space, any other escaped character itself."""
    single = lambda part: F.regexp_replace(F.regexp_replace(part, r"\\[tnr]", " "), r"(?s)\\(.)", "$1")
    return F.when(F.contains(c, F.lit("\\")), F.array_join(F.transform(F.split(c, r"\\\\"), single), "\\")).otherwise(c)


def clean_term(c: Column) -> Column:
    """The value of a wire term; null is empty, blank nodes and bare values stay as they are."""
    t = strip(F.coalesce(c, F.lit("")))
    inside = F.substr(t, F.lit(2), F.length(t) - 2)
    said = lambda body: strip(F.translate(unescape(body), "\t\r\n", "   "))
    quoted = F.startswith(t, F.lit('"'))
    plain = quoted & F.endswith(t, F.lit('"')) & (F.length(t) > 1)  # most literals: no pattern is needed
    iri = F.startswith(t, F.lit("<")) & F.endswith(t, F.lit(">"))
    return F.when(iri, inside).when(plain, said(inside)).when(quoted & t.rlike(LITERAL), said(F.regexp_extract(t, LITERAL, 1))).otherwise(t)


def term_struct(c: Column) -> Column:
    """(kind, value, datatype, lang) of a wire term."""
    t = strip(F.coalesce(c, F.lit("")))
    kind = F.when(t.startswith("<"), "iri").when(t.startswith("_:"), "bnode").when(t == "", "none").otherwise("literal")
    return F.struct(kind.alias("kind"), clean_term(c).alias("value"), F.regexp_extract(t, r'"\^\^<?([^>]+)>?$', 1).alias("datatype"), F.regexp_extract(t, r'"@([A-Za-z0-9-]+)$', 1).alias("lang"))


def wire_literal(c: Column, suffix: str = "") -> Column:
    """A value as a quoted wire literal, with a suffix such as @en or ^^xsd:integer."""
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(raw), F.lit(escaped))
    return F.concat(F.lit('"'), c, F.lit('"' + suffix))


def iri_localname(c: Column) -> Column:
    """What follows the last / or #, trailing slashes ignored."""
    return F.regexp_extract(F.regexp_replace(c, r"/+$", ""), r"[^/#]*$", 0)


def prefixed(c: Column, p: str) -> Column:
    return F.when((c == "") | c.startswith(p), c).otherwise(F.concat(F.lit(p), c))


def unprefixed(c: Column, p: str) -> Column:
    return F.when(c.startswith(p), F.substr(c, F.lit(len(p) + 1))).otherwise(c)


def first_match(c: Column, pattern: str) -> Column:
    """Group 1 of the first match, the whole match where the pattern has no group, empty without a match."""
    return F.regexp_extract(c, pattern, 1 if re.compile(pattern).groups else 0)


def split_values(c: Column, sep: str) -> Column:
    """The trimmed non-empty parts."""
    return F.filter(F.transform(F.split(c, re.escape(sep)), strip), lambda v: v != "")


def _pair(arg: str) -> tuple[str, str]:
    """The two sides of a:b, where a backslash before a colon keeps it."""
    parts = re.split(r"(?<!\\):", arg, maxsplit=1)
    old, new = (parts + [""])[:2]
    return old.replace("\\:", ":"), new.replace("\\:", ":")


#: name -> function of (argument text) giving Column -> Column. split gives an array.
TRANSFORMS: dict[str, Callable[[str], Callable[[Column], Column]]] = {
    "iri_localname": lambda _: iri_localname,
    "prefix": lambda p: lambda c: prefixed(c, p),
    "strip_prefix": lambda p: lambda c: unprefixed(c, p),
    "replace": lambda a: lambda c: F.replace(c, F.lit(_pair(a)[0]), F.lit(_pair(a)[1])),
    "regex": lambda r: lambda c: first_match(c, r),
    "split": lambda d: lambda c: split_values(c, d or ","),
    "lower": lambda _: F.lower,
    "upper": lambda _: F.upper,
    "int": lambda _: lambda c: F.regexp_extract(c, r"-?[0-9]+", 0),
}


def split_steps(spec: str) -> list[str]:
    """Steps of a chain: comma-separated, trimmed; a backslash before a comma keeps it."""
    parts = re.split(r"(?<!\\),", spec or "")
    out: list[str] = []
    for p in parts:
        if not p.strip() and out and out[-1].split(":")[0] == "split" and out[-1].endswith(":"):
            out[-1] += ","  # "split:," names the comma itself
        elif p.strip():
            out.append(p.strip().replace("\\,", ","))
    return out


def register_transform(name: str, build: Callable[[str], Callable[[Column], Column]]) -> None:
    """Add a named transform that mappings can use."""
    TRANSFORMS[name] = build


def compile_transform(spec: str) -> tuple[Callable[[Column], Column], bool]:
    """(function, whether it gives an array) of a transform chain; an unknown name is an error."""
    steps, listed = [], False
    for step in split_steps(spec):
        name, _, arg = step.partition(":")
        if name not in TRANSFORMS:
            raise ValueError(f"unknown transform {name!r}")
        steps.append((TRANSFORMS[name](arg), name == "split"))
        listed |= name == "split"

    def run(c: Column) -> Column:
        many = False
        for f, splits in steps:
            if not many:
                c, many = f(c), splits
            elif splits:
                c = F.flatten(F.transform(c, f))
            else:
                c = F.transform(c, f)
        return c

    return run, listed


def compile_filter(spec: str) -> Callable[[Column], Column]:
    """A boolean Column function of a filter spec: empty, nonempty, equals:v or regex:r."""
    name, _, arg = (spec or "").partition(":")
    if not name:
        return lambda c: F.lit(True)
    if name == "nonempty":
        return lambda c: c != ""
    if name == "equals":
        return lambda c: c == arg
    if name == "regex":
        return lambda c: c.rlike(arg)
    raise ValueError(f"unknown filter {name!r}")


def expand_curie(c: Column, prefixes: dict[str, str]) -> Column:
    """prefix:local as an IRI where the prefix is known and no // follows; <iri> is unwrapped."""
    head, local = F.substring_index(c, ":", 1), F.regexp_extract(c, r"(?s)^[^:]*:(.*)$", 1)
    known = F.create_map(*(F.lit(x) for kv in prefixes.items() for x in kv)) if prefixes else F.create_map(F.lit(""), F.lit(""))
    iri = c.startswith("<") & c.endswith(">")
    ok = c.contains(":") & F.map_contains_key(known, head) & ~local.startswith("//")
    return F.when(iri, F.substr(c, F.lit(2), F.length(c) - 2)).when(ok, F.concat(F.try_element_at(known, head), local)).otherwise(c)


def local_name(c: Column) -> Column:
    """What follows the last :, / or #."""
    return F.regexp_extract(c, r"[^:/#]*$", 0)


def same_iri(c: Column) -> Column:
    """A form in which https and http, and X:1 and X_1, are the same."""
    return F.regexp_replace(F.regexp_replace(c, "^https://", "http://"), r"([A-Za-z]+):([0-9]+)$", "$1_$2")


# Names of Greek letters and ASCII forms of typographic punctuation.
GREEK = {
    "α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "ε": "epsilon", "ζ": "zeta", "η": "eta", "θ": "theta",
    "ι": "iota", "κ": "kappa", "λ": "lambda", "μ": "mu", "ν": "nu", "ξ": "xi", "ο": "omicron", "π": "pi",
    "ρ": "rho", "σ": "sigma", "ς": "sigma", "τ": "tau", "υ": "upsilon", "φ": "phi", "χ": "chi", "ψ": "psi",
    "ω": "omega", "ɣ": "gamma",
}
PUNCTUATION = {"‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "‘": "'", "’": "'", "“": '"', "”": '"', "−": "-"}


def _compatible() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose NFKD form, marks removed, is ASCII: of one character, and of several."""
    one, several = {}, {}
    for point in range(0x80, 0x110000):
        ch = chr(point)
        if ch in GREEK or ch in PUNCTUATION or 0xD800 <= point < 0xE000:
            continue
        plain = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if plain and plain.isascii():
            (one if len(plain) == 1 else several)[ch] = plain
    return one, several


def to_ascii(c: Column) -> Column:
    """Closest ASCII: Greek letters by name, typographic punctuation, compatibility forms without marks, else ?.

    Characters of several ASCII characters (ligatures, circled numbers) are replaced one by one, so they
    are only looked for in texts that have one of them.
    """
    one, several = _compatible()
    one = one | PUNCTUATION
    out = reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), GREEK.items(), c)
    out = F.translate(out, "".join(one), "".join(one.values()))
    rare = "[" + "".join(several) + "]"
    table = F.create_map(*(F.lit(x) for kv in several.items() for x in kv))
    by_char = F.array_join(F.transform(F.split(out, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), "")
    out = F.when(out.rlike(rare), by_char).otherwise(out)
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.regexp_replace(out, r"[^\x00-\x7F]", "?")).otherwise(c)


# Names of the types that a value must parse as.
INTEGER_TYPES = ("int", "java.lang.Integer", "long", "java.lang.Long", "short", "java.lang.Short")
FLOAT_TYPES = ("double", "java.lang.Double", "float", "java.lang.Float")
INTEGER = r"^\s*[+-]?[0-9]+\s*$"
FLOAT = r"(?i)^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|nan|inf|infinity)\s*$"


def fits_type(c: Column, declared: str) -> Column:
    """Whether a text parses as the declared type; anything is a string."""
    if declared in INTEGER_TYPES:
        return c.rlike(INTEGER)
    return c.rlike(FLOAT) if declared in FLOAT_TYPES else F.lit(True)


def guess_type(c: Column) -> Column:
    """Integer, Double, Boolean or String by the look of an example."""
    return F.when(c.rlike(r"^-?[0-9]+$"), "java.lang.Integer").when(c.rlike(r"^-?[0-9]*\.[0-9]+(?:[eE][+-]?[0-9]+)?$"), "java.lang.Double").when(F.lower(c).isin("true", "false"), "java.lang.Boolean").otherwise("java.lang.String")


def looks_literal(c: Column) -> Column:
    """Whether an example is a literal rather than an IRI, CURIE or blank node."""
    return ~(c.rlike(r"^<.*>$") | c.rlike(r"^_:") | c.rlike(r'^[A-Za-z][\w.-]*:[^\s"]+$')) | c.startswith('"')


def snake(c: Column) -> Column:
    """camelCase as snake_case."""
    return F.lower(F.regexp_replace(c, r"([a-z0-9])([A-Z])", "$1_$2"))


def flat(c: Column) -> Column:
    """Letters and digits only, lower-cased."""
    return F.regexp_replace(F.lower(c), r"[^a-z0-9]", "")


def variable_name(c: Column) -> Column:
    """A legal variable name: other characters become _, a leading digit gets one before it."""
    return F.regexp_replace(F.regexp_replace(c, r"[^A-Za-z0-9_]", "_"), r"^([0-9])", "_$1")


def xml_quoted(c: Column) -> Column:
    """A value as a quoted XML attribute."""
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\n", "&#10;"), ("\t", "&#9;"), ("\r", "&#13;")):
        c = F.replace(c, F.lit(raw), F.lit(escaped))
    return F.concat(F.lit('"'), c, F.lit('"'))


def markdown_cell(c: Column, most: int = 160) -> Column:
    """Escaped for a Markdown table and cut to ``most`` characters."""
    plain = F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))
    return F.when(F.length(plain) > most, F.concat(F.substr(plain, F.lit(1), F.lit(most - 1)), F.lit("…"))).otherwise(plain)


OPERATOR = r"(?:\s*(?:!=|>=|<=|=|>|<)\s*|\s+(?:IS NOT|IS|NOT LIKE|LIKE|NOT IN|IN)\s+)"


def constraint_path(c: Column) -> Column:
    """The path on the left of a constraint's operator."""
    return strip(F.get(F.split(c, OPERATOR, 2), F.lit(0)))
