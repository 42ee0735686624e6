"""Scans of a remote query endpoint: one request, pages, or batches of keys, as a Spark data source.

``send(query) -> (status, body)`` does the transport, so everything here runs without a network in tests. It has to be
a function that workers can import.
"""

from __future__ import annotations

import csv
import io
import json
import re
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .readers import sniff

Send = Callable[[str], tuple[int, str]]

#: Rows that a sorted scan may return at most on common endpoints; beyond it keys are sent in batches.
SORTED_CAP = 200_000
PAGE, BATCH = 10_000, 1_000
#: Answers after which another result format is worth a try.
OTHER_FORMAT = (302, 303, 400, 405, 406, 415)
FORMATS = ("application/sparql-results+json", "text/tab-separated-values", "text/csv")
GET_LIMIT = 4000


#: What an endpoint answers that doesn't sort more rows than some number.
CAPPED = re.compile(r"\bsorted?\b[^.]*\b(?:top|cap|limit|rows)\b|\bonly \d+ are allowed", re.I)


class _Redirect(urllib.request.HTTPRedirectHandler):
    """A POST that is sent elsewhere keeps its query: as a GET where the address stays short, else as a POST again."""

    def redirect_request(self, req, fp, code, msg, headers, newurl):
        if req.get_method() != "POST" or req.data is None:
            return super().redirect_request(req, fp, code, msg, headers, newurl)
        address = f"{newurl}{'&' if '?' in newurl else '?'}{req.data.decode()}"
        accept = {"Accept": req.get_header("Accept", "*/*")}
        return urllib.request.Request(address, headers=accept) if len(address) <= GET_LIMIT else urllib.request.Request(newurl, req.data, accept, method="POST")


def http_send(endpoint: str, timeout: int = 120) -> Send:
    """POST, then GET for short queries, for each result format in turn; an answer that names a cap on sorting ends it."""
    opener = urllib.request.build_opener(_Redirect)

    def send(query: str) -> tuple[int, str]:
        status, body = 0, ""
        data = urllib.parse.urlencode({"query": query})
        for accept in FORMATS:
            for method in ("POST", "GET"):
                if method == "GET" and len(data) > GET_LIMIT:
                    continue
                url = endpoint if method == "POST" else f"{endpoint}?{data}"
                request = urllib.request.Request(url, data.encode() if method == "POST" else None, {"Accept": accept}, method=method)
                try:
                    with opener.open(request, timeout=timeout) as r:
                        return r.status, r.read().decode("utf-8", "replace")
                except urllib.error.HTTPError as e:
                    status, body = e.code, e.read().decode("utf-8", "replace")
                    if status not in OTHER_FORMAT or CAPPED.search(body):
                        return status, body
        return status, body

    return send


def with_limit(query: str, limit: int | None, offset: int = 0) -> str:
    """The query with its LIMIT kept (None), removed (0) or replaced, and an OFFSET."""
    bare = query if limit is None else re.sub(r"\s*\b(?:LIMIT|OFFSET)\s+\d+", "", query, flags=re.I)
    return bare.rstrip() + (f"\nLIMIT {limit}" if limit else "") + (f" OFFSET {offset}" if offset else "")


def with_order(query: str) -> str:
    """Ordered by the first selected variable unless it has an order."""
    m = re.search(r"SELECT\s+(?:DISTINCT\s+)?(\?\w+)", query, re.I)
    return query if not m or re.search(r"\bORDER\s+BY\b", query, re.I) else query.rstrip() + f"\nORDER BY {m[1]}"


def with_values(query: str, var: str, keys: list[str]) -> str:
    """The query with a VALUES list at the start of its pattern."""
    listed = " ".join(k if k.startswith(("<", '"')) else f'"{k}"' for k in keys)
    return re.sub(r"WHERE\s*\{", lambda m: m[0] + f" VALUES ?{var} {{ {listed} }}", query, count=1, flags=re.I)


def variables(query: str) -> list[str]:
    m = re.search(r"SELECT\s+(?:DISTINCT\s+)?((?:\?\w+\s*)+)", query, re.I)
    return re.findall(r"\?(\w+)", m[1]) if m else []


def required_part(query: str) -> str:
    """The query without its OPTIONAL groups."""
    out, i = "", 0
    while m := re.compile(r"OPTIONAL\s*\{", re.I).search(query, i):
        out, depth, at = out + query[i : m.start()], 1, m.end()
        while depth and at < len(query):
            depth += {"{": 1, "}": -1}.get(query[at], 0)
            at += 1
        i = at
    return out + query[i:]


def _wire(cell: dict | None) -> str:
    if not cell:
        return ""
    v = cell["value"]
    if cell["type"] == "uri":
        return f"<{v}>"
    if cell["type"] == "bnode":
        return f"_:{v}"
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        v = v.replace(a, b)
    tail = f"@{cell['xml:lang']}" if "xml:lang" in cell else f"^^<{cell['datatype']}>" if "datatype" in cell else ""
    return f'"{v}"{tail}'


def decode(body: str, names: list[str]) -> list[tuple[str, ...]]:
    """Rows of wire terms of a body in any of the formats; an empty body has none."""
    if not body.strip():
        return []
    kind = sniff(body)
    if kind == "json":
        return [tuple(_wire(b.get(n)) for n in names) for b in json.loads(body)["results"]["bindings"]]
    if kind == "tsv":
        lines = [x for x in re.split(r"\r\n|\r|\n", body) if x]
        cells = [x.split("\t") for x in lines[1:]]
    else:
        cells = [[c if c.startswith("http") or not c else '"' + c.replace("\\", "\\\\").replace('"', '\\"') + '"' for c in r] for r in list(csv.reader(io.StringIO(body)))[1:]]
    return [tuple((r + [""] * len(names))[: len(names)]) for r in cells]


@dataclass
class Scan:
    """A scan's rows so far and how it ended: fetched, partial or failed."""

    names: list[str]
    status: str = "fetched"
    errors: list[str] = field(default_factory=list)


def scan_pages(send: Send, query: str, page: int = PAGE, limit: int | None = None, scan: Scan | None = None, cap: int = SORTED_CAP) -> Iterator[tuple[str, ...]]:
    """Pages in order. After a short page one row beyond is asked for; if there is one, the endpoint cuts pages
    and the page size becomes what it gave. A scan that reaches ``cap`` or an error ends as partial (or failed, without rows)."""
    names, ordered, at = variables(query), with_order(query), 0
    scan = scan or Scan(names)
    while limit is None or at < limit:
        size = page if limit is None else min(page, limit - at)
        if at + size > cap:
            size = cap - at
        status, body = send(with_limit(ordered, size, at)) if size > 0 else (0, "cap reached")
        if status != 200:
            scan.status = "partial" if at else "failed"
            scan.errors.append(f"{status}: {body[:200]}")
            return
        rows = decode(body, names)
        yield from rows
        at += len(rows)
        if len(rows) < size:
            if not rows:
                return
            more_status, more = send(with_limit(ordered, 1, at))
            if more_status != 200 or not decode(more, names):
                return
            page = len(rows)


def scan_batches(send: Send, query: str, var: str, keys: list[str], size: int = BATCH, scan: Scan | None = None) -> Iterator[tuple[str, ...]]:
    """One request for each batch of keys; failed batches are skipped and make the scan partial."""
    names = variables(query)
    scan = scan or Scan(names)
    good = 0
    for i in range(0, len(keys), size):
        status, body = send(with_values(with_limit(query, 0), var, keys[i : i + size]))
        if status == 200:
            good += 1
            yield from decode(body, names)
        else:
            scan.errors.append(f"batch {i // size}: {status}")
    if scan.errors:
        scan.status = "partial" if good else "failed"


def domain_query(query: str, var: str) -> str | None:
    """SELECT DISTINCT of a key over the required part; None if the key is only bound in an OPTIONAL."""
    bare = required_part(query)
    body = bare[bare.index("{") :] if "{" in bare else ""
    if f"?{var}" not in body:
        return None
    return re.sub(r"SELECT\s+(?:DISTINCT\s+)?(?:\?\w+\s*)+", f"SELECT DISTINCT ?{var} ", with_limit(bare, 0), count=1, flags=re.I)


def _keys(send: Send, domain: str, var: str, page: int, done: Scan) -> list[str]:
    """A query's keys; a list that was cut short makes the scan partial."""
    listed = Scan([var])
    keys = [r[0] for r in scan_pages(send, domain, page, scan=listed, cap=10**12)]
    done.errors += [f"list of keys cut: {e}" for e in listed.errors]
    return keys


def _pages_then_batches(send: Send, query: str, domain: str | None, page: int, cap: int, batch: int, done: Scan) -> Iterator[tuple[str, ...]]:
    """Pages up to where the endpoint refuses to sort further; then the keys that no page was sure to hold whole, in batches.

    Pages come sorted by the first variable, so all rows of every key but the last page's last one have been seen. Rows of that
    key are held back until it is known that they are all there.
    """
    names, asked = variables(query), Scan(variables(query))
    seen: set[str] = set()
    held: list[tuple[str, ...]] = []
    for r in scan_pages(send, query, page, scan=asked, cap=cap):
        if held and r[0] != held[0][0]:
            yield from held
            seen.add(held[0][0])
            held = []
        held.append(r)
    refused = asked.status != "fetched" and (any(e.startswith("0: cap reached") for e in asked.errors) or any(CAPPED.search(e) for e in asked.errors))
    if not (refused and domain):
        yield from held
        done.status, done.errors = asked.status, done.errors + asked.errors
        return
    rest = [k for k in _keys(send, domain, names[0], page, done) if k not in seen]
    yield from scan_batches(send, query, names[0], rest, batch, done)


def scan(send: Send, query: str, page: int = PAGE, cap: int = SORTED_CAP, batch: int = BATCH) -> tuple[Iterator[tuple[str, ...]], Scan]:
    """Pages, or key batches where the count of rows is over ``cap``, or from where the endpoint turns out to have a cap of its own."""
    names = variables(query)
    done = Scan(names)
    status, body = send(f"SELECT (COUNT(*) AS ?n) WHERE {{ {with_limit(query, 0)} }}")
    found = re.search(r'"(\d+)"|(?:^|\n)(\d+)\s*$', body) if status == 200 else None
    rows = int(found[1] or found[2]) if found else None  # unknown isn't none
    domain = domain_query(query, names[0]) if names else None
    if rows is not None and rows > cap and domain:
        return scan_batches(send, query, names[0], _keys(send, domain, names[0], page, done), batch, done), done
    return _pages_then_batches(send, query, domain, page, cap, batch, done), done


class Page(InputPartition):
    def __init__(self, offset: int, size: int):
        self.offset, self.size = offset, size


def read_range(send: Send, query: str, at: int, rows: int) -> Iterator[tuple[str, ...]]:
    """``rows`` rows of the sorted result from ``at`` on, in as many requests as an endpoint that cuts pages needs.

    An answer without rows before the end is an error: nothing is left out silently.
    """
    names, ordered, end = variables(query), with_order(query), at + rows
    while at < end:
        status, body = send(with_limit(ordered, end - at, at))
        got = decode(body, names) if status == 200 else []
        if not got:
            raise OSError(f"rows {at} to {end}: {status}, {'no rows' if status == 200 else body[:200]}")
        yield from got
        at += len(got)


class EndpointReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names = schema.fieldNames()
        self.query, self.page, self.rows = options["query"], int(options.get("page", PAGE)), int(options["rows"])
        self.endpoint = options["endpoint"]

    def partitions(self) -> list[InputPartition]:
        return [Page(at, self.page) for at in range(0, self.rows, self.page)]

    def read(self, partition: Page) -> Iterator[tuple]:
        yield from read_range(http_send(self.endpoint), self.query, partition.offset, min(partition.size, self.rows - partition.offset))


class EndpointSource(DataSource):
    """Format "endpoint": one partition for each page. Options: endpoint, query, rows (how many there are), page."""

    @classmethod
    def name(cls) -> str:
        return "endpoint"

    def schema(self) -> str:
        return ", ".join(f"`{v}` string" for v in variables(self.options["query"]))

    def reader(self, schema: StructType) -> EndpointReader:
        return EndpointReader(schema, self.options)


def read_endpoint(spark: SparkSession, endpoint: str, query: str, rows: int, page: int = PAGE) -> DataFrame:
    spark.dataSource.register(EndpointSource)
    return spark.read.format("endpoint").option("endpoint", endpoint).option("query", query).option("rows", rows).option("page", page).load()
