"""URL rules with redirect equivalence.

Rules allow or block a host with its subdomains below a path.  Pages that
redirect to, or name as canonical, one another are aliases: connected
components over these edges.  A block decision on any member of a component
holds for all its members, but for those that a rule of their own allows:
an explicit allow on a url precedes a block inherited from an alias.

Rules meet urls by joins: every distinct host is split into its suffixes,
these are joined to the rules' hosts, and urls are joined to the rules of
their host.  Only urls without a rule of their own meet the components.

Nulls: a null url, or one without ``://``, has an empty host and path, fits no
rule and has no aliases; it is allowed.  A null html has no edges.  Repeated
pages are judged alike.  Links are read as a browser does: quoted attributes
may hold ``>``, character references are decoded, relative links and dot
segments are resolved, from the page's ``base`` if it has one.
"""

from __future__ import annotations

import html
import re
import string
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .text import bounded_batches, slices, utf8

#: Rules are broadcast up to this many, and joined by shuffles beyond.
BROADCAST_RULES = 10_000
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_NODE = re.compile(r"\s*([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)([^#]*)")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|template)\b.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<tag>base|link|meta)(?P<attrs>[\s/](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s\"'=/>]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_REFRESH = re.compile(r"(?is)[;,]\s*url\s*=\s*['\"]?\s*([^'\"]+)")


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, group), F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://``, up to the path; A-Z lower-cased."""
    return F.translate(_part(url, 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return _part(url, 2)


def node_of(url: str | None) -> str | None:
    """The resource a url names: no fragment, http and https alike, dot
    segments resolved, an empty path as ``/``; None for what has no host."""
    m = _NODE.match(url or "")
    if not m or not m[2]:
        return None
    scheme, host, path = m[1].lower(), m[2].translate(_LOWER), m[3] or "/"
    if "/." in path or "/%2" in path:
        kept: list[str] = []
        for part in path.split("/")[1:]:
            name = part.lower().replace("%2e", ".")
            if name == "..":
                kept[-1:] = []
            elif name != ".":
                kept.append(part)
        path = "/" + "/".join(kept) + ("/" if kept and name in (".", "..") else "")
    return f"{'http' if scheme == 'https' else scheme}://{host}{path}{m[4]}"


def links_of(url: str | None, page: str | None) -> list[str]:
    """Absolute urls that a page redirects to by a meta refresh or names as
    canonical, outside comments, scripts, styles and templates, seen from the
    page's base."""
    base, found = url, []
    for m in _TAG.finditer(page or ""):
        if not m["tag"]:
            continue
        own: dict[str, str] = {}
        for name, value in _ATTRIBUTE.findall(m["attrs"]):
            own.setdefault(name.lower(), html.unescape(value.strip("\"'") if value[:1] in "\"'" else value))
        tag = m["tag"].lower()
        if tag == "base" and base is url and own.get("href", "").strip():
            base = _joined(url, own["href"])
        elif tag == "link" and "canonical" in own.get("rel", "").lower().split():
            found.append(own.get("href", ""))
        elif tag == "meta" and own.get("http-equiv", "").strip().lower() == "refresh":
            to = _REFRESH.search(own.get("content", ""))
            found.append(to[1] if to else "")
    return [to for link in found if link.strip() and (to := _joined(base, link))]


def _joined(base: str | None, link: str) -> str | None:
    link = re.sub(r"[\t\n\r]", "", link.strip())
    try:
        return urljoin(base or "", link)
    except ValueError:  # not a url, such as an open bracket for a host
        return None


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The node of each row's url, and the nodes that its html links to."""
    for batch in slices(batches, "html"):
        rest = [i for i, c in enumerate(batch.schema.names) if c != "html"]
        urls = batch.column("url").to_pylist()
        nodes = [node_of(u) for u in urls]
        to = []
        for u, own, page in zip(urls, nodes, batch.column("html").to_pylist()):
            seen = {node_of(x) for x in links_of(u, page.decode(errors="replace"))} if own and page else set()
            to.append(sorted(x for x in seen if x and x != own))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in rest), pa.array(nodes, pa.string()), pa.array(to, pa.list_(pa.string()))], names=[*(batch.schema.names[i] for i in rest), "node", "links"]
        )


def located(pages: DataFrame) -> DataFrame:
    """page_id, url, node and links of (page_id, url, html).  Only html that
    can hold a link leaves the JVM."""
    page_id = next(f.dataType.simpleString() for f in pages.schema if f.name == "page_id")
    rows = pages.select("page_id", "url", F.when(F.col("html").rlike("(?i)canonical|refresh"), utf8("html")).alias("html"))
    return rows.mapInArrow(_located, f"page_id {page_id}, url string, node string, links array<string>")


def _redirects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([node_of(x) for x in batch.column(c).to_pylist()], pa.string()) for c in ("from_url", "to_url")], names=["u", "v"])


def fitting_rules(urls: DataFrame, rules: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` of ``urls`` (which has host and path) with the rule (host and
    path) that fits and its verdict: the longest, of equals an allow; urls
    without one are left out."""
    few = F.broadcast if rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES else (lambda x: x)
    named = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = urls.select("host").filter("host != ''").distinct().select("host", F.explode(suffixes).alias("rule_host"))
    by_host = hosts.join(few(named), "rule_host").select("host", "rule_path", "verdict", F.concat("rule_host", "rule_path").alias("rule"))
    fit = urls.join(by_host, "host").filter(F.col("path").startswith(F.col("rule_path")))
    rank = F.struct(F.char_length("rule"), F.col("verdict") == "allow", "rule")
    return fit.groupBy(*keys).agg(F.max_by(F.struct("rule", "verdict"), rank).alias("best")).select(*keys, "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """One row for each row of ``pages``: page_id, url, host, path, rule (null
    if none fits), verdict (allow or block) and inherited (whether the block
    comes from an alias).  ``rules`` has verdict, host and path; ``redirects``
    may add edges (from_url, to_url) to those in the pages' html."""
    bounded_batches(pages.sparkSession)
    found = located(pages).checkpoint()  # narrow rows, read twice: the html is scanned once
    own = found.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "node")
    places = own.select("host", "path").distinct()
    ruled = fitting_rules(places, rules, ["host", "path"])
    edges = found.select(F.col("node").alias("u"), F.explode("links").alias("v"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select("from_url", "to_url").mapInArrow(_redirects, "u string, v string"))
    rooted = components(edges).checkpoint()
    # resources of a component that a rule blocks, then all members of such a component
    nodes = rooted.select("node", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
    blocked = fitting_rules(nodes, rules, ["node"]).filter("verdict = 'block'").select("node")
    roots = rooted.join(blocked, "node", "left_semi").select("root").distinct()
    aliases = rooted.join(roots, "root", "left_semi").select("node", F.lit(True).alias("inherited"))
    judged = own.join(ruled, ["host", "path"], "left")
    return judged.join(aliases, "node", "left").select(
        "page_id", "url", "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("inherited"), "block").otherwise("allow")).alias("verdict"),
        (F.col("verdict").isNull() & F.coalesce("inherited", F.lit(False))).alias("inherited"),
    )
