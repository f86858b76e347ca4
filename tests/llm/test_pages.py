"""URL rules and HTML extraction."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from bucketvote.llm import html_text as HT
from bucketvote.llm import url_filter as UF
from bucketvote.llm.queries import URL_RULES

RULES = "verdict string, host string, path string"
PAGES = "page_id long, url string, html string"


def split(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")


def rule_of(url, rules):
    host, path = split(url)
    fit = [(len(h + p), v == "allow", h + p, v) for v, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[2:] if fit else (None, None)


URLS = [
    "http://a.org/", "https://www.Example.ORG/es/1?x#y", "http://example.org/en/12", "http://notexample.org/es/", "http://x.com/fr/1", "http://com/de/",
    "http://x.com/de", "http://x.com/de/", "http://x.com", "http://x.com?/de/", None, "", "no scheme", "ftp://a.b.example.org/en/1", "x://y://z.com/de/", "http://É.com/de/é",
    "http://example.org/es/?a=http://x.com/fr/",
]


@pytest.mark.parametrize("broadcast", [10_000, 1])
def test_longest_rule_wins(spark, monkeypatch, broadcast):
    monkeypatch.setattr(UF, "BROADCAST_RULES", broadcast)
    rules = [*URL_RULES, ("block", "x.com", "/fr/1"), ("allow", "org", "/es/12345"), ("block", "example.org", "/es/")]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate([*URLS, *URLS])], PAGES).withColumn("rule", F.lit("own")).withColumn("node", F.lit(0))
    got = UF.judge(pages, spark.createDataFrame(rules, RULES)).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        rule, verdict = rule_of(r["url"], rules)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (*split(r["url"]), rule, verdict or "allow"), r
        assert not r["inherited"]


LINK = '<html><link rel="canonical" href="%s">'
LINKED = [
    (1, "http://a.net/x", LINK % "https://z.com/de/9"),  # blocked target
    (2, "http://b.net/y?q=1#f", "<meta content='0; URL=/x2' http-equiv=Refresh>"),
    (3, "http://b.net/x2", "<link href=http://a.net/x rel='nofollow CANONICAL'>"),
    (4, "http://c.org/x", LINK % "http://a.net/x"),  # allowed by its own rule
    (5, "http://d.net/x", "<!-- " + LINK % "http://a.net/x" + " --><script>'" + LINK % "http://a.net/x" + "'</script>"),
    (6, "https://f.net", None), (7, "http://f.net/", LINK % "//a.net/x"),  # one resource
    (8, "http://e.net/a/b", LINK % "c?u=1&amp;v=2"), (9, "http://e.net/a/c?u=1&v=2", LINK % "http://a.net/x"),
    (10, "http://g.net/1", LINK % "#top"), (11, None, LINK % "http://a.net/x"), (12, "http://g.net/2", LINK % ""),
    (13, "http://h.net/1", LINK % "http://c.org/x"),  # by way of an allowed page
    (14, "http://i.net/1", LINK % "mailto:a@b"), (15, "http://j.net/1", "<link rel=stylesheet href='http://a.net/x'>"),
]


def test_blocks_reach_aliases_and_own_allows_precede_them(spark):
    rules = spark.createDataFrame(URL_RULES, RULES)
    got = {r["page_id"]: (r["verdict"], r["inherited"]) for r in UF.judge(spark.createDataFrame(LINKED, PAGES), rules).collect()}
    blocked = {1, 2, 3, 6, 7, 8, 9, 13}
    assert got == {i: ("block", True) if i in blocked else ("allow", False) for i, _, _ in LINKED}
    more = spark.createDataFrame([("http://g.net/1", "http://k.net/"), ("http://k.net/", "http://a.net/x"), (None, "x")], "from_url string, to_url string")
    again = {r["page_id"]: r["verdict"] for r in UF.judge(spark.createDataFrame(LINKED, PAGES), rules, more).collect()}
    assert {i for i, v in again.items() if v == "block"} == blocked | {10}


def test_long_chains_and_empty_tables(spark):
    rules = spark.createDataFrame(URL_RULES, RULES)
    chain = [(i, f"http://n{i}.net/", LINK % (f"http://n{i + 1}.net/" if i < 49 else "http://x.com/de/")) for i in range(50)]
    assert UF.judge(spark.createDataFrame(chain, PAGES), rules).filter("verdict = 'block'").count() == 50
    assert UF.judge(spark.createDataFrame([], PAGES), rules).count() == 0
    assert UF.judge(spark.createDataFrame(chain, PAGES), spark.createDataFrame([], RULES)).filter("verdict = 'allow'").count() == 50


@pytest.mark.parametrize(
    "url,page,node",
    [
        ("http://a.net/x/p", LINK % "../q", "http://a.net/q"), ("http://a.net/x/p", LINK % "./q/./r", "http://a.net/x/q/r"), ("http://a.net/x", LINK % "../../..", "http://a.net/"),
        ("http://a.net/x/p", LINK % "caf&eacute;&#47;&#x62;", "http://a.net/x/café/b"), ("http://a.net/", LINK % "/b?u=1&amp;v=2#f", "http://a.net/b?u=1&v=2"),
        ("http://a.net/", "<link title='a > b' data-x=\"'>\" rel=canonical href=/c>", "http://a.net/c"), ("https://A.net", LINK % "//B.Net", "http://b.net/"),
        ("http://a.net/x", "<base href='http://c.net/y/'>" + LINK % "z", "http://c.net/y/z"), ("http://a.net/x", LINK % "?p=2", "http://a.net/x?p=2"),
        ("http://a.net/x", LINK % "https://d.net/a/b/../%2E%2e/e/.", "http://d.net/e/"), ("http://a.net/x", '<META HTTP-EQUIV="refresh" CONTENT="5;URL=\'y\'">', "http://a.net/y"),
        ("http://a.net/x", LINK % " \n/sp\tace ", "http://a.net/space"), ("http://a.net/x", "<link rel=canonical/href=/no><link data-rel=canonical href=/no>", None),
        ("http://a.net/x", LINK % "http://[bad", None), ("http://a.net/x", "<template>" + LINK % "/t" + "</template>", None), ("http://a.net/" + "y" * 200_000, LINK % ("z" * 100_000), "http://a.net/" + "z" * 100_000),
    ],
)
def test_links_as_a_browser_reads_them(url, page, node):
    assert [UF.node_of(x) for x in UF.links_of(url, page)] == ([node] if node else [])


def test_components_of_many_edges(spark):
    """A hub of 60,000, a chain of 200, a tree and pairs: about 10**5 edges."""
    from bucketvote.llm.components import components

    hub = spark.range(1, 60_001).select(F.lit("hub").alias("u"), F.concat(F.lit("leaf"), F.col("id").cast("string")).alias("v"))
    chain = spark.range(200).select(F.format_string("n%03d", "id").alias("u"), F.format_string("n%03d", F.col("id") + 1).alias("v"))
    tree = spark.range(1, 20_000).select(F.format_string("t%05d", F.floor(F.col("id") / 3)).alias("u"), F.format_string("t%05d", "id").alias("v"))
    pairs = spark.range(20_000).select(F.format_string("p%05da", "id").alias("u"), F.format_string("p%05db", "id").alias("v"))
    found = components(hub.union(chain).union(tree).union(pairs)).withColumn("kind", F.substring("root", 1, 1)).groupBy("kind").agg(F.countDistinct("root").alias("roots"), F.count("*").alias("nodes"))
    assert {r["kind"]: (r["roots"], r["nodes"]) for r in found.collect()} == {"h": (1, 60_001), "n": (1, 201), "t": (1, 20_000), "p": (20_000, 40_000)}


LONG = "This is the first of the long paragraphs, which has so many words in it that it is good."
PAGE = f"""<!DOCTYPE html><html><head><title>no</title><style>p{{}}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><h1>Site name</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><div class="cookie-notice">{LONG}</div>
<article><header><h1>The  head&shy;line</h1></header><p>{LONG}<p><b>Short &amp;&nbsp;bold<br>line</b><div class="ad">{LONG}</div>
<p><a href="x">{LONG}</a></p><pre>a < b &lt; c</pre><section id="comments"><p>{LONG}</p></section></article>
<aside>{LONG}</aside><form><p>{LONG}</p></form><footer>&copy; someone</footer></body></html>"""


def test_article_without_its_surroundings():
    assert HT.main_blocks(PAGE) == ["The head\xadline", LONG, "Short & bold line", "a < b < c"]


@pytest.mark.parametrize(
    "page,expected",
    [
        ("", []), ("just text", ["just text"]), ("<p>", []), ("<article><h1>Only", ["Only"]), ("<article><p>x</p>", ["x"]),
        (f"<p>{LONG}</p><p>Short.</p><ul><li><a href=x>menu item</a></li></ul>", [LONG, "Short."]),  # nearest of the decided
        (f"<ul><li><a href=x>menu item</a></li></ul><p>Short.</p><p>Short two.</p><p>{LONG}</p>", ["Short.", "Short two.", LONG][1:]),
        (f"<div id=main><p>{LONG}</p></div><div class=sidebar><p>{LONG}</p></div>", [LONG]),
        (f"<!-- <p>{LONG}</p> --><div hidden>{LONG}</div><p>{LONG}", [LONG]),
        ("<p>" + "word " * 40 + "</p><p>" + LONG + "</p>", [LONG]),  # long and without stop words
        (f"<article><p>{LONG}</p><!-- cut", [LONG]), (f"<article><p title=\"a > b\">{LONG}</p><a href='", [LONG]),
    ],
)
def test_block_rules(page, expected):
    assert HT.main_blocks(page) == expected


def test_main_text_of_a_table(spark):
    huge = "<article>" + f"<p>{LONG}</p>" * 5000
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", ""), (3, "w", huge), (4, "x", "<" * 20_000), (5, "y", "<a " + "'" * 20_001)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("text", F.lit("own")).withColumn("_llm_html", F.lit("x"))
    got = [tuple(r) for r in HT.main_text(pages.drop("_llm_html")).collect()]
    by = {(a, b): t for a, b, t in got}
    assert len(got) == 7 and got.count((1, "u", "\n".join(HT.main_blocks(PAGE)))) == 2
    assert by[(None, None)] == by[(2, "v")] == "" and by[(3, "w")].count("\n") == 4999
    assert HT.main_text(pages.limit(0)).count() == 0
