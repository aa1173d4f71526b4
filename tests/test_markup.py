"""Character references and links against Python's own, folds against loops."""

import html
import os
import time
from urllib.parse import unquote, urljoin

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallgrass.functions import markup as M
from tallgrass.operators import reshape as R

BASES = ["http://h/a/b.html", "https://h.org/a/b/c?q=1#f", "http://h", "http://h/", "http://h/a//b/", "http://h/x;p?y",
         "https://h:8080/d/./e/../f"]
LINKS = ["", "?v=1", "#top", "?", "#", "//host", "//host/x?y", "../", "..", ".", "./", "../..", "../../../x", "g", "./g", "g/",
         "/g", "g?y", "g?y#s", "g;x", ";x", "../g", "../../g", "/./g", "/../g", "g.", ".g", "g..", "..g", "./../g", "./g/.",
         "g/./h", "g/../h", "g?y/./x", "g#s/../x", "mailto:a@b", "http:g", "HTTP://X/y", "http://x", "x//y", "a b.xlsx",
         "/x//y", "ftp://o/p", "javascript:void(0)", "é/ü?ñ", "%20%zz", "a..b/c", "///x"]


def resolved(spark, pairs):
    df = spark.createDataFrame([(i, b, h) for i, (b, h) in enumerate(pairs)], "i int, b string, h string")
    out = df.select("i", M.resolve(F.col("b"), M.link_parts(F.col("b")), F.col("h")).alias("r")).collect()
    return [r["r"] for r in sorted(out)]


def test_links_resolve_as_urljoin_does(spark):
    pairs = [(b, h) for b in BASES for h in LINKS if h != "///x"]
    got = resolved(spark, pairs)
    assert {p: g for p, g in zip(pairs, got)} == {p: urljoin(*p) for p in pairs}


def test_random_links_resolve_as_urljoin_does(spark):
    piece = st.sampled_from(["a", "b.c", "..", ".", "x y", "é", "a=1"])
    path = st.lists(piece, max_size=5).map("/".join)
    href = st.builds(lambda p, lead, q, f: lead + p + q + f, path, st.sampled_from(["", "/", "./", "../"]),
                     st.sampled_from(["", "?v=1", "?a/../b"]), st.sampled_from(["", "#top", "#a/b"]))
    pairs = []

    @settings(max_examples=400, deadline=None)
    @given(st.sampled_from(BASES), href)
    def collect(b, h):
        pairs.append((b, h))
    collect()
    assert resolved(spark, pairs) == [urljoin(b, h) for b, h in pairs]


def test_file_names_decode_as_unquote_does(spark):
    links = ["https://h/x/a%20b.xlsx", "https://h/x/a+b.xlsx", "https://h/x/50%zz%20c.xlsx", "https://h/x/a.xlsx?v=1",
             "https://h/%C3%A9.xlsx", "https://h/x/", "https://h/a%2Fb.xls", "https://h/100%", "plain"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(links)], "i int, link string")
    got = [r[1] for r in sorted(df.select("i", M.file_name(F.col("link"))).collect())]
    assert got == [os.path.basename(unquote(x)) for x in links]


def test_references_decode_as_html_does(spark):
    texts = ["", "&", "&&amp;&", "R&eacute;sum&#xe9; &ndash;", "&amp;lt;", "&lt;b&gt;", "&#39;&#039;&#x27;", "&nbsp;x", "&copy2", "&copy",
             "&notit;", "&notin;", "&unknown;", "&#0;&#x110000;&#xD800;&#128;&#x9f;", "&#1;&#13;&#xFFFE;", "&#;&#x;&#xg;", "&AMP&amp",
             "&NotEqualTilde;", "a&b=c", "&#99999999999999999999;", "&Aacute", "&CounterClockwiseContourIntegral;", "&#x1F600;é&#233",
             "&ampamp;", "& amp;", "&amp ;"]
    marks = st.sampled_from(["&", "amp", "lt", ";", "#", "x41", "65", "eacute", "not", "in", " ", "z", "notin;", "&#"])
    words = []

    @settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.too_slow])
    @given(st.lists(marks, max_size=8).map("".join))
    def collect(t):
        words.append(t)
    collect()
    texts += words
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[1] for r in sorted(df.select("i", M.decoded(F.col("t"))).collect())]
    assert [(t, g) for t, g in zip(texts, got)] == [(t, html.unescape(t)) for t in texts]
    # every name of the table
    names = sorted(n for n in M.html5 if n.endswith(";"))
    df = spark.createDataFrame([("".join(f"&{n}" for n in names),)], "t string")
    assert df.select(M.decoded(F.col("t"))).first()[0] == "".join(M.html5[n] for n in names)


def test_references_in_attributes(spark):
    df = spark.createDataFrame([("?a=1&copy=2&lt;&amp;x&copy&reg;",)], "t string")
    assert df.select(M.decoded(F.col("t"), attribute=True)).first()[0] == "?a=1&copy=2<&x©®"


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 1000])
def test_fold_yields_in_order(spark, n):
    out = M.fold_out(F.expr(f"slice(sequence(1, {n + 1}), 1, {n})"), F.struct(F.lit(0).alias("sum")), "int",
                     lambda s, x: (F.struct((s["sum"] + x).alias("sum")), F.when(x % 3 == 0, s["sum"])))
    r = spark.range(1).select(out.alias("r")).first()["r"]
    want, total = [], 0
    for x in range(1, n + 1):
        want += [total] if x % 3 == 0 else []
        total += x
    assert (r["s"]["sum"], list(r["out"])) == (total, want)


def long_page(n):
    cell = "".join(f'<li><a href="f{i % (n // 2 + 1)}.xlsx">{R.PRIMARY_LINK_TEXT if i % 2 else R.COMPANION_LINK_TEXT}</a></li>'
                   + (f"</ul></div><h2>FY {2001 + i % 50}</h2><div class='text aem-GridColumn--default--12'><ul>" if i % 10 == 9 else "")
                   for i in range(n))
    return ("<div class='aem-Grid aem-Grid--12 aem-Grid--default--12'><div class='title aem-GridColumn--default--12'>"
            f"<h2>FY 2020</h2></div><div class='text aem-GridColumn--default--12'><ul>{cell}</ul></div></div>")


def test_long_pages_take_time_in_proportion(spark):
    def seconds(n, pages):
        df = spark.createDataFrame([(i, "https://h/x/", long_page(n)) for i in range(pages)], "page_id long, url string, html string")
        t = time.time()
        rows = R.discover_links(df.coalesce(1)).collect()
        return time.time() - t, len(rows)
    seconds(50, 1)
    many, n_many = seconds(1000, 8)
    one, n_one = seconds(8000, 1)
    assert n_one > 3000 and n_many > 8 * 400
    assert one < 3 * many + 2, (one, many)
