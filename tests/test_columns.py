"""Column functions, each over a table of cases."""

import gzip
import re
import zlib
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from linkhoard.functions import html, http
from linkhoard.functions import sitemap as S
from linkhoard.functions import urls as U


def evaluate(spark, cases, schema, *columns):
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], f"i int, {schema}")
    return [tuple(r)[1:] for r in sorted(rows.select("i", *columns).collect())]


def one(spark, values, column):
    return [r[0] for r in evaluate(spark, [(v,) for v in values], "v string", column(F.col("v")).alias("out"))]


def test_code_type(spark):
    cases = {
        "200": "success", "1200": "success", "301": "redirect", "302": "redirect", "400": "error", "404": "error",
        "500": "error", "503": "error", "999": "unknown", "100": "unknown", None: "unknown",
    }
    assert one(spark, list(cases), http.code_type) == list(cases.values())


def test_error_family(spark):
    cases = {
        "Timeout::Error": "ServerError", "Zlib::BufError": "ServerError", "Errno::ECONNRESET": "ClientError",
        "SocketError": "ClientError", "MaxRedirectError": "MaxRedirectError", "Other": "Error", None: None,
    }
    assert one(spark, list(cases), http.error_family) == list(cases.values())


def test_strip_and_blank(spark):
    values = [None, "", "  ", "\t\n\u000b\f\r\u0000", " a b ", "a"]
    assert one(spark, values, U.strip) == [None, "", "", "", "a b", "a"]
    assert one(spark, values, U.is_blank) == [True, True, True, True, False, False]


def test_with_scheme(spark):
    values = ["example.com", "http://a", "https://a", "HTTP://a", "x\nhttp://a", "ftp://a"]
    want = ["http://example.com", "http://a", "https://a", "http://HTTP://a", "x\nhttp://a", "http://ftp://a"]
    assert one(spark, values, U.with_scheme) == want


def test_is_http_url(spark):
    good = [
        "http://a", "https://a.b:80/c?d=e#f", "HTTP://a/", "http://u:p@h/", "http://[::1]:8/x", "http://a_b.com/%20",
        "http://a?x", "http://a/" + "y" * 200_000, "http://a/" + "%41" * 50_000,
    ]
    bad = [None, "", "a.com", "ftp://a/", "http://a b", "http://a/é", "http://a/%zz", "http://a/<x>", "/x", "http://a\n"]
    assert one(spark, good + bad, U.is_http_url) == [True] * len(good) + [False] * len(bad)


def test_parts(spark):
    values = ["http://u:p@h.x:81/a/b?c=d#e", "https://h", "http://h?q#f", "/p", "http://[::1]:8/x", "http://a_b/"]
    assert one(spark, values, U.host) == ["h.x", "h", "h", None, "[::1]", "a_b"]
    assert one(spark, values[:3], U.request_path) == ["/a/b?c=d", "/", "/?q"]
    assert one(spark, values[:1], U.robots_url) == ["http://u:p@h.x:81/robots.txt"]


def test_resolve_like_the_standard_library(spark):
    bases = ["http://h/a/b/c?q=1#f", "http://h", "http://h/", "https://h:8/a/../b/", "http://h/x/y/"]
    refs = [
        "g", "./g", "g/", "/g", "//g/x", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "g;x", "", ".", "./", "..", "../", "../g",
        "../..", "../../", "../../g", "../../../g", "/./g", "/../g", "g.", ".g", "g..", "./../g", "./g/.", "g/./h", "g/../h",
        "http://o/p", "x/../../y?z=../w",
    ]
    cases = [(b, r) for b in bases for r in refs]
    got = evaluate(spark, cases, "b string, r string", U.resolve(F.col("b"), F.col("r")).alias("out"))

    def want(base, ref):
        if ref == "":
            return base
        if ref.startswith("?"):  # the standard library normalises the base path as well
            return base.split("#")[0].split("?")[0] + ref
        if ref.startswith("#"):
            return base.split("#")[0] + ref
        return urljoin(base, ref)

    wrong = [(c, g[0], want(*c)) for c, g in zip(cases, got) if g[0] != want(*c)]
    assert wrong == []


def test_host_matches(spark):
    values = ["shop.test", "my.shop.test", "eu-west.mirror.test", "eu-west.mirror.test.evil", "mirror.test", None]
    rules = ["shop.test", re.compile(r"^[a-z]{2}-\w+\.mirror\.test$")]
    assert one(spark, values, lambda c: U.host_matches(c, rules)) == [True, False, True, False, False, False]


def test_redirect_target(spark):
    cases = [
        ("http://example.com", "/path", "http://example.com/path", None),
        ("http://example.com", "https://o.org/x", "https://o.org/x", None),
        ("http://example.com", None, None, "InvalidRedirectError"),
        ("http://example.com", "http://a b", None, "InvalidURIError"),
    ]
    at, to = F.col("a"), F.col("l")
    got = evaluate(
        spark, [c[:2] for c in cases], "a string, l string", http.redirect_target(at, to).alias("t"), http.redirect_error(to).alias("e")
    )
    assert got == [c[2:] for c in cases]


def test_decode_body(spark):
    plain, zipped = b"some text\n", gzip.compress(b"some text\n")
    cases = [None, plain, zipped, zipped[:-3], zipped[:-8] + b"\0" * 8, zipped + gzip.compress(b"more"), b"\x1f\x8b", b""]
    want = [b"", plain, b"some text\n", zipped[:-3], zipped[:-8] + b"\0" * 8, b"some text\n", b"\x1f\x8b", b""]
    got = evaluate(spark, [(c,) for c in cases], "v binary", S.decode_body(F.col("v")).alias("out"))
    assert [bytes(r[0]) for r in got] == want


NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
DOCUMENTS = [
    # body, kind, page locations, child locations
    (f'<?xml version="1.0"?>\n<urlset {NS}>\n<url>\n<loc> http://a/ </loc><lastmod>2005-01-01</lastmod></url></urlset>', "urlset", ["http://a/"], []),
    (f"<sitemapindex {NS}><sitemap><loc>http://a/1</loc></sitemap><sitemap><loc>http://a/2</loc></sitemap></sitemapindex>", "index", [], ["http://a/1", "http://a/2"]),
    ("<a></a><b></b>", "plain", [], []),
    ("<a></a><a></a>", "plain", [], []),
    ("<a/><a/>", "plain", [], []),
    ("<a><a></a></a>", "other", [], []),
    ("http://a/1\n  https://a/2 \r\nnope\nftp://a/3", "plain", ["http://a/1", "https://a/2"], []),
    ("", "plain", [], []),
    (None, "plain", [], []),
    ("<urlset/>", "urlset", [], []),
    ("<urlset></urlset>http://a/1", "plain", [], []),
    ("<urlset></urlset>\nhttp://a/1\n", "plain", ["http://a/1"], []),
    ("<urlset></urlset>\n<!-- <b> -->\n<?pi x?>\n", "urlset", [], []),
    ("<!DOCTYPE urlset [<!ELEMENT urlset ANY>]>\n<!-- c --><urlset><url><loc>http://a/</loc></url></urlset>", "urlset", ["http://a/"], []),
    ("﻿<urlset><url><loc>http://a/?x&amp;y</loc></url></urlset>", "urlset", ["http://a/?x&y"], []),
    ("<urlset><url><loc>http://a/?x&y</loc></url></urlset>", "plain", [], []),
    ("<urlset><url><loc><![CDATA[http://a/?x&y]]></loc></url><url><loc/></url><url/></urlset>", "urlset", ["http://a/?x&y"], []),
    ("<sm:urlset xmlns:sm='x'><sm:url><sm:loc>http://a/</sm:loc></sm:url></sm:urlset>", "urlset", [], []),
    ("<feed><url><loc>http://a/</loc></url></feed>", "other", ["http://a/"], []),
    ("<urlset><x><url><loc>http://a/</loc></url></x></urlset>", "urlset", [], []),
    ("<html><head><meta charset=x></head></html>", "plain", [], []),
    ("<urlset><url><loc>http://a/</loc></url>", "plain", [], []),
]


def test_sitemap_documents(spark):
    bodies = spark.createDataFrame([(i, d[0]) for i, d in enumerate(DOCUMENTS)], "i int, body string")
    parsed = S.with_document(bodies.withColumn("body", F.col("body").cast("binary")), "d").orderBy("i").collect()
    got = [(r.d.kind, r.d.page_locs, r.d.child_locs) for r in parsed]
    assert got == [d[1:] for d in DOCUMENTS]
    names = [r.d.root_name for r in parsed]
    assert names[0] == "urlset" and names[1] == "sitemapindex" and names[2] is None and names[17] == "urlset"


def test_links(spark):
    page = """<html><head><link rel=x href='/style.css'></head><body><!-- <a href="/no1"> -->
    <script>var s = '<a href="/no2">';</script><a class="a>b" href="/found#part">x</a><A HREF=rel/y?a=1&amp;b=2>y</a>
    <a name="no3">z</a><iframe src="//o.org/f"></iframe><frame src=' g '><a href="mailto:x@y">m</a><a data-href="/no4">n</a>
    <a href="">self</a><a href="#top">top</a>"""
    got = evaluate(spark, [(page,)], "v string", html.links(F.lit("http://h/d/p.html#q"), F.col("v")).alias("out"))[0][0]
    assert [(x.pos, x.dst) for x in got] == [
        (0, "http://h/style.css"), (1, "http://h/found"), (2, "http://h/d/rel/y?a=1&b=2"), (3, "http://o.org/f"),
        (4, "http://h/d/g"), (5 + 1, "http://h/d/p.html"), (7, "http://h/d/p.html"),
    ]


@pytest.mark.parametrize("text", ["<a " * 20_000, "<a x" + "y" * 300_000, "<!--" * 50_000, '<a href="' + "x" * 300_000])
def test_links_of_broken_pages(spark, text):
    assert evaluate(spark, [(text,)], "v string", html.links(F.lit("http://h/"), F.col("v")).alias("out"))[0][0] == []


def test_sitemap_encodings(spark):
    def body(declared, codec, loc="http://a/é"):
        return f'<?xml version="1.0"{declared}?><urlset><url><loc>{loc}</loc></url></urlset>'.encode(codec)

    read = [
        body("", "utf-8"), body(' encoding="UTF-8"', "utf-8-sig"), body(" encoding='ISO-8859-1'", "latin-1"), body(' encoding="windows-1252"', "cp1252"),
        body(' encoding="UTF-16"', "utf-16"), body("", "utf-16-le"), body(' encoding="utf-16"', "utf-16-be"), body("", "utf-32"),
        gzip.compress(body(' encoding="latin1"', "latin-1")), body(' encoding="UTF-16"', "utf-8"), body(' encoding="ISO-8859-1"', "utf-8-sig"),
    ]
    unread = [body(' encoding="no-such"', "utf-8"), b"\xff\xfe\x00", body(' encoding="hex"', "utf-8"), body(' encoding="ascii-8"', "utf-8"), b"\xfe\xff\xd8\x00"]
    empty = [None, b"", gzip.compress(b"")]
    lines = "http://a/1\nhttp://a/2".encode("utf-16")  # a text of lines, which takes ASCII URLs only
    rows = spark.createDataFrame(list(enumerate([*read, *unread, *empty, lines])), "i int, body binary")
    got = {r.i: r.d for r in S.with_document(rows, "d").collect()}
    for i in range(len(read)):
        assert (got[i].page_locs, got[i].dropped) == (["http://a/é"], 0), read[i]
    for i in range(len(read), len(read + unread)):
        assert (got[i].kind, got[i].page_locs, got[i].dropped) == ("plain", [], 1), unread[i - len(read)]
    assert got.pop(len(got) - 1).page_locs == ["http://a/1", "http://a/2"]
    for i in range(len(read + unread), len(got)):
        assert (got[i].page_locs, got[i].dropped) == ([], 0)
