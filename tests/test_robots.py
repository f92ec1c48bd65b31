"""robots.txt against a plain restatement of its rules."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkhoard.functions import robots as RF
from linkhoard.operators import robots as R

NEVER = re.compile(r"(?!)")


def compile_pattern(value):
    return re.compile("^" + re.escape(value).replace(r"\*", ".*")) if value.strip() else NEVER


def plain_verdict(text, path, agent_name):
    """Line by line, as one would read the file."""
    agent, denied, allowed = re.compile(".*"), False, False
    lines = text.split("\n")
    for number, line in enumerate(lines):
        if not line.strip() or line.strip().startswith("#"):
            continue
        if number < len(lines) - 1:
            line += "\n"
        else:
            line = line.rstrip(":")
        key, _, value = line.partition(":")
        value = value.strip()
        if key == "User-agent":
            agent = compile_pattern(value)
        elif key in ("Allow", "Disallow") and agent.search(agent_name) and compile_pattern(value).search(path):
            allowed |= key == "Allow"
            denied |= key == "Disallow"
    return not denied or allowed


def documents(spark, *texts):
    return spark.createDataFrame([(f"h{i}", t) for i, t in enumerate(texts)], "host string, text string")


def test_entries(spark):
    text = "# c\n\n  # d\nUser-agent: *\r\nDisallow\n Allow: /x\nSitemap: http://a:80/s.xml\nSitemap: end::"
    got = documents(spark, text).select(F.inline(RF.entries(F.col("text")))).collect()
    assert [tuple(r) for r in got] == [
        (4, "User-agent", "*"), (5, "Disallow\n", ""), (6, " Allow", "/x"), (7, "Sitemap", "http://a:80/s.xml"), (8, "Sitemap", "end"),
    ]


def test_rules_delays_and_others(spark):
    text = (
        "Disallow: /early\nUser-agent: a.b*\nUser-agent: c\nDisallow: /x?*$\nAllow:\nCrawl-delay: 7s\nCrawl-delay: 3\n"
        "User-agent: a.b*\nCrawl-delay: x\nHost: me\nsitemap: low\nSitemap: high\n"
    )
    parsed = R.parse(documents(spark, text))
    rules = [tuple(r)[1:] for r in R.rules(parsed).orderBy("line_no").collect()]
    assert rules == [
        (1, ".*", "Disallow", "^/early"), (4, "^c", "Disallow", r"^/x\?.*\$"), (5, "^c", "Allow", "(?!)"),
    ]
    assert sorted(tuple(r)[1:] for r in R.delays(parsed).collect()) == [(r"^a\.b.*", 0), ("^c", 3)]
    assert sorted(tuple(r)[1:3] for r in R.others(parsed).collect()) == [("Host", "me"), ("Sitemap", "high"), ("sitemap", "low")]
    assert [tuple(r)[1:] for r in R.sitemaps(parsed).collect()] == [(0, "high")]


def test_acceptance(spark):
    given_ = [
        ("a", "200", "OK", "text/plain", b"x"), ("b", "200", "OK", "text/plain; charset=utf-8", b"x"), ("c", "200", "OK", "text/html", b"x"),
        ("d", "404", "Not Found", "text/plain", b"x"), ("e", "200", "ok", "text/plain", b"x"), ("f", None, None, None, None),
    ]
    docs = spark.createDataFrame(given_, "host string, code string, message string, content_type string, body binary")
    got = {r.host: (r.accepted, r.text) for r in R.accepted_documents(docs).collect()}
    default = (False, "User-agent: *\nAllow: /\n")
    assert got == {"a": (True, "x"), "b": (True, "x"), "c": default, "d": default, "e": default, "f": default}


_line = st.builds(
    lambda key, colon, value: f"{key}{colon}{value}",
    st.sampled_from(["User-agent", "Allow", "Disallow", "allow", " Disallow", "#", "Sitemap", ""]),
    st.sampled_from([": ", ":", " : ", ""]),
    st.sampled_from(["*", "bot", "linkhoard", "link*rd", "/", "/a", "/a*", "/*b", "/a$", "/a.b", "/a?x=", "", " /a/ ", "/a/b::"]),
)
_document = st.builds(lambda lines, end: "\n".join(lines) + end, st.lists(_line, max_size=8), st.sampled_from(["", "\n", "\r\n"]))
PATHS = ["/", "/a", "/a/b", "/b", "/a?x=1", "/a.b", "/axb", "/c/b", "/a$"]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_document, min_size=40, max_size=40))
def test_verdicts(spark, texts):
    urls = spark.createDataFrame(
        [(f"http://h{i}{p}",) for i in range(len(texts)) for p in PATHS] + [("http://unknown/a",)], "url string"
    )
    got = {r.url: r.allowed for r in R.verdicts(urls, R.parse(documents(spark, *texts)), "linkhoard/0.1", rows=1000).collect()}
    want = {f"http://h{i}{p}": plain_verdict(t, p, "linkhoard/0.1") for i, t in enumerate(texts) for p in PATHS}
    want["http://unknown/a"] = True
    assert {u: (got[u], texts[int(u[8:].split("/")[0])]) for u in want if u != "http://unknown/a" and got[u] != want[u]} == {}
    assert got == want


def test_schedule(spark, plans):
    urls = spark.createDataFrame([(f"h{i % 2}", i) for i in range(10)], "host string, ord long")
    parsed = R.parse(documents(spark, "User-agent: link*\nCrawl-delay: 4\nUser-agent: other\nCrawl-delay: 9\n", ""))
    got = {r.ord: r.start_s for r in R.schedule(urls, parsed, "linkhoard/0.1").collect()}
    assert got == {i: 4 * (i // 2) if i % 2 == 0 else 0 for i in range(10)}


def test_long_documents(spark):
    n = 5_000
    many = "".join(f"User-agent: a{i}\nDisallow: /{i}\nCrawl-delay: {i}\n" for i in range(n))
    again = "Allow: /first\n" + "User-agent: b\nCrawl-delay: 1\nUser-agent: c\nCrawl-delay: 2\n" * n + "User-agent: b\nUser-agent: d"
    parsed = R.parse(documents(spark, many, again, ""))
    rules = {(r.host, r.line_no): r.agent_pattern for r in R.rules(parsed).collect()}
    assert rules == {("h0", 3 * i + 2): f"^a{i}" for i in range(n)} | {("h1", 1): ".*"}
    delays = [tuple(r) for r in R.delays(parsed).collect()]
    assert delays == [("h0", f"^a{i}", i) for i in range(n)] + [("h1", "^b", 1), ("h1", "^c", 2)]
