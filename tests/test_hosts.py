"""Strategies, hosts and limits of single sources."""

import random
import re
from collections import defaultdict

import pytest

from linkhoard.config import Options
from linkhoard.operators import crawl as C
from linkhoard.operators import hosts as H
from linkhoard.operators.ranking import limit_by_source
from linkhoard.operators.submit import RecordedAdapter
from linkhoard.plans.archive import archive

from .test_runs import index, responses, saved, urlset
from .test_steps import breadth_first

NAMES = ["a.org", "b.a.org", "xa.org", "A.org", "c.b.a.org", "org", "a.net", ".".join("abcdefghijkl") + ".org", "k.l.org", "a..org"]
RULES = [
    "a.org", ".a.org", ".org", "B.A.ORG", ". ", "/", "//", " ", "", None, "/a/", r"/^b\./", r"/\.org$/", r"/\.b\.a\.org$/", r"/(a|b)\.net$/",
    r"/^(x|y)|\.net$/", r"/\\.org$/", r"/[.]org$/", ".c.d.e.f.g.h.i.j.k.l.org", ".b.d.e.f.g.h.i.j.k.l.org", ".".join("abcdefghijkl") + ".org",
]
SOURCES = "source_id long, source string, hosts array<string>"


def allows(rule, host):
    rule = (rule or "").strip(" ")
    if len(rule) > 1 and rule[0] == rule[-1] == "/":
        return len(rule) > 2 and re.search(rule[1:-1], host) is not None
    if rule.startswith("."):
        name = rule[1:].lower()
        return name != "" and (host.lower() == name or host.lower().endswith("." + name))
    return host.lower() == rule.lower()


def test_each_rule_accepts_the_hosts_it_names(spark, plans):
    rules = H.index(spark.createDataFrame([*[(i, "", [r]) for i, r in enumerate(RULES)], (None, "", RULES), (99, "", None)], SOURCES))
    ids = [*range(len(RULES)), None, 99]
    pairs = spark.createDataFrame([(i, h) for i in ids for h in [*NAMES, None]], "source_id long, host string")
    got = {(r.source_id, r.host) for r in H.accepted(pairs.union(pairs), rules, rows=10_000).collect()}
    want = {(i, h) for i, r in enumerate(RULES) for h in NAMES if allows(r, h)}
    assert got == want | {(None, h) for h in NAMES if any(allows(r, h) for r in RULES)}


def test_patterns_lie_under_the_labels_they_end_in(spark):
    given = {r"/\.org$/": "org", r"/(a|b)\.net$/": "", r"/^b[0-9]+\.a\.org$/": "a.org", r"/\\.org$/": "", "/a/": "", ".A.org": "a.org", "x.y": "x.y"}
    for rule, key in given.items():
        rows = H.index(spark.createDataFrame([(1, "", [rule])], SOURCES)).collect()
        assert [r.place for r in rows] == [f"1\n{key}"], rule


def test_no_rules_need_no_index(spark):
    assert H.index(spark.createDataFrame([(1, "a", []), (2, "b", None), (3, "c", [" "])], SOURCES)) is None


def test_crawl_with_rules_of_each_source(spark, plans, monkeypatch):
    monkeypatch.setattr(C, "PARENTS_PER_CHUNK", 3)
    rng = random.Random(5)
    nodes = [f"http://{rng.choice('ab')}.h{i % 3}.org/{i}" for i in range(60)]
    graph = {n: [rng.choice([*nodes, "http://a.h0.org/missing"]) for _ in range(rng.randrange(1, 5))] for n in nodes}
    links = C.LinkTable.of_rows(
        spark.createDataFrame([(s, i, d) for s, ds in graph.items() for i, d in enumerate(ds)], "src string, pos long, dst string")
    )
    choices = [None, [], ["a.h1.org"], [".h2.org"], [r"/^b\.h[01]/", "a.h2.org"], [r"/\.h0\.org$/"], [".org"]]
    given = [(i, nodes[i], choices[i % len(choices)]) for i in range(14)]
    got = defaultdict(list)
    for r in sorted(C.crawl(spark.createDataFrame(given, SOURCES), links, hosts=["b.h1.org"]).collect()):
        assert r.ord == len(got[r.source_id])
        got[r.source_id].append((r.url, r.depth))
    for i, start, rules in given:
        host = start.split("/")[2]

        def accepts(url, host=host, rules=rules):
            to = url.split("/")[2]
            return to in (host, "b.h1.org") or any(allows(r, to) for r in rules or [])

        assert got[i] == breadth_first(graph, start, accepts, -1), start


def test_limits_of_single_sources(spark, plans):
    urls = spark.createDataFrame([(s, o, f"u{o}") for s in (1, 2, 3, 4, 5, None) for o in range(4)], "source_id long, ord long, url string")
    limits = spark.createDataFrame([(1, 2), (2, 0), (3, -1), (4, None), (None, 1), (1, 3)], "source_id long, url_limit int")
    for default, rest in ((-1, 4), (3, 3)):
        left = defaultdict(list)
        for r in limit_by_source(urls, limits, default).collect():
            left[r.source_id].append(r.ord)
        want = {1: 2, 3: 4, 4: rest, 5: rest, None: 1}
        assert {s: sorted(o) for s, o in left.items()} == {s: list(range(n)) for s, n in want.items()}


def test_one_run_with_a_strategy_for_each_source(spark, plans):
    table = responses(
        spark,
        {"url": "http://a/robots.txt", "content_type": "text/plain", "body": b"Sitemap: http://a/s.xml"},
        {"url": "http://a/s.xml", "body": index("http://a/u")},
        {"url": "http://a/u", "body": urlset("http://a/1", "http://a/2", "http://a/3")},
        {"url": "http://a", "body": b'<a href="/own">x</a>'},
        {"url": "http://a/own", "body": b""},
        {"url": "http://b", "body": b'<a href="http://a/own">away</a><a href="/y">y</a>'},
        {"url": "http://b/y", "body": b""},
    )
    given = [
        (1, "http://a", None, None, None),
        (2, "http://a", "crawl", None, None),
        (3, "http://a/s.xml", "sitemap", None, 1),
        (4, "http://b", None, ["/^a$/"], None),
        (5, "http://b", "crawl", ["a"], -1),
        (6, "http://b", "url", None, None),
        (7, "http://b", "crawl", ["a"], 0),
    ]
    sources = spark.createDataFrame(given, "source_id long, source string, strategy string, hosts array<string>, url_limit int")
    run = archive(sources, table, RecordedAdapter(saved(spark, ("http://b", {}))), Options(limit=2))
    got = defaultdict(list)
    for r in run.results.orderBy("source_id", "ord").collect():
        got[r.source_id].append(r.uri)
    assert got == {
        1: ["http://a/1", "http://a/2"],
        2: ["http://a", "http://a/own"],
        3: ["http://a/1"],
        4: ["http://b", "http://a/own"],
        5: ["http://b", "http://a/own", "http://b/y"],
        6: ["http://b"],
    }
    assert {r.source_id: r.n_found for r in run.summary.collect()} == {1: 3, 2: 2, 3: 3, 4: 2, 5: 3, 6: 1, 7: 0}
    assert archive(sources.limit(0), table, RecordedAdapter(saved(spark))).results.count() == 0


@pytest.mark.parametrize(("column", "value"), [("strategy", "walk"), ("url_limit", -2)])
def test_settings_that_say_nothing_are_refused(spark, column, value):
    sources = spark.createDataFrame([(1, "http://a", value)], f"source_id long, source string, {column} {'string' if column == 'strategy' else 'int'}")
    with pytest.raises(ValueError, match="1 sources"):
        archive(sources, responses(spark, {"url": "http://a", "body": b""}), RecordedAdapter(saved(spark, ("x", {}))))
