"""Ranking, lookups, redirects, sitemaps and crawls against brute force."""

import random
import re
from collections import defaultdict
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from linkhoard.functions import urls as U
from linkhoard.operators import crawl as C
from linkhoard.operators import sitemaps as S
from linkhoard.operators.captures import Captures
from linkhoard.operators.fetch import fetch, follow
from linkhoard.operators.lookup import lookup
from linkhoard.operators.ranking import limit_per_source, number_rows, running_total
from linkhoard.operators.robots import parse
from linkhoard.schemas import RESPONSES
from linkhoard.sources import tables


def responses(spark, *rows):
    """Rows given as dicts with at least ``url``; code 200 unless said otherwise."""
    names = ["url", "code", "message", "content_type", "location", "body", "error_class", "error_message"]
    full = [{**dict.fromkeys(names), "code": "200", "message": "OK", **r} for r in rows]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], RESPONSES)


# Ranking


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_number_rows(spark, chunk):
    rng = random.Random(chunk)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(5)}", o) for o in rng.sample(range(500), 200)]
    df = spark.createDataFrame(rows, "g string, o long")
    got = number_rows(df, "g", "o", extra={"total": "n", "first": "f"}, chunk=chunk).collect()
    groups = defaultdict(list)
    for g, o in rows:
        groups[g].append(o)
    want = {(g, o): (sorted(v).index(o) + 1, len(v), min(v)) for g, v in groups.items() for o in v}
    assert {(r.g, r.o): (r.rn, r.n, r.f) for r in got} == want
    direct = number_rows(df, "g", "o", extra={"total": "n", "first": "f"}, rows=200).collect()
    assert {(r.g, r.o): (r.rn, r.n, r.f) for r in direct} == want
    cut = number_rows(df, "g", "o", chunk=chunk, limit=4).collect()
    assert {(r.g, r.o) for r in cut} == {k for k, v in want.items() if v[0] <= 4}


def test_running_total(spark, plans):
    rng = random.Random(1)
    rows = [("a" if rng.random() < 0.7 else "b", [rng.randrange(4), i], rng.randrange(9)) for i in range(120)]
    df = spark.createDataFrame(rows, "g string, p array<long>, n long")
    got = {tuple(r.p): r.before for r in running_total(df, "g", ["p"], "n", "before", rows=120).collect()}
    assert got == {tuple(p): sum(n2 for g2, p2, n2 in rows if g2 == g and p2 < p) for g, p, _ in rows}


@pytest.mark.parametrize(("limit", "kept"), [(-1, 5), (None, 5), (0, 0), (1, 2), (2, 4), (9, 5)])
def test_limit_per_source(spark, limit, kept):
    urls = spark.createDataFrame([(1, 0, "a"), (1, 5, "b"), (1, 9, "c"), (2, 3, "d"), (2, 4, "e")], "source_id long, ord long, url string")
    assert limit_per_source(urls, limit).count() == kept


def test_limit_below_minus_one(spark):
    with pytest.raises(ValueError):
        limit_per_source(spark.createDataFrame([], "source_id long, ord long"), -2)


# Lookups


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("options", [{}, {"narrow_right": True}, {"rows": 400}, {"rows": 400, "narrow_right": True, "light": True}])
def test_lookup_with_hot_and_null_keys(spark, how, options):
    keys = ["hot"] * 200 + [None] * 100 + [f"k{i}" for i in range(100)]
    left = spark.createDataFrame(list(enumerate(keys)), "i long, k string")
    right = spark.createDataFrame([("hot", 1), ("k3", 2), ("k4", 3), ("unused", 4)], "rk string, v int")
    got = lookup(left, right, "k", "rk", spread=["i"], how=how, **options)
    assert sorted(got.columns) == ["i", "k", "v"]
    values = {"hot": 1, "k3": 2, "k4": 3}
    want = [(i, values.get(k)) for i, k in enumerate(keys) if how == "left" or k in values]
    assert sorted((r.i, r.v) for r in got.collect()) == want


# Redirects


def test_redirects(spark, plans):
    table = responses(
        spark,
        {"url": "https://example.com", "code": "301", "location": "/redirect-path"},
        {"url": "https://example.com/redirect-path"},
        {"url": "http://loop/a", "code": "302", "location": "b"},
        {"url": "http://loop/b", "code": "302", "location": "/a"},
        {"url": "http://bad/1", "code": "301"},
        {"url": "http://bad/2", "code": "301", "location": "ht tp"},
        {"url": "http://bad/3", "code": "301", "location": "ftp://x/"},
        {"url": "http://bad/4", "code": "301", "location": "http://nowhere/"},
        {"url": "http://odd", "code": "100"},
        {"url": "http://gone", "code": "404"},
        {"url": "http://down", "code": None, "error_class": "Timeout::Error", "error_message": "late"},
        *[{"url": f"http://chain/{i}", "code": "301", "location": f"{i + 1}"} for i in range(12)],
        {"url": "http://chain/12"},
    )
    asked = [
        "https://example.com", "http://loop/a", "http://bad/1", "http://bad/2", "http://bad/3", "http://bad/4", "odd", "http://gone",
        "http://down", "http://chain/1", "http://chain/2", "http://none", "http://sp ace",
    ]
    requests = spark.createDataFrame([(u,) for u in asked + asked[:2]], "url string")
    got = {r.url: r for r in follow(requests, table).collect()}
    assert len(got) == len(asked)
    assert {u: (r.error_class, r.final_url, r.code, r.hops) for u, r in got.items()} == {
        "https://example.com": (None, "https://example.com/redirect-path", "200", 1),
        "http://loop/a": ("MaxRedirectError", None, None, 10),
        "http://bad/1": ("InvalidRedirectError", None, None, 0),
        "http://bad/2": ("InvalidURIError", None, None, 0),
        "http://bad/3": ("InvalidURIError", None, None, 1),
        "http://bad/4": ("ClientError", None, None, 1),
        "odd": ("UnknownResponseCodeError", None, None, 0),
        "http://gone": (None, "http://gone", "404", 0),
        "http://down": ("ServerError", None, None, 0),
        "http://chain/1": ("MaxRedirectError", None, None, 10),
        "http://chain/2": (None, "http://chain/12", "200", 10),
        "http://none": ("ClientError", None, None, 0),
        "http://sp ace": ("InvalidURIError", None, None, 0),
    }
    assert got["http://down"].error_message == "Timeout::Error, late"
    one = requests.limit(1)
    assert follow(one, table, max_redirects=1).first().code == "200"
    assert follow(one, table, max_redirects=0).first().error_class == "MaxRedirectError"
    assert follow(one, table, follow_redirects=False).first().code == "301"
    strict = follow(spark.createDataFrame([("http://gone",)], "url string"), table, raise_on_http_error=True).first()
    assert strict.error_class == "ResponseError"


# Sitemaps


def index(*children):
    return ("<sitemapindex>" + "".join(f"<sitemap><loc> {c} </loc></sitemap>" for c in children) + "</sitemapindex>").encode()


def urlset(*pages):
    return ("<urlset>" + "".join(f"<url><loc>{p}</loc></url>" for p in pages) + "</urlset>").encode()


def depth_first(docs, url, visited):
    """The same walk, one document at a time."""
    if url in visited or url not in docs:
        return []
    visited.add(url)
    kind, entries = docs[url]
    return [p for e in entries for p in depth_first(docs, e, visited)] if kind == "index" else list(entries)


def sitemap_table(spark, docs):
    return responses(spark, *[{"url": u, "body": (index if k == "index" else urlset)(*e)} for u, (k, e) in docs.items()])


def test_sitemap_order_on_random_graphs(spark, plans):
    """Acyclic graphs with shared documents and shortcuts, several roots at once."""
    rng = random.Random(7 if plans == "small" else 8)
    docs, sources, want = {}, [], {}
    for g in range(6):
        names = [f"http://g{g}/{i}" for i in range(10)]
        for i, name in enumerate(names):
            later = names[i + 1 :]
            if i == 0 or (later and rng.random() < 0.6):
                docs[name] = ("index", [rng.choice([*later, "http://missing/x"]) for _ in range(rng.randrange(1, 5))])
            else:
                docs[name] = ("urlset", [f"http://p/{g}/{rng.randrange(4)}" for _ in range(rng.randrange(4))])
        for start in (0, 1):
            sources.append((len(sources), names[start]))
            want[sources[-1][0]] = depth_first(docs, names[start], set())
    got = defaultdict(list)
    found = S.sitemap_urls(spark.createDataFrame(sources, "source_id long, source string"), sitemap_table(spark, docs))
    for r in sorted(found.collect(), key=lambda r: (r.source_id, r.ord)):
        assert r.ord == len(got[r.source_id])
        got[r.source_id].append(r.url)
    assert {s: got[s] for s in want} == want


def test_sitemap_cycles_duplicates_and_failures(spark):
    docs = {
        "http://a/i": ("index", ["http://a/u", "http://a/i", "http://a/j", "http://a/u"]),
        "http://a/j": ("index", ["http://a/i", "http://a/v", "http://a/404"]),
        "http://a/u": ("urlset", ["http://a/1", "http://a/1"]),
        "http://a/v": ("urlset", ["http://a/1"]),
    }
    table = sitemap_table(spark, docs).unionByName(
        responses(
            spark,
            {"url": "http://a/404", "code": "404", "body": b"http://a/from-404"},
            {"url": "http://a/moved", "code": "301", "location": "/u"},
            {"url": "http://a/err", "code": None, "error_class": "SocketError"},
        )
    )
    sources = spark.createDataFrame([(1, "a/i"), (2, "http://a/moved"), (3, "http://a/err")], "source_id long, source string")
    got = [(r.source_id, r.url[9:]) for r in S.sitemap_urls(sources, table).orderBy("source_id", "ord").collect()]
    assert got == [(1, "1"), (1, "1"), (1, "1"), (1, "from-404"), (2, "1"), (2, "1")]


def test_sitemap_bodies_at_hand(spark):
    table = sitemap_table(spark, {"http://a/u": ("urlset", ["http://a/1"])})
    bodies = spark.createDataFrame([(1, index("http://a/u", "http://a/u")), (2, b"http://x/\n")], "source_id long, body binary")
    got = [(r.source_id, r.ord, r.url) for r in S.urls_of_bodies(bodies, table).orderBy("source_id").collect()]
    assert got == [(1, 0, "http://a/1"), (2, 0, "http://x/")]


def test_discovery(spark, plans):
    def robots(host, text):
        return {"url": f"http://{host}/robots.txt", "content_type": "text/plain", "body": text}

    def misses(host, names):
        return [{"url": f"http://{host}/{n}", "code": "404"} for n in names]

    names = S.U.SITEMAP_NAMES
    table = responses(
        spark,
        robots("r", b"Sitemap: http://r/s.xml\nSitemap: http://r/s.xml\nSitemap: http://r/none.xml\n"),
        {"url": "http://r/s.xml", "body": urlset("http://r/1")},
        robots("empty", b"Sitemap: http://empty/none.xml"),
        {"url": "http://empty/sitemap_index.xml.gz", "body": urlset("http://empty/1")},
        *misses("c", names[:3]),
        {"url": "http://c/" + names[3], "body": index("http://c/u")},
        {"url": "http://c/u", "body": urlset("http://c/1", "http://c/2")},
        *misses("s", names),
        {"url": "http://s", "body": b"http://s/1\nhttp://s/2"},
        *misses("e", names[:1]),
        {"url": "http://e/" + names[1], "code": None, "error_class": "Timeout::Error"},
        {"url": "http://e/" + names[2], "body": urlset("http://e/1")},
    )
    sources = spark.createDataFrame(list(enumerate(["http://r", "empty", "http://c/", "s", "http://e"])), "source_id long, source string")
    urls, found = S.discover(sources, table)
    got = defaultdict(list)
    for r in urls.orderBy("source_id", "ord").collect():
        got[r.source_id].append(r.url)
    assert dict(got) == {0: ["http://r/1"] * 2, 2: ["http://c/1", "http://c/2"], 3: ["http://s/1", "http://s/2"]}
    assert dict(map(tuple, found.collect())) == {0: "robots", 1: "robots", 2: "candidate", 3: "self", 4: "error"}


# Crawl


def breadth_first(graph, start, accepts, limit):
    order, seen, level, depth = [], {start}, [start], 0
    while level:
        nxt = []
        for page in level:
            if page not in graph:
                continue
            if limit >= 0 and len(order) >= limit:
                return order
            order.append((page, depth))
            for to in graph[page]:
                if to not in seen and accepts(to):
                    seen.add(to)
                    nxt.append(to)
        level, depth = nxt, depth + 1
    return order


@pytest.mark.parametrize("limit", [-1, 7])
def test_crawl_on_random_graphs(spark, plans, limit, monkeypatch):
    monkeypatch.setattr(C, "PARENTS_PER_CHUNK", 3)
    monkeypatch.setattr(C, "LINKS_PER_PART", 2)
    rng = random.Random(limit + 2)
    nodes = [f"http://h{i % 3}/{i}" for i in range(60)]
    graph = {n: [rng.choice([*nodes, "http://h0/missing"]) for _ in range(rng.randrange(5))] for n in nodes if rng.random() < 0.9}
    # A page without links still is a page: it links to itself.
    graph = {s: ds or [s] for s, ds in graph.items()}
    links = C.LinkTable.of_rows(
        spark.createDataFrame([(s, i, d) for s, ds in graph.items() for i, d in enumerate(ds)], "src string, pos long, dst string")
    )
    starts = [n for n in nodes[:12]]
    got = defaultdict(list)
    sources = spark.createDataFrame(list(enumerate(starts)), "source_id long, source string")
    for r in sorted(C.crawl(sources, links, hosts=["h2"], limit=limit).collect()):
        assert r.ord == len(got[r.source_id])
        got[r.source_id].append((r.url, r.depth))
    for i, s in enumerate(starts):
        host = s.split("/")[2]
        assert got[i] == breadth_first(graph, s, lambda u, h=host: u.split("/")[2] in (h, "h2"), limit), s


def test_crawl_of_response_bodies(spark):
    table = responses(
        spark,
        {"url": "http://www.example.com/", "body": b'<a href="http://www.example.com/found">f</a><a href="/moved">m</a><a href="/dead">d</a>'},
        {"url": "http://www.example.com/found", "code": "404", "body": b"<a href='http://other.org/'>o</a>"},
        {"url": "http://www.example.com/moved", "code": "301", "location": "/target"},
        {"url": "http://www.example.com/target", "body": None},
        {"url": "http://www.example.com/dead", "code": None, "error_class": "SocketError"},
        {"url": "http://other.org/"},
    )
    sources = spark.createDataFrame([(1, "www.example.com/")], "source_id long, source string")
    links = C.LinkTable.of_responses(table)
    assert [r.url for r in C.crawl(sources, links).orderBy("ord").collect()] == [
        f"http://www.example.com/{p}" for p in ("", "found", "moved", "target")
    ]
    rules = parse(spark.createDataFrame([("www.example.com", "Disallow: /mov")], "host string, text string"))
    polite = C.crawl(sources, links, rules=rules, user_agent="x").orderBy("ord").collect()
    assert [r.url[23:] for r in polite] == ["", "found"]
    assert C.crawl(sources, links, limit=0).count() == 0


# Sources


def test_url_sources(spark, tmp_path):
    lists = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"])], "source_id long, urls array<string>")
    assert sorted(map(tuple, tables.url_list(lists).collect())) == [(1, 0, "a"), (1, 1, "b"), (2, 0, "c")]
    single = spark.createDataFrame([(1, "a")], "source_id long, urls string")
    assert [tuple(r) for r in tables.url_list(single).collect()] == [(1, 0, "a")]
    (tmp_path / "one.txt").write_text("".join(f" http://x/{i} \n\n" for i in range(500)))
    (tmp_path / "two.txt").write_text("http://y/")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    read = tables.read_url_text(spark, str(tmp_path)).collect()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    files = defaultdict(list)
    for r in sorted(read, key=lambda r: r.ord):
        files[r.source_id].append(r.url)
    assert sorted(files.values(), key=len) == [["http://y/"], [f"http://x/{i}" for i in range(500)]]
    assert len({(r.source_id, r.ord) for r in read}) == len(read)


def test_work_folder_follows_the_session(spark):
    assert tables.work_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "spark://host:7077", "yarn"])
def test_a_cluster_must_name_a_shared_folder(master):
    settings = {"spark.master": master}
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.work_folder(SimpleNamespace(conf=settings))


def test_small_tables_only_when_bounded():
    assert tables.is_small(10) and not tables.is_small(None) and not tables.is_small(10**9)


def _capture_table(spark, rows):
    schema = "url string, code string, message string, content_type string, location string, body binary, error_class string, error_message string, captured_at int"
    return spark.createDataFrame([(u, c, None, None, loc, b, e, None, at) for u, c, loc, b, e, at in rows], schema)


def test_request_keys(spark):
    same = {
        "http://a.example": "http://a.example/",
        "http://A.Example/": "http://a.example/",
        "http://user:pw@a.example:80/#top": "http://a.example/",
        "http://a.example:/": "http://a.example/",
        "https://a.example:443?q=1#x": "https://a.example/?q=1",
        "https://a.example:80/B/": "https://a.example:80/B/",
        "http://a.example/x#y": "http://a.example/x",
        "HTTPS://a.example/x": "https://a.example/x",
        "http://[::1]:80/p": "http://[::1]/p",
        "mailto:a@b": "mailto:a@b",
        "": "",
    }
    df = spark.createDataFrame(list(same.items()), "url string, want string")
    assert [r for r in df.withColumn("got", U.request_key(F.col("url"))).collect() if r["got"] != r["want"]] == []
    assert spark.createDataFrame([(None,)], "url string").select(U.request_key(F.col("url"))).first()[0] is None


@pytest.mark.parametrize("small", [True, False])
def test_captures_answer_once(spark, small, monkeypatch):
    if not small:
        monkeypatch.setattr(tables, "SMALL_ROWS", -1)
    old, new = b"old", b"new"
    table = _capture_table(spark, [
        ("http://a.example", "404", None, old, None, 1), ("http://a.example/#top", "200", None, new, None, 2), ("http://A.example/", "503", None, old, None, None),
        ("http://b.example/", None, None, None, "SocketError", 5), ("http://b.example", "200", None, new, None, 5),
        ("http://c.example/x", "301", "/y#part", None, None, 1), ("http://c.example/y", "200", None, new, None, 1), ("http://c.example/y", "200", None, new, None, 1),
        ("http://d.example/", "302", "#again", None, None, 1), ("http://e.example/", "301", "http://a.example#low", None, None, None),
    ])
    asked = ["a.example", "http://a.example/", "http://a.example/#f", "http://b.example", "http://c.example/x#z", "http://d.example", "http://e.example", "http://none.example"]
    requests = spark.createDataFrame([(u,) for u in asked], "url string")
    read = follow(requests, table, payload=lambda found: found.withColumn("payload", F.col("body").cast("string")))
    got = {r.url: (r.code, r.final_url, r.error_class, r.payload) for r in read.collect()}
    assert len(got) == len(asked) == read.count()
    assert got["a.example"] == ("200", "http://a.example", None, "new") and got["http://a.example/#f"][3] == "new"
    assert got["http://b.example"] == ("200", "http://b.example", None, "new")
    assert got["http://c.example/x#z"] == ("200", "http://c.example/y#part", None, "new")
    assert got["http://d.example"][2] == "MaxRedirectError" and got["http://none.example"][2] == "ClientError"
    assert got["http://e.example"] == ("200", "http://a.example#low", None, "new")
    one = fetch(spark.createDataFrame([("http://A.example#q", 1)], "url string, n int"), table, spread=["n"]).collect()
    assert [(r.url, r.code) for r in one] == [("http://A.example#q", "200")]
    assert sorted(r.url for r in Captures.of(table).single().collect()) == ["http://a.example/#top", "http://b.example", "http://c.example/x", "http://c.example/y", "http://d.example/", "http://e.example/"]


@pytest.mark.parametrize("small", [True, False])
def test_no_plan_shuffles_bodies(spark, tmp_path, small, monkeypatch):
    if not small:
        monkeypatch.setattr(tables, "SMALL_ROWS", -1)
    path = str(tmp_path / "responses")
    _capture_table(spark, [(f"http://h{k}.example/", "200", None, b"x" * k, None, 1) for k in range(50)]).write.parquet(path)
    plans = []
    kept = tables.materialize
    monkeypatch.setattr(tables, "materialize", lambda df, label: (plans.append(df._jdf.queryExecution().executedPlan().toString()), kept(df, label))[1])
    monkeypatch.setattr("linkhoard.operators.captures.materialize", tables.materialize)
    table = spark.read.parquet(path)
    out = follow(table.select("url"), table, payload=lambda found: found.withColumn("payload", F.length("body")), rows=50)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert out.filter("payload is not null").count() == 50
    lines = [line for plan in plans for line in plan.splitlines()]
    assert any("body#" in line for line in lines)
    # What stands below an exchange in its own stage reads bodies only to take something from them: no projection that feeds one keeps the column.
    for k, line in enumerate(lines):
        if "Exchange " in line and "Broadcast" not in line:
            below = next((x for x in lines[k + 1 :] if "Project [" in x or "Aggregate" in x or "Scan" in x), "")
            assert not re.search(r"\bbody#\d+(?=[,\]])", below.split("Scan")[0]), line + below
