from linkhoard.llm import sitetree

SCHEMA = "page_id long, url string, html string"
ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></ul></nav><div class="cookie-notice">Cookies</div><!-- x --><div class="ad">Buy</div>
<article><header><h1>Title &amp; more</h1></header><p>One <b>two</b>three<br>four<p>F&eacute;&nbsp;ve &lt;6&gt;<ul><li>a<li>b</ul><form>Mail<input></form>
<aside>side</aside><table><tr><td>c1<td>c2</table></article><section id="comments"><article><p>Reader</p></article></section><footer>End</footer></body></html>"""


def extracted(spark, rows, **settings):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as host", "'y' as text", "1 as node")
    return sorted(((r["page_id"], r["text"]) for r in sitetree.extract(df, sitetree.Settings(**settings)).collect()), key=str)


def test_blocks_of_one_page(spark):
    want = "Title & more One twothree four Fé ve <6> a b c1 c2"
    assert sitetree.main_text(ARTICLE, {}) == want
    assert sitetree.main_text(ARTICLE.replace("article", "div").replace('id="comments"', 'class="reader-comments"'), {}) == "One twothree four Fé ve <6> a b c1 c2"
    assert extracted(spark, [(1, "http://h/", ARTICLE), (2, None, ARTICLE), (2, None, ARTICLE)]) == [(1, want), (2, want), (2, want)]


def site(n, host="http://s.example/", inside=""):
    return [(i, f"{host}{i}", f"<body><div class='top'>Welcome to us</div><div class='story'><h2>Story {i}</h2><p>Text number {i} of many.</p>{inside}</div><div class='links'><a href=x>More {i}</a></div></body>") for i in range(n)]


def test_low_entropy_nodes_go_on_sites_with_enough_pages(spark):
    assert extracted(spark, site(8)) == [(i, f"Story {i} Text number {i} of many.") for i in range(8)]
    few = extracted(spark, site(3))
    assert few[0] == (0, "Welcome to us Story 0 Text number 0 of many. More 0")


def test_repeats_inside_landmarks_need_more_evidence(spark):
    rows = [(i, u, h.replace("<div class='story'>", "<article>")) for i, u, h in site(8, inside="<div class='tail'>Printed at home</div>")]
    assert extracted(spark, rows)[2] == (2, "Story 2 Text number 2 of many. More 2")


def test_copies_of_an_article_stay(spark):
    # Half of the pages of a site hold the same article: its node has high entropy for some blocks only.
    rows = [(i, f"http://c.example/{i}", f"<body><main><p>{'The same long text.' if i % 2 else f'Own text {i}.'}</p></main></body>") for i in range(12)]
    assert extracted(spark, rows)[1] == (1, "The same long text.")


def test_both_ways_to_send_low_nodes_agree(spark):
    rows = site(8) + [(100 + i, u, h) for i, u, h in site(6, "https://T.example/")]
    assert extracted(spark, rows) == extracted(spark, rows, broadcast_rows=-1)


def test_nulls_empty_cut_and_deep_pages(spark):
    deep = "<div><p>" * 3000 + "x"
    rows = [(1, "http://a/", None), (2, "http://a/", ""), (3, "http://a/", "plain & text &am"), (4, "http://a/", "<article><p>cut <b"), (5, "nonsense", "<p>a</p><script>never closed"), (6, "http://a/", deep), (None, None, "<p>n")]
    assert extracted(spark, rows) == sorted([(1, ""), (2, ""), (3, "plain & text &am"), (4, "cut"), (5, "a"), (6, "x"), (None, "n")], key=str)
    assert extracted(spark, []) == []


def test_equal_pages_are_no_boilerplate(spark):
    page = "<body><nav>Menu {0}</nav><div class='more'><a href=x>Link {0}</a></div><{1}><p>The same long text.</p></{1}></body>"
    for tag in ("article", "div"):
        rows = [(i, f"http://e.example/{i % 3}", page.format(i, tag)) for i in range(6)]
        got = extracted(spark, rows)
        assert [i for i, _ in got] == list(range(6)) and all("The same long text." in text for _, text in got)


def test_copies_of_one_page_do_not_remove_the_others(spark):
    for tag in ("article", "div"):
        texts = ["The same long text." if i % 20 else f"Own text {i}." for i in range(200)]
        rows = [(i, f"http://n.example/{i}", f"<body><div class='top'>Welcome</div><{tag} class='x'><p>{t}</p></{tag}></body>") for i, t in enumerate(texts)]
        assert extracted(spark, rows) == sorted(enumerate(texts), key=str)


def test_blocks_of_one_page_stay_in_repeated_nodes(spark):
    # The pages differ, so the notice that most of them hold is repeated; texts beside it are not.
    texts = ["Under construction." if i % 20 else f"Own text {i}." for i in range(200)]
    rows = [(i, f"http://u.example/{i}", f"<body><main><h1>Page {i}</h1><p>{t}</p></main></body>") for i, t in enumerate(texts)]
    assert extracted(spark, rows) == sorted(((i, f"Page {i}" if i % 20 else f"Page {i} {t}") for i, t in enumerate(texts)), key=str)
