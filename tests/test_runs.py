"""Submission, streaming and whole runs."""

import pytest
from pyspark.sql import functions as F

from linkhoard.config import Options
from linkhoard.functions.urls import SAVE_ENDPOINT
from linkhoard.operators.submit import CallableAdapter, RecordedAdapter, posted, submit, summarize
from linkhoard.plans.archive import archive
from linkhoard.streaming.submit import recorded_results, submit_stream

from .test_steps import index, responses, urlset

URLS = "source_id long, ord long, url string"


def saved(spark, *pairs):
    return responses(spark, *[{"url": SAVE_ENDPOINT + u, **more} for u, more in pairs])


def test_recorded_adapter(spark):
    table = saved(
        spark,
        ("http://a/1", {}),
        ("http://a/2", {"code": "301", "location": "/x"}),
        ("http://a/3", {"code": "503"}),
        ("http://a/4", {"code": None, "error_class": "Timeout::Error", "error_message": "late"}),
        ("http://a/5", {"code": "100"}),
    )
    given = [" http://a/1\n", "http://a/2", "http://a/3", "http://a/4", "http://a/5", "http://a/6", "http://a b", None, "http://a/1"]
    urls = spark.createDataFrame([(1, i, u) for i, u in enumerate(given)], URLS)
    results = submit(urls, RecordedAdapter(table))
    rows = {r.ord: r for r in results.collect()}
    assert [rows[i].code for i in range(9)] == ["200", "301", "503", None, None, None, None, None, "200"]
    assert [rows[i].error_class for i in range(3, 8)] == [
        "ServerError", "UnknownResponseCodeError", "ClientError", "InvalidURIError", "ClientError",
    ]
    assert rows[0].uri == " http://a/1\n" and rows[0].request_url == SAVE_ENDPOINT + "http://a/1"
    assert rows[3].request_url is None and rows[3].error_message == "Timeout::Error, late"
    assert {r.response_error for r in rows.values()} == {None}
    assert sorted(r.ord for r in posted(results).collect()) == [0, 1, 2, 8]
    assert summarize(results).first().asDict() == {
        "source_id": 1, "n_sent": 9, "n_posted": 4, "n_errors": 5, "n_success": 2, "n_redirect": 1, "n_http_error": 1,
    }


def answering(folder):
    """An adapter function that leaves a file for every URL it is called with."""

    def call(batches):
        import os
        import uuid

        for batch in batches:
            for source_id, ord_ in zip(batch["source_id"], batch["ord"]):
                open(os.path.join(folder, f"{source_id}-{ord_}-{uuid.uuid4().hex}"), "w").close()
            yield batch.assign(
                uri=batch["url"], code="200", request_url="r:" + batch["url"], response_error=None, error_class=None, error_message=None
            )[["source_id", "ord", "uri", "code", "request_url", "response_error", "error_class", "error_message"]]

    return call


def test_callable_adapter_submits_once(spark, tmp_path):
    urls = spark.range(50).select(F.lit(1).cast("long").alias("source_id"), F.col("id").alias("ord"), F.concat(F.lit("u"), "id").alias("url"))
    results = submit(urls, CallableAdapter(answering(str(tmp_path)), concurrency=4))
    assert results.count() == 50 and posted(results).count() == 50
    assert sorted(p.name.split("-")[1] for p in tmp_path.iterdir()) == sorted(map(str, range(50)))
    assert submit(urls, answering(str(tmp_path)), concurrency=2).count() == 50


def test_adapters_are_checked(spark):
    with pytest.raises(TypeError):
        CallableAdapter("no function")
    with pytest.raises(ValueError):
        CallableAdapter(len, concurrency=0)
    with pytest.raises(TypeError):
        submit(spark.range(1), None)


@pytest.mark.parametrize(
    "bad", [{"strategy": "guess"}, {"concurrency": 0}, {"limit": -2}, {"max_redirects": -1}]
)
def test_options_are_checked(bad):
    with pytest.raises(ValueError):
        Options(**bad)


def test_stream_records_each_key_once(spark, tmp_path):
    source, out, calls = tmp_path / "in", tmp_path / "out", tmp_path / "calls"
    calls.mkdir()
    adapter = CallableAdapter(answering(str(calls)), concurrency=2)
    seen = []

    def run():
        stream = spark.readStream.schema(URLS).option("maxFilesPerTrigger", 1).parquet(str(source))
        on_batch = lambda results, batch_id: seen.append((batch_id, results.count()))
        submit_stream(stream, adapter, str(out), str(tmp_path / "ck"), on_batch=on_batch).awaitTermination()

    def add(*rows):
        spark.createDataFrame(list(rows), URLS).coalesce(1).write.mode("append").parquet(str(source))

    add((1, 0, "a"), (1, 1, "b"), (1, 0, "a"))
    run()
    add((1, 1, "b"), (1, 2, "c"))
    run()
    rows = sorted((r.source_id, r.ord, r.uri) for r in recorded_results(spark, str(out)).collect())
    assert rows == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c")]
    assert seen == [(0, 2), (1, 1)]
    assert len(list(calls.iterdir())) == 3
    add((1, 2, "c"), (2, 0, "d"), (1, 0, "a"))
    run()
    assert seen[2:] == [(2, 1)] and len(list(calls.iterdir())) == 4


def test_stream_tries_again_what_has_no_result(spark, tmp_path):
    source, out, calls = tmp_path / "in", tmp_path / "out", tmp_path / "calls"
    calls.mkdir()
    adapter = CallableAdapter(answering(str(calls)), concurrency=1)
    spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (1, 2, "c")], URLS).write.parquet(str(source))

    def run(checkpoint, on_batch=None):
        stream = spark.readStream.schema(URLS).parquet(str(source))
        submit_stream(stream, adapter, str(out), str(tmp_path / checkpoint), on_batch=on_batch).awaitTermination()

    def fail(results, batch_id):
        raise RuntimeError("lost after the results were written")

    with pytest.raises(Exception, match="lost after"):
        run("ck", fail)
    run("ck")  # the batch is tried again and finds its results
    assert len(list(calls.iterdir())) == 3 and recorded_results(spark, str(out)).count() == 3
    spark.createDataFrame([(1, 0, "a"), (1, 3, "d")], URLS).write.mode("append").parquet(str(source))
    run("ck")
    assert len(list(calls.iterdir())) == 4
    with pytest.raises(Exception, match="another checkpoint"):
        run("other")


@pytest.fixture
def site(spark):
    table = responses(
        spark,
        {"url": "http://a/robots.txt", "content_type": "text/plain", "body": b"Sitemap: http://a/s.xml"},
        {"url": "http://a/s.xml", "body": index("http://a/u")},
        {"url": "http://a/u", "body": urlset("http://a/1", "http://a/2", "http://a/1")},
        {"url": "http://b", "body": b'<a href="/x">x</a>'},
        {"url": "http://b/x", "body": b'<a href="/">home</a><a href="/y">y</a>'},
        {"url": "http://b/y", "body": b""},
    )
    pages = ["http://a/1", "http://a/2", "http://b", "http://b/x", "http://b/y", "a", "b", "http://a/s.xml"]
    sources = spark.createDataFrame([(1, "http://a"), (2, "b")], "source_id long, source string")
    return sources, table, RecordedAdapter(saved(spark, *[(p, {}) for p in pages]))


@pytest.mark.parametrize(
    ("options", "want"),
    [
        (Options(), {1: ["http://a/1", "http://a/2", "http://a/1"], 2: ["http://b", "http://b/x", "http://b/y"]}),
        (Options(limit=2, dedupe=True), {1: ["http://a/1", "http://a/2"], 2: ["http://b", "http://b/x"]}),
        (Options(strategy="crawl", respect_robots_txt=True), {2: ["http://b", "http://b/x", "http://b/y"]}),
        (Options(strategy="url"), {1: ["http://a"], 2: ["b"]}),
        (Options(strategy="sitemap"), {}),
    ],
)
def test_strategies(site, options, want):
    sources, table, adapter = site
    got = {}
    for r in archive(sources, table, adapter, options).results.orderBy("source_id", "ord").collect():
        got.setdefault(r.source_id, []).append(r.uri)
    assert got == want


def test_summary_counts_what_the_limit_cut(site):
    sources, table, adapter = site
    run = archive(sources, table, adapter, Options(limit=1))
    rows = {r.source_id: (r.n_found, r.n_sent, r.n_posted) for r in run.summary.collect()}
    assert rows == {1: (3, 1, 1), 2: (1, 1, 1)}
    assert run.posted.count() == 2
