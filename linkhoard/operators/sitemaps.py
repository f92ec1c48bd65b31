"""Sitemaps: recursive expansion, discovery, and ordered URL lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import http
from ..functions import sitemap as S
from ..functions import urls as U
from ..sources.tables import materialize, measure, settle
from . import robots
from .captures import Captures
from .fetch import follow, follower
from .lookup import lookup
from .ranking import running_total

_PATH = "array<bigint>"


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def parse_documents(documents: DataFrame) -> DataFrame:
    """``(doc_url, kind, root_name, page_locs, child_locs, dropped)`` from ``(doc_url, body)``."""
    return S.with_document(documents, "_doc").select("doc_url", "_doc.*")


def expand(roots: DataFrame, responses: DataFrame, *, max_redirects: int = 10) -> tuple[DataFrame, DataFrame]:
    """Find all sitemap documents reachable from each root; one visited set per root.

    ``roots`` is ``(root_id, doc_url)``, with ``root_id`` a ``struct<source_id, root_pos>``, and
    optionally ``doc`` (a parsed document struct) where the body is already at hand. Returns two tables: ``reached(root_id, doc_url, path)`` with every
    document once per root, and ``documents(doc_url, kind, page_locs, child_locs, dropped)``.

    ``path`` lists the positions of the links from the root. A document that several links lead
    to keeps its smallest path, which is the moment a depth-first walk meets it first: whenever a
    later level offers a smaller path, the document's children are offered again.
    """
    seeded = "doc" in roots.columns
    step = [
        F.col("root_id"),
        F.col("doc_url"),
        F.concat("path", F.array(F.col("_pos").cast("long"))).alias("path"),
    ]
    shortest = F.min("path").alias("path")
    # Offers and known paths meet in one aggregation.
    nowhere = F.lit(None).cast(_PATH)
    best = [shortest, F.min("_known").alias("_known")]
    better = F.col("path").isNotNull() & (F.col("_known").isNull() | (F.col("path") < F.col("_known")))

    answer = follower(responses, payload=S.document_reader("payload"), max_redirects=max_redirects)
    rows_written = F.count("*")
    start = roots.select("root_id", "doc_url", F.array().cast(_PATH).alias("path"))
    frontier, seen = measure(start, "sitemap-roots", rows=rows_written)
    documents: list[DataFrame] = []
    if seeded:
        documents.append(materialize(roots.select("doc_url", "doc.*"), "sitemap-seeds"))
    levels = []
    while rows := seen["rows"]:
        levels.append(frontier)
        wanted = frontier.select(F.col("doc_url").alias("url"))
        if documents:
            fetched = _union([d.select(F.col("doc_url").alias("url")) for d in documents])
            wanted = wanted.join(fetched, "url", "left_anti")
        if not (seeded and len(levels) == 1):
            answers = answer(wanted, rows)
            documents.append(answers.select(F.col("url").alias("doc_url"), "payload.*"))
        indexes = _union(
            [d.filter(F.col("kind") == S.INDEX).select(F.col("doc_url").alias("_index_url"), "child_locs") for d in documents]
        )
        offered = (
            lookup(frontier, indexes, "doc_url", "_index_url", spread=["root_id"], how="inner", rows=rows)
            .select("root_id", "path", F.posexplode("child_locs").alias("_pos", "doc_url"))
            .select(*step, nowhere.alias("_known"))
        )
        known = _union([x.select("root_id", "doc_url", nowhere.alias("path"), F.col("path").alias("_known")) for x in levels])
        improved = offered.unionByName(known).groupBy("root_id", "doc_url").agg(*best).filter(better).drop("_known")
        frontier, seen = measure(improved, f"sitemap-level-{len(levels)}", rows=rows_written)
    every = _union(levels or [frontier]).groupBy("root_id", "doc_url").agg(shortest)
    if not documents:
        documents = [parse_documents(Captures.of(responses).responses.limit(0).withColumnRenamed("url", "doc_url"))]
    return materialize(every, "sitemap-reached"), _union(documents)


def dropped_locations(reached: DataFrame, documents: DataFrame) -> DataFrame:
    """``(source_id, n_documents, n_dropped)``: documents reached, and their entries that gave no location."""
    counted = documents.select(F.col("doc_url").alias("_read_url"), F.col("dropped"))
    found = lookup(reached, counted, "doc_url", "_read_url", spread=["root_id"], how="left")
    return found.groupBy("root_id.source_id").agg(
        F.count("*").alias("n_documents"), F.coalesce(F.sum("dropped"), F.lit(0)).cast("long").alias("n_dropped")
    )


def ordered_urls(reached: DataFrame, documents: DataFrame) -> DataFrame:
    """``(source_id, ord, url)`` in depth-first document order, ``ord`` dense from 0 per source.

    Only documents are ordered; the position of a URL is the number of URLs in earlier documents
    plus its place in its own.
    """
    rows = reached.count()
    listing = documents.filter(F.size("page_locs") > 0).withColumnRenamed("doc_url", "_leaf_url")
    sizes = listing.select("_leaf_url", F.size("page_locs").cast("long").alias("_n"))
    leaves = (
        lookup(reached, sizes, "doc_url", "_leaf_url", spread=["root_id"], how="inner", rows=rows)
        .select("root_id.source_id", "root_id.root_pos", "path", "doc_url", "_n")
    )
    placed = running_total(leaves, "source_id", ["root_pos", "path"], "_n", "_before", rows=rows)
    pages = listing.select("_leaf_url", "page_locs")
    return (
        lookup(placed, pages, "doc_url", "_leaf_url", spread=["source_id", "_before"], how="inner", rows=rows)
        .select("source_id", "_before", F.posexplode("page_locs").alias("_pos", "url"))
        .select("source_id", (F.col("_before") + F.col("_pos")).alias("ord"), "url")
    )


def roots_of(
    starts: DataFrame, doc_url: str = "doc_url", root_pos: str | None = None
) -> DataFrame:
    """``(root_id, doc_url)`` from ``(source_id, doc_url[, root_pos])``."""
    position = F.lit(0) if root_pos is None else F.col(root_pos)
    return starts.select(
        F.struct(F.col("source_id").alias("source_id"), position.cast("long").alias("root_pos")).alias("root_id"),
        U.with_scheme(U.strip(F.col(doc_url))).alias("doc_url"),
    )


def sitemap_urls(sources: DataFrame, responses: DataFrame, *, max_redirects: int = 10) -> DataFrame:
    """``(source_id, ord, url)`` of the sitemap at each ``(source_id, source)``."""
    return ordered_urls(*expand(roots_of(sources, "source"), responses, max_redirects=max_redirects))


def urls_of_bodies(bodies: DataFrame, responses: DataFrame, *, max_redirects: int = 10) -> DataFrame:
    """``(source_id, ord, url)`` of sitemap bodies already at hand, ``(source_id, body)``.

    A body has no address of its own, so nothing that is listed can count as visited by it.
    """
    seeds = bodies.select(
        F.struct(F.col("source_id").alias("source_id"), F.lit(0).cast("long").alias("root_pos")).alias("root_id"),
        F.concat(F.lit("body:"), F.col("source_id")).alias("doc_url"),
        "body",
    )
    seeds = S.with_document(seeds, "doc").drop("body")
    return ordered_urls(*expand(seeds, responses, max_redirects=max_redirects))


def candidates(sources: DataFrame) -> DataFrame:
    """``(source_id, source, pos, candidate)``: the well-known sitemap places of each source."""
    names = F.array(*[F.lit(n) for n in U.SITEMAP_NAMES])
    return sources.select(
        "source_id", "source", F.posexplode(names).alias("pos", "_name")
    ).select(
        "source_id", "source", F.col("pos").cast("long").alias("pos"), U.child_url(F.col("source"), F.col("_name")).alias("candidate")
    )


def probe(
    sources: DataFrame, responses: DataFrame, *, max_redirects: int = 10, rows: int | None = None
) -> DataFrame:
    """``(source_id, pos, outcome, final_url)``: the first candidate that decides, per source.

    A 2xx answer is a ``hit``; a final 4xx or 5xx is a miss and the next candidate counts; a
    request error (``error``) ends the search. Sources with six misses have no row.
    """
    tried = candidates(sources).withColumn("url", U.with_scheme(F.col("candidate")))
    rows = None if rows is None else rows * len(U.SITEMAP_NAMES)
    answers = follow(tried, responses, max_redirects=max_redirects, rows=rows)
    outcome = (
        F.when(F.col("error_class").isNotNull(), "error")
        .when(http.is_success(F.col("code")), "hit")
        .otherwise("miss")
    )
    return (
        lookup(
            tried,
            answers.select(F.col("url").alias("_tried"), outcome.alias("outcome"), "final_url"),
            "url",
            "_tried",
            spread=["source_id"],
            rows=rows,
        )
        .filter(F.col("outcome") != "miss")
        .groupBy("source_id")
        .agg(F.min(F.struct("pos", "outcome", "final_url")).alias("_first"))
        .select("source_id", "_first.*")
    )


def discover(
    sources: DataFrame, responses: DataFrame, *, max_redirects: int = 10
) -> tuple[DataFrame, DataFrame]:
    """Sitemap URLs of each ``(source_id, source)``: robots.txt, well-known places, the URL itself.

    Returns ``urls(source_id, ord, url)`` and ``found(source_id, via)`` with ``via`` one of
    ``robots``, ``candidate``, ``self``, ``error``. The answer of robots.txt is final even when its
    sitemaps list nothing.
    """
    responses = Captures.of(responses)
    normalized, seen = measure(
        sources.select("source_id", U.with_scheme(F.col("source")).alias("source")), "sources", rows=F.count("*")
    )
    rows = seen["rows"]
    parsed = robots.parse(robots.scan(normalized, responses, "source", rows=rows)).filter(F.size("sitemaps") > 0)
    declared = settle(
        lookup(
            normalized.withColumn("_host", U.host(F.col("source"))),
            parsed.select(F.col("host").alias("_robots_host"), "sitemaps"),
            "_host",
            "_robots_host",
            spread=["source_id"],
            rows=rows,
        ).select("source_id", "source", "sitemaps"),
        "declared-sitemaps",
        rows,
    )
    undeclared = declared.filter(F.col("sitemaps").isNull()).select("source_id", "source")
    probed = settle(probe(undeclared, responses, max_redirects=max_redirects, rows=rows), "probed", rows)
    from_robots = declared.select(
        "source_id", F.posexplode("sitemaps").alias("root_pos", "doc_url"), F.lit("robots").alias("via")
    )
    from_candidates = probed.filter(F.col("outcome") == "hit").select(
        "source_id", F.lit(0).alias("root_pos"), F.col("final_url").alias("doc_url"), F.lit("candidate").alias("via")
    )
    from_source = undeclared.join(probed, "source_id", "left_anti").select(
        "source_id", F.lit(0).alias("root_pos"), F.col("source").alias("doc_url"), F.lit("self").alias("via")
    )
    starts = materialize(
        _union([from_robots, from_candidates, from_source]).select("source_id", "root_pos", "doc_url", "via"),
        "sitemap-starts",
    )
    reached, documents = expand(roots_of(starts, root_pos="root_pos"), responses, max_redirects=max_redirects)
    failed = probed.filter(F.col("outcome") == "error").select("source_id", F.lit("error").alias("via"))
    found = starts.select("source_id", "via").distinct().unionByName(failed)
    return ordered_urls(reached, documents), found
