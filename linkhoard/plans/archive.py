"""A whole run: collect URLs by strategy, apply the limit, submit, report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import NO_LIMIT, STRATEGIES, Options
from ..functions import urls as U
from ..operators import crawl as C
from ..operators import robots as R
from ..operators import sitemaps as S
from ..operators.captures import Captures
from ..operators.ranking import limit_by_source, limit_per_source
from ..operators.submit import Adapter, posted, submit, summarize
from ..sources.tables import materialize, measure


@dataclass(frozen=True)
class Run:
    """Tables of a finished run."""

    urls: DataFrame
    results: DataFrame
    sources: DataFrame

    @property
    def posted(self) -> DataFrame:
        return posted(self.results)

    @property
    def summary(self) -> DataFrame:
        """Counts per source, including URLs found but cut off by the limit; zeros where nothing was found."""
        found = self.urls.groupBy("source_id").agg(F.count("*").alias("n_found"))
        every = self.sources.select("source_id").distinct().join(found, "source_id", "left")
        return every.join(summarize(self.results), "source_id", "left").na.fill(0)


def crawl_urls(
    sources: DataFrame, responses: DataFrame, options: Options, links: DataFrame | None = None
) -> DataFrame:
    """``(source_id, ord, url)`` by crawling.

    ``links`` (``src, pos, dst``) replaces the links found in response bodies.
    """
    rules = None
    if options.respect_robots_txt:
        rules = materialize(R.parse(_robots_of(sources, responses, options, links)), "robots")
    table = C.LinkTable.of_responses(responses) if links is None else C.LinkTable.of_rows(links)
    return C.crawl(
        sources, table, hosts=options.hosts, limit=options.limit, rules=rules, user_agent=options.user_agent
    ).select("source_id", "ord", "url")


def _robots_of(
    sources: DataFrame, responses: DataFrame, options: Options, links: DataFrame | None
) -> DataFrame:
    """robots.txt of every host a crawl may visit: the start hosts and the hosts accepted by the options.

    Where sources have host rules of their own, the hosts of all pages.
    """
    starts = sources.select(U.with_scheme(F.col("source")).alias("url"))
    own = "hosts" in sources.columns
    if options.hosts or own:
        pages = Captures.of(responses).responses.select("url") if links is None else links.select(F.col("src").alias("url"))
        starts = starts.unionByName(pages if own else pages.filter(U.host_matches(U.host(F.col("url")), options.hosts)))
    return R.scan(starts, responses)


def _listed(sources: DataFrame, responses: Captures, options: Options) -> tuple[DataFrame, DataFrame]:
    """URLs that sitemaps list, and the sources for which they list none."""
    listed, _ = S.discover(sources, responses, max_redirects=options.max_redirects)
    listed = materialize(listed, "discovered")
    return listed, sources.join(listed.select("source_id").distinct(), "source_id", "left_anti")


def auto_urls(
    sources: DataFrame, responses: DataFrame, options: Options, links: DataFrame | None = None
) -> DataFrame:
    """``(source_id, ord, url, via)``: sitemap URLs of a source where there are any, else a crawl."""
    responses = Captures.of(responses)
    listed, rest = _listed(sources, responses, options)
    crawled = crawl_urls(materialize(rest, "to-crawl"), responses, options, links)
    return listed.withColumn("via", F.lit("sitemap")).unionByName(crawled.withColumn("via", F.lit("crawl")))


def by_strategy(sources: DataFrame, options: Options) -> dict[str, DataFrame]:
    """Sources by strategy: their column ``strategy`` where there is one, NULL there and tables without it take that of the options.

    The driver learns how many sources each strategy has, and a name that is no strategy is an error.
    """
    if "strategy" not in sources.columns:
        return {options.strategy: sources}
    chosen = F.coalesce("strategy", F.lit(options.strategy))
    counts = {s: F.count_if(chosen == s) for s in STRATEGIES}
    table, seen = measure(
        sources.withColumn("strategy", chosen), "sources", **counts, other=F.count_if(~chosen.isin(*STRATEGIES))
    )
    if seen["other"]:
        raise ValueError(f"{seen['other']} sources name a strategy that is none of {', '.join(STRATEGIES)}")
    return {s: table.filter(F.col("strategy") == s).drop("strategy") for s in STRATEGIES if seen[s]}


def collect(
    sources: DataFrame, responses: DataFrame, options: Options, links: DataFrame | None = None
) -> DataFrame:
    """``(source_id, ord, url)`` for ``(source_id, source)``, before the limit.

    ``sources`` may have ``strategy``, ``hosts`` (rules of ``operators.hosts``) and ``url_limit`` for each source; only crawls obey a limit here. All crawls are one loop over levels,
    those of sources without a sitemap included. Rows of one source should have one strategy: positions are per strategy.
    The result reads written tables only, so using it twice repeats no work.
    """
    groups = by_strategy(sources, options)
    if not {"auto", "crawl", "sitemap"}.isdisjoint(groups):
        responses = Captures.of(responses)
    found, to_crawl = [], []
    if "auto" in groups:
        listed, rest = _listed(groups["auto"], responses, options)
        found.append(listed)
        to_crawl.append(rest)
    if "crawl" in groups:
        to_crawl.append(groups["crawl"])
    if to_crawl:
        wanted = [x.select("source_id", "source", *[c for c in ("hosts", "url_limit") if c in x.columns]) for x in to_crawl]
        starts = materialize(reduce(DataFrame.unionByName, wanted), "to-crawl")
        found.append(crawl_urls(starts, responses, options, links))
    if "sitemap" in groups:
        found.append(materialize(S.sitemap_urls(groups["sitemap"], responses, max_redirects=options.max_redirects), "listed"))
    for plain in ("urls", "url"):
        if plain in groups:
            given = groups[plain]
            ord_ = F.col("ord") if "ord" in given.columns else F.lit(0).cast("long")
            found.append(given.select("source_id", ord_.alias("ord"), F.col("source").alias("url")))
    if not found:
        return sources.select("source_id", F.lit(0).cast("long").alias("ord"), F.col("source").alias("url")).filter(F.lit(False))
    return reduce(DataFrame.unionByName, [x.select("source_id", "ord", "url") for x in found])


def archive(
    sources: DataFrame,
    responses: DataFrame,
    adapter: Adapter,
    options: Options | None = None,
    links: DataFrame | None = None,
    on_results: Callable[[DataFrame], None] | None = None,
) -> Run:
    """Archive every source. Limits are applied before the adapter sees a URL; ``on_results`` sees the results.

    ``sources`` is ``(source_id, source)``; columns ``strategy``, ``hosts`` and ``url_limit`` tell single sources what the options tell all
    of them. NULL there means what the options say; ``hosts`` add to those of the options. A ``url_limit`` below -1 is an error.
    """
    options = options or Options()
    limited = "url_limit" in sources.columns
    if limited:
        sources, seen = measure(sources, "limits", wrong=F.count_if(F.col("url_limit") < NO_LIMIT))
        if seen["wrong"]:
            raise ValueError(f"url_limit of {seen['wrong']} sources is neither -1 (no limit) nor 0 or more")
    urls = collect(sources, responses, options, links)
    if options.dedupe:
        urls = urls.groupBy("source_id", "url").agg(F.min("ord").alias("ord")).select("source_id", "ord", "url")
        urls = materialize(urls, "deduplicated")
    chosen = urls
    if limited:
        chosen = materialize(limit_by_source(urls, sources, options.limit), "chosen")
    elif options.limit != NO_LIMIT:
        chosen = materialize(limit_per_source(urls, options.limit), "chosen")
    return Run(urls, submit(chosen, adapter, options.concurrency, on_results), sources)
