"""robots.txt over many hosts: rules, verdicts, declared sitemaps, fetch schedules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import robots as R
from ..functions import urls as U
from .fetch import follow
from .lookup import lookup
from .ranking import number_rows


def accepted_documents(documents: DataFrame) -> DataFrame:
    """``(host, accepted, text)`` from ``(host, code, message, content_type, body)``."""
    parts = [F.col(c) for c in ("code", "message", "content_type")]
    return documents.select(
        "host",
        R.is_accepted(*parts).alias("accepted"),
        R.accepted_text(*parts, F.col("body")).alias("text"),
    )


def scan(urls: DataFrame, responses: DataFrame, url: str = "url", *, rows: int | None = None) -> DataFrame:
    """``(host, accepted, text)`` for every host among ``urls``.

    One document per host, whatever the scheme and port; a host whose document cannot be fetched
    gets the default one.
    """
    hosts = (
        urls.select(U.host(F.col(url)).alias("host"), U.robots_url(F.col(url)).alias("_robots_url"))
        .filter(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.min("_robots_url").alias("url"))
    )
    parts = [F.col(c) for c in ("code", "message", "content_type")]
    document = F.struct(
        R.is_accepted(*parts).alias("accepted"), R.accepted_text(*parts, F.col("body")).alias("text")
    )
    answers = follow(
        hosts, responses, payload=lambda found: found.withColumn("payload", document), raise_on_http_error=True, rows=rows
    )
    return hosts.join(answers, "url", "left").select(
        "host",
        F.coalesce("payload.accepted", F.lit(False)).alias("accepted"),
        F.coalesce("payload.text", F.lit(R.DEFAULT_DOCUMENT)).alias("text"),
    )


def parse(documents: DataFrame) -> DataFrame:
    """One row per host: ``(host, rules, delays, others, sitemaps)`` from ``(host, text)``."""
    entries, directives = F.col("_entries"), F.col("_directives")
    return (
        documents.withColumn("_entries", R.entries(F.col("text")))
        .withColumn("_directives", R.directives(entries))
        .withColumn("_delays", R.delays(directives))
        .select(
            "host",
            R.rules(directives).alias("rules"),
            R.last_per_agent(F.col("_delays")).alias("delays"),
            R.others(entries).alias("others"),
            R.sitemaps(entries).alias("sitemaps"),
        )
    )


def lines(documents: DataFrame) -> DataFrame:
    """``(host, line_no, key, value)``"""
    return documents.select("host", F.inline(R.entries(F.col("text"))))


def rules(parsed: DataFrame) -> DataFrame:
    """``(host, line_no, agent_pattern, directive, path_pattern)``"""
    return parsed.select("host", F.inline("rules")).drop("prefix")


def delays(parsed: DataFrame) -> DataFrame:
    """``(host, agent_pattern, delay_s)``"""
    return parsed.select("host", F.inline("delays")).drop("line_no")


def others(parsed: DataFrame) -> DataFrame:
    """``(host, key, value, line_no)``"""
    return parsed.select("host", F.inline("others")).select("host", "key", "value", "line_no")


def sitemaps(parsed: DataFrame) -> DataFrame:
    """``(host, root_pos, sitemap_url)`` in document order."""
    return parsed.select("host", F.posexplode("sitemaps").alias("root_pos", "sitemap_url")).withColumn(
        "root_pos", F.col("root_pos").cast("long")
    )


def grouped(parsed: DataFrame) -> DataFrame:
    """``(host, agent_pattern, directive, path_patterns)``: patterns per agent in line order."""
    return (
        rules(parsed)
        .groupBy("host", "agent_pattern", "directive")
        .agg(F.sort_array(F.collect_list(F.struct("line_no", "path_pattern"))).alias("_rules"))
        .select(
            "host", "agent_pattern", "directive", F.transform("_rules", lambda r: r["path_pattern"]).alias("path_patterns")
        )
    )


def verdicts(
    urls: DataFrame,
    parsed: DataFrame,
    user_agent: str,
    url: str = "url",
    out: str = "allowed",
    *,
    rows: int | None = None,
) -> DataFrame:
    """Add ``out``: may the user agent visit the URL?

    All rules of a host travel as one array, so each URL is joined once and never multiplied;
    the rules for other agents are removed before the join.
    """
    relevant = parsed.select(
        F.col("host").alias("_robots_host"), R.for_agent(F.col("rules"), user_agent).alias("_rules")
    )
    return (
        lookup(urls.withColumn("_host", U.host(F.col(url))), relevant, "_host", "_robots_host", spread=[url], rows=rows)
        .withColumn(out, R.is_allowed(U.request_path(F.col(url)), F.col("_rules")))
        .drop("_host", "_rules")
    )


def schedule(urls: DataFrame, parsed: DataFrame, user_agent: str, ord: str = "ord", host: str = "host") -> DataFrame:
    """Add ``start_s``: seconds after the first fetch of a host at which a URL may be fetched.

    The delay is the same for all URLs of a host, so the running sum is position times delay.
    """
    delay = F.try_element_at(
        F.filter("delays", lambda d: F.rlike(F.lit(user_agent), d["agent_pattern"])), F.lit(-1)
    )["delay_s"]
    per_host = parsed.select(F.col("host").alias("_robots_host"), delay.alias("_delay"))
    ranked = number_rows(urls, host, ord, rn="_rn")
    return (
        lookup(ranked, per_host, host, "_robots_host", spread=[ord])
        .withColumn("start_s", F.coalesce("_delay", F.lit(0)) * (F.col("_rn") - 1))
        .drop("_delay", "_rn")
    )
