"""Breadth-first link crawl of many sites at once."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import NO_LIMIT, check_limit
from ..functions import html, http
from ..functions import urls as U
from ..sources.tables import is_small, materialize, measure, settle
from . import hosts as host_rules
from . import robots as robots_ops
from .captures import Captures
from .lookup import lookup
from .ranking import number_rows


# Pages of one source whose links are ranked together: a bounded piece of a level.
PARENTS_PER_CHUNK = 1 << 12
# Links of one page that are stored in one row.
LINKS_PER_PART = 1 << 10


def page_links(pages: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """``(src, pos, href, dst)``: the links of every page in page order."""
    return pages.select(F.col(url).alias("src"), F.inline(html.links(F.col(url), F.col(body))))


@dataclass(frozen=True)
class LinkTable:
    """Links to crawl along.

    ``pages`` is ``(page, n_links, parts)``: every page that can be visited, with the number of its
    links (NULL if unknown) and of the pieces they are stored in. ``parts`` is ``(page_part, links)``
    with an array of links per piece; ``page_part`` is the page and the piece number. A page with
    very many links has many pieces, so no row grows with the table.
    """

    pages: DataFrame
    parts: DataFrame

    @classmethod
    def of_rows(cls, links: DataFrame, pages: DataFrame | None = None) -> LinkTable:
        """From ``(src, pos, dst)``; every ``src`` is a page, and so is every ``url`` of ``pages``, with or without links."""
        piece = F.expr(f"pos div {LINKS_PER_PART}")
        counted = links.select(F.col("src").alias("page"), F.lit(1).alias("_link"), (piece + 1).alias("_parts"))
        if pages is not None:
            bare = pages.select(F.col("url").alias("page"), F.lit(0).alias("_link"), F.lit(0).cast("long").alias("_parts"))
            counted = counted.unionByName(bare)
        found = counted.groupBy("page").agg(F.sum("_link").alias("n_links"), F.max("_parts").alias("parts"))
        parts = links.groupBy(_page_part(F.col("src"), piece).alias("page_part")).agg(
            F.collect_list(F.struct(F.col("pos").cast("long").alias("pos"), "dst")).alias("links")
        )
        return cls(materialize(found, "pages"), materialize(parts, "links"))

    @classmethod
    def of_responses(cls, responses: DataFrame | Captures) -> LinkTable:
        """From response bodies, one capture per page; a redirect target counts as first link.

        Failed exchanges give no page: they are neither visited nor counted. Links are taken from the
        bodies once and written in pieces of bounded size, so that levels read links and no bodies.
        """
        arrived = Captures.of(responses).single().filter(F.col("error_class").isNull())
        target = http.redirect_target(F.col("url"), F.col("location"))
        redirect = F.when(
            http.is_redirect(F.col("code")) & target.isNotNull(),
            F.array(F.struct(F.lit(-1).cast("long").alias("pos"), U.without_fragment(target).alias("dst"))),
        )
        in_body = F.transform(
            html.links(F.col("url"), F.col("body").cast("string")), lambda x: F.struct(x["pos"], x["dst"])
        )
        none = F.array().cast("array<struct<pos:bigint,dst:string>>")
        linked = arrived.select(
            F.col("url").alias("page"), F.concat(F.coalesce(redirect, none), F.coalesce(in_body, none)).alias("links")
        ).withColumn("n_links", F.size("links").cast("long"))
        pieces = F.ceil(F.col("n_links") / LINKS_PER_PART)
        cut = F.transform(
            F.sequence(F.lit(0), F.greatest(pieces - 1, F.lit(0)).cast("int")),
            lambda k: F.slice("links", k * LINKS_PER_PART + 1, F.lit(LINKS_PER_PART)),
        )
        stored = materialize(
            linked.select("page", "n_links", pieces.alias("parts"), F.posexplode(cut).alias("piece", "links")), "page-links"
        )
        pages = stored.filter("piece = 0").select("page", "n_links", "parts")
        parts = stored.filter("n_links > 0").select(_page_part(F.col("page"), F.col("piece")).alias("page_part"), "links")
        return cls(pages, parts)


def _page_part(page: Column, piece: Column) -> Column:
    return F.concat_ws("\n", page, piece.cast("string"))


def host_filter(links: DataFrame, hosts: Iterable[str | re.Pattern], url: str = "dst") -> DataFrame:
    """Only the rows whose URL is on an accepted host."""
    return links.filter(U.host_matches(U.host(F.col(url)), hosts))


def crawl(
    sources: DataFrame,
    links: LinkTable,
    *,
    hosts: Iterable[str | re.Pattern] = (),
    limit: int | None = NO_LIMIT,
    rules: DataFrame | None = None,
    user_agent: str = "",
) -> DataFrame:
    """Visit pages level by level from each ``(source_id, source)``: ``(source_id, ord, depth, url)``.

    Every source has its own history. A link is followed when its host is the start host or matches ``hosts`` or, if ``sources`` has an array
    column ``hosts``, a rule of its source there (``operators.hosts``); with ``rules`` (parsed robots.txt per host) also only when
    allowed. ``limit`` bounds the pages visited per source; a column ``url_limit`` of ``sources`` tells single sources theirs (NULL: ``limit``).

    Order is breadth first: by depth, then by the parent's position, then by the place of the link.
    One level is a join to the pages that can be visited, and one to their links; the loop ends when
    no source finds a new page. The history is an append-only list of level tables.
    """
    limit = check_limit(limit)
    own_hosts = host_rules.index(sources) if "hosts" in sources.columns else None
    own_limits = "url_limit" in sources.columns
    # What all rows of a source share and offers hand on.
    shared = {"start_host": "string"} | ({"most": "long"} if own_limits else {})
    start = U.with_scheme(F.col("source"))
    zero = F.lit(0).cast("long")
    found, seen = measure(
        sources.select(
            "source_id",
            start.alias("url"),
            U.host(start).alias("start_host"),
            *([F.coalesce(F.col("url_limit").cast("long"), F.lit(limit).cast("long")).alias("most")] if own_limits else []),
            zero.alias("base"),
            (zero - 1).alias("parent"),
            zero.alias("pos"),
        ),
        "crawl-start",
        rows=F.count("*"),
    )
    # All rows of a source share ``base``, the number of pages visited before their level.
    ord_ = F.col("base") + F.col("rn") - 1
    level_columns = [
        F.col("source_id"),
        F.col("url"),
        *map(F.col, shared),
        ord_.alias("ord"),
        (F.col("base") + F.col("_level_total")).alias("base"),
        F.col("n_links"),
        F.col("parts"),
    ]
    unlimited = limit == NO_LIMIT and not own_limits
    most = F.col("most") if own_limits else F.lit(limit)
    within_limit = F.lit(True) if unlimited else (most == NO_LIMIT) | (F.col("ord") < most)
    goes_on = F.lit(True) if unlimited else (most == NO_LIMIT) | (F.col("base") < most)
    dst_host = U.host(F.col("link.dst"))
    accepted = (dst_host == F.col("start_host")) | U.host_matches(dst_host, tuple(hosts))
    # Offers and history meet in one aggregation: a page is new if no row of the history is there.
    offer_columns = [
        F.col("source_id"),
        F.col("link.dst").alias("url"),
        *map(F.col, shared),
        F.col("base"),
        F.struct(F.col("ord").alias("parent"), F.col("link.pos").alias("pos")).alias("_from"),
        F.lit(False).alias("_seen"),
    ]
    seen_columns = [
        F.col("source_id"),
        F.col("url"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in shared.items()],
        F.lit(None).cast("long").alias("base"),
        F.lit(None).cast("struct<parent:bigint,pos:bigint>").alias("_from"),
        F.lit(True).alias("_seen"),
    ]
    first_offer = [
        *[F.max(name).alias(name) for name in shared],
        F.max("base").alias("base"),
        F.min("_from").alias("_from"),
        F.bool_or("_seen").alias("_seen"),
    ]
    sizes = {
        "rows": F.count("*"),
        "offers": F.sum(F.when(goes_on, F.coalesce("n_links", F.lit(1)))),
        "unknown": F.count_if(F.col("n_links").isNull()),
    }
    page_part = F.explode(
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda piece: _page_part(F.col("url"), piece))
    )
    onward_columns = [F.col(c) for c in ("source_id", *shared, "base", "ord")]

    rows = seen["rows"] if own_limits or limit != 0 else 0
    visited = 0
    levels: list[DataFrame] = []
    while rows:
        if rules is not None:
            found = robots_ops.verdicts(found, rules, user_agent, rows=rows).filter("allowed").drop("allowed")
            found = settle(found, "crawl-allowed", rows)
        fetched = lookup(
            found,
            links.pages,
            "url",
            "page",
            spread=["source_id", "parent", "pos"],
            how="inner",
            rows=rows,
            narrow_right=True,
            light=True,
        )
        ranked = number_rows(
            settle(fetched, "crawl-fetched", rows),
            "source_id",
            "parent",
            ties=("pos", "url"),
            extra={"total": "_level_total"},
            chunk=PARENTS_PER_CHUNK,
            rows=rows,
        )
        level, seen = measure(
            ranked.select(*level_columns).filter(within_limit), f"crawl-level-{len(levels)}", **sizes
        )
        levels.append(level)
        visited += seen["rows"]
        if not seen["offers"]:
            break
        going = level.filter(goes_on).select("url", "parts", *onward_columns)
        going = going.select(page_part.alias("_from_part"), *onward_columns)
        onward = (
            lookup(
                going,
                links.parts,
                "_from_part",
                "page_part",
                spread=["source_id", "ord"],
                how="inner",
                rows=seen["rows"] if is_small(seen["offers"]) else None,
                narrow_right=True,
            )
            .select(*onward_columns, F.explode("links").alias("link"))
        )
        rows = None if seen["unknown"] else seen["offers"]
        if own_hosts is None:
            onward = onward.filter(accepted)
        else:
            onward = host_rules.keep_accepted(
                onward, F.col("link.dst"), accepted, own_hosts, spread=[F.col("ord"), F.col("link.pos")], rows=rows
            )
        onward = onward.select(*offer_columns)
        history = reduce(DataFrame.unionByName, [x.select(*seen_columns) for x in levels])
        if is_small(rows) and not is_small(visited):
            # Few offers, long history: read the history without a shuffle.
            history = history.join(F.broadcast(onward.select("source_id", "url")), ["source_id", "url"], "left_semi")
        found = (
            onward.unionByName(history)
            .groupBy("source_id", "url")
            .agg(*first_offer)
            .filter(~F.col("_seen"))
            .select("source_id", "url", *shared, "base", "_from.parent", "_from.pos")
        )
        if not is_small(rows):
            found, seen = measure(found, f"crawl-found-{len(levels)}", rows=F.count("*"))
            rows = seen["rows"]
    visits = [
        x.select("source_id", "ord", F.lit(depth).cast("long").alias("depth"), "url")
        for depth, x in enumerate(levels)
    ]
    if not visits:
        return found.select("source_id", zero.alias("ord"), zero.alias("depth"), "url").filter(F.lit(False))
    return reduce(DataFrame.unionByName, visits)
