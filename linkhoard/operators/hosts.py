"""Hosts that a crawl may visit besides the start host, source by source.

A source lists its rules in an array ``hosts`` of strings:

* ``name`` accepts that host,
* ``.name`` accepts that host and all below it,
* ``/pattern/`` accepts hosts in which the pattern (Java syntax) finds a match.

Names are compared without letter case; NULL and blank entries say nothing. A pattern that can't be compiled fails the run.

Rules are found through an index over the last labels of a host. A host asks for its own last labels, at most ``LABELS`` of them, and for the
empty key; a rule lies under the last labels that any accepted host must end with. Only patterns that tell no such labels lie under the empty key.
Every rule found is then tried on the host, so the index decides nothing but what is tried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..sources.tables import is_small, materialize, measure, settle
from .lookup import lookup

LABELS = 8
# A pattern ends in these labels for certain: escaped dots and letters up to the end, no alternative and no comment.
_TAIL = r"^[^|#]*?(?<!\\)((?:\\\.[A-Za-z0-9-]+)+)\$$"


def _last_labels(name: Column, n: int | Column) -> Column:
    labels = F.split(name, r"\.", -1)
    n = F.least(F.lit(n), F.size(labels))
    return F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")


def _keys(host: Column) -> Column:
    """Keys a host asks for: its last 1 to ``LABELS`` labels, and the empty one."""
    last = F.split(_last_labels(host, LABELS), r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(last)), lambda k: F.array_join(F.slice(last, k, F.size(last)), ".")
    )
    return F.array_distinct(F.concat(suffixes, F.array(F.lit(""))))


def _place(source_id: Column, key: Column) -> Column:
    """Text of a source and a key; NULL is a source like any other."""
    return F.concat(F.coalesce(source_id.cast("string"), F.lit("null")), F.lit("\n"), key)


def index(sources: DataFrame) -> DataFrame | None:
    """``(place, rules)`` of ``(source_id, hosts)``, one row per source and key; None if no source has a rule."""
    rule = F.trim(F.col("rule"))
    kind = F.when(rule.rlike("(?s)^/.*/$") & (F.length(rule) > 1), "pattern").when(rule.startswith("."), "below").otherwise("exact")
    text = (
        F.when(kind == "pattern", F.substring(rule, F.lit(2), F.length(rule) - 2))
        .when(kind == "below", F.lower(F.substring(rule, F.lit(2), F.length(rule))))
        .otherwise(F.lower(rule))
    )
    given = sources.select("source_id", F.explode("hosts").alias("rule")).filter(rule != "")
    given = given.select("source_id", kind.alias("kind"), text.alias("text")).filter("text != ''")
    tail = F.lower(F.substring(F.replace(F.regexp_extract("text", _TAIL, 1), F.lit("\\."), F.lit(".")), 2, 1 << 30))
    key = F.when(F.col("kind") == "pattern", F.when(tail == "", "").otherwise(_last_labels(tail, LABELS))).otherwise(
        _last_labels(F.col("text"), LABELS)
    )
    rules = given.groupBy(_place(F.col("source_id"), key).alias("place")).agg(
        F.collect_set(F.struct("kind", "text")).alias("rules")
    )
    table, seen = measure(rules, "host-rules", rows=F.count("*"))
    return table if seen["rows"] else None


def _accepts(rules: Column, host: Column) -> Column:
    """True if one of the rules accepts the host."""
    name = F.lower(host)
    return F.exists(
        rules,
        lambda r: F.when(r["kind"] == "pattern", F.rlike(host, r["text"]))
        .when(r["kind"] == "below", (name == r["text"]) | name.endswith(F.concat(F.lit("."), r["text"])))
        .otherwise(name == r["text"]),
    )


def accepted(pairs: DataFrame, rules: DataFrame, *, rows: int | None = None) -> DataFrame:
    """Those of the distinct ``(source_id, host)`` that the source's own rules accept.

    ``rows`` is a known upper bound on the pairs. Pairs without a host are accepted by nothing.
    """
    pairs = pairs.select("source_id", "host").filter("host IS NOT NULL").distinct()
    asked = pairs.select("source_id", "host", F.explode(_keys(F.lower("host"))).alias("_key")).select(
        "source_id", "host", _place(F.col("source_id"), F.col("_key")).alias("_place")
    )
    many = None if rows is None else rows * (LABELS + 1)
    found = lookup(
        settle(asked, "host-keys", many), rules, "_place", "place", spread=["host"], how="inner", rows=many, narrow_right=True
    )
    return found.filter(_accepts(F.col("rules"), F.col("host"))).select("source_id", "host").distinct()


def keep_accepted(offers: DataFrame, url: Column, given: Column, rules: DataFrame, *, spread: list[Column], rows: int | None = None) -> DataFrame:
    """Offers that ``given`` accepts, and those on hosts that rules of their own source accept.

    Only hosts that ``given`` refuses are looked up, each once per source. ``rows`` is a known upper bound on the offers.
    """
    given = F.coalesce(given, F.lit(False))
    columns = offers.columns
    marked = offers.select(
        "*", given.alias("_given"), F.when(~given, U.host(url)).alias("_host"), F.xxhash64(*spread).alias("_spread")
    )
    marked = settle(marked, "host-offers", rows)
    strangers = marked.filter("NOT _given").select("source_id", F.col("_host").alias("host"))
    pair = _place(F.col("source_id"), F.col("_host"))
    wanted = accepted(strangers, rules, rows=rows).select(_place(F.col("source_id"), F.col("host")).alias("_pair"), F.lit(True).alias("_accepted"))
    if not is_small(rows):
        wanted = materialize(wanted, "hosts-accepted")
    told = lookup(marked.withColumn("_wanted", pair), wanted, "_wanted", "_pair", spread=["_spread"], rows=rows)
    return told.filter(F.col("_given") | F.coalesce("_accepted", F.lit(False))).select(*columns)
