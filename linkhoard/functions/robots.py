"""robots.txt columns. A document is parsed inside its own row with array functions, so no
lines are shuffled; explode the arrays only where a long table is wanted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import urls

# The document assumed when none is served, directive names (case-sensitive).
DEFAULT_DOCUMENT = "User-agent: *\nAllow: /\n"
AGENT, ALLOW, DISALLOW, DELAY, SITEMAP = "User-agent", "Allow", "Disallow", "Crawl-delay", "Sitemap"

ANY_AGENT = ".*"
NEVER = "(?!)"


def is_accepted(code: Column, message: Column, content_type: Column) -> Column:
    """A document counts only as plain text with status ``200 OK``."""
    media_type = F.lower(urls.strip(F.substring_index(content_type, ";", 1)))
    return F.coalesce((media_type == "text/plain") & (code == "200") & (message == "OK"), F.lit(False))


def accepted_text(code: Column, message: Column, content_type: Column, body: Column) -> Column:
    return F.coalesce(
        F.when(is_accepted(code, message, content_type), body.cast("string")), F.lit(DEFAULT_DOCUMENT)
    )


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def entries(text: Column) -> Column:
    """``array<struct<line_no, key, value>>`` of the lines that are neither blank nor comments.

    The key is everything before the first colon, untrimmed. A line without a colon keeps its
    line break in the key, and so matches no directive unless it is the unterminated last line.
    """

    def numbered(lines: Column) -> Column:
        last = F.size(lines)

        def entry(line: Column, index: Column) -> Column:
            closed = index + 1 < last
            # Trailing colons of an unterminated line belong to no field.
            line = F.when(closed, line).otherwise(F.regexp_replace(line, ":+$", ""))
            colon = F.instr(line, ":")
            key = F.when(colon > 0, F.substring(line, F.lit(1), colon - 1)).otherwise(
                F.concat(line, F.when(closed, "\n").otherwise(""))
            )
            value = F.when(colon > 0, urls.strip(F.substring(line, colon + 1, F.length(line)))).otherwise("")
            return F.struct(
                (index + 1).cast("long").alias("line_no"), key.alias("key"), value.alias("value"), line.alias("line")
            )

        return F.transform(lines, entry)

    kept = F.filter(_with(F.split(text, "\n", -1), numbered), lambda e: ~e["line"].rlike(r"\A\s*(#|\z)"))
    return F.transform(kept, lambda e: F.struct(e["line_no"], e["key"], e["value"]))


def pattern(value: Column) -> Column:
    """Start-anchored regular expression of a rule: ``*`` is a wildcard, all else is literal."""
    escaped = F.regexp_replace(value, r"([\[\]{}()|\-.\\?+^$#\s])", r"\\$1")
    return F.when(value == "", NEVER).otherwise(F.concat(F.lit("^"), F.replace(escaped, F.lit("*"), F.lit(".*"))))


def directives(entries_: Column) -> Column:
    """``array<struct<agent_pattern, line_no, key, value>>`` of the entries other than ``User-agent`` lines, each with the last agent before it.

    The document is cut at its agents and every agent takes the slice behind it, so the time grows with the number of lines.
    """
    none = F.struct(F.lit(-1).alias("at"), F.lit(ANY_AGENT).alias("pattern"))
    agents = F.transform(
        entries_, lambda e, i: F.when(e["key"] == AGENT, F.struct(i.alias("at"), pattern(e["value"]).alias("pattern")))
    )
    cuts = F.concat(F.array(none), F.filter(agents, lambda a: a.isNotNull()))

    def sections(document: Column) -> Column:
        lines, cuts_ = document["lines"], document["cuts"]

        def section(cut: Column, k: Column) -> Column:
            end = F.coalesce(F.get(cuts_, k + 1)["at"], F.size(lines))
            return F.transform(
                F.slice(lines, cut["at"] + 2, end - cut["at"] - 1),
                lambda e: F.struct(cut["pattern"].alias("agent_pattern"), e["line_no"], e["key"], e["value"]),
            )

        return F.flatten(F.transform(cuts_, section))

    return _with(F.struct(entries_.alias("lines"), cuts.alias("cuts")), sections)


def rules(directives_: Column) -> Column:
    """``array<struct<line_no, agent_pattern, directive, path_pattern, prefix>>``.

    A rule belongs to the last ``User-agent`` line before it. ``prefix`` holds the literal text
    of a rule without wildcard, which is tested without a regular expression.
    """
    return F.transform(
        F.filter(directives_, lambda e: e["key"].isin(ALLOW, DISALLOW)),
        lambda e: F.struct(
            e["line_no"],
            e["agent_pattern"],
            e["key"].alias("directive"),
            pattern(e["value"]).alias("path_pattern"),
            F.when((e["value"] != "") & ~e["value"].contains("*"), e["value"]).alias("prefix"),
        ),
    )


def delays(directives_: Column) -> Column:
    """``array<struct<line_no, agent_pattern, delay_s>>`` of all ``Crawl-delay`` lines."""

    def leading_integer(value: Column) -> Column:
        digits = F.regexp_extract(value, r"^[+-]?\d+", 0)
        largest = F.lit((1 << 63) - 1)
        too_large = F.when(digits.startswith("-"), -largest).when(digits != "", largest).otherwise(F.lit(0).cast("long"))
        return F.coalesce(digits.try_cast("long"), too_large)

    return F.transform(
        F.filter(directives_, lambda e: e["key"] == DELAY),
        lambda e: F.struct(e["line_no"], e["agent_pattern"], leading_integer(e["value"]).alias("delay_s")),
    )


def last_per_agent(delays_: Column) -> Column:
    """A later line for an agent replaces an earlier one. The delays are sorted by agent, so each is compared with its successor only."""

    def last_ones(ordered: Column) -> Column:
        return F.filter(ordered, lambda d, k: ~F.coalesce(F.get(ordered, k + 1)["agent_pattern"] == d["agent_pattern"], F.lit(False)))

    by_agent = F.sort_array(F.transform(delays_, lambda d: F.struct(d["agent_pattern"], d["line_no"], d["delay_s"])))
    return F.sort_array(F.transform(_with(by_agent, last_ones), lambda d: F.struct(d["line_no"], d["agent_pattern"], d["delay_s"])))


def others(entries_: Column) -> Column:
    """Entries whose key is no rule directive, e.g. ``Sitemap``."""
    return F.filter(entries_, lambda e: ~e["key"].isin(AGENT, ALLOW, DISALLOW, DELAY))


def sitemaps(entries_: Column) -> Column:
    return F.transform(F.filter(entries_, lambda e: e["key"] == SITEMAP), lambda e: e["value"])


def for_agent(rules_: Column, user_agent: str) -> Column:
    """Only the rules whose agent pattern matches the user agent."""
    return F.filter(rules_, lambda r: F.rlike(F.lit(user_agent), r["agent_pattern"]))


def is_allowed(path: Column, rules_: Column) -> Column:
    """No disallow rule matches, or some allow rule does; NULL rules allow everything."""

    def hit(directive: str) -> Column:
        return F.exists(
            rules_,
            lambda r: (r["directive"] == directive)
            & F.when(r["prefix"].isNotNull(), F.startswith(path, r["prefix"])).otherwise(
                F.rlike(path, r["path_pattern"])
            ),
        )

    return F.coalesce(~hit(DISALLOW) | hit(ALLOW), F.lit(True))
