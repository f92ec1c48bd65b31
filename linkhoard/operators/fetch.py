"""Fetching from a table of recorded responses: one exchange, and redirect chains."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import http
from ..functions.urls import is_http_url, with_scheme
from ..sources.tables import measure
from .captures import Captures
from .lookup import lookup

MAX_REDIRECTS = 10
_HEADERS = ("code", "message", "location", "error_class", "error_message")


def fetch(
    requests: DataFrame, responses: DataFrame | Captures, url: str = "url", *, spread: list[str], rows: int | None = None
) -> DataFrame:
    """Left join of requests to the captures that count, on the request key; one exchange, no redirects followed.

    All columns of the responses but ``url`` and ``body`` are added.
    """
    captures = Captures.of(responses)
    answers = captures.chosen.drop("_capture").withColumnRenamed("_key", "_answer_key")
    keyed = requests.withColumn("_key", captures.key(F.col(url)))
    return lookup(keyed, answers, "_key", "_answer_key", spread=spread, rows=rows).drop("_key")


def failure_message(url: Column, error: Column, known: Column) -> Column:
    """Text for a failed request: the recorded error, or what is wrong with the answer."""
    return (
        F.when(error == "InvalidURIError", F.concat(F.lit("malformed URL or redirect at "), url))
        .when(~known, F.concat(F.lit("no response on record for "), url))
        .when(F.col("error_class").isNotNull(), F.concat_ws(", ", "error_class", "error_message"))
        .when(error.endswith("RedirectError"), F.concat(F.lit("cannot follow the redirect of "), url))
        .when(
            error == "UnknownResponseCodeError",
            F.concat(F.lit("unknown response code "), F.coalesce("code", F.lit("")), F.lit(" for "), url),
        )
        .otherwise(F.concat(F.lit("response code "), F.coalesce("code", F.lit("")), F.lit(" for "), url))
    )


def outcome_of(url: Column, known: Column, **rules: bool) -> Column:
    """Outcome of a looked-up request: a malformed URL or a missing response is an error."""
    return (
        F.when(~is_http_url(url), "InvalidURIError")
        .when(~known, "ClientError")
        .otherwise(http.outcome(F.col("code"), F.col("error_class"), **rules))
    )


def follow(requests: DataFrame, responses: DataFrame | Captures, *, rows: int | None = None, **options) -> DataFrame:
    """Answer each distinct ``url`` of ``requests`` once; see ``follower`` for options and result."""
    return follower(responses, **options)(requests, rows)


def follower(
    responses: DataFrame | Captures,
    *,
    payload: Callable[[DataFrame], DataFrame] | None = None,
    max_redirects: int = MAX_REDIRECTS,
    follow_redirects: bool = True,
    raise_on_http_error: bool = False,
) -> Callable[[DataFrame, int | None], DataFrame]:
    """A step that answers each distinct ``url`` of a table, following redirects.

    It takes the requests and, if known, an upper bound on their number, and returns
    ``(url, final_url, code, message, hops, error_class, error_message[, payload])``. A failed request
    has ``final_url`` and ``code`` NULL. ``payload`` adds a column ``payload`` computed from the
    response columns, where a chain ends. Bodies are read only for it, after the last hop and where they lie.

    Each hop is one join of the URLs still moving to the captures that count, without bodies. The loop ends when none is left, at the
    latest after ``max_redirects`` hops. A chain that comes back to a request of its own can only end
    as ``MaxRedirectError`` and does so at once.
    """
    captures = Captures.of(responses)
    read = None if payload is None else captures.reader(payload)
    missing = [F.lit(None).cast("string").alias(c) for c in _HEADERS if c not in captures.chosen.columns]
    answers = captures.chosen.select("*", *missing).select(
        F.col("_key").alias("_answer_key"), "_capture", *_HEADERS, F.lit(True).alias("_recorded")
    )

    known = F.coalesce(F.col("_recorded"), F.lit(False))
    outcome = outcome_of(
        F.col("at"), known, follow_redirects=follow_redirects, raise_on_http_error=raise_on_http_error
    )
    redirected = F.col("_outcome") == http.FOLLOW
    answered = F.col("_outcome") == http.RESPONSE
    endless = F.array_contains(F.array_append("trail", F.col("_key")), captures.key(F.col("_target")))
    failed = F.coalesce(
        F.when(redirected, http.redirect_error(F.col("location"))),
        F.when(redirected & ((F.col("hops") >= max_redirects) | endless), "MaxRedirectError"),
        F.when(~redirected & ~answered, F.col("_outcome")),
    )
    step_columns = [
        F.col("url"),
        F.when(answered, F.col("at")).alias("final_url"),
        F.when(answered, F.col("code")).alias("code"),
        F.when(answered, F.col("message")).alias("message"),
        F.when(F.col("_failed") == "MaxRedirectError", F.lit(max_redirects).cast("long")).otherwise(F.col("hops")).alias("hops"),
        F.col("_failed").alias("error_class"),
        F.when(F.col("_failed").isNotNull(), failure_message(F.col("at"), F.col("_failed"), known)).alias("error_message"),
        F.when(F.col("_failed").isNull(), F.col("_target")).alias("_next"),
        F.array_append("trail", F.col("_key")).alias("trail"),
        F.when(answered, F.col("_capture")).alias("_capture"),
    ]
    target = F.when(redirected, http.redirect_target(F.col("at"), F.col("location")))
    onward = [F.col("url"), F.col("_next").alias("at"), (F.col("hops") + 1).alias("hops"), F.col("trail")]
    moves = F.col("_next").isNotNull()

    first_columns = [
        F.col("url"),
        with_scheme(F.col("url")).alias("at"),
        F.lit(0).cast("long").alias("hops"),
        F.array().cast("array<string>").alias("trail"),
    ]

    def answer(requests: DataFrame, rows: int | None = None) -> DataFrame:
        asked = rows
        moving = requests.select("url").distinct().select(*first_columns)
        finished = []
        while True:
            found = lookup(
                moving.withColumn("_key", captures.key(F.col("at"))),
                answers,
                "_key",
                "_answer_key",
                spread=["url"],
                rows=rows,
                narrow_right=rows is not None,
                light=True,
            )
            step, seen = measure(
                found.withColumn("_outcome", outcome)
                .withColumn("_target", target)
                .withColumn("_failed", failed)
                .select(*step_columns),
                "hop",
                rows=F.count("*"),
                moving=F.count("_next"),
            )
            asked = seen["rows"] if asked is None else asked
            finished.append(step.filter(~moves).drop("_next", "trail"))
            rows = seen["moving"]
            if rows == 0:
                break
            moving = step.filter(moves).select(*onward)
        done = reduce(DataFrame.unionByName, finished)
        if read is None:
            return done.drop("_capture")
        payloads = read(done.select("_capture").filter(F.col("_capture").isNotNull()), asked)
        return lookup(done, payloads.withColumnRenamed("_capture", "_read"), "_capture", "_read", spread=["url"], rows=asked).drop("_capture")

    return answer
