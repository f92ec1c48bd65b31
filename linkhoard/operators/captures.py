"""Which recorded exchange answers a request.

Two URLs that ask a server for the same thing have one request key (``functions.urls.request_key``): a fragment, a missing
final slash of a bare host, upper-case host names, user info and default ports make no difference. A table of responses may hold several
captures of a key. The latest by ``captured_at`` counts, if there is such a column (NULL is earliest); among equally late ones an
answer comes before a transport error, then a hash of the row decides, so that the choice never depends on the order of rows.

The choice is made on a narrow table without bodies. Bodies are read where they lie, when the captures wanted are known.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import request_key
from ..sources.tables import is_small, materialize, measure

BODY = "body"
CAPTURED_AT = "captured_at"
Payload = Callable[[DataFrame], DataFrame]


def _identity(responses: DataFrame) -> Column:
    """Name of a capture: rows that agree in all columns have one."""
    return F.concat_ws(" ", F.hex(F.xxhash64(*[F.col(c) for c in sorted(responses.columns)])), request_key(F.col("url")))


@dataclass(frozen=True)
class Captures:
    """Responses with the capture that counts for each request key.

    ``chosen`` has one row per key: ``_key``, ``_capture``, and the columns of the responses but ``url`` and ``body``.
    ``surplus`` is the number of rows that don't count.
    """

    responses: DataFrame
    chosen: DataFrame
    surplus: int
    by_text: bool = False

    def key(self, url: Column) -> Column:
        return url if self.by_text else request_key(url)

    @classmethod
    def of(cls, responses: DataFrame | Captures, by_text: bool = False) -> Captures:
        """With ``by_text`` the text of a URL is its key: for tables in which each text was recorded for itself."""
        if isinstance(responses, Captures):
            return responses
        light = [c for c in responses.columns if c not in ("url", BODY)]
        latest = F.col(CAPTURED_AT) if CAPTURED_AT in light else F.lit(0)
        answered = F.col("error_class").isNull() if "error_class" in light else F.lit(True)
        rank = F.struct(latest.alias("_at"), answered.alias("_answered"), _identity(responses).alias("_capture"), *light)
        best = responses.select((F.col("url") if by_text else request_key(F.col("url"))).alias("_key"), rank.alias("_best")).groupBy("_key")
        best = best.agg(F.max("_best").alias("_best"), F.count("*").alias("_rows"))
        chosen, seen = measure(best.select("_key", "_rows", "_best._capture", *[f"_best.{c}" for c in light]), "captures", rows=F.count("*"), all=F.sum("_rows"))
        return cls(responses, chosen.drop("_rows"), (seen["all"] or 0) - seen["rows"], by_text)

    def single(self) -> DataFrame:
        """The responses that count, with all their columns. Rows that agree in all columns are one."""
        if not self.surplus:
            return self.responses
        keyed = self.responses.withColumn("_capture", _identity(self.responses))
        counted = keyed.groupBy("_capture").agg(F.count("*").alias("_rows"))
        others = counted.join(self.chosen.select("_capture"), "_capture", "left_anti").select("_capture")
        twice = counted.filter("_rows > 1").select("_capture")
        surplus, seen = measure(others.withColumn("_twice", F.lit(False)).unionByName(twice.withColumn("_twice", F.lit(True))), "surplus-captures", rows=F.count("*"))
        # Few rows are surplus as a rule: then the responses are not moved, except for rows that stand there twice.
        surplus = F.broadcast(surplus) if is_small(seen["rows"]) else surplus
        marked = keyed.join(surplus, "_capture", "left")
        kept = marked.filter(F.col("_twice").isNull())
        repeated = marked.filter("_twice").dropDuplicates(["_capture"])
        return kept.unionByName(repeated).select(*self.responses.columns)

    def reader(self, payload: Payload) -> Callable[[DataFrame, int | None], DataFrame]:
        """A step from ``(_capture)`` and, if known, a bound on its rows to ``(_capture, payload)``.

        ``payload`` adds the column ``payload`` row by row. Bodies are never shuffled: few captures are sent to where the bodies
        lie; for many, the payloads of all responses are worked out there, once, and only they move.
        """
        keyed = self.responses.withColumn("_capture", _identity(self.responses))
        stored: list[DataFrame] = []

        def read(wanted: DataFrame, rows: int | None = None) -> DataFrame:
            if is_small(rows):
                found = payload(keyed.join(F.broadcast(wanted.distinct()), "_capture"))
                return found.select("_capture", "payload").dropDuplicates(["_capture"])
            if not stored:
                every = payload(keyed).select("_capture", "payload").dropDuplicates(["_capture"])
                stored.append(materialize(every, "payloads"))
            return stored[0]

        return read
