"""Options of an archiving run."""

from __future__ import annotations

import re
from dataclasses import dataclass

STRATEGIES = ("auto", "crawl", "sitemap", "urls", "url")
NO_LIMIT = -1


@dataclass(frozen=True)
class Options:
    """Everything a run can be told.

    ``hosts`` holds exact names (``str``) and patterns (``re.Pattern``, Java syntax) that a crawl
    may visit besides the start host. ``limit`` bounds the URLs submitted for each source.
    ``concurrency`` is the number of tasks that call an adapter function, ``None`` that of the session.
    """

    strategy: str = "auto"
    hosts: tuple[str | re.Pattern, ...] = ()
    concurrency: int | None = None
    limit: int = NO_LIMIT
    user_agent: str = "linkhoard/0.1"
    respect_robots_txt: bool = False
    max_redirects: int = 10
    dedupe: bool = False

    def __post_init__(self) -> None:
        if self.strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy {self.strategy!r}, expected one of {', '.join(STRATEGIES)}")
        if self.concurrency is not None and self.concurrency < 1:
            raise ValueError("concurrency must be at least 1")
        check_limit(self.limit)
        if self.max_redirects < 0:
            raise ValueError("max_redirects must not be negative")


def check_limit(limit: int | None) -> int:
    """``-1`` or ``None`` mean no limit; anything below ``-1`` is an error."""
    if limit is None:
        return NO_LIMIT
    if limit < NO_LIMIT:
        raise ValueError("limit must be -1 (no limit) or not negative")
    return limit
