"""Crawling rules as operators: what a response means, which links are followed, how fast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import registrable_host, same_site

# Phrases of a maintenance page, classes of status codes, the least body.
MAINTENANCE = [r"site\s+(?:is\s+)?(?:down|unavailable)\s+for\s+maintenance", r"scheduled\s+maintenance", r"temporarily\s+unavailable", r"service\s+unavailable", r"please\s+try\s+again\s+later", r"request\s+blocked"]
LIMITED = [429, 503]
RETRYABLE = [408, 425, 429, 500, 502, 503, 504, 507, 522, 524]
FATAL = [400, 401, 403, 404, 405, 410, 451]
LEAST_BODY = 512
MARKED_BYTES = 20_000


def classify_response(status: Column, body: Column) -> Column:
    """rate_limited, fetch, unavailable, or null where a response is fine or fatal."""
    raw = F.coalesce(body.cast("binary"), F.lit("").cast("binary"))
    # one byte a character, so that white space and case stay those of ASCII
    head = F.decode(F.substring(raw, 1, MARKED_BYTES), "ISO-8859-1")
    empty = (F.octet_length(raw) < LEAST_BODY) | head.rlike(f"(?i)(?:{'|'.join(MAINTENANCE)})")
    return F.when(status.isin(LIMITED), "rate_limited").when(status.isin(RETRYABLE), "fetch").when(status.isin(FATAL), F.lit(None)).when(status.between(200, 299) & empty, "unavailable")


def accepted_links(links: DataFrame, seen: DataFrame, max_depth: int, allowed_host: str = "") -> DataFrame:
    """Links (ord, url, priority, depth) that a frontier takes: not too deep, on the allowed site,
    not seen before; of equal ones the first. A link refused for depth or site is not seen."""
    d = links.where(F.col("depth") <= max_depth)
    if allowed_host:
        d = d.where(same_site(registrable_host(F.col("url")), F.lit(allowed_host)))
    d = d.join(seen.select("url").distinct(), "url", "left_anti")
    return d.groupBy("url").agg(F.min(F.struct("ord", "priority", "depth")).alias("m")).select("url", "m.ord", "m.priority", "m.depth")


def drained(accepted: DataFrame, limit: int) -> DataFrame:
    """The first links to be fetched: by priority, then in the order they were found."""
    if limit < 0:
        raise ValueError("limit cannot be negative")
    return accepted.orderBy(F.desc("priority"), F.asc("ord")).limit(limit)


def with_policy(hosts: DataFrame, policies: DataFrame, per_minute: int = 30, off_start: int = 0, off_end: int = 5, multiplier: float = 1.5) -> DataFrame:
    """Hosts with their politeness policy, or the defaults where they have none."""
    default = {"requests_per_minute": F.lit(per_minute), "off_start": F.lit(off_start), "off_end": F.lit(off_end), "multiplier": F.lit(multiplier)}
    return hosts.join(policies, "host", "left").withColumns({c: F.coalesce(c, v) for c, v in default.items()})


def budget_at(hour: Column) -> Column:
    """Requests a minute at a local hour; the window of other speed may pass midnight."""
    a, b, n = F.col("off_start"), F.col("off_end"), F.col("requests_per_minute")
    inside = F.when(a <= b, (hour >= a) & (hour < b)).otherwise((hour >= a) | (hour < b))
    return F.when(inside, F.greatest(F.lit(1), F.floor(n * F.col("multiplier")).cast("int"))).otherwise(n)


def delay_for(attempt: Column, base: float = 1.0, multiplier: float = 2.0, most: float = 60.0) -> Column:
    """Seconds before an attempt (from 1), without jitter; the first never waits."""
    return F.when(attempt <= 1, 0.0).otherwise(F.least(F.lit(most), base * F.pow(F.lit(multiplier), attempt - 2)))
