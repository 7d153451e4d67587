"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

NULL_TOKEN = "<NULL>"
UNIT_SEPARATOR = "\x1f"
DAYS_PER_MONTH = 30.4375


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Ratio; null where the denominator is null or not positive."""
    return F.when(denominator > 0, numerator / denominator)


def population_std(x: Column) -> Column:
    """Standard deviation with ddof 0; null below two observations."""
    return F.when(F.count(x) >= 2, F.stddev_pop(x))


def profile_std(x: Column) -> Column:
    """Standard deviation with ddof 1; 0.0 for a single observation."""
    return F.when(F.count(x) <= 1, F.when(F.count(x) == 1, 0.0)).otherwise(F.stddev_samp(x))


def month_index(date: Column) -> Column:
    """year * 12 + month."""
    return F.year(date) * 12 + F.month(date)


def in_window(event: Column, anchor: Column, months: int | None) -> Column:
    """Event on or after anchor minus ``months`` and strictly before the anchor; None is all history."""
    before = event < anchor
    return before if months is None else before & (event >= F.add_months(anchor, -months))


def month_is_complete(month_start: Column, anchor: Column) -> Column:
    """The month has ended before the anchor date."""
    return F.last_day(month_start) < anchor


def expected_months(anchor: Column, in_service: Column, months: int | None) -> Column:
    """Whole months from the later of service start and window start, the latter alone without a service start, to the month before the anchor's; null if none."""
    end = month_index(anchor) - 1
    start = month_index(in_service)
    if months is not None:
        start = F.greatest(start, month_index(F.add_months(anchor, -months)))
    n = end - start + 1
    return F.when(n > 0, n)


def normalize_space(text: Column) -> Column:
    """Lower case, white space collapsed and trimmed; null becomes empty."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\s]+", " ")))


def normalize_plain(text: Column) -> Column:
    """As normalize_space, but blank and null become null."""
    out = normalize_space(text)
    return F.when(out != "", out)


def tokens(text: Column) -> Column:
    """Runs of letters and digits."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def canonical(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(NULL_TOKEN))


def fingerprint(columns: Sequence[Column], digits: int = 64) -> Column:
    """SHA-256 of the canonical values joined by the unit separator."""
    return F.substring(F.sha2(F.concat_ws(UNIT_SEPARATOR, *[canonical(c) for c in columns]), 256), 1, digits)


def right_closed_bucket(x: Column, edges: Column) -> Column:
    """1-based bucket with bounds (e1, e2], the outer ones open; null stays null."""
    return F.when(x.isNotNull(), F.size(F.filter(edges, lambda e: e < x)) + 1)


def left_closed_bucket(x: Column, edges: Column) -> Column:
    """1-based bucket with bounds [e1, e2); null stays null."""
    return F.when(x.isNotNull(), F.size(F.filter(edges, lambda e: e <= x)) + 1)


def grid_cell(p: Column, steps: int = 1000) -> Column:
    """The largest k with k / steps <= p."""
    k = F.floor(p * steps)
    return F.when((k + 1) / float(steps) <= p, k + 1).when(k / float(steps) > p, k - 1).otherwise(k).cast("int")


def clip(x: Column, low: float, high: float) -> Column:
    return F.when(x < low, low).when(x > high, high).otherwise(x)


def logit(p: Column, eps: float = 1e-6) -> Column:
    q = clip(p, eps, 1 - eps)
    return F.log(q / (1 - q))
