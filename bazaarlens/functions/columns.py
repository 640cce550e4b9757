"""Small scalar and array expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Double division that gives NULL for a zero or NULL divisor."""
    return F.try_divide(col(top).cast("double"), col(bottom).cast("double"))


def half_even(c: Column | str, digits: int = 0) -> Column:
    """Round half to even, the rounding of floats in warehouse and frame libraries."""
    return F.bround(col(c), digits)


def blank_to(c: Column | str, default: str) -> Column:
    """NULL or empty string becomes ``default``."""
    return F.coalesce(F.nullif(col(c), F.lit("")), F.lit(default))


def has_items(c: Column | str) -> Column:
    return F.coalesce(F.size(col(c)) > 0, F.lit(False))


def has_tag(c: Column | str, tag: str) -> Column:
    """Array contains ``tag``, ignoring case."""
    return F.exists(col(c), lambda h: F.lower(h) == tag.lower())


def tag_set(tags: Iterable[str]) -> list[str]:
    return sorted({t.lower() for t in tags})


def matched_tags(c: Column | str, tags: Iterable[str]) -> Column:
    """Array items, original case and repeats kept, whose lower case is in ``tags``."""
    known = tag_set(tags)
    return F.filter(col(c), lambda h: F.lower(h).isin(known))


def has_any_tag(c: Column | str, tags: Iterable[str]) -> Column:
    known = tag_set(tags)
    return F.exists(col(c), lambda h: F.lower(h).isin(known))


def on_days(c: Column | str, first: str | date, days: int = 1) -> Column:
    """Half-open range on the raw timestamp, so that the scan can use it."""
    start = date.fromisoformat(str(first))
    end = start + timedelta(days=days)
    return (col(c) >= F.lit(start.isoformat()).cast("timestamp_ntz")) & (
        col(c) < F.lit(end.isoformat()).cast("timestamp_ntz")
    )


def since(c: Column | str, moment: str) -> Column:
    return col(c) >= F.lit(moment).cast("timestamp_ntz")


def trailing(c: Column | str, days: int, as_of: str) -> Column:
    """Rows of the ``days`` days before ``as_of``; the end is a parameter, never now()."""
    start = date.fromisoformat(as_of[:10]) - timedelta(days=days)
    return since(c, start.isoformat() + as_of[10:])


def cascade(steps: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """First true condition decides; NULL conditions count as false."""
    out = default if isinstance(default, Column) else F.lit(default)
    for cond, value in reversed(list(steps)):
        out = F.when(cond, value if isinstance(value, Column) else F.lit(value)).otherwise(out)
    return out


def band(c: Column | str, bands: Sequence[tuple[str, float, float | None]], default: str = "Unknown") -> Column:
    """Label of the inclusive band [low, high]; an open high is None; the last match wins."""
    number = col(c)
    steps = []
    for label, low, high in sorted(bands, key=lambda b: b[1], reverse=True):
        hit = number >= F.lit(low)
        steps.append((hit if high is None else hit & (number <= F.lit(high)), label))
    return cascade(steps, default)


def to_number(c: Column | str) -> Column:
    """Number or NULL when the text is none."""
    return col(c).try_cast("double")


def nth(c: Column | str, n: int, default: Column | None = None) -> Column:
    """n-th item (from 1) of an array, or the default."""
    item = F.try_element_at(col(c), F.lit(n))
    return item if default is None else F.coalesce(item, default)


def local_time(ms: Column | str, zone: str = "+07:00") -> Column:
    """Epoch milliseconds as wall-clock text in ``zone`` (UTC+7), whatever the session zone is."""
    utc = F.convert_timezone(F.current_timezone(), F.lit(zone), F.timestamp_millis(col(ms)).cast("timestamp_ntz"))
    return F.date_format(utc, "yyyy-MM-dd HH:mm:ss")


def clock(ms: Column | str) -> Column:
    """Milliseconds as HH:MM:SS; hours may pass 24."""
    seconds = F.floor(col(ms) / 1000)
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(seconds / 3600),
        F.floor(F.pmod(seconds, F.lit(3600)) / 60),
        F.pmod(seconds, F.lit(60)),
    )


def follower_tier(c: Column | str) -> Column:
    # The four follower tiers.
    return cascade(
        [(col(c) < 10_000, "1K-10K"), (col(c) < 100_000, "10K-100K"), (col(c) < 1_000_000, "100K-1M")],
        "1M+",
    )
