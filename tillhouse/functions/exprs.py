"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillhouse.schemas import MONEY


def money(c: Column | str) -> Column:
    return F.col(c).cast(MONEY) if isinstance(c, str) else c.cast(MONEY)


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """Exact half-up ``part / whole`` on counts; null when ``whole`` is 0."""
    d = "decimal(20,0)"
    return F.round(F.try_divide(part.cast(d), whole.cast(d)), digits).cast(f"decimal({digits + 14},{digits})")


def ratio(part: Column, whole: Column) -> Column:
    """Unrounded double ratio, 0 when ``whole`` is 0 (dashboard convention)."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def date_key(c: Column | str) -> Column:
    """20240131 for 2024-01-31."""
    return F.date_format(c, "yyyyMMdd").cast("int")


def week_start(c: Column | str) -> Column:
    return F.date_trunc("week", c).cast("date")


def month_start(c: Column | str) -> Column:
    return F.trunc(c, "month")


def strip(c: Column) -> Column:
    """Remove any leading and trailing whitespace; Spark's trim only removes blanks."""
    return F.regexp_replace(F.regexp_replace(c, r"^[\s\u001c-\u001f\u0085\p{Z}]+", ""), r"[\s\u001c-\u001f\u0085\p{Z}]+$", "")


def email_hash(c: Column) -> Column:
    """Hex SHA-256 of the stripped, lower-cased address; null stays null."""
    return F.sha2(F.lower(strip(c)), 256)


def contains_text(c: Column | str, text: str) -> Column:
    """Case-insensitive substring match; ``%`` and ``_`` in ``text`` match themselves."""
    column = F.col(c) if isinstance(c, str) else c
    return F.lower(column).contains(text.lower())


# Dashboard range presets as days and months.
RANGE_DAYS = {"7d": 7, "30d": 30, "90d": 90, "6mo": 180}
RANGE_MONTHS = {"7d": 1, "30d": 1, "90d": 3, "6mo": 6}
DEFAULT_RANGE = "30d"


def range_days(preset: str | None) -> int:
    return RANGE_DAYS.get(preset or DEFAULT_RANGE, RANGE_DAYS[DEFAULT_RANGE])


def range_months(preset: str | None) -> int:
    return RANGE_MONTHS.get(preset or DEFAULT_RANGE, RANGE_MONTHS[DEFAULT_RANGE])


def since_days(as_of: Column, days: int) -> Column:
    """First day of a window that reaches ``days`` days back from ``as_of``."""
    return F.date_sub(as_of.cast("date"), days)


def since_months(as_of: Column, months: int) -> Column:
    return F.add_months(as_of.cast("date"), -months)
