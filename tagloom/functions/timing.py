"""Date and epoch arithmetic. The session zone is UTC (see ``session``)."""

from __future__ import annotations

from tagloom.functions.casting import to_double

SECONDS_PER_DAY = 86400


def birth_year(c: str) -> str:
    return f"year(try_cast({c} AS DATE))"


def month_day(c: str) -> str:
    """month * 100 + day, so that calendar ranges become numeric ranges."""
    return f"month(try_cast({c} AS DATE)) * 100 + dayofmonth(try_cast({c} AS DATE))"


def to_timestamp(c: str) -> str:
    """Text or wall-clock timestamp to timestamp; null stays null."""
    return f"CAST(try_cast({c} AS TIMESTAMP_NTZ) AS TIMESTAMP)"


def epoch_seconds(c: str) -> str:
    return f"unix_seconds({to_timestamp(c)})"


def epoch_micros(c: str) -> str:
    return f"unix_micros({to_timestamp(c)})"


def hour_of(c: str) -> str:
    return f"hour({to_timestamp(c)})"


def epoch_date(seconds: str) -> str:
    return f"CAST(timestamp_seconds({seconds}) AS DATE)"


def days_between(later: str, earlier: str) -> str:
    """Calendar days between two epochs."""
    return f"datediff({epoch_date(later)}, {epoch_date(earlier)})"


def recency_days(as_of: str, seconds: str) -> str:
    """Calendar days from an epoch to the reference date."""
    return f"datediff(DATE'{as_of}', {epoch_date(seconds)})"


def days_since(as_of: str, seconds_text: str) -> str:
    """Fractional days from an epoch text to midnight of the reference date."""
    return f"(unix_seconds(TIMESTAMP'{as_of}') - {to_double(seconds_text)}) / {SECONDS_PER_DAY}"
