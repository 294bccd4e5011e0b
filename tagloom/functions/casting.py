"""Lenient casts: a text that is no number gives null, as the sources expect."""

from __future__ import annotations

# 20 integer digits hold every bigint; 18 decimals are more than any amount carries
_WIDE_DECIMAL = "DECIMAL(38,18)"


def text(value: str) -> str:
    """A string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return text(value)
    return f"{value!r}D" if isinstance(value, float) else str(value)


def _whole_number(c: str, kind: str) -> str:
    """Only texts with a decimal point take the slower decimal parse, and no text without
    digits reaches the plain cast, where a failing parse is costly."""
    return (f"CASE WHEN contains({c}, '.') THEN try_cast(try_cast({c} AS {_WIDE_DECIMAL}) AS {kind}) "
            f"WHEN {c} <> '' THEN try_cast({c} AS {kind}) END")


def to_long(c: str) -> str:
    """Text column to bigint, dropping decimals."""
    return _whole_number(c, "BIGINT")


def to_int(c: str) -> str:
    return _whole_number(c, "INT")


def to_double(c: str) -> str:
    return f"try_cast({c} AS DOUBLE)"


def whole_id(c: str, kind: str = "BIGINT") -> str:
    """Text to an id; ids are whole numbers, anything else is null."""
    return f"try_cast({c} AS {kind})"


def suffix_id(c: str, digits: int | None) -> str:
    """Customer id from the last ``digits`` characters of a member id (None: all of it)."""
    return whole_id(c if digits is None else f"right({c}, {digits})")
