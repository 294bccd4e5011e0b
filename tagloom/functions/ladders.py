"""Code books and ladders given as data, compiled to one CASE or map expression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from tagloom.functions.casting import literal
from tagloom.labels import Bin, TextRule


def case(branches: Sequence[tuple[str, object]], default: object = None) -> str:
    whens = " ".join(f"WHEN {condition} THEN {literal(label)}" for condition, label in branches)
    return f"CASE {whens} ELSE {literal(default)} END" if whens else literal(default)


def _book(pairs) -> str:
    return "map(" + ", ".join(literal(x) for pair in pairs for x in pair) + ")"


def decode(c: str, book: Mapping[str, str], default: str) -> str:
    """Code to label by a small book; unknown code and null give the default."""
    return f"coalesce(try_element_at({_book(book.items())}, {c}), {literal(default)})"


def decode_position(c: str, book: Mapping[str, str]) -> str:
    """Position of a code in its book, ``len(book)`` for unknown codes and null."""
    return f"coalesce(try_element_at({_book(zip(book, range(len(book))))}, {c}), {len(book)})"


def decode_many(c: str, book: Mapping[str, Sequence[str]], default: str) -> str:
    """Many codes to one label."""
    return case([(f"{c} IN ({', '.join(literal(x) for x in codes)})", label) for label, codes in book.items()],
                default)


def _inside(c: str, b: Bin) -> str:
    bounds = {">=": b.ge, ">": b.gt, "<=": b.le, "<": b.lt}
    return " AND ".join(f"{c} {sign} {literal(x)}" for sign, x in bounds.items() if x is not None)


def bin_ladder(c: str, bins: Sequence[Bin], default: object = None) -> str:
    """Number to label; null and uncovered numbers give the default (possibly null)."""
    return case([(_inside(c, b), b.label) for b in bins], default)


def rung(value: float, bins: Sequence[Bin], default: object = None) -> object:
    """The label of one known number, for ladders over a small fixed domain."""
    for b in bins:
        if not ((b.ge is not None and value < b.ge) or (b.gt is not None and value <= b.gt)
                or (b.le is not None and value > b.le) or (b.lt is not None and value >= b.lt)):
            return b.label
    return default


def _matches(c: str, rule: TextRule) -> str:
    tests = [f"{c} LIKE {literal(p)}" for p in rule.like] + [f"{c} = {literal(x)}" for x in rule.equals]
    return " OR ".join(tests)


def text_ladder(c: str, rules: Sequence[TextRule], default: str) -> str:
    """Text to label by patterns; null gives the default."""
    return case([(_matches(c, r), r.label) for r in rules], default)


def text_position(c: str, rules: Sequence[TextRule]) -> str:
    """Position of the matching rule, ``len(rules)`` for the default."""
    return case([(_matches(c, r), i) for i, r in enumerate(rules)], len(rules))


def label_at(position: str, labels: Sequence[str]) -> str:
    """Label for a zero-based position."""
    return f"element_at(array({', '.join(literal(x) for x in labels)}), CAST({position} AS INT) + 1)"
