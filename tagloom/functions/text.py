"""Text, list and ratio helpers."""

from __future__ import annotations

from tagloom.functions.casting import text
from tagloom.labels import PRODUCT_END, PRODUCT_START


def product_id(url: str) -> str:
    """Text between the first ``/product/`` and the first ``.html`` of a page address."""
    head = f"substring_index({url}, {text(PRODUCT_END)}, 1)"
    start = f"nullif(instr({head}, {text(PRODUCT_START)}), 0)"
    return (f"CASE WHEN contains({url}, {text(PRODUCT_END)}) "
            f"THEN substr({head}, {start} + {len(PRODUCT_START)}) END")


def share(part: str, total: str) -> str:
    """part / total, null for an empty total."""
    return f"try_divide(CAST({part} AS DOUBLE), CAST({total} AS DOUBLE))"


def share_3_decimals(part: str, total: str) -> str:
    """part / total of two counts cut (not rounded) to three decimals, in whole-number arithmetic."""
    return f"(({part}) * 1000 DIV nullif({total}, 0)) / 1000D"


def split_to_columns(c: str, names: list[str], separator: str = ",") -> list[str]:
    """List text to one column per position; missing positions are null."""
    return [f"get(split({c}, {text(separator)}), {i}) AS {name}" for i, name in enumerate(names)]


def explode_list(c: str, separator: str = ",") -> str:
    return f"explode(split({c}, {text(separator)}))"


def join_field(items: str, field: str, separator: str = ",") -> str:
    """One field of an array of structs as a joined text, in array order."""
    return f"array_join(transform({items}, x -> CAST(x.{field} AS STRING)), {text(separator)})"


def join_distinct(values: str, separator: str = ",") -> str:
    """Values of a group, already distinct, as a sorted, joined text without nulls.

    A list, not a set: over a set Spark would drop the preceding distinct as redundant
    and collect the raw rows of a hot key in one task instead.
    """
    return f"array_join(array_sort(collect_list({values})), {text(separator)})"


def join_set(values: str, separator: str = ",") -> str:
    """``join_distinct`` of values that may repeat: repeats are removed in every task before the shuffle."""
    return f"array_join(array_sort(collect_set({values})), {text(separator)})"
