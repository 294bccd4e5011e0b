"""The expressions of ``functions`` as SQL functions, for users who write SQL only.

They are defined in SQL, so Spark inlines them: the optimizer sees the expressions themselves, nothing
runs in Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from tagloom.functions.casting import suffix_id, to_long
from tagloom.functions.text import join_field, product_id, share_3_decimals
from tagloom.functions.timing import days_between, epoch_seconds, hour_of


@dataclass(frozen=True)
class SqlFunction:
    """``takes``: parameters with types; ``gives``: a type or a table; ``body``: an expression or a query."""

    name: str
    takes: str
    gives: str
    body: str

    def definition(self, kind: str) -> str:
        return f"CREATE OR REPLACE {kind}FUNCTION {self.name}({self.takes}) RETURNS {self.gives} RETURN {self.body}"


FUNCTIONS = [
    SqlFunction("product_id", "url STRING", "STRING", product_id("url")),
    SqlFunction("share_3_decimals", "part BIGINT, total BIGINT", "DOUBLE", share_3_decimals("part", "total")),
    SqlFunction("epoch_of", "at STRING", "BIGINT", epoch_seconds("at")),
    SqlFunction("hour_of", "at STRING", "INT", hour_of("at")),
    SqlFunction("days_between", "later BIGINT, earlier BIGINT", "INT", days_between("later", "earlier")),
    SqlFunction("member_id", "member STRING", "BIGINT", suffix_id("member", None)),
    SqlFunction("whole_number", "amount STRING", "BIGINT", to_long("amount")),
    SqlFunction("recommended_items", "items ARRAY<STRUCT<item: BIGINT, score: DOUBLE>>", "STRING", join_field("items", "item")),
    SqlFunction("list_items", "list STRING", "TABLE(place INT, item STRING)", "SELECT place, item FROM posexplode(split(list, ',')) AS t(place, item)"),
]


def register_functions(spark: SparkSession, permanent: bool = False) -> list[str]:
    """Names of the functions, now known to the session; ``permanent`` stores them in its catalogue."""
    for function in FUNCTIONS:
        spark.sql(function.definition("" if permanent else "TEMPORARY "))
    return [function.name for function in FUNCTIONS]
