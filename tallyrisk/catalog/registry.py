"""Named queries and, where SQL can say it, the same query as SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: Common table expressions of the SQL side: name to (names it needs, text).
_CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, text: str, needs: tuple[str, ...] = ()) -> None:
    _CTES[name] = (list(needs), text)


def sql(body: str, *needs: str) -> str:
    """The body behind the CTEs it needs."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for other in _CTES[name][0]:
                add(other)
            order.append(name)

    for name in needs:
        add(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in order) + "\n" + body


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and its SQL."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return register


def r(value: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison: noise first, then the digits shown."""
    value = F.col(value) if isinstance(value, str) else value
    return F.round(F.round(value, 9), digits)


def rs(value: str, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return f"round(round({value}, 9), {digits})"


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: r(c, digits) for c in columns})


def text_ts(column: Column | str) -> Column:
    """A timestamp as text with microseconds."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def text_ts_sql(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"
