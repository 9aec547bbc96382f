"""Registry of queries and their DuckDB oracles, and SQL snippets the oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens.sources.standins import record_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, records: tuple[str, ...] | list[str] = (), ctes: str = ""):
    """Register a query; ``sql`` reads the test tables and the named ``records``."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            parts = [p for p in (record_sql(*records) if records else "", ctes) if p]
            ORACLES[name] = ("WITH " + ",\n".join(parts) + "\n" if parts else "") + sql
        return fn
    return add


def day(ms: str) -> str:
    """DuckDB: yyyy-MM-dd of epoch milliseconds."""
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%d')"


def moment(ms: str) -> str:
    """DuckDB: yyyy-MM-dd HH:mm:ss of epoch milliseconds."""
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%d %H:%M:%S')"


def window(ms: str, seconds: int) -> str:
    """DuckDB: start of a tumbling window."""
    return f"(({ms}) - ({ms}) % {seconds * 1000})"


def window_text(w: str, seconds: int) -> str:
    """DuckDB: the three window columns."""
    return f"{moment(w)} AS stt, {moment(f'{w} + {seconds * 1000}')} AS edt, {day(w)} AS cur_date"
