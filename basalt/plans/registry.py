"""Registry of named queries: a Spark callable ``(spark, sf_dir) -> DataFrame``
and, where the result is expressible in SQL, the DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that its ``@register`` calls run."""
    from basalt.plans import (  # noqa: F401
        catalog_queries, io_queries, log_queries, manifest_queries, message_queries, metric_queries,
        profile_queries, sql_queries, stream_queries,
    )
